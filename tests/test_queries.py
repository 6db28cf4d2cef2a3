"""Every registered query against its SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from articleflow.plans import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare.compare(spark, con, SF, name).startswith("same")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["item_no", "line_no", "line"] and df.count() > 0

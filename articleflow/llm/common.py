"""What several text operators share: reading, learning splits, Arrow mapping, whole-table helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# A-Z to a-z and nothing else, on UTF-8 bytes.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a missing id counts as empty text, so bucket 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, nulls as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def add_columns(
    df: DataFrame,
    fields: list[T.StructField],
    make: Callable[[], Callable[..., Iterable]],
    inputs: list[str],
    keep: list[str] | None = None,
) -> DataFrame:
    """Append computed columns, one Arrow batch at a time.

    ``make`` runs once in each task and returns a function from the input arrays to the values
    of ``fields``. Columns of ``keep`` (default all) pass unchanged; a kept column with the name
    of a new one gives way to it.
    """
    names = [f.name for f in fields]
    keep = [c for c in (df.columns if keep is None else keep) if c not in names]
    types = [to_arrow_type(f.dataType) for f in fields]
    schema = T.StructType([df.schema[c] for c in keep] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            new = work(*(batch.column(c) for c in inputs))
            arrays = [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(new, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + arrays, names=keep + names)

    return df.select(*dict.fromkeys([*keep, *inputs])).mapInArrow(run, schema)


def most_frequent(df: DataFrame, n: str, size: int) -> DataFrame:
    """The rows with the largest counts ``n``, at most ``size`` of them.

    The cut is found from a histogram over the logarithm of the counts, which has a few thousand
    cells whatever the table; rows of the cell in which the limit falls stay out.
    """
    cell = F.floor(F.log(F.col(n).cast("double")) * 64)
    rows = df.where(F.col(n) > 0).groupBy(cell.alias("cell")).agg(F.count("*").alias("rows")).collect()
    total, cut = 0, None
    for r in sorted(rows, key=lambda r: -r["cell"]):
        total += r["rows"]
        if total > size:
            break
        cut = r["cell"]
    return df.where(F.lit(False) if cut is None else (F.col(n) > 0) & (cell >= cut))

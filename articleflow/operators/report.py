"""Digest lines, status table, counters and alerts.

Numbering reads its input twice, so verdicts should come from a stored table, as
they do after a run; see ``settle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articleflow.functions.text import cn_numeral, first_filled, text_of
from articleflow.operators.ordered import numbered

# Punctuation of digest lines, and the line of an empty day.
NUMBER_MARK = "、"
SOURCE_LINE = "（%s：%s）"
NOTHING_TODAY = "今日无新增相关资讯。"


def digest_lines(verdicts: DataFrame, pos: str, relevant_only: bool = True) -> DataFrame:
    """Three lines per article (title, summary, source), numbered from 1 by position.

    A day without articles has the single line that says so.
    """
    rows = verdicts.filter(F.col("label") == "TRUE") if relevant_only else verdicts
    rows = rows.select(pos, "title_out", "summary", "entity", "url")
    placed = numbered(rows, pos, "item_no")
    lines = [
        F.concat(cn_numeral(F.col("item_no")), F.lit(NUMBER_MARK), F.col("title_out")),
        F.col("summary"),
        F.format_string(SOURCE_LINE, first_filled(F.col("entity"), F.lit("Source")), text_of(F.col("url"))),
    ]
    body = placed.select("item_no", F.posexplode(F.array(*lines)).alias("k", "line")).select(
        "item_no", (F.col("k") + 1).cast("bigint").alias("line_no"), "line"
    )
    none = (
        rows.select(F.lit(1).alias("x")).limit(1)
        .agg(F.count("x").alias("n"))
        .filter(F.col("n") == 0)
        .select(
            F.lit(0).cast("bigint").alias("item_no"), F.lit(1).cast("bigint").alias("line_no"),
            F.lit(NOTHING_TODAY).alias("line"),
        )
    )
    return body.unionByName(none)


def status_table(verdicts: DataFrame, pos: str) -> DataFrame:
    shown = (
        F.when(F.col("label") == "TRUE", F.lit("Relevant"))
        .when(F.col("label") == "ERROR", F.lit("ERROR"))
        .otherwise(F.lit("Irrelevant"))
    )
    rows = verdicts.select(pos, "title", "url", shown.alias("status"), "m1_status", "m2_status")
    return numbered(rows, pos, "no").select("no", "title", "url", "status", "m1_status", "m2_status")


def run_counters(history: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One row: history rows, batch rows, relevant ones, errors. One aggregate, no join."""
    old = history.select(F.lit(True).alias("h"), F.lit(None).cast("string").alias("label"))
    new = verdicts.select(F.lit(False).alias("h"), F.col("label"))

    def n(condition: Column) -> Column:
        return F.count(F.when(condition, F.lit(1)))

    return old.unionByName(new).agg(
        n(F.col("h")).alias("total_all"),
        n(~F.col("h")).alias("total_new"),
        n(F.col("label") == "TRUE").alias("total_relevant"),
        n(F.col("label") == "ERROR").alias("total_errors"),
    )


def source_summary(collected: DataFrame, written: DataFrame) -> DataFrame:
    """Per source: rows collected and rows newly written."""
    both = collected.select("source", F.lit(0).alias("w")).unionByName(
        written.select("source", F.lit(1).alias("w"))
    )
    return both.groupBy("source").agg(
        F.count(F.when(F.col("w") == 0, F.lit(1))).alias("total_collected"),
        F.count(F.when(F.col("w") == 1, F.lit(1))).alias("new_items"),
    )


def alert_rollup(verdicts: DataFrame, pos: str, first: int = 10) -> DataFrame:
    """Whether any article raised an alert, and the first messages in input order."""
    message = F.concat(
        F.lit("Title: "), text_of(F.col("title")), F.lit("\nReason: "), F.col("reasoning")
    )
    head = (
        verdicts.filter(F.col("alert")).select(F.col(pos).alias("p"), message.alias("m"))
        .orderBy("p").limit(first)
    )
    listed = F.array_sort(F.collect_list(F.struct("p", "m")))
    return head.agg(
        (F.count("p") > 0).alias("alert"),
        F.array_join(F.transform(listed, lambda x: x["m"]), "\n").alias("messages"),
    )

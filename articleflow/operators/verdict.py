"""From raw scorer answers to labels, and back into the article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articleflow.functions import verdicts as V
from articleflow.functions.text import first_filled, text_of
from articleflow.operators.incremental import spread_join

# Bits of a filter that goes to all tasks, as a power of two: 32 MB.
FILTER_BITS = 28


def pair_answers(responses: DataFrame, key: str = "article_id") -> DataFrame:
    """One row per article with the raw answers of both models; a missing one is null.

    Answers repeated for one model: the first non-null by text order, so that the
    result does not depend on the order of rows.
    """
    return responses.groupBy(key).agg(
        *[F.min(F.when(F.col("model") == m, F.col("raw"))).alias(f"{m}_raw") for m in ("m1", "m2")]
    )


def answers(df: DataFrame, m1_raw: str = "m1_raw", m2_raw: str = "m2_raw") -> DataFrame:
    """Add the structs ``m1`` and ``m2`` with the scalars of each answer."""
    return df.withColumns({"m1": V.answer(F.col(m1_raw)), "m2": V.answer(F.col(m2_raw))})


def merge(df: DataFrame) -> DataFrame:
    """Label, texts, per-model audit columns and the alert flag.

    Expects ``title``, ``abstract``, ``content`` and the structs of :func:`answers`.
    """
    both_failed = (F.col("m1")["status"] == V.ERROR) & (F.col("m2")["status"] == V.ERROR)
    chosen = df.withColumn("_best", F.when(~both_failed, V.best_answer()))
    best = F.col("_best")

    def audit(m: str) -> dict[str, Column]:
        a = F.col(m)
        return {
            f"{m}_status": a["status"],
            f"{m}_is_relevant": a["is_relevant"],
            f"{m}_reason": a["reason"],
        }

    return chosen.withColumns(
        {
            "label": V.merged_label(),
            "confidence": F.coalesce(best["confidence"], F.lit(0.0)),
            "title_out": first_filled(best["title_cn"], text_of(F.col("title"))),
            "summary": V.report_summary(best["summary"], F.col("abstract"), F.col("content")),
            "reasoning": F.when(both_failed, F.lit(V.BOTH_FAILED)).otherwise(
                text_of(best["reasoning"])
            ),
            "alert": both_failed,
            **audit("m1"),
            **audit("m2"),
        }
    ).drop("_best", "m1", "m2")


def judged(articles: DataFrame, responses: DataFrame, article_key: str, key: str) -> DataFrame:
    """Articles with their merged verdict. An article without answers failed twice."""
    paired = articles.join(
        responses.withColumnRenamed(key, article_key), article_key, "left"
    )
    return merge(answers(paired)).drop("m1_raw", "m2_raw")


def evaluated(verdicts: DataFrame, keep: list[str]) -> DataFrame:
    """Input columns plus the five verdict columns, as text."""
    return verdicts.select(
        *keep, F.col("label").alias("is_relevant"),
        "m1_is_relevant", "m1_reason", "m2_is_relevant", "m2_reason",
    )


def keyword_prefilter(df: DataFrame, terms: list[str] | None = None) -> DataFrame:
    """Articles that mention any term, with how many do."""
    hits = V.matched_terms(F.col("title"), F.col("abstract"), F.col("content"), terms or V.KEYWORDS)
    return df.withColumn("matched", hits).filter(F.col("matched") > 0)


def term_words(text: Column) -> Column:
    """Words of a text in lower case: runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text_of(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def may_be_in(rows: DataFrame, few: DataFrame, key: str, count: int) -> DataFrame:
    """Rows whose key may be among the ``count`` keys of ``few``: all that are, and a small share of others.

    A bit is set for the hash of each key, and all tasks get the bits, at most 2 ** ``FILTER_BITS`` of them: 16 or
    more for a key, fewer only where a table has more keys than that allows, which lets more others through.
    """
    size = 1 << max(15, min(FILTER_BITS, (16 * count).bit_length()))
    slot = F.xxhash64(key).bitwiseAND(F.lit(size - 1))
    place = F.col("_slot").bitwiseAND(F.lit(63)).cast("int")
    word = F.shiftright("_slot", 6)
    ones = few.select(slot.alias("_slot")).select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), place).alias("_bits"))
    zeros = few.sparkSession.range(size >> 6).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    words = ones.union(zeros).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    blocks = words.groupBy(F.shiftright("_word", 9).alias("_block")).agg(F.array_sort(F.collect_list(F.struct("_word", "_bits"))).alias("_words"))
    blocks = F.broadcast(blocks.select("_block", F.transform("_words", lambda x: x["_bits"]).alias("_words")))
    placed = rows.withColumn("_slot", slot).withColumn("_block", F.shiftright("_slot", 15))
    at = F.shiftright("_slot", 6).bitwiseAND(F.lit(511)).cast("int")
    return placed.join(blocks, "_block").filter(F.getbit(F.get("_words", at), place) == 1).select(*rows.columns)


def keyword_table(articles: DataFrame, terms: DataFrame, pos: str, columns: list[str], term: str = "term") -> DataFrame:
    """Rows (pos, matched): how many of the terms an article holds, for articles that hold any.

    ``terms`` is a table of any size. A term is a run of whole words, of one or several; blanks and signs
    between words don't count, and terms that have the same words are one. The lengths of terms decide which
    runs of words are made from a text; each run is looked up once for an article, by an equi-join
    that spreads runs found in very many articles. Most runs are in no term: those that a filter over the terms
    tells apart are dropped before the join. ``pos`` names an article. Texts of ``columns`` follow each
    other; null texts are empty, and an empty term matches nothing.
    """
    known = terms.select(term_words(F.col(term)).alias("w")).filter(F.size("w") > 0)
    known = known.select(F.array_join("w", " ").alias("run"), F.size("w").alias("n")).distinct()
    lengths = {r.n: r["count"] for r in known.groupBy("n").count().collect()}  # a few small numbers
    if not lengths:
        return articles.select(pos, F.lit(0).cast("long").alias("matched")).limit(0)
    whole = articles.select(pos, term_words(F.concat_ws(" ", *(text_of(F.col(c)) for c in columns))).alias("w"))

    def runs(n: int) -> Column:
        starts = F.when(F.size("w") >= n, F.sequence(F.lit(1), F.size("w") - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.lit(n)), " "))

    made = whole.select(pos, F.explode(F.array_distinct(F.flatten(F.array(*(runs(n) for n in sorted(lengths)))))).alias("run"))
    few = known.select("run")
    found = spread_join(may_be_in(made, few, "run", sum(lengths.values())), few, ["run"], "left_semi")
    return found.groupBy(pos).agg(F.count("*").alias("matched"))

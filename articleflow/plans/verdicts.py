"""Queries over scorer answers, verdicts and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from articleflow.functions import verdicts as V
from articleflow.functions.text import cn_numeral as numeral
from articleflow.functions.text import title_short as short
from articleflow.operators import report as R
from articleflow.operators import verdict as J
from articleflow.operators.filters import lookback
from articleflow.operators.incremental import new_rows
from articleflow.operators.scoring import keyword_scorer, score, score_once, stored_answers
from articleflow.plans import fixtures as X
from articleflow.plans.incremental import RECENT_NEW
from articleflow.plans.registry import query
from articleflow.session import settle, work_dir


def judged(spark, sf_dir):
    return J.judged(X.articles(spark, sf_dir), X.responses(spark, sf_dir), "pos", "article_id")


# Answers of other shapes: a text flag, a number, a null, a list, and one that is no object.
SHAPES = X.STAGED + """,
shaped AS (
  SELECT pos, CASE pos % 10
      WHEN 0 THEN '{"is_relevant": "yes", "confidence_score": 0.5}'
      WHEN 1 THEN '{"is_relevant": 1}' WHEN 2 THEN '{"is_relevant": null, "reasoning": null}'
      WHEN 3 THEN '[true]' WHEN 4 THEN '{"is_relevant": "ERROR"}' WHEN 5 THEN '{"is_relevant": ""}'
      WHEN 6 THEN '{"is_relevant": []}' WHEN 7 THEN '{"confidence_score": 1}'
      WHEN 8 THEN 'text {"is_relevant": true, "reasoning": "r"} tail' ELSE NULL END AS m1_raw,
    CASE WHEN pos % 4 = 0 THEN '{"is_relevant": true, "title_cn": "T"}'
      WHEN pos % 4 = 1 THEN '{"is_relevant": false}' WHEN pos % 4 = 2 THEN '{broken' ELSE NULL END AS m2_raw
  FROM staged)"""


def shaped(spark, sf_dir):
    p = F.col("pos")
    m1 = {
        0: '{"is_relevant": "yes", "confidence_score": 0.5}', 1: '{"is_relevant": 1}',
        2: '{"is_relevant": null, "reasoning": null}', 3: "[true]", 4: '{"is_relevant": "ERROR"}',
        5: '{"is_relevant": ""}', 6: '{"is_relevant": []}', 7: '{"confidence_score": 1}',
        8: 'text {"is_relevant": true, "reasoning": "r"} tail',
    }
    m2 = {0: '{"is_relevant": true, "title_cn": "T"}', 1: '{"is_relevant": false}', 2: "{broken"}

    def pick(values, base):
        case = F.lit(None).cast("string")
        for k, v in values.items():
            case = F.when(p % base == k, F.lit(v)).otherwise(case)
        return case

    return X.staged(spark, sf_dir).select(
        "pos", "title", "abstract", "content", pick(m1, 10).alias("m1_raw"), pick(m2, 4).alias("m2_raw")
    )


@query(
    "parse_verdict",
    X.with_sql(
        X.RESPONSES + r""",
        objects AS (
          SELECT article_id, regexp_extract(m1_raw, '\{.*\}', 0, 's') AS a,
                 regexp_extract(m2_raw, '\{.*\}', 0, 's') AS b FROM responses),
        checked AS (
          SELECT article_id, coalesce(json_valid(a), false) AS m1_is_object,
                 coalesce(json_valid(b), false) AS m2_is_object,
                 CASE WHEN json_valid(a) THEN a ELSE '{}' END AS a,
                 CASE WHEN json_valid(b) THEN b ELSE '{}' END AS b FROM objects)""",
        """
        SELECT article_id, m1_is_object, coalesce(json_extract_string(a, '$.is_relevant'), '') AS m1_flag,
               m2_is_object, CAST(json_extract_string(b, '$.confidence_score') AS DOUBLE) AS m2_confidence
        FROM checked""",
    ),
)
def parse_verdict(spark, sf_dir):
    r = X.responses(spark, sf_dir).withColumns(
        {"a": V.parse_object(F.col("m1_raw")), "b": V.parse_object(F.col("m2_raw"))}
    )
    return r.select(
        "article_id", F.col("a").isNotNull().alias("m1_is_object"),
        F.coalesce(F.try_variant_get("a", "$.is_relevant", "string"), F.lit("")).alias("m1_flag"),
        F.col("b").isNotNull().alias("m2_is_object"),
        F.try_variant_get("b", "$.confidence_score", "double").alias("m2_confidence"),
    )


@query(
    "model_status",
    X.with_sql(
        X.VERDICTS,
        "SELECT pos, m1_status, m1_is_relevant, m1_reason, m2_status, m2_is_relevant, m2_reason FROM verdicts",
    ),
)
def model_status(spark, sf_dir):
    """From the long form: one row per article and model, paired again."""
    wide = X.responses(spark, sf_dir)
    long = wide.select(
        "article_id", F.inline(F.array(*[
            F.struct(F.lit(m).alias("model"), F.col(f"{m}_raw").alias("raw")) for m in ("m1", "m2")
        ]))
    ).filter(F.col("raw").isNotNull() | (F.col("model") == "m1"))
    a = J.answers(J.pair_answers(long))
    return a.select(
        F.col("article_id").alias("pos"),
        *[F.col(f"{m}.{f}").alias(f"{m}_{f}") for m in ("m1", "m2") for f in ("status", "is_relevant", "reason")],
    )


@query(
    "dual_verdict",
    X.with_sql(
        X.VERDICTS,
        """
        SELECT pos, label, confidence, title AS title_out, summary, reasoning, m1_status, m1_is_relevant,
               m1_reason, m2_status, m2_is_relevant, m2_reason, alert FROM verdicts""",
    ),
)
def dual_verdict(spark, sf_dir):
    return judged(spark, sf_dir).select(
        "pos", "label", "confidence", "title_out", "summary", "reasoning", "m1_status", "m1_is_relevant",
        "m1_reason", "m2_status", "m2_is_relevant", "m2_reason", "alert",
    )


@query(
    "verdict_label",
    X.with_sql(
        SHAPES,
        """
        SELECT pos,
          CASE WHEN k1 = 9 AND k2 = 3 THEN 'ERROR'
               WHEN k1 IN (0, 1) THEN 'FALSE' WHEN k1 = 4 THEN 'ERROR' WHEN k1 = 8 THEN 'TRUE'
               WHEN k2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS label,
          CASE k1 WHEN 0 THEN 'yes' WHEN 1 THEN '1' WHEN 4 THEN 'ERROR' WHEN 5 THEN '' WHEN 6 THEN '[]'
               WHEN 8 THEN 'True' ELSE 'None' END AS m1_is_relevant,
          CASE k1 WHEN 2 THEN 'None' WHEN 3 THEN 'Parse Error' WHEN 8 THEN 'r'
               WHEN 9 THEN 'Connection Failed' ELSE '' END AS m1_reason,
          CASE k2 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE 'None' END AS m2_is_relevant,
          k1 = 9 AND k2 = 3 AS alert
        FROM (SELECT pos, pos % 10 AS k1, pos % 4 AS k2 FROM shaped) s""",
    ),
)
def verdict_label(spark, sf_dir):
    return J.merge(J.answers(shaped(spark, sf_dir))).select(
        "pos", "label", "m1_is_relevant", "m1_reason", "m2_is_relevant", "alert"
    )


@query(
    "evaluated_rows",
    X.with_sql(
        X.VERDICTS,
        """
        SELECT title, abstract, content, url, entity, label AS is_relevant, m1_is_relevant, m1_reason,
               m2_is_relevant, m2_reason FROM verdicts""",
    ),
)
def evaluated_rows(spark, sf_dir):
    return J.evaluated(judged(spark, sf_dir), ["title", "abstract", "content", "url", "entity"])


@query(
    "report_fallback",
    X.with_sql(
        SHAPES,
        """
        SELECT pos, CASE WHEN k2 = 0 AND k1 NOT IN (0, 1, 4, 8) THEN 'T' ELSE title END AS title_out,
               CASE WHEN pos % 3 = 0 THEN substring(content, 1, 200) ELSE abstract END AS summary
        FROM (SELECT s.pos, s.pos % 10 AS k1, s.pos % 4 AS k2, title, abstract, content
              FROM shaped s JOIN staged t ON s.pos = t.pos) x""",
    ),
)
def report_fallback(spark, sf_dir):
    s = shaped(spark, sf_dir)
    s = s.withColumn("abstract", F.when(F.col("pos") % 3 != 0, F.col("abstract")))
    return J.merge(J.answers(s)).select("pos", "title_out", "summary")


PROMPT_SQL = (
    "'" + V.PROMPT_HEAD + "Title: ' || title || chr(10) || 'Abstract: ' || abstract || chr(10) "
    "|| 'Content Sample: ' || substring(content, 1, 1000)"
)


@query("prompt_column", X.with_sql(X.STAGED, f"SELECT pos, {PROMPT_SQL} AS prompt FROM staged"))
def prompt_column(spark, sf_dir):
    c = F.col
    return X.staged(spark, sf_dir).select(
        "pos", V.prompt(c("title"), c("abstract"), c("content")).alias("prompt")
    )


TERMS = ["worthless", "thouinor", "schlich", "mentai", "ciónue", "erthat"]
HITS = " + ".join(
    f"CAST(contains(lower(title || ' ' || abstract || ' ' || content), '{t}') AS BIGINT)" for t in TERMS
)


@query(
    "keyword_prefilter",
    X.with_sql(X.STAGED, f"SELECT pos, {HITS} AS matched FROM staged WHERE {HITS} > 0"),
)
def keyword_prefilter(spark, sf_dir):
    found = J.keyword_prefilter(X.staged(spark, sf_dir), TERMS)
    return found.select("pos", F.col("matched").cast("bigint").alias("matched"))


# Terms of two and three words, from the titles; every fifth document brings its own.
RUNS = X.STAGED + """,
named AS (SELECT pos, regexp_extract_all(lower(title), '[\\p{L}\\p{N}]+') AS w FROM staged WHERE pos % 5 = 0),
terms AS (
  SELECT DISTINCT array_to_string(list_slice(w, i, i + n - 1), ' ') AS run, n
  FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS i FROM named, (SELECT unnest([2, 3]) AS n) s)),
texts AS (SELECT pos, regexp_extract_all(lower(title || ' ' || content), '[\\p{L}\\p{N}]+') AS w FROM staged),
made AS (
  SELECT DISTINCT pos, array_to_string(list_slice(w, i, i + n - 1), ' ') AS run
  FROM (SELECT pos, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, (SELECT unnest([2, 3]) AS n) s))"""


@query("keyword_table", X.with_sql(RUNS, "SELECT pos, count(*) AS matched FROM made WHERE run IN (SELECT run FROM terms) GROUP BY pos"))
def keyword_table(spark, sf_dir):
    """A table of terms, as many as the titles give, against whole articles."""
    s = X.staged(spark, sf_dir)
    w = s.filter("pos % 5 = 0").select(J.term_words(F.col("title")).alias("w"))
    runs = [
        w.filter(F.size("w") >= n).select(F.explode(F.sequence(F.lit(1), F.size("w") - (n - 1))).alias("i"), "w").select(F.array_join(F.slice("w", F.col("i"), F.lit(n)), " - ").alias("term"))
        for n in (2, 3)
    ]
    return J.keyword_table(s, runs[0].union(runs[1]), "pos", ["title", "content"])


SCORED = " + ".join(f"CAST(contains(lower(p), '{t}') AS BIGINT)" for t in TERMS)


@query(
    "scorer_job",
    X.with_sql(
        X.STAGED,
        f"""
        SELECT pos, CASE WHEN h > 0 OR g THEN 'TRUE' ELSE 'FALSE' END AS label,
               CASE WHEN h > 0 THEN least(1.0, 0.25 * h) WHEN g THEN 0.25 ELSE 0.0 END::DOUBLE AS confidence,
               CAST(h AS VARCHAR) || ' terms' AS m1_reason
        FROM (SELECT pos, {SCORED} AS h, contains(lower(p), 'tion') AS g
              FROM (SELECT pos, {PROMPT_SQL} AS p FROM staged) a) b""",
    ),
)
def scorer_job(spark, sf_dir):
    c = F.col
    prompts = X.staged(spark, sf_dir).withColumns(
        {
            "prompt": V.prompt(c("title"), c("abstract"), c("content")),
            "content": F.substring("content", 1, 200),
        }
    ).select("pos", "title", "abstract", "content", "prompt")
    scored = score(prompts, {"m1": keyword_scorer(TERMS), "m2": keyword_scorer(["tion"])})
    return J.merge(J.answers(scored)).select("pos", "label", "confidence", "m1_reason")


@query(
    "scored_once",
    X.with_sql(
        X.STAGED,
        f"""
        SELECT pos, copy, CASE WHEN h > 0 OR g THEN 'TRUE' ELSE 'FALSE' END AS label,
               CAST(h AS VARCHAR) || ' terms' AS m1_reason, (SELECT 2 * count(DISTINCT {PROMPT_SQL}) FROM staged) AS asked
        FROM (SELECT pos, copy, {SCORED} AS h, contains(lower(p), 'tion') AS g
              FROM (SELECT pos, copy, {PROMPT_SQL} AS p FROM staged, (SELECT unnest([0, 1, 2]) AS copy) c) a) b""",
    ),
)
def scored_once(spark, sf_dir):
    """Every prompt three times, in two runs over a store of answers; ``asked`` is what the scorers were given in all."""
    c = F.col
    path = work_dir(spark, "scored-once")
    prompts = X.staged(spark, sf_dir).withColumns(
        {"prompt": V.prompt(c("title"), c("abstract"), c("content")), "copy": F.explode(F.array(*(F.lit(i) for i in range(3)))), "content": F.substring("content", 1, 200)}
    ).select("pos", "copy", "title", "abstract", "content", "prompt")
    prompts = settle(prompts, "prompts")
    scorers = {"m1": ("m1-1", keyword_scorer(TERMS)), "m2": ("m2-1", keyword_scorer(["tion"]))}
    score_once(prompts.filter("pos % 2 = 0 and copy < 2"), scorers, path, parts=2)
    scored = score_once(prompts, scorers, path, parts=1)
    asked = sum(stored_answers(spark, path, version).count() for version, _ in scorers.values())
    return J.merge(J.answers(scored)).select("pos", c("copy").cast("int").alias("copy"), "label", "m1_reason", F.lit(asked).cast("long").alias("asked"))


@query(
    "alert_rollup",
    X.with_sql(
        X.VERDICTS,
        """
        SELECT count(*) > 0 AS alert,
               coalesce(string_agg('Title: ' || title || chr(10) || 'Reason: ' || reasoning, chr(10) ORDER BY pos), '') AS messages
        FROM (SELECT * FROM verdicts WHERE alert ORDER BY pos LIMIT 10) x""",
    ),
)
def alert_rollup(spark, sf_dir):
    return R.alert_rollup(judged(spark, sf_dir), "pos")


@query(
    "run_counters",
    X.with_sql(
        X.VERDICTS,
        """
        SELECT (SELECT count(*) FROM history) AS total_all, count(*) AS total_new,
               count(*) FILTER (WHERE label = 'TRUE') AS total_relevant,
               count(*) FILTER (WHERE label = 'ERROR') AS total_errors FROM verdicts""",
    ),
)
def run_counters(spark, sf_dir):
    return R.run_counters(X.history(spark, sf_dir), judged(spark, sf_dir))


@query(
    "status_table",
    X.with_sql(
        X.VERDICTS,
        """
        SELECT row_number() OVER (ORDER BY pos) AS no, title, url,
               CASE label WHEN 'TRUE' THEN 'Relevant' WHEN 'ERROR' THEN 'ERROR' ELSE 'Irrelevant' END AS status,
               m1_status, m2_status FROM verdicts""",
    ),
)
def status_table(spark, sf_dir):
    kept = judged(spark, sf_dir).select("pos", "title", "url", "label", "m1_status", "m2_status")
    return R.status_table(settle(kept, "status"), "pos")


DIGIT = "substring('一二三四五六七八九', CAST({n} AS INT), 1)"
NUMERAL = (
    "CASE WHEN {n} < 1 OR {n} > 99 THEN CAST({n} AS VARCHAR) ELSE "
    "CASE WHEN {n} >= 20 THEN " + DIGIT.format(n="({n} // 10)") + " ELSE '' END || "
    "CASE WHEN {n} >= 10 THEN '十' ELSE '' END || "
    "CASE WHEN {n} % 10 > 0 THEN " + DIGIT.format(n="({n} % 10)") + " ELSE '' END END"
)


@query(
    "cn_numeral",
    X.with_sql(X.STAGED, f"SELECT pos, {NUMERAL.format(n='(pos % 131 - 5)')} AS numeral FROM staged"),
)
def cn_numeral(spark, sf_dir):
    return X.staged(spark, sf_dir).select("pos", numeral(F.col("pos") % 131 - 5).alias("numeral"))


@query(
    "title_short",
    X.with_sql(
        X.STAGED,
        """
        SELECT pos, CASE WHEN length(t) < 50 THEN t ELSE substring(t, 1, 47) || '...' END AS title
        FROM (SELECT pos, substring(title, 1, CAST(45 + pos % 8 AS INT)) AS t FROM staged) s""",
    ),
)
def title_short(spark, sf_dir):
    s = X.staged(spark, sf_dir)
    cut = F.substring("title", F.lit(1), (F.col("pos") % 8 + 45).cast("int"))
    return s.select("pos", short(cut).alias("title"))


def digest_sql(frame: str) -> str:
    return f"""
    placed AS (SELECT row_number() OVER (ORDER BY pos) AS item_no, * FROM {frame} WHERE label = 'TRUE'),
    lines AS (
      SELECT item_no, CAST(1 AS BIGINT) AS line_no, {NUMERAL.format(n='item_no')} || '、' || title AS line FROM placed
      UNION ALL SELECT item_no, 2, summary FROM placed
      UNION ALL SELECT item_no, 3, '（' || entity || '：' || url || '）' FROM placed)"""


EMPTY_DAY = """
    SELECT item_no, line_no, line FROM lines
    UNION ALL SELECT CAST(0 AS BIGINT), CAST(1 AS BIGINT), '今日无新增相关资讯。'
    WHERE NOT EXISTS (SELECT 1 FROM lines)"""


@query("digest_lines", X.with_sql(X.VERDICTS + "," + digest_sql("verdicts"), EMPTY_DAY))
def digest_lines(spark, sf_dir):
    kept = judged(spark, sf_dir).select("pos", "label", "title_out", "summary", "entity", "url")
    return R.digest_lines(settle(kept, "digest"), "pos")


DAILY = (
    X.VERDICTS + ","
    + RECENT_NEW.split("AS (SELECT * FROM articles WHERE published_on < DATE '2024-01-16'),", 1)[1]
    + ", daily AS (SELECT * FROM verdicts WHERE pos IN (SELECT pos FROM fresh)),"
)


@query("daily_digest", X.with_sql(DAILY + digest_sql("daily"), EMPTY_DAY))
def daily_digest(spark, sf_dir):
    """One day end to end: window, repeats, history, verdicts, digest."""
    recent = lookback(X.articles(spark, sf_dir), X.NOW)
    fresh = new_rows(recent, X.history(spark, sf_dir), "pos")
    verdicts = J.judged(fresh, X.responses(spark, sf_dir), "pos", "article_id")
    kept = verdicts.select("pos", "label", "title_out", "summary", "entity", "url")
    return R.digest_lines(settle(kept, "daily-digest"), "pos")

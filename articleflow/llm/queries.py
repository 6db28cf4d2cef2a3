"""The registered text queries; each derives its columns from the operator's own results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articleflow.llm import archive, bpe, chat, codes, decontaminate, dialogue, language, lm, quality, repeats, rollup, simhash, toxicity
from articleflow.llm.common import bucket, table
from articleflow.operators.incremental import spread_join
from articleflow.session import configure, settle, work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (bucket("doc_id", 5) == 0).alias("held_out"))
    model = language.fit(docs.where("not held_out"))
    return language.predict(docs, model, keep=["doc_id", "held_out"])


_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    "op4_decontaminate",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
    b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
    wins AS (
        SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS s
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
    ),
    places AS (
        SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM wins))
    ),
    found AS (SELECT p.r, p.i, p.n, q.item FROM places p JOIN wins q ON p.n = q.n AND p.s = q.s),
    words AS (
        SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT r, i, n FROM found))
        GROUP BY r
    ),
    items AS (
        SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY r
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
    """,
)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.benchmark_hits(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return hits.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_runs") > 0).alias("contaminated"),
    )


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model, keep=["doc_id"])


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = (bucket("doc_id", 5) == 0).alias("held_out")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out)
    labels = table(spark, sf_dir, "labels").where(bucket("doc_id", 5) != 0)
    model = toxicity.fit(docs.where("not held_out"), labels)
    return toxicity.score(docs, model, keep=["doc_id", "held_out"]).drop("toxic_passages")


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs, vocabulary, bpe.build_lexicon(docs, vocabulary), keep=["doc_id"])


@query(
    "op1_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS r FROM pages),
    s AS (
        SELECT *, sha1(html) AS hex, strlen(html) AS n,
               first_value(r) OVER w AS first_row, first_value(page_id) OVER w AS first_page
        FROM p WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST, r)
    ),
    bits AS (
        SELECT *, list_transform(range(0, 32), lambda i:
            ((16 * (instr('0123456789abcdef', hex[(i * 5) // 4 + 1]) - 1)
              + (CASE WHEN (i * 5) // 4 + 2 <= 40 THEN instr('0123456789abcdef', hex[(i * 5) // 4 + 2]) - 1 ELSE 0 END))
              >> (3 - (i * 5) % 4)) & 31) AS fives
        FROM s
    )
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(fives, lambda v: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[v + 1]), '') AS payload_digest,
           CASE WHEN r = first_row THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN r <> first_row THEN first_page END AS refers_to
    FROM bits
    """,
)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.archive(spark, table(spark, sf_dir, "pages")).drop("url", "record_id", "date")


@query("op6_repeats")
def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs, keep=["doc_id"], outputs="digest")


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = bucket("doc_id", 10) == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"), (~held_out).alias("train"))
    return lm.score(docs, "train", keep=["doc_id", "held_out"]).drop("bits_per_byte")


_COUNTS = r"""
    WITH d AS (
        SELECT doc_id, source, lang, coalesce(text, '') AS text,
               array_to_string(list_transform(list_filter(list_zip(l, range(1, len(l) + 1)), lambda x: list_position(l, x[1]) = x[2]), lambda x: x[1]), chr(10)) AS once
        FROM (SELECT *, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
    ),
    v AS (SELECT unnest([1, 2]) AS k),
    c AS (
        SELECT doc_id, source, lang, text, 'words-' || k AS version,
               len(regexp_extract_all(text, CASE WHEN k = 1 THEN '[^\x20\x09-\x0D]+' ELSE '[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]' END)) AS n,
               len(regexp_extract_all(once, CASE WHEN k = 1 THEN '[^\x20\x09-\x0D]+' ELSE '[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]' END)) AS r
        FROM d, v
    ),
    kept AS (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first_id FROM c)
    SELECT source, lang, version, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(r) AS BIGINT) AS n_tokens
    FROM kept WHERE doc_id = first_id OR first_id IS NULL GROUP BY ALL
"""


@query("op8_rollup", _COUNTS)
def op8_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in; exact copies are deleted but for the smallest id; of the others,
    those with repeated lines are counted anew without them; the deletes come a second time, before and after
    the first batches have gone into the running total."""
    once = F.array_join(F.array_distinct(F.split(F.coalesce("text", F.lit("")), "\n")), "\n")
    docs = table(spark, sf_dir, "documents")
    counts = [rollup.counted(F.col("text"), v).alias(f"n{i}") for i, v in enumerate(rollup.VERSIONS)]
    again = [rollup.counted(F.col("once"), v).alias(f"r{i}") for i, v in enumerate(rollup.VERSIONS)]
    key = F.sha2(F.coalesce("text", F.lit("")), 256).alias("key")
    docs = settle(docs.select("doc_id", "source", "lang", "text", once.alias("once")).select("doc_id", "source", "lang", key, *counts, *again), "counted")
    before = {v: F.col(f"n{i}") for i, v in enumerate(rollup.VERSIONS)}
    after = {v: F.col(f"r{i}") for i, v in enumerate(rollup.VERSIONS)}
    first = docs.groupBy("key").agg(F.min("doc_id").alias("first_id"))
    known = spread_join(docs, first, ["key"], "inner")
    copy = F.coalesce(F.coalesce(F.col("doc_id") != F.col("first_id"), F.lit(True)) & F.col("first_id").isNotNull(), F.lit(False))
    changed = F.array(*before.values()) != F.array(*after.values())
    root = work_dir(spark, "rollup")
    rollup.commit(rollup.inserts(docs, before), root, 1)
    rollup.commit(rollup.deletes(known.where(copy), before), root, 2)
    rollup.commit(rollup.revisions(known.where(~copy & changed), before, after), root, 3)
    rollup.commit(rollup.deletes(known.where(copy), before), root, 2)
    rollup.compact(spark, root, 2)
    rollup.commit(rollup.deletes(known.where(copy), before), root, 2)
    return rollup.totals(spark, root)


_SPECIAL = "<|im_end|><|im_start|>assistant ok"


@query(
    "op13_chat",
    rf"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{_SPECIAL}' UNION ALL SELECT -1, 1, 'assistant', '{_SPECIAL}'
    ),
    e AS (SELECT *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS t, replace(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'), chr(10), '<|nl|>') AS r FROM c)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(r) + length(t) + 12 + 1 + 10 + 1) AS BIGINT) AS formatted_chars,
           regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE '-' END, '' ORDER BY turn NULLS FIRST, role, text), 's?(ua)+') AS order_valid
    FROM e GROUP BY conv_id
    """,
)
def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_SPECIAL).alias("text")
    )
    back = chat.read_back(chat.assemble(given.unionByName(planted)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    lost = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "order_valid",
    )


def _add(x: str, cost: str, letter: str) -> str:
    """A path, its cost in nine digits before its letters, one edit longer."""
    return f"(lpad(CAST(CAST(left({x}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({x}, 10) || '{letter}')"


def _when(kind: str, x: str, letter: str) -> str:
    """The path ``x`` with the turn kept if its role is of ``kind``, or given another role."""
    if letter == "R":
        return f"CASE WHEN NOT goes THEN {_add(x, '2 + late', 'R')} END"
    return f"CASE WHEN NOT goes AND kind = '{kind}' THEN {_add(x, 'late', 'K')} END"


_INSERTED = f"""least(x2, {_add("x0", "2", "I")}, {_add("x1", "2", "I")}, {_add("x3", "2", "I")}) AS y2,
        least(x3, {_add("x2", "2", "I")}, {_add("x0", "4", "II")}, {_add("x1", "4", "II")}) AS y3"""
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT))),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


@query(
    "op11_dialogue",
    rf"""
    WITH RECURSIVE given AS (
        SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
    ),
    fated AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS fate FROM given),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
               CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM fated, range(2) AS copy(n) WHERE fate <> 0 AND (n = 0 OR fate = 3)
    ),
    placed AS (
        SELECT *, row_number() OVER w AS i, left(role, 1) AS kind, lag(left(role, 1)) OVER w AS kind_before, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said
        FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
    ),
    turns AS (
        SELECT *, said = '' OR seen AS goes,
               CASE WHEN said <> '' AND NOT seen AND right(said, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS late
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM placed)
    ),
    paths AS (
        SELECT conv_id, 0 AS i, '000000000' AS x0, CAST(NULL AS VARCHAR) AS x1, CAST(NULL AS VARCHAR) AS x2, CAST(NULL AS VARCHAR) AS x3
        FROM (SELECT DISTINCT conv_id FROM conversations)
        UNION ALL
        SELECT conv_id, i, {_add("x0", "3", "D")}, least({_add("x1", "3", "D")}, {_when("s", "x0", "K")}),
               least({_add("y2", "3", "D")}, {", ".join(_when("u", x, c) for x in ("x0", "x1", "y3") for c in "KR")}),
               least({_add("y3", "3", "D")}, {_when("a", "y2", "K")}, {_when("a", "y2", "R")})
        FROM (
            SELECT t.conv_id, t.i, goes, late, kind, x0, x1, {_INSERTED}
            FROM paths p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1
        )
    ),
    ended AS (SELECT conv_id, least(x0, y3) AS path FROM (SELECT conv_id, x0, {_INSERTED}, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS n FROM paths) WHERE n = 1),
    letters AS (SELECT conv_id, unnest(range(10, len(path) + 1)) AS p, substr(path, p, 1) AS letter FROM ended),
    steps AS (
        SELECT *, sum(CAST(letter <> 'I' AS INT)) OVER w AS i, sum(CAST(letter <> 'D' AS INT)) OVER w AS o
        FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)
    ),
    made AS (
        SELECT s.conv_id, s.p, s.letter, s.o, t.role, CASE WHEN s.letter = 'I' THEN '' ELSE t.text END AS text,
               max(CAST(s.o = 1 AND s.letter = 'K' AND t.kind = 's' AS INT)) OVER (PARTITION BY s.conv_id) AS led
        FROM steps s LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.i = s.i WHERE s.letter <> 'D'
    ),
    repaired AS (
        SELECT conv_id, string_agg((CASE WHEN letter = 'K' THEN role WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY p) AS script
        FROM made GROUP BY conv_id
    ),
    facts AS (
        SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
               count(*) FILTER (WHERE said = '') AS blank, count(*) FILTER (WHERE said <> '' AND seen) AS duplicate, CAST(sum(late) AS BIGINT) AS truncated,
               count(*) FILTER (WHERE kind_before IS NOT NULL AND kind_before || kind NOT IN ('su', 'ua', 'au')) AS illegal
        FROM turns GROUP BY conv_id
    )
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, CAST(left(path, 9) AS BIGINT) AS cost, substr(path, 10) AS audit, sha256(coalesce(script, '')) AS repaired_sha256
    FROM ended e LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM e.conv_id
    """,
)
def op11_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return dialogue.repair(dialogue.damage(given), ids=given)


def _codes_sql() -> str:
    """The rounds written out one after another."""
    ctes = [
        """kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v,
               row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    )""",
        "cut AS MATERIALIZED (SELECT r, p, list_slice(v, p * (len(v) // 4) + 1, (p + 1) * (len(v) // 4)) AS x FROM kept, range(4) AS t(p))",
        "c0 AS MATERIALIZED (SELECT p, r - 1 AS j, x AS c FROM cut WHERE r <= 256)",
    ]
    for k in range(5):
        ctes.append(
            f"""a{k} AS MATERIALIZED (
        SELECT r, cut.p, min({{'d': CAST(list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c) AS BIGINT), 'j': j}}) AS best
        FROM cut JOIN c{k} USING (p) GROUP BY r, cut.p
    )"""
        )
        if k < 4:
            ctes.append(
                f"""c{k + 1} AS MATERIALIZED (
        WITH sums AS (
            SELECT p, j, i, sum(x[i]) AS s, count(*) AS n
            FROM (SELECT cut.p, best.j AS j, x, unnest(range(1, len(x) + 1)) AS i FROM a{k} JOIN cut USING (r, p)) GROUP BY ALL
        ),
        means AS (SELECT p, j, list(floor(s / n) ORDER BY i) AS m FROM sums GROUP BY p, j)
        SELECT c{k}.p, c{k}.j, coalesce(m, c) AS c FROM c{k} LEFT JOIN means USING (p, j)
    )"""
            )
    return "WITH " + ",\n    ".join(ctes) + """,
    coded AS (SELECT r, string_agg(lpad(lower(to_hex(best.j)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a4 GROUP BY r),
    book AS (SELECT sha256(coalesce(string_agg(CAST(CAST(c[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, j, i), '')) AS h FROM (SELECT p, j, c, unnest(range(1, len(c) + 1)) AS i FROM c4))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
    FROM kept JOIN coded USING (r), book
    """


@query("op12_codes", _codes_sql())
def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"))
    coded = settle(coded, "coded")
    sums = settle(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels").withColumnRenamed("label", "of")
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    rows = coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left")
    return rows.select("vec_id", code.alias("code"), "error", "label_error", F.lit(codes.fingerprint(books)).alias("codebooks_sha256"))

import json

from pyspark.sql import functions as F

from articleflow.functions import verdicts as V
from articleflow.operators import report as R
from articleflow.operators import verdict as J
from articleflow.operators.scoring import keyword_scorer, score

FIELDS = "pos bigint, title string, abstract string, content string, entity string, url string, m1_raw string, m2_raw string"


def merged(spark, *pairs):
    rows = [(i, f"t{i}", "abs", "content", "e", f"u{i}", a, b) for i, (a, b) in enumerate(pairs)]
    return J.merge(J.answers(spark.createDataFrame(rows, FIELDS)))


def js(**fields):
    return json.dumps(fields, ensure_ascii=False)


def test_parse_is_lenient(spark):
    cases = {
        '```json\n{"a": 1}\n```': True, 'text {"a": {"b": 2}} tail': True, "[1]": False, "nothing": False, "": False,
        '{"a": 1': False, '{"a": 1} {"b": 2}': False, "{}": True, '{"a": 1, "a": 2}': True, "[{}]": True,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = df.select("v", V.parse_object(F.col("v")).isNotNull().alias("x")).collect()
    assert {r["v"]: r["x"] for r in got} == cases


def test_merge_rules(spark):
    yes, no = js(is_relevant=True, confidence_score=0.9, title_cn="T1", summary="S1", reasoning="R1"), js(is_relevant=False)
    rows = merged(
        spark,
        (no, no), (yes, None), (None, None), (None, "junk"), (no, js(is_relevant=True, confidence_score=0.4)),
        ("{}", "{}"), (js(is_relevant=False, reasoning="a"), None), (None, js(is_relevant=False, reasoning="b")),
    ).orderBy("pos").collect()
    assert [r["label"] for r in rows] == ["FALSE", "TRUE", "ERROR", "FALSE", "TRUE", "FALSE", "FALSE", "FALSE"]
    assert [r["alert"] for r in rows] == [False, False, True, False, False, False, False, False]
    assert [r["confidence"] for r in rows] == [0.0, 0.9, 0.0, 0.0, 0.4, 0.0, 0.0, 0.0]
    assert (rows[1]["title_out"], rows[1]["summary"], rows[1]["reasoning"]) == ("T1", "S1", "R1")
    assert (rows[0]["title_out"], rows[0]["summary"]) == ("t0", "abs")
    assert rows[2]["reasoning"] == V.BOTH_FAILED
    assert [r["m1_status"] for r in rows[:6]] == ["success", "success", "error", "error", "success", "parse_error"]
    assert (rows[1]["m2_is_relevant"], rows[1]["m2_reason"]) == ("None", "Connection Failed")
    assert rows[5]["m1_reason"] == "Parse Error"
    assert (rows[6]["reasoning"], rows[7]["reasoning"]) == ("a", "b")


def test_flags_that_are_not_booleans(spark):
    true = js(is_relevant=True)
    rows = merged(
        spark,
        (js(is_relevant="yes"), true), (js(is_relevant=0), true), (js(is_relevant=None), true), (js(is_relevant=""), true),
        (js(is_relevant=[1]), true), (js(is_relevant={}), true), (js(other=1), true), (js(is_relevant="true"), None),
        (js(is_relevant=1.5), None), (js(is_relevant="ERROR"), true),
    ).orderBy("pos").collect()
    assert [r["label"] for r in rows] == [
        "FALSE", "TRUE", "TRUE", "TRUE", "FALSE", "TRUE", "TRUE", "FALSE", "FALSE", "ERROR",
    ]
    assert [r["m1_is_relevant"] for r in rows] == ["yes", "0", "None", "", "[1]", "{}", "None", "true", "1.5", "ERROR"]


def test_summary_falls_back_to_content(spark):
    df = spark.createDataFrame([(1, "t", None, "x" * 300, "e", "u", None, None)], FIELDS)
    assert J.merge(J.answers(df)).first()["summary"] == "x" * 200


def test_missing_side_of_a_pair_is_a_failure(spark):
    long = spark.createDataFrame([(1, "m1", "{}"), (2, "m2", '{"a":1}')], "article_id bigint, model string, raw string")
    got = {r["article_id"]: (r["m1"]["status"], r["m2"]["status"]) for r in J.answers(J.pair_answers(long)).collect()}
    assert got == {1: ("parse_error", "error"), 2: ("error", "success")}


def test_scorers_are_independent(spark):
    def broken(prompts):
        raise OSError("down")

    df = spark.createDataFrame([(1, "Digital Euro"), (2, "bananas")], "pos bigint, prompt string")
    got = score(df, {"m1": keyword_scorer(["digital euro"]), "m2": broken}).orderBy("pos").collect()
    assert [json.loads(r["m1_raw"])["is_relevant"] for r in got] == [True, False]
    assert [r["m2_raw"] for r in got] == [None, None]


def test_default_terms(spark):
    df = spark.createDataFrame(
        [(1, "Stablecoin rules", "", "a DLT pilot"), (2, "bananas", None, None)],
        "pos bigint, title string, abstract string, content string",
    )
    assert [(r["pos"], r["matched"]) for r in J.keyword_prefilter(df).collect()] == [(1, 2)]


def test_digest_and_status(spark):
    yes = js(is_relevant=True)
    v = merged(spark, (js(is_relevant=False), None), (yes, None), (None, None), (yes, yes))
    lines = R.digest_lines(v, "pos").orderBy("item_no", "line_no").collect()
    assert [r["line"] for r in lines] == ["一、t1", "abs", "（e：u1）", "二、t3", "abs", "（e：u3）"]
    every = R.digest_lines(v, "pos", relevant_only=False)
    assert every.count() == 12
    empty = R.digest_lines(v.filter("pos < 1"), "pos").collect()
    assert [(r["item_no"], r["line"]) for r in empty] == [(0, R.NOTHING_TODAY)]
    status = R.status_table(v, "pos").orderBy("no").collect()
    assert [(r["no"], r["status"]) for r in status] == [(1, "Irrelevant"), (2, "Relevant"), (3, "ERROR"), (4, "Relevant")]
    counters = R.run_counters(v.limit(3), v).first().asDict()
    assert counters == {"total_all": 3, "total_new": 4, "total_relevant": 2, "total_errors": 1}


def test_alerts_keep_the_first_ten(spark):
    v = merged(spark, *[(None, None)] * 12)
    row = R.alert_rollup(v, "pos").first()
    assert row["alert"] and row["messages"].count("Title: ") == 10
    assert row["messages"].startswith(f"Title: t0\nReason: {V.BOTH_FAILED}\nTitle: t1\n")
    calm = R.alert_rollup(merged(spark, ("{}", None)), "pos").first()
    assert (calm["alert"], calm["messages"]) == (False, "")


def test_prompt_uses_the_first_thousand_characters(spark):
    df = spark.createDataFrame([("t", None, "é" * 1500)], "title string, abstract string, content string")
    prompt = df.select(V.prompt(F.col("title"), F.col("abstract"), F.col("content"), head="H\n").alias("p")).first()["p"]
    assert prompt == "H\nTitle: t\nAbstract: \nContent Sample: " + "é" * 1000

"""Expressions over the raw text answers of two independent scorers.

An answer is parsed once into a VARIANT; scalars are taken out of it before any
shuffle, because a VARIANT can be neither grouped nor hashed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from articleflow.functions.text import bind, first_filled, text_of

# Status names, reasons and the message of a double failure.
ERROR, PARSE_ERROR, SUCCESS = "error", "parse_error", "success"
CONNECTION_FAILED, PARSE_FAILED = "Connection Failed", "Parse Error"
BOTH_FAILED = "双路API调用均失败 (Connection Error)"


_END = "end-of-answer"


def parse_object(raw: Column) -> Column:
    """The JSON object between the first ``{`` and the last ``}``, else null.

    The parser stops after one value, so the object is read as the first element of
    a list whose second must be our end mark: anything left over is an error.
    """
    text = F.nullif(F.regexp_extract(raw, r"(?s)\{.*\}", 0), F.lit(""))
    framed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))
    return bind(framed, _sole_object)


def _sole_object(framed: Column) -> Column:
    value = F.try_variant_get(framed, "$[0]", "variant")
    whole = F.try_variant_get(framed, "$[1]", "string") == _END
    return F.when(whole & F.schema_of_variant(value).startswith("OBJECT"), value)


def _field(obj: Column, name: str) -> Column:
    return F.try_variant_get(obj, f"$.{name}", "variant")


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _as_text(value: Column, missing: str) -> Column:
    """Text of a field: booleans capitalised, JSON null is ``None``."""
    kind, text = _kind(value), F.try_variant_get(value, "$", "string")
    return (
        F.when(value.isNull(), F.lit(missing))
        .when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )


def _truthy(value: Column) -> Column:
    kind = _kind(value)
    text = F.try_variant_get(value, "$", "string")
    return F.coalesce(
        F.when(kind == "BOOLEAN", text == "true")
        .when(kind == "STRING", text != "")
        .when(kind.startswith("ARRAY"), text != "[]")
        .when(kind.startswith("OBJECT"), text != "{}")
        .when(kind == "VOID", F.lit(False))
        .otherwise(F.try_variant_get(value, "$", "double") != 0),
        F.lit(False),
    )


def _plain_text(value: Column) -> Column:
    return F.when(_kind(value) != "VOID", F.try_variant_get(value, "$", "string"))


def answer(raw: Column) -> Column:
    """The scalars of one answer as a struct; the text is parsed once."""
    whole = F.struct(raw.alias("raw"), parse_object(raw).alias("obj"))
    return bind(whole, lambda x: _with_flag(x["raw"], x["obj"]))


def _with_flag(raw: Column, obj: Column) -> Column:
    parsed = F.coalesce(_kind(obj) != "OBJECT<>", F.lit(False))
    flag = _field(obj, "is_relevant")
    is_text = F.try_variant_get(flag, "$", "string")
    status = (
        F.when(raw.isNull(), F.lit(ERROR)).when(~parsed, F.lit(PARSE_ERROR)).otherwise(F.lit(SUCCESS))
    )
    reason = (
        F.when(raw.isNull(), F.lit(CONNECTION_FAILED))
        .when(~parsed, F.lit(PARSE_FAILED))
        .otherwise(_as_text(_field(obj, "reasoning"), ""))
    )
    return F.struct(
        status.alias("status"),
        F.when(parsed, _as_text(flag, "None")).otherwise(F.lit("None")).alias("is_relevant"),
        reason.alias("reason"),
        (parsed & _truthy(flag)).alias("truthy"),
        F.coalesce((_kind(flag) == "BOOLEAN") & (is_text == "true"), F.lit(False)).alias("is_true"),
        F.coalesce((_kind(flag) == "STRING") & (is_text == "ERROR"), F.lit(False)).alias("says_error"),
        F.coalesce(F.try_variant_get(obj, "$.confidence_score", "double"), F.lit(0.0)).alias("confidence"),
        _plain_text(_field(obj, "title_cn")).alias("title_cn"),
        _plain_text(_field(obj, "summary")).alias("summary"),
        _plain_text(_field(obj, "reasoning")).alias("reasoning"),
    )


def merged_label(m1: str = "m1", m2: str = "m2") -> Column:
    """``ERROR`` / ``TRUE`` / ``FALSE``.

    The first truthy flag counts; only the JSON boolean true makes ``TRUE``, so a
    truthy non-boolean from the first model hides a true from the second.
    """
    a, b = F.col(m1), F.col(m2)
    both_failed = (a["status"] == ERROR) & (b["status"] == ERROR)
    says_true = F.when(a["truthy"], a["is_true"]).otherwise(b["is_true"])
    says_error = F.when(a["truthy"], a["says_error"]).otherwise(b["says_error"])
    return (
        F.when(both_failed | says_error, F.lit("ERROR"))
        .when(says_true, F.lit("TRUE"))
        .otherwise(F.lit("FALSE"))
    )


def best_answer(m1: str = "m1", m2: str = "m2") -> Column:
    """The answer whose texts are reported: relevant before parsed, first before second."""
    a, b = F.col(m1), F.col(m2)
    return (
        F.when(a["truthy"], a)
        .when(b["truthy"], b)
        .when(a["status"] == SUCCESS, a)
        .when(b["status"] == SUCCESS, b)
    )


def report_summary(summary: Column, abstract: Column, content: Column) -> Column:
    return first_filled(summary, text_of(abstract), F.substring(text_of(content), 1, 200))


# Terms of the keyword prefilter.
KEYWORDS = [
    "cbdc", "central bank digital currency", "digital currency", "digital euro",
    "digital dollar", "e-cny", "digital yuan", "digital pound", "digital rupee",
    "digital ruble", "digital real", "digital won", "tokenized deposit",
    "rln", "regulated liability network", "wholesale cbdc", "retail cbdc",
    "stablecoin", "crypto asset", "ledger technology", "dlt", "blockchain",
]


def matched_terms(title: Column, abstract: Column, content: Column, terms: list[str]) -> Column:
    """How many terms occur in the lower-cased text of an article."""
    whole = F.lower(F.concat_ws(" ", text_of(title), text_of(abstract), text_of(content)))
    listed = F.array(*[F.lit(t) for t in terms])
    return bind(whole, lambda text: F.size(F.filter(listed, lambda t: F.contains(text, t))))


PROMPT_HEAD = (
    "Decide whether the article below is relevant to the monitored topic. Answer with one "
    "JSON object holding is_relevant, confidence_score, title_cn, summary and reasoning.\n"
)


SAMPLE = 1000  # characters of the content that a prompt shows


def prompt(title: Column, abstract: Column, content: Column, head: str = PROMPT_HEAD, sample: int = SAMPLE) -> Column:
    return F.concat(
        F.lit(head),
        F.lit("Title: "), text_of(title),
        F.lit("\nAbstract: "), text_of(abstract),
        F.lit("\nContent Sample: "), F.substring(text_of(content), 1, sample),
    )

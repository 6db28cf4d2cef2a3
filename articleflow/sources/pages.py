"""Landed pages to listing items and text blocks.

Spark places the pages and their rules; Python only walks one page at a time,
on Arrow batches bounded by bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articleflow.functions.dates import site_date
from articleflow.functions.text import clean_one_line, prefixed_url
from articleflow.operators.ordered import line_groups
from articleflow.schema import BLOCKS
from articleflow.sources import dom
from articleflow.sources.rules import GENERIC_RULE, SITE_RULES, rules_table

BLOCK_ROW = pa.struct(
    [("container", pa.int32()), ("pos", pa.int32()), ("tag", pa.string()), ("text", pa.string())]
)
ITEM_FIELDS = ["date_raw", "title", "link", "abstract", "category"]
ITEM_ROW = pa.struct([("pos", pa.int32()), *[(n, pa.string()) for n in ITEM_FIELDS]])
ITEMS = "array<struct<pos:int," + ",".join(f"{n}:string" for n in ITEM_FIELDS) + ">>"


# Rule columns that only the article pages themselves need.
CONTENT_RULES = [
    "containers", "block_tags", "loose_tags", "body_text", "remove", "tight_tags", "pick", "separator",
    "min_length", "loose_min_length", "free_li", "trim", "drop_pattern", "detail_date",
]


def _groups(selector: str) -> list[str]:
    return [g.strip() for g in selector.split("|") if g.strip()]


def _elements(root: dom.Node, tags: str, skip: set) -> Iterator[dom.Node]:
    for group in _groups(tags):
        if group.endswith(":first"):
            node = dom.first(root, group[: -len(":first")], skip)
            if node is not None:
                yield node
        else:
            yield from dom.select(root, group, skip)


def _containers(root: dom.Node, rule: dict, skip: set) -> list[dom.Node]:
    found: list[dom.Node] = []
    for group in _groups(rule["containers"]):
        if rule["pick"] == "longest":
            found += [n for n in dom.select(root, group) if n not in found]
            continue
        node = dom.first(root, group, skip)
        if node is not None:
            found.append(node)
            if rule["pick"] == "first":
                break
    return found


def page_blocks(html: str | None, rule: dict) -> list[dict]:
    """Text blocks of one page; container -1 when no container gave any.

    A rule with a date of its own for pages has it last, in container -2.
    """
    root = dom.parse(html or "")
    skip = set(dom.select(root, rule["remove"])) if rule["remove"] else set()
    tight = set(rule["tight_tags"].split(","))
    out: list[dict] = []

    def add(container: int, node: dom.Node) -> None:
        text = node.text("" if node.tag in tight else " ", skip)
        if text:
            out.append({"container": container, "pos": len(out), "tag": node.tag, "text": text})

    containers = _containers(root, rule, skip)
    for i, container in enumerate(containers):
        for node in _elements(container, rule["block_tags"], skip):
            add(i, node)
    whole_page = not containers or rule["pick"] == "sufficient"
    if not out and whole_page and rule["loose_tags"]:
        for node in _elements(root, rule["loose_tags"], skip):
            add(-1, node)
    if not out and rule["body_text"]:
        body = dom.first(root, "body")
        if body is not None:
            add(-1, body)
    if rule["detail_date"]:
        stamp = dom.first(root, rule["detail_date"])
        text = stamp.text("") if stamp is not None else ""
        out.append({"container": -2, "pos": len(out), "tag": "date", "text": text})
    return out


def _value(item: dom.Node, selector: str) -> str:
    """Text of the parts of a selector (joined by a space) or an attribute (``sel@name``)."""
    found = []
    for part in selector.split(" + "):
        path, _, attr = part.strip().partition("@")
        node = dom.first(item, path)
        if node is not None:
            found.append(node.attrs.get(attr, "") if attr else node.text(" "))
    return " ".join(found).strip()


def page_items(html: str | None, rule: dict) -> list[dict]:
    """List entries of one page in order. A ``dt`` entry is a date header of its own."""
    if not rule["item"]:
        return []
    out = []
    for pos, item in enumerate(dom.select(dom.parse(html or ""), rule["item"])):
        if item.tag == "dt":
            row = {n: "" for n in ITEM_FIELDS} | {"date_raw": item.text("")}
        else:
            link = dom.first(item, rule["item_link"])
            row = {
                "date_raw": _value(item, rule["item_date"]),
                "title": _value(item, rule["item_title"]),
                "link": (link.attrs.get("href", "") if link is not None else "").strip(),
                "abstract": _value(item, rule["item_abstract"]),
                "category": _value(item, rule["item_category"]),
            }
        out.append({"pos": pos, **row})
    return out


def _map_pages(
    pages: DataFrame, rule_columns: list[str], fn: Callable[[str, dict], list[dict]],
    name: str, sql_type: str, arrow_type: pa.DataType,
) -> DataFrame:
    """Add ``name`` computed from ``html``. The page and the selectors end here, so that
    later shuffles do not carry them; all other columns pass through."""
    done = {"html", *rule_columns} - {"pick"}
    keep = [c for c in pages.columns if c not in done]
    types = dict(pages.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in keep], f"`{name}` {sql_type}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rules = batch.select(rule_columns).to_pylist()
            html = batch.column("html").to_pylist()
            values = pa.array([fn(h, r) for h, r in zip(html, rules)], pa.list_(arrow_type))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], values], names=[*keep, name]
            )

    return pages.mapInArrow(run, schema)


# Rules that are sent to every task; a larger table is joined by its size.
SENT_RULES = 10_000


def with_rules(pages: DataFrame, rules: list[dict] | None = None) -> DataFrame:
    """Attach each page's rule; a source without one gets the generic rule.

    Rules are configuration, counted before they are sent to every task, so that a
    source with most of the pages is not gathered for this join.
    """
    table = rules_table(pages.sparkSession, rules)
    few = len(SITE_RULES if rules is None else rules) <= SENT_RULES
    generic = rules_table(pages.sparkSession, [GENERIC_RULE]).drop("source").first().asDict()
    found = pages.join(F.broadcast(table) if few else table, "source", "left")
    kinds = dict(table.dtypes)
    return found.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c])) for c, v in generic.items()})


def extract_blocks(pages: DataFrame) -> DataFrame:
    """Add ``blocks`` to pages that carry their rule columns. Remove known pages first."""
    columns = [
        "containers", "block_tags", "loose_tags", "body_text", "remove", "tight_tags", "pick", "detail_date",
    ]
    return _map_pages(pages, columns, page_blocks, "blocks", BLOCKS, BLOCK_ROW)


def extract_items(pages: DataFrame) -> DataFrame:
    """Listing rows ``(.., pos, date_raw, title, link, abstract, category)``, raw."""
    columns = [
        "item", "item_date", "item_title", "item_link", "item_abstract", "item_category",
    ]
    items = _map_pages(pages.drop(*CONTENT_RULES), columns, page_items, "items", ITEMS, ITEM_ROW)
    keep = [c for c in items.columns if c not in ("items", "category")]
    site = [F.col("category").alias("site_category")] if "category" in items.columns else []
    return items.select(*keep, *site, F.explode("items").alias("i")).select(
        *keep, *(["site_category"] if site else []), "i.*"
    )


LINE_ROW = pa.struct([("pos", pa.int32()), ("line", pa.string()), ("line_link", pa.string())])
# Rule columns that only listings need; after grouping lines a rule is attached again.
_ITEM_RULES = ["item", "item_date", "item_title", "item_link", "item_abstract", "item_category"]


def page_lines(html: str | None, rule: dict) -> list[dict]:
    """Lines of a page as it is shown, with the address that covers them."""
    lines = dom.text_lines(dom.parse(html or ""))
    return [{"pos": i, "line": text, "line_link": link} for i, (text, link) in enumerate(lines)]


def line_items(pages: DataFrame, keys: list[str], rules: list[dict] | None = None) -> DataFrame:
    """Listing rows, as ``extract_items`` gives them, of pages that list their items as lines of text.

    ``pages`` carry their rules; a rule's ``line_dates`` is the pattern of a line that begins an item. ``keys`` name
    a page. A date line that can't be read begins an item too: it ends the item before,
    and the undated policy of the source decides about its own.
    """
    listed = pages.filter(F.col("line_dates") != "").select("source", *keys, "html", "item", "line_dates")
    lines = _map_pages(listed, ["item"], page_lines, "lines", "array<struct<pos:int,line:string,line_link:string>>", LINE_ROW)
    rows = lines.select("source", *keys, "line_dates", F.explode("lines").alias("l")).select("source", *keys, "line_dates", "l.*")
    starts = F.rlike(F.col("line"), F.col("line_dates"))
    items = line_groups(rows, ["source", *keys], "pos", "line", starts, "line_link")
    found = with_rules(items.withColumnRenamed("category", "_category"), rules).withColumnRenamed("category", "site_category")
    return found.drop(*CONTENT_RULES, *_ITEM_RULES).withColumnRenamed("_category", "category").withColumn("abstract", F.lit(""))


def resolve_items(items: DataFrame, today: Column) -> DataFrame:
    """Absolute links, cleaned texts and the listing date by the source's style."""
    return items.withColumns(
        {
            "published_on": site_date(F.col("date_style"), F.col("date_raw"), today),
            "link": prefixed_url(F.col("link"), F.col("base_url"), F.col("directory")),
            "title": clean_one_line(F.col("title")),
            "abstract": clean_one_line(F.col("abstract")),
        }
    ).drop("base_url", "directory")

"""Text, link and numeral expressions. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from html import unescape as decoded
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space, and the zero-width
# and line/paragraph separators that are turned into a space.
WS = (
    r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
ZERO_WIDTH = r"\x{200B}\x{200C}\x{200D}\x{2028}\x{2029}"

WS_CHARS = "".join(
    chr(c)
    for lo, hi in [
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
        (0x3000, 0x3000),
    ]
    for c in range(lo, hi + 1)
)

# The same sets for Java's regular expressions. A range in front of ``&&`` rejects
# ordinary letters with one test; the bare unions are several times slower.
_ODD_SPACE = r"[\x09-\x1F\x85-\x{3000}&&[" + WS + ZERO_WIDTH + "]]"
_ZERO_WIDTH_RUN = r"[\x{200B}-\x{2029}&&[" + ZERO_WIDTH + "]]+"

# Word characters for boundary tests, independent of what a JDK means by \b.
WORD = r"\p{L}\p{N}_"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimizer would otherwise paste ``value`` into each place that uses it, which
    repeats the work and makes the generated code too large to compile.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def strip(col: Column) -> Column:
    """Remove white space of any kind at both ends in one pass."""
    return F.btrim(col, F.lit(WS_CHARS))


def clean_one_line(col: Column) -> Column:
    """Null becomes empty; every run of white space or zero-width marks one space."""
    spaced = F.regexp_replace(text_of(col), _ODD_SPACE, " ")
    return F.btrim(F.regexp_replace(spaced, " {2,}", " "))


def clean_multi_line(col: Column) -> Column:
    """Keep line breaks, unify them, and shrink runs of blank lines to one."""
    s = F.regexp_replace(text_of(col), _ZERO_WIDTH_RUN, " ")
    s = F.replace(F.replace(s, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    s = F.regexp_replace(s, f"\\n[{WS}]*\\n", "\n\n")
    return strip(s)


def first_filled(*cols: Column) -> Column:
    """First column that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def make_uid(source: Column, link: Column) -> Column:
    return F.sha2(F.concat(text_of(source), F.lit("|"), text_of(link)), 256)


def absolute_url(link: Column, base: Column) -> Column:
    """Relative links get the base in front, with exactly one slash between."""
    link, base = text_of(link), text_of(base)
    joined = F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.ltrim(link, F.lit("/")))
    return (
        F.when(link == "", F.lit(""))
        .when(link.startswith("http"), link)
        .when(base != "", joined)
        .otherwise(link)
    )


def prefixed_url(link: Column, base: Column, directory: Column) -> Column:
    """Site links: ``//host`` gets https, others the site's base (and directory)."""
    link, base, directory = text_of(link), text_of(base), text_of(directory)
    return (
        F.when(link == "", F.lit(""))
        .when(directory != "", F.concat(base, directory, link))
        .when(link.startswith("//"), F.concat(F.lit("https:"), link))
        .when(link.startswith("http"), link)
        .otherwise(F.concat(base, link))
    )


def content_type(link: Column) -> Column:
    link = text_of(link)
    return (
        F.when(link == "", F.lit("unknown"))
        .when(F.lower(link).endswith(".pdf"), F.lit("pdf"))
        .otherwise(F.lit("html"))
    )


def title_short(title: Column) -> Column:
    title = text_of(title)
    return F.when(F.length(title) < 50, title).otherwise(
        F.concat(F.substring(title, 1, 47), F.lit("..."))
    )


# Numerals used by digest headings.
DIGITS = ["〇", "一", "二", "三", "四", "五", "六", "七", "八", "九"]
TEN = "十"


def cn_numeral(n: Column) -> Column:
    """1 to 99 in Chinese numerals, anything else as plain digits."""
    tens, unit = F.floor(n / 10).cast("int"), F.pmod(n, F.lit(10)).cast("int")
    digit = F.array(*[F.lit(d) for d in DIGITS])
    head = F.when(tens >= 2, F.get(digit, tens)).otherwise(F.lit(""))
    ten = F.when(tens >= 1, F.lit(TEN)).otherwise(F.lit(""))
    tail = F.when(unit > 0, F.get(digit, unit)).otherwise(F.lit(""))
    return F.when(n.between(1, 99), F.concat(head, ten, tail)).otherwise(n.cast("string"))


# Names looked up first; texts seldom hold others.
_USUAL = "amp lt gt quot apos nbsp copy reg trade middot bull hellip ndash mdash lsquo rsquo ldquo rdquo laquo raquo euro pound deg sect".split()


def _entity_map(names: list[str]) -> Column:
    """References and their characters as one constant, built from two texts and not name by name."""
    keys, values = "\x01".join(f"&{n}" for n in names), "\x01".join(html5[n] for n in names)
    return F.map_from_arrays(F.split(F.lit(keys), "\x01"), F.split(F.lit(values), "\x01"))


def _code_point(number: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def unescape(col: Column) -> Column:
    """Decode character references; texts without ``&`` are passed through."""
    return bind(col, _unescaped)


def _unescaped(col: Column) -> Column:
    token = r"(?s)&#?[0-9A-Za-z]{1,32};|[^&]+|&"
    usual = [f"{n};" for n in _USUAL]
    short = _entity_map(usual)
    every = _entity_map([n for n in html5 if n.endswith(";") and n not in usual])

    def decode(t: Column) -> Column:
        dec = F.regexp_extract(t, "^&#([0-9]{1,7});$", 1)
        hexa = F.regexp_extract(t, "^&#[xX]([0-9A-Fa-f]{1,6});$", 1)
        number = F.coalesce(
            F.nullif(dec, F.lit("")).cast("bigint"),
            F.conv(F.nullif(hexa, F.lit("")), 16, 10).cast("bigint"),
        )
        # Numbers 128 to 159 stand for the characters that old pages mean by them.
        old = F.get(F.array(*[F.lit(decoded(f"&#{n};")) for n in range(128, 160)]), (number - 128).cast("int"))
        ok = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        return F.when(
            t.startswith("&"),
            F.coalesce(F.try_element_at(short, t), F.when(t.rlike("^&[A-Za-z]"), F.try_element_at(every, t)), F.when(number.between(128, 159), old), F.when(ok, _code_point(number)), t),
        ).otherwise(t)

    parts = F.transform(F.regexp_extract_all(col, F.lit(token), F.lit(0)), decode)
    return F.when(F.contains(col, F.lit("&")), F.array_join(parts, "")).otherwise(col)


# Attributes up to the end of a tag; a quoted value may hold ``>``.
_ATTRIBUTES = r"""(?:[\s/=]++|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]++))?+)*+"""


def html_text(html: Column) -> Column:
    """Markup out, text pieces joined by one space."""
    s = text_of(html)
    s = F.regexp_replace(s, r"(?is)<(script|style|template)\b[^>]*>.*?</\1\s*>", " ")
    s = F.regexp_replace(s, rf"(?s)<!--.*?-->|</?[a-zA-Z][^\s/>]*+{_ATTRIBUTES}>|<[!/?a-zA-Z][^>]*>", " ")
    return clean_one_line(unescape(s))

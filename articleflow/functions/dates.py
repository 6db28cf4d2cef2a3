"""Date expressions.

A text is matched against a few shapes with regular expressions and the parts
are put together by ``try_make_timestamp_ntz``. No formatter is tried and failed
per row, so an unparsable value costs no exception and gives null.
"""

from __future__ import annotations

import calendar

from pyspark.sql import Column
from pyspark.sql import functions as F

from articleflow.functions.text import WORD, WS, bind, strip, text_of

FULL = [m.lower() for m in calendar.month_name[1:]]
ABBR = [m.lower() for m in calendar.month_abbr[1:]]
_FULL = "(" + "|".join(FULL) + ")"
_ABBR = "(" + "|".join(ABBR) + ")"
_ANY = "(" + "|".join(FULL + ABBR) + ")"
_LEFT, _RIGHT = f"(?<![{WORD}])", f"(?![{WORD}])"
_TIME = r"(?:[T\s]+(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\.\d+)?(?:\s*([AaPp])\.?[Mm]\.?(?![A-Za-z]))?)?"


_BLANKS = f"[{WS}]+"
_YEAR_LAST = r"(?i)^([a-z]{3,9})\s+(\d{1,2})\s+(\d{1,2}:\d{2}(?::\d{2})?)(\s+[A-Z]{1,5}|\s+[+-]\d{4})?\s+(\d{4})$"


def month_number(name: Column) -> Column:
    pairs: list[Column] = []
    for i, m in enumerate(ABBR, start=1):
        pairs += [F.lit(m), F.lit(i)]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.substring(name, 1, 3)))


def _part(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def shaped(text: Column, pattern: str, order: str, time_from: int = 0) -> Column:
    """Timestamp from the groups of ``pattern``; ``order`` names them (y, m, d or M=name).

    ``time_from`` is the number of the hour group when the pattern has a time.
    """
    part = {c: _part(text, pattern, i + 1) for i, c in enumerate(order)}
    month = month_number(part["M"]) if "M" in part else part["m"].cast("int")
    if time_from:
        h, mi, s = (
            F.coalesce(_part(text, pattern, time_from + i).cast("int"), F.lit(0)) for i in range(3)
        )
        half = F.lower(_part(text, pattern, time_from + 3))
        h = F.when((half == "p") & (h < 12), h + 12).when((half == "a") & (h == 12), F.lit(0)).otherwise(h)
    else:
        h = mi = s = F.lit(0)
    # Two digits name a year as mail dates do.
    y = part["y"].cast("int")
    year = F.when(F.length(part["y"]) == 2, y + F.when(y < 70, 2000).otherwise(1900)).otherwise(y)
    stamp = F.try_make_timestamp_ntz(
        year, month, part["d"].cast("int"), h, mi, s.cast("decimal(16,6)")
    )
    return F.when(text.rlike(pattern), stamp)


def feed_timestamp(raw: Column, to_utc: bool = False) -> Column:
    """Published time of a feed entry: many formats, wall time kept, offset dropped.

    With ``to_utc`` a numeric offset is applied instead of dropped.
    """
    s = F.regexp_replace(strip(text_of(raw)), _BLANKS, " ")
    s = F.regexp_replace(s, r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s*", "")
    s = F.regexp_replace(s, r"(?i)\bsept\b", "Sep")
    # The year behind the time, as C prints dates.
    s = F.regexp_replace(s, _YEAR_LAST, "$1 $2, $5 $3$4")
    return bind(s, lambda t: _feed_timestamp(t, to_utc))


def _feed_timestamp(s: Column, to_utc: bool) -> Column:
    offset = r"\s*(?:Z|[A-Z]{1,5}|(?:GMT|UTC)?[+-]\d{2}(?::?\d{2})?)?$"
    full = [
        (rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}}){_TIME}{offset}", "ymd"),
        (rf"^(\d{{4}})/(\d{{1,2}})/(\d{{1,2}}){_TIME}{offset}", "ymd"),
        (rf"(?i)^(\d{{1,2}})[\s-]+{_ANY}\.?,?[\s-]+(\d{{4}}|\d{{2}}){_TIME}{offset}", "dMy"),
        (rf"(?i)^{_ANY}\.?\s+(\d{{1,2}}),?\s+(\d{{4}}){_TIME}{offset}", "Mdy"),
        (rf"^(0?[1-9]|1[0-2])[/.-](\d{{1,2}})[/.-](\d{{4}}){_TIME}{offset}", "mdy"),
        (rf"^(\d{{1,2}})[/.-](\d{{1,2}})[/.-](\d{{4}}){_TIME}{offset}", "dmy"),
    ]
    compact = (rf"^(\d{{4}})(\d{{2}})(\d{{2}}){offset}", "ymd")
    stamp = F.coalesce(
        *[shaped(s, p, order, time_from=4) for p, order in full], shaped(s, *compact)
    )
    if not to_utc:
        return stamp
    zone = r"([+-])(\d{2}):?(\d{2})?$"
    timed = s.rlike(r"\d:\d")
    minutes = F.coalesce(
        _part(s, zone, 2).cast("int") * 60 + F.coalesce(_part(s, zone, 3).cast("int"), F.lit(0)), F.lit(0)
    )
    signed = F.when(_part(s, zone, 1) == "-", -minutes).otherwise(minutes)
    return F.when(timed, stamp - F.make_dt_interval(F.lit(0), F.lit(0), signed)).otherwise(stamp)


def feed_date(raw: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text, or empty."""
    return F.coalesce(F.date_format(feed_timestamp(raw), "yyyy-MM-dd HH:mm:ss"), F.lit(""))


# The day, month and year ranges accepted in free text.
_DAY = r"(0[1-9]|[12]\d|3[01])"
_MONTH = r"(0[1-9]|1[0-2])"
_YEAR = r"(202[2-9])"
_SEP = r"[-/.]"

# More than any accepted date takes on either side of its year, where no run of blanks is longer than _RUN.
_BEFORE, _AFTER, _RUN = 64, 12, 7


def _around_years(text: Column) -> Column:
    """What stands around each accepted year, one piece after the other.

    Long texts are searched once for the year; the date patterns then run over a few
    characters. ``_`` marks a cut, so that a cut is never taken for a word boundary.
    """
    parts = F.split(F.concat(F.lit(" "), text), "(?=202[2-9])")
    return bind(parts, _pieces)


def _pieces(parts: Column) -> Column:
    def piece(after: Column, i: Column) -> Column:
        cut = (F.length(after) > _AFTER) | (i < F.size(parts) - 2)
        return F.concat(
            F.lit("_"), F.right(F.get(parts, i), F.lit(_BEFORE)), F.left(after, F.lit(_AFTER)),
            F.when(cut, F.lit("_")).otherwise(F.lit("")),
        )

    return F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), piece), "")


def text_date(text: Column) -> Column:
    """A date mentioned in free text as ``yyyy-MM-dd``, or empty.

    Numeric year-first dates win over day-first ones, those over month names.
    The numeric forms are taken as written, without a calendar check.
    """

    def found(whole: Column) -> Column:
        # Blanks are collapsed in the pieces. Where a piece holds a long run of them, so that a date with its gaps
        # may not fit in it, the whole text is collapsed first.
        def narrow(pieces: Column) -> Column:
            again = bind(F.regexp_replace(whole, _BLANKS, " "), _around_years)
            return F.when(pieces.rlike(f"[{WS}]{{{_RUN + 1}}}"), again).otherwise(F.regexp_replace(pieces, _BLANKS, " "))

        single = bind(bind(whole, _around_years), narrow)
        # Most texts name no such year: one cheap search decides before the others run.
        return F.when(whole.rlike("202[2-9]"), bind(single, _text_date)).otherwise(F.lit(""))

    return bind(text_of(text), found)


def _text_date(s: Column) -> Column:
    ymd = f"{_LEFT}{_YEAR}{_SEP}{_MONTH}{_SEP}{_DAY}{_RIGHT}"
    dmy = f"{_LEFT}{_DAY}{_SEP}{_MONTH}{_SEP}{_YEAR}{_RIGHT}"
    day, gap = r"(\d{1,2})(?:st|nd|rd|th)?", r"\s"
    day_first = rf"(?i){_LEFT}{day}{gap}(?:of{gap})?{_ANY}\.?,?{gap}{_YEAR}{_RIGHT}"
    month_first = rf"(?i){_LEFT}{_ANY}\.?{gap}{day},?{gap}{_YEAR}{_RIGHT}"
    joined = [
        F.concat_ws("-", *[F.regexp_extract(s, p, g) for g in groups])
        for p, groups in ((ymd, (1, 2, 3)), (dmy, (3, 2, 1)))
    ]
    named = F.date_format(
        F.coalesce(shaped(s, day_first, "dMy"), shaped(s, month_first, "Mdy")), "yyyy-MM-dd"
    )
    return F.coalesce(
        F.when(s.rlike(ymd), joined[0]).when(s.rlike(dmy), joined[1]).otherwise(named), F.lit("")
    )


def year_signal(text: Column, current_year: int) -> Column:
    """1 January of the current year if it is named, else of the first 2020-2025 year."""
    s = text_of(text)
    older = F.regexp_extract(s, f"{_LEFT}(202[0-5]){_RIGHT}", 1)
    return (
        F.when(F.contains(s, F.lit(str(current_year))), F.lit(f"{current_year}-01-01"))
        .when(older != "", F.concat(older, F.lit("-01-01")))
        .otherwise(F.lit(""))
    )


def entry_date(raw: Column, search_text: Column, current_year: int) -> Column:
    """Feed cascade: published text, then a date in the text, then a year signal."""
    day = F.coalesce(
        F.nullif(text_date(search_text), F.lit("")),
        F.nullif(year_signal(search_text, current_year), F.lit("")),
    )
    return F.coalesce(
        F.nullif(feed_date(raw), F.lit("")), F.concat(day, F.lit(" 00:00:00")), F.lit("")
    )


def site_date(style: Column, raw: Column, today: Column) -> Column:
    """Listing date by the source's date style; null when it cannot be read."""
    clean = strip(F.regexp_replace(text_of(raw), "&nbsp;", " "))
    return bind(clean, lambda s: _site_date(style, s, today))


def _site_date(style: Column, s: Column, today: Column) -> Column:
    d, y = r"(\d{1,2})", r"(\d{4})"
    dmy_full, dmy_abbr = rf"(?i)^{d}\s+{_FULL}\s+{y}$", rf"(?i)^{d}\s+{_ABBR}\s+{y}$"
    two = lambda t: F.coalesce(shaped(t, dmy_full, "dMy"), shaped(t, dmy_abbr, "dMy"))
    after_label = F.when(
        F.contains(s, F.lit("Published Date:")), strip(F.regexp_replace(s, r"(?s)^[^:]*:", ""))
    ).otherwise(s)
    ordinal = F.regexp_replace(s, r"(?i)(\d+)(st|nd|rd|th)\s+of\s+", "$1 ")
    days_ago = _part(s, r"(\d{1,6})\s*天前", 1).cast("int")
    month_day = r"(\d{1,2})[./-](\d{1,2})$"
    this_year = F.try_make_timestamp_ntz(
        F.year(today), _part(s, month_day, 1).cast("int"), _part(s, month_day, 2).cast("int"),
        F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"),
    )
    styles = {
        "month_day_year": shaped(s, rf"(?i)^{_FULL}\s+{d},\s+{y}$", "Mdy"),
        "numeric": F.coalesce(
            shaped(s, rf"^{d}/{d}/{y}$", "dmy"), shaped(s, rf"^{d}\.{d}\.{y}$", "dmy"),
            shaped(s, rf"^{y}-{d}-{d}$", "ymd"), shaped(s, rf"^{d}-{d}-{y}$", "dmy"),
        ),
        "day_month_year": shaped(s, dmy_full, "dMy"),
        "dotted_month": shaped(s, rf"(?i)^{_ABBR}\.\s*{d},\s*{y}", "Mdy"),
        "before_comma": two(strip(F.substring_index(s, ",", 1))),
        "after_label": two(after_label),
        "before_bullet": two(strip(F.substring_index(s, "•", 1))),
        "slash_day_first": shaped(s, rf"^{d}/{d}/{y}", "dmy"),
        "slash_month_first": shaped(s, rf"^{d}/{d}/{y}", "mdy"),
        "relative": F.coalesce(
            F.date_sub(today, days_ago).cast("timestamp_ntz"),
            shaped(s, rf"{y}[./-]{d}[./-]{d}", "ymd"),
            F.when(~s.rlike(rf"{y}[./-]{d}[./-]{d}"), this_year),
        ),
        "day_month_abbr": shaped(s, rf"(?i)^{d}\s+{_ABBR}\s+{y}", "dMy"),
        "ordinal": F.coalesce(
            shaped(ordinal, rf"(?i){d}(?:st|nd|rd|th)?\s+{_ANY}\.?,?\s+{y}", "dMy"),
            shaped(ordinal, rf"(?i){_ANY}\.?\s+{d}(?:st|nd|rd|th)?,?\s+{y}", "Mdy"),
            shaped(ordinal, rf"{y}-{d}-{d}", "ymd"),
        ),
        "trailing_dot": shaped(F.regexp_replace(s, r"[\s.]+$", ""), dmy_full, "dMy"),
        "feed": feed_timestamp(s),
    }
    case = None
    for name, value in styles.items():
        case = F.when(style == name, value) if case is None else case.when(style == name, value)
    return case.cast("date")


def resolve_undated(published_on: Column, policy: Column, today: Column) -> Column:
    """Undated items become today's under the ``today`` policy, else stay null."""
    return F.coalesce(published_on, F.when(policy == "today", today))

"""Dates of comments -> Beijing civil dates. Column -> Column; the reference date is an argument, never the clock."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewflow.functions.numbers import narrow_digits
from reviewflow.functions.text import SPACE, bound, pystrip

ZONE = "Asia/Shanghai"
#: Date headers whose date-only values stay as they are.
VERBATIM_HEADERS = ("评论日期", "评论时间", "评论日期与产品")
_NUMERALS = "一二三四五六七八九"


def chinese_numbers() -> dict[str, int]:
    """The numerals from 1 to 99 as they are spoken, by rule."""
    out = {c: i + 1 for i, c in enumerate(_NUMERALS)} | {"两": 2}
    tens = {"": 1} | {c: i + 1 for i, c in enumerate(_NUMERALS)}
    for head, t in tens.items():
        for tail, u in ({"": 0} | {c: i + 1 for i, c in enumerate(_NUMERALS)}).items():
            out[f"{head}十{tail}"] = 10 * t + u
    return out


def _count(raw: Column) -> Column:
    spoken = F.create_map(*(F.lit(x) for k, v in chinese_numbers().items() for x in (k, v)))
    return F.coalesce(narrow_digits(raw).try_cast("int"), F.try_element_at(spoken, raw))


def unix_date(c: Column) -> Column:
    """A count of seconds or milliseconds since 1970 as a Beijing date, else null."""
    return bound(pystrip(c), _unix)


def _unix(t: Column) -> Column:
    def of(x: Column) -> Column:
        seconds = F.when(F.abs(x) >= 10_000_000_000, x / 1000).otherwise(x)
        return F.when(F.abs(seconds) < 250_000_000_000, F.date_format(F.from_utc_timestamp(F.timestamp_seconds(seconds.cast("double")), ZONE), "yyyy-MM-dd"))

    return F.when(t.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$"), bound(t.try_cast("decimal(38,6)"), of))


def relative_date(c: Column, ref: date) -> Column:
    """Relative phrases of days, weeks, months and years against ``ref``, else null."""
    return bound(F.regexp_replace(pystrip(c), f"{SPACE}+", " "), lambda n: _relative(n, ref))


def _relative(n: Column, ref: date) -> Column:
    day = F.lit(ref)
    iso = lambda d: F.date_format(d, "yyyy-MM-dd")
    form = r"(?i)^([0-9０-９]+|[一二两三四五六七八九十]+) *(?:%s)$"

    def ago(unit: str, f: Callable[[Column], Column]) -> Column:
        raw = F.regexp_extract(n, form % unit, 1)
        return F.when(n.rlike(form % unit), bound(_count(raw), f))

    phrase = F.coalesce(
        ago("年 *前|years? +ago|yrs? +ago", lambda k: F.lpad((F.lit(ref.year) - k).cast("string"), 4, "0")),
        ago("[个個]?月 *前|months? +ago|mos? +ago", lambda k: F.date_format(F.add_months(day, -k), "yyyy-MM")),
        ago("周 *前|星期 *前|weeks? +ago|wks? +ago", lambda k: iso(F.date_sub(day, k * 7))),
        ago("天 *前|日 *前|days? +ago", lambda k: iso(F.date_sub(day, k))),
    )
    return (
        F.when(n.isin("今天", "今日") | (F.lower(n) == "today"), iso(day))
        .when((n == "昨天") | (F.lower(n) == "yesterday"), iso(F.date_sub(day, 1)))
        .when(n == "前天", iso(F.date_sub(day, 2)))
        .when(n.rlike("(?i)(?:前|ago)$"), phrase)
    )


def _calendar(c: Column, form: str) -> Column:
    """The date of a text that has the form (groups year, month, day), if the calendar has it."""
    y, m, d = (F.regexp_extract(c, form, i) for i in (1, 2, 3))
    text = F.concat(y, F.lit("-"), F.lpad(m, 2, "0"), F.lit("-"), F.lpad(d, 2, "0"))
    return F.when(c.rlike(form), F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd"))


_CLOCK = r"(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9]"
_ISO_CLOCK = r"(?:[01][0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:\.[0-9]{1,6})?)?"


def _iso_date(c: Column) -> Column:
    zoned = rf"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ]{_ISO_CLOCK}(?:Z|[+-](?:[01][0-9]|2[0-3]):[0-5][0-9])$"
    at = F.try_to_timestamp(F.regexp_replace(c, "Z$", "+00:00"))
    aware = F.when(c.rlike(zoned), F.date_format(F.from_utc_timestamp(at, ZONE), "yyyy-MM-dd"))
    naive = _calendar(c, rf"^([0-9]{{4}})-([0-9]{{2}})-([0-9]{{2}})(?:[T ]{_ISO_CLOCK})?$")
    return F.coalesce(aware, naive)


def platform_date(c: Column, ref: date) -> Column:
    """The Beijing date of a date text in any platform's form; texts in none of them stay, blank becomes null."""
    patterns = (
        rf"^([0-9]{{4}})-([0-9]{{1,2}})-([0-9]{{1,2}})(?: +{_CLOCK})?$",
        rf"^([0-9]{{4}})/([0-9]{{1,2}})/([0-9]{{1,2}})(?: +{_CLOCK})?$",
        r"^([0-9]{4})年([0-9]{1,2})月([0-9]{1,2})日$",
    )
    edited = rf"(?i)(?:{SPACE}+\(edited\)|{SPACE}*（修改过）){SPACE}*$"

    def of(x: Column) -> Column:
        c, t, n = x["c"], x["t"], x["n"]
        written = F.when(n.rlike("^[0-9]{4}[-/年]"), F.coalesce(_iso_date(n), *(_calendar(n, p) for p in patterns)))
        compact = F.coalesce(_calendar(t, "^([0-9]{4})([0-9]{2})([0-9]{2})$"), c)
        rest = F.coalesce(_unix(t), relative_date(n, ref), written, c)
        return F.when(t == "", None).when(t.rlike("^[0-9]{8}$"), compact).otherwise(rest)

    stripped = bound(pystrip(c), lambda t: F.struct(c.alias("c"), t.alias("t"), F.regexp_replace(t, edited, "").alias("n")))
    return F.when(c.isNotNull(), bound(stripped, of))


def is_datetime_text(c: Column) -> Column:
    return narrow_digits(c).rlike("[0-9]{1,2}:[0-9]{1,2}")


def dated_by_header(c: Column, header: str, ref: date) -> Column:
    """Values under a verbatim header are converted only if they are a count or hold a time of day."""
    if header not in VERBATIM_HEADERS:
        return platform_date(c, ref)
    return F.when(pystrip(c).rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$") | is_datetime_text(c), platform_date(c, ref)).otherwise(c)


_SPLIT = rf"(?d)^{SPACE}*([0-9]{{4}}年[0-9]{{1,2}}月[0-9]{{1,2}}日|[0-9]{{4}}[/-][0-9]{{1,2}}[/-][0-9]{{1,2}}){SPACE}*(?:(?:已购|已购买)[:：])?{SPACE}*(.*)$"


def split_date(c: Column) -> Column:
    """The leading date of a combined date and product text, else the whole text."""
    return F.when(c.rlike(_SPLIT), F.regexp_extract(c, _SPLIT, 1)).when(pystrip(c) == "", None).otherwise(c)


def split_product(c: Column) -> Column:
    """What follows the leading date, stripped; null where there is no date or nothing follows."""
    return F.when(c.rlike(_SPLIT), F.nullif(pystrip(F.regexp_extract(c, _SPLIT, 2)), F.lit("")))

"""Platform layouts: recognising a table by its exact headers and projecting it with the layout's operations."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.conf import values as V
from reviewflow.functions.numbers import narrow_digits
from reviewflow.functions.text import SPACE, nonblank, pystrip


class LayoutError(ValueError):
    """No layout, or more than one, for a table's headers."""


@dataclass(frozen=True)
class Layout:
    platform: str
    name: str
    headers: tuple[str, ...]
    outputs: tuple[tuple[str, str, tuple[str, ...]], ...]


def layouts() -> list[Layout]:
    return [Layout(p, n, h, o) for p, all_ in V.LAYOUTS.items() for n, h, o in all_]


def platforms_named(name: str) -> list[str]:
    """Platforms whose name or other name this is, without letter case."""
    key = name.strip().casefold()
    return [p for p in V.LAYOUTS if key in {p.casefold(), *(a.casefold() for a in V.LAYOUT_NAMES[p])}]


def detect(headers: list[str], platform: str | None = None) -> Layout:
    """The layout whose headers are exactly these, in order; a named platform narrows the choice."""
    allowed = set(platforms_named(platform)) if platform else set(V.LAYOUTS)
    if not allowed:
        raise LayoutError(f"unknown platform {platform}")
    found = [x for x in layouts() if x.platform in allowed and x.headers == tuple(headers)]
    if len(found) != 1:
        raise LayoutError("no layout has these headers" if not found else f"several layouts: {[x.platform for x in found]}")
    return found[0]


def join_trimmed(*parts: Column) -> Column:
    return F.nullif(F.concat_ws(V.JOIN_SEPARATOR, *map(nonblank, parts)), F.lit(""))


def _dated(y: Column, m: Column, d: Column) -> Column:
    return F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))


def amazon_review_date(c: Column) -> Column:
    form = r"^([0-9]{4})年([0-9]{1,2})月([0-9]{1,2})日(?:在.+发布评论)?$"
    t = pystrip(c)
    return F.when(t == "", None).when(t.rlike(form), _dated(*(F.regexp_extract(t, form, i) for i in (1, 2, 3)))).otherwise(c)


def amazon_star_rating(c: Column) -> Column:
    form = rf"^([0-9]+(?:\.[0-9]+)?){SPACE}*颗星，最多{SPACE}*5{SPACE}*颗星$"
    number = F.regexp_extract(pystrip(c), form, 1)
    return F.when((number != "") & number.try_cast("decimal(38,10)").between(1, 5), number).otherwise(c)


def amazon_helpful_count(c: Column) -> Column:
    number = F.regexp_extract(narrow_digits(pystrip(c)), rf"^([0-9]+){SPACE}*个人发现此评论有用$", 1)
    return F.when(number != "", F.regexp_replace(number, "^0+(?=[0-9])", "")).otherwise(c)


def rakuten_review_date(c: Column) -> Column:
    t = pystrip(c)
    us, iso = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$", r"^([0-9]{4})[/-]([0-9]{1,2})[/-]([0-9]{1,2})$"
    a = _dated(F.regexp_extract(t, us, 3), F.regexp_extract(t, us, 1), F.regexp_extract(t, us, 2))
    b = _dated(*(F.regexp_extract(t, iso, i) for i in (1, 2, 3)))
    text = F.when(t.rlike(us), a).when(t.rlike(iso), b)
    return F.coalesce(F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd"), c)


def rakuten_helpful_count(c: Column) -> Column:
    number = F.regexp_extract(narrow_digits(pystrip(c)), rf"^([0-9]+){SPACE}*人$", 1)
    return F.when(number != "", F.regexp_replace(number, "^0+(?=[0-9])", "")).otherwise(c)


def rakuten_user_attribute(c: Column) -> Column:
    gender = F.regexp_extract(c, "(男性|女性)", 1)
    age = F.regexp_replace(F.regexp_extract(c, rf"([0-9]{{1,3}}{SPACE}*(?:代(?:以上)?|歳|才))", 1), f"{SPACE}+", " ")
    return F.nullif(F.concat_ws(" ", F.nullif(gender, F.lit("")), F.nullif(age, F.lit(""))), F.lit(""))


def rakuten_display_name(c: Column) -> Column:
    return F.nullif(nonblank(c), F.lit("購入者さん"))


OPERATIONS = {
    "copy": lambda c: c,
    "empty": lambda: F.lit(None).cast("string"),
    "join_trimmed": join_trimmed,
    "amazon_review_date": amazon_review_date,
    "amazon_star_rating": amazon_star_rating,
    "amazon_helpful_count": amazon_helpful_count,
    "rakuten_review_date": rakuten_review_date,
    "rakuten_helpful_count": rakuten_helpful_count,
    "rakuten_user_attribute": rakuten_user_attribute,
    "rakuten_display_name": rakuten_display_name,
}


def project(rows: DataFrame, layout: Layout, keep: list[str]) -> DataFrame:
    """The platform's temporary table."""
    return rows.select(*keep, *(OPERATIONS[op](*(F.col(f"`{s}`") for s in src)).alias(out) for out, op, src in layout.outputs))


def project_all(tables: list[DataFrame], keep: list[str], platform: str | None = None) -> DataFrame:
    """Every table through its own layout, then one table in the given order; all layouts must give the same fields in order.

    All tables are checked before anything is read. Blank rows are kept.
    """
    if not tables:
        raise LayoutError("no table")
    chosen = [detect([c for c in t.columns if c not in keep], platform) for t in tables]
    shapes = {tuple(o[0] for o in x.outputs) for x in chosen}
    if len({x.platform for x in chosen}) > 1 or len(shapes) > 1:
        raise LayoutError("the layouts of these tables have different fields")
    return reduce(DataFrame.unionByName, [project(t, x, keep) for t, x in zip(tables, chosen, strict=True)])

"""Header resolution and the eleven-column standard table.

Headers are resolved on the driver; the result is one ``select`` that Catalyst prunes to the columns it needs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.conf import values as V
from reviewflow.functions import dates, numbers
from reviewflow.functions.text import nonblank


class HeaderError(ValueError):
    """A required header is missing, or one field has several sources."""


def stripped(h: object) -> str:
    """Merge and naming: compared without white space at the ends."""
    return "" if h is None else str(h).strip()


def without_space(h: object) -> str:
    """Standardizing, cleaning, audit, keyword filter: compared without any white space."""
    return re.sub(r"\s+", "", stripped(h))


def folded(h: object) -> str:
    """Reply prefixes: like without_space, and without letter case."""
    return without_space(h).casefold()


def one_column(headers: list[str], target: str, rule=without_space) -> str:  # noqa: ANN001
    """The single header that equals the target by a rule of comparison."""
    found = [h for h in headers if rule(h) == rule(target)]
    if len(found) != 1:
        raise HeaderError(f"{len(found)} headers for {target}, not one")
    return found[0]


@dataclass(frozen=True)
class Selected:
    """Where an output field comes from: one header, parts of a composite, or nothing."""

    field: str
    source: str | None
    parts: tuple[str | None, ...] = ()


def select_columns(headers: list[str]) -> list[Selected]:
    lookup: dict[str, list[str]] = {}
    for h in headers:
        if without_space(h):
            lookup.setdefault(without_space(h), []).append(h)
    out = []
    for field, aliases in V.ALIASES.items():
        found = [h for a in dict.fromkeys(map(without_space, aliases)) for h in lookup.get(a, [])]
        if len(found) > 1:
            raise HeaderError(f"several columns for {field}: {found}")
        parts = tuple((lookup.get(without_space(p)) or [None])[0] for p in V.COMPOSITE.get(field, ()))
        if not found and not any(parts) and field in V.REQUIRED:
            raise HeaderError(f"no column for {field}")
        out.append(Selected(field, found[0] if found else None, parts if any(parts) else ()))
    return out


def dropped_headers(headers: list[str]) -> list[str]:
    """Headers of the privacy list that a table has and the standard table won't."""
    listed = {without_space(h) for h in V.DROP_HEADERS}
    return [h for h in headers if without_space(h) in listed]


def field_value(s: Selected, ref: date, product_name: str | None = None) -> Column:
    src = F.col(f"`{s.source}`") if s.source else F.lit(None).cast("string")
    combined = s.source is not None and without_space(s.source) == "评论日期与产品"
    if s.field == "评论日期":
        value = dates.split_date(src) if combined else src
        return dates.dated_by_header(value, without_space(s.source) if s.source else "", ref)
    if s.field == "产品名":
        value = dates.split_product(src) if combined else src
        return numbers.product_or(value, product_name) if product_name else value
    if s.field == "电商平台评分":
        return numbers.normalize_rating(src)
    if s.field == "点赞数":
        return numbers.normalize_likes(src)
    if s.parts:
        gender, age = (F.col(f"`{p}`") if p else F.lit(None).cast("string") for p in s.parts)
        return numbers.attribute(src, gender, age)
    return src


def standardized(rows: DataFrame, ref: date, keep: list[str], product_name: str | None = None, identity: Column | None = None) -> DataFrame:
    """The eleven fields in order, after the kept lineage columns. 哈希ID is generated, never copied."""
    headers = [c for c in rows.columns if c not in keep]
    cols = []
    for s in select_columns(headers):
        value = (identity if identity is not None else F.lit(None).cast("string")) if s.field == "哈希ID" else field_value(s, ref, product_name)
        cols.append(value.alias(s.field))
    return rows.select(*keep, *cols)


def filled(c: str) -> Column:
    return nonblank(F.col(f"`{c}`"))

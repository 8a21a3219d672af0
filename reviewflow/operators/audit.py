"""Auditing a standardized table against its source: issue codes and counts, never values."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.conf import values as V
from reviewflow.functions.text import nonblank
from reviewflow.operators.headers import HeaderError, field_value, select_columns, without_space

# Headers of raw identities that a standardized table must not have.
RAW_IDENTITIES = frozenset(("名称", "用户名称", "用户名", "昵称", "username", "author", "author_name", "author_channel_id", "authorChannelId", "用户ID", "IP地址", "IP属地", "ip_location"))


def header_issues(columns: list[str], expect_hash: bool = True) -> list[str]:
    out = []
    if list(columns) != list(V.ALIASES):
        out.append("header_schema_mismatch")
    bare = [without_space(c) for c in columns]
    if len(set(bare)) < len(bare):
        out.append("duplicate_output_header")
    if set(columns) & RAW_IDENTITIES:
        out.append("forbidden_identity_header")
    n = bare.count("哈希ID")
    if n > 1:
        out.append("duplicate_hash_id_header")
    if n == 0 and expect_hash:
        out.append("missing_hash_id_header")
    return out


def value_counts(std: DataFrame, hash_column: str = "哈希ID", likes: str = "点赞数") -> DataFrame:
    """(n_rows, bad_hash, blank_likes) in one pass."""
    h = F.col(f"`{hash_column}`")
    return std.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum((nonblank(h).isNotNull() & ~h.rlike("^[0-9a-f]{64}$")).cast("long")), F.lit(0)).alias("bad_hash"),
        F.coalesce(F.sum(nonblank(F.col(f"`{likes}`").cast("string")).isNull().cast("long")), F.lit(0)).alias("blank_likes"),
    )


def _differs(field: str, expected: Column, found: Column) -> Column:
    """Blank equals blank, numbers are equal by value, anything else by text. A blank product may have got the run's product name."""
    a, b = expected.cast("string"), found.cast("string")
    num = r"^[+-]?[0-9]+(\.[0-9]+)?$"
    same = F.when(a.rlike(num) & b.rlike(num), a.try_cast("decimal(38,10)").eqNullSafe(b.try_cast("decimal(38,10)"))).otherwise(a.eqNullSafe(b))
    empty = F.lit(True) if field == "产品名" else nonblank(b).isNull()
    return ~F.when(nonblank(a).isNull(), empty).otherwise(same)


def mapping_mismatches(std: DataFrame, source: DataFrame, keys: list[str], ref: date) -> DataFrame:
    """(field, mismatches): the mapping is computed again from the source and compared cell by cell on the row keys."""
    again = [(s.field, field_value(s, ref)) for s in select_columns([c for c in source.columns if c not in keys]) if s.field != "哈希ID"]
    src = source.select(*keys, *(v.alias(f"_src_{i}") for i, (_, v) in enumerate(again)))
    both = std.join(src, keys)
    wrong = [_count(_differs(f, F.col(f"_src_{i}"), F.col(f"`{f}`"))).alias(f"m{i}") for i, (f, _) in enumerate(again)]
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"m{i}").alias("mismatches")) for i, (f, _) in enumerate(again))))
    return both.agg(*wrong).select(pairs.alias("x")).select("x.*")


def sheet_counts(std: DataFrame, source: DataFrame | None, sheet: str, row: str, ref: date) -> tuple[DataFrame, bool]:
    """(sheet, n_rows, n_source, bad_hash, blank_likes, mismatches) of every sheet, and whether the mapping could be computed again.

    Both sides are tables of one layout each. Rows are compared by their number in their sheet; a row that only one side has is in
    its side's count. Checks of columns that are absent count nothing.
    """
    own = [c for c in std.columns if c not in (sheet, row)]
    has = lambda h: F.col(f"`{h}`") if h in own else None
    h, likes = has("哈希ID"), has("点赞数")
    bad = F.lit(False) if h is None else nonblank(h).isNotNull() & ~h.rlike("^[0-9a-f]{64}$")
    blank = F.lit(False) if likes is None else nonblank(likes.cast("string")).isNull()
    left = std.select(F.col(sheet).alias("sheet"), F.col(row).alias("_row"), F.lit(1).alias("_std"), bad.alias("_bad"), blank.alias("_blank"), *(F.col(f"`{c}`") for c in own))
    again: list[tuple[str, Column]] = []
    checked = False
    if source is not None:
        try:
            selected = select_columns([c for c in source.columns if c not in (sheet, row)])
            again = [(s.field, field_value(s, ref)) for s in selected if s.field != "哈希ID" and s.field in own]
            checked = True
        except HeaderError:
            pass
        right = source.select(F.col(sheet).alias("sheet"), F.col(row).alias("_row"), F.lit(1).alias("_src"), *(v.alias(f"_src_{i}") for i, (_, v) in enumerate(again)))
        both = left.join(right, ["sheet", "_row"], "full")
    else:
        both = left.withColumn("_src", F.lit(None).cast("int"))
    met = F.col("_std").isNotNull() & F.col("_src").isNotNull()
    wrong = [_count(met & _differs(f, F.col(f"_src_{i}"), F.col(f"`{f}`"))) for i, (f, _) in enumerate(again)]
    total = sum(wrong[1:], wrong[0]) if wrong else F.lit(0).cast("long")
    counts = both.groupBy("sheet").agg(
        F.count("_std").alias("n_rows"), F.count("_src").alias("n_source"), _count(F.col("_bad")).alias("bad_hash"), _count(F.col("_blank")).alias("blank_likes"), total.alias("mismatches")
    )
    return counts, checked


def _count(c: Column) -> Column:
    return F.coalesce(F.sum(c.cast("long")), F.lit(0))


def audit(std: DataFrame, source: DataFrame, keys: list[str], ref: date) -> dict[str, object]:
    """Codes and counts of everything that is wrong; one pass for values, one join for the mapping."""
    fields = [c for c in std.columns if c not in keys]
    issues = dict.fromkeys(header_issues(fields), 1)
    if "header_schema_mismatch" not in issues:
        counts = value_counts(std).first()
        issues |= {code: n for code, n in (("invalid_hash_id_format", counts.bad_hash), ("blank_likes_value", counts.blank_likes)) if n}
        if (expected := source.count()) != counts.n_rows:
            issues["data_row_count_mismatch"] = abs(expected - counts.n_rows)
        try:
            wrong = sum(r.mismatches for r in mapping_mismatches(std, source, keys, ref).collect())
            checked = True
        except HeaderError:
            wrong, checked = 0, False
        if wrong:
            issues["mapped_value_mismatch"] = wrong
    else:
        checked = False
    return {"passed": not issues, "issues": issues, "source_mapping_checked": checked}


def sheet_issues(expected: list[str], found: list[str]) -> list[tuple[str, str | None]]:
    """(code, sheet) for sheets of a standardized workbook that its source has not, or has in another order."""
    out: list[tuple[str, str | None]] = [("worksheet_name_or_order_mismatch", None)] if expected != found else []
    return out + [("source_worksheet_missing", s) for s in found if s not in expected]

"""Comparing two tables as multisets and row by row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from reviewflow.functions.text import nonblank, row_hash

#: Sizes of the samples in a comparison report; the counts beside them cover everything.
ROW_SAMPLES, SEQUENCE_SAMPLES, GROUP_SAMPLES = 100, 50, 20


def multiset_difference(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What each side has more of than the other, with multiplicity."""
    return left.exceptAll(right), right.exceptAll(left)


def excess_rows(left: DataFrame, right: DataFrame, row: str, columns: list[str]) -> DataFrame:
    """(row, hash, columns...) of the first occurrences on the left of every row it has more often than the right."""
    quoted = [f"`{c}`" for c in columns]
    more = left.select(*quoted).exceptAll(right.select(*quoted)).groupBy(*quoted).agg(F.count("*").alias("_n"))
    same = [F.col(f"l.`{c}`").eqNullSafe(F.col(f"m.`{c}`")) for c in columns]
    hit = left.alias("l").join(more.alias("m"), reduce(lambda a, b: a & b, same))
    rank = F.row_number().over(W.partitionBy(*(F.col(f"l.`{c}`") for c in columns)).orderBy(F.col(f"l.`{row}`")))
    ranked = hit.withColumn("_rank", rank).where("_rank <= _n")
    cells = [F.coalesce(F.col(f"l.`{c}`").cast("string"), F.lit("")) for c in columns]
    return ranked.select(F.col(f"l.`{row}`").alias("source_row"), row_hash(cells).alias("row_hash"), *(F.col(f"l.`{c}`") for c in columns))


def sequence_mismatches(left: DataFrame, right: DataFrame, row: str, column: str) -> DataFrame:
    """(row, left, right) where both have the row and its values differ; as far as the shorter goes."""
    both = left.select(row, F.col(f"`{column}`").alias("left_value")).join(right.select(row, F.col(f"`{column}`").alias("right_value")), row)
    return both.where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def duplicate_groups(rows: DataFrame, column: str, row: str) -> DataFrame:
    """(value, n, first_row) of every nonblank value that occurs more than once."""
    v = nonblank(F.col(f"`{column}`").cast("string")).alias("value")
    return rows.select(v, row).where("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n"), F.min(row).alias("first_row")).where("n > 1")


def duplicate_summary(rows: DataFrame, column: str, row: str) -> DataFrame:
    """(duplicate_rows, duplicate_groups): rows beyond the first of their value, and values that repeat."""
    g = duplicate_groups(rows, column, row)
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"), F.count("*").alias("duplicate_groups"))


def row_sequence_mismatches(left: DataFrame, right: DataFrame, row: str, columns: list[str]) -> DataFrame:
    """(row_number, left, right) of rows that both sides have and that differ in any cell; cells as a JSON array."""
    cells = lambda t, name: t.select(F.col(row).alias("row_number"), F.to_json(F.array(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns))).alias(name))
    return cells(left, "left").join(cells(right, "right"), "row_number").where("left <> right")


def report(left: DataFrame, right: DataFrame, row: str, columns: list[str], comment: str) -> dict[str, object]:
    """Counts of all differences with bounded samples; nothing else comes to the driver."""
    only_left, only_right = excess_rows(left, right, row, columns), excess_rows(right, left, row, columns)
    text_left, text_right = multiset_difference(left.select(f"`{comment}`"), right.select(f"`{comment}`"))
    moved = row_sequence_mismatches(left, right, row, columns)
    dup = {side: duplicate_summary(t, comment, row).first().asDict() for side, t in (("left", left), ("right", right))}
    shown = lambda t, order, n: [r.asDict() for r in t.orderBy(order).limit(n).collect()]
    return {
        "rows_left": left.count(), "rows_right": right.count(), "columns_left": len(columns), "columns_right": len(columns), "header": columns,
        "only_left": only_left.count(), "only_right": only_right.count(), "comments_only_left": text_left.count(), "comments_only_right": text_right.count(),
        "sequence_mismatches": moved.count(), "duplicates": dup,
        "samples": shown(only_left, "source_row", ROW_SAMPLES), "samples_right": shown(only_right, "source_row", ROW_SAMPLES),
        "comment_samples_left": [r[0] for r in text_left.orderBy(f"`{comment}`").limit(ROW_SAMPLES).collect()],
        "comment_samples_right": [r[0] for r in text_right.orderBy(f"`{comment}`").limit(ROW_SAMPLES).collect()],
        "sequence_samples": shown(moved, "row_number", SEQUENCE_SAMPLES), "group_samples": shown(duplicate_groups(left, comment, row), "first_row", GROUP_SAMPLES),
    }

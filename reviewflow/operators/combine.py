"""Ordered union of tables, source columns, blank rows, and counts of what is there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.functions.text import pystrip
from reviewflow.operators.headers import HeaderError, stripped

#: Lineage of a row: file, sheet and row, by which the order of the input is restored.
LINEAGE = ("_file_idx", "_file", "_sheet_idx", "_sheet", "_row")


def is_blank(columns: list[str]) -> Column:
    """Whether no cell of a row holds anything but white space."""
    return reduce(lambda a, b: a & b, (F.coalesce(pystrip(F.col(f"`{c}`").cast("string")) == "", F.lit(True)) for c in columns))


def merged(tables: list[DataFrame], add_source_columns: bool = False) -> DataFrame:
    """Ordered union of sheets that carry lineage columns; the first header wins, others must equal it after stripping.

    Headers are compared before any row is read. Blank rows go. The order is that of the lineage columns; sort at the sink.
    """
    if not tables:
        raise HeaderError("no table to merge")
    own = lambda t: [c for c in t.columns if c not in LINEAGE]
    first = own(tables[0])
    for t in tables[1:]:
        if [stripped(h) for h in own(t)] != [stripped(h) for h in first]:
            raise HeaderError(f"headers differ: {own(t)} and {first}")
    named = [t.select(*LINEAGE, *(F.col(f"`{a}`").alias(b) for a, b in zip(own(t), first, strict=True))) for t in tables]
    out = reduce(DataFrame.unionByName, named).where(~is_blank(first))
    if add_source_columns:
        out = out.withColumn("source_file", F.element_at(F.split("_file", "[/\\\\\\\\]"), -1)).withColumn("source_sheet", F.col("_sheet"))
    return out


def inventory(rows: DataFrame, sheets: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """(keys..., rows): rows that aren't blank of every sheet, 0 for sheets without any."""
    counts = rows.where(~is_blank(columns)).groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return sheets.select(*keys).distinct().join(counts, keys, "left").select(*keys, F.coalesce("n_rows", F.lit(0)).alias("n_rows"))

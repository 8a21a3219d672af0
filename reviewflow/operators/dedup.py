"""Keeping the best of equal comments, clearing repeated subcomments, and the event log of both.

Rows are identified by (sheet columns, order columns). A hot comment costs each task one row, as only its maximum travels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from reviewflow.conf import values as V
from reviewflow.functions.numbers import likes_for_ranking
from reviewflow.functions.text import nonblank, pystrip, strip_https
from reviewflow.operators.rules import deletion_reason
from reviewflow.storage import written

DUPLICATE = "同一工作表内重复评论（保留点赞数最高，点赞相同保留最后一条）"
SUBCOMMENTS = ("一级评论", "二级评论", "三级评论")


def stripped_comment(c: Column) -> Column:
    return F.coalesce(pystrip(c), F.lit(""))


def with_reasons(rows: DataFrame, sheet: list[str], order: list[str], comment: str, likes: str | None, clean_words: list[str] | None = None) -> DataFrame:
    """``_reason`` of every row: a rule's reason, or that an equal comment of its sheet is kept instead.

    ``order`` is unique within a sheet. The best of a comment is a maximum, so tasks reduce a comment to one row each before
    anything is shuffled, however many rows have it; what travels is a 128-bit digest, not the text. Joined back, a hot comment
    meets a single row, so its own rows can be split. Equal comments share their rule, so the maximum needs none.
    """
    rank = likes_for_ranking(F.col(f"`{likes}`")) if likes else F.lit(0)
    marked = rows.withColumn("_text", stripped_comment(F.col(f"`{comment}`")))
    marked = marked.withColumns({"_k1": F.xxhash64("_text"), "_k2": F.xxhash64("_text", F.lit(1)), "_own": F.struct(rank.alias("_likes"), *order)})
    key = [*sheet, "_k1", "_k2"]
    best = marked.groupBy(*key).agg(F.max("_own").alias("_best")).withColumnsRenamed({k: f"_b{i}" for i, k in enumerate(key)})
    same = [F.col(k).eqNullSafe(F.col(f"_b{i}")) if k in sheet else F.col(k) == F.col(f"_b{i}") for i, k in enumerate(key)]
    reason = F.coalesce(deletion_reason(F.col("_text"), clean_words), F.when(~F.col("_own").eqNullSafe(F.col("_best")), F.lit(DUPLICATE)))
    out = marked.join(best, same, "left").withColumn("_reason", reason)
    return out.drop("_text", "_k1", "_k2", "_own", "_best", *(f"_b{i}" for i in range(len(key))))


def best_rows(rows: DataFrame, sheet: list[str], order: list[str], comment: str, likes: str | None) -> DataFrame:
    """Only the survivors of ``with_reasons``."""
    return with_reasons(rows, sheet, order, comment, likes).where("_reason IS NULL").drop("_reason")


def cleared_cells(rows: DataFrame, sheet: list[str], order: list[str], columns: tuple[str, ...] = SUBCOMMENTS, least: int = V.SUBCOMMENT_LENGTH) -> DataFrame:
    """(sheet..., order..., _col, value, reason) of subcomment cells to clear: too short, or the same text stands later.

    All columns of a sheet are one pool; later means a later row, or in the same row a column further right.
    """
    cells = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(c).alias("_col"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(columns))))
    each = rows.select(*sheet, *order, cells.alias("_c")).select(*sheet, *order, "_c.*").withColumn("_t", nonblank(F.col("value"))).where("_t IS NOT NULL")
    short = F.length("_t") < least
    # Of equal texts the last stays. A maximum per text and its digest travel, never all rows of a hot text.
    each = each.withColumns({"_short": short, "_k1": F.xxhash64("_t"), "_k2": F.xxhash64("_t", F.lit(1)), "_own": F.struct(*order, "i")})
    key = [*sheet, "_k1", "_k2"]
    last = each.where(~F.col("_short")).groupBy(*key).agg(F.max("_own").alias("_last")).withColumnsRenamed({k: f"_l{i}" for i, k in enumerate(key)})
    same = [F.col(k).eqNullSafe(F.col(f"_l{i}")) if k in sheet else F.col(k) == F.col(f"_l{i}") for i, k in enumerate(key)]
    both = each.join(last, same, "left")
    named = lambda text: F.concat(F.lit(f"{text}: "), "_col")
    reason = F.when(F.col("_short"), named(f"子评论长度小于 {least}")).when(~F.col("_own").eqNullSafe(F.col("_last")), named("同一工作表内重复子评论"))
    out = both.withColumn("reason", reason).where("reason IS NOT NULL").withColumn("value", F.col("_t"))
    return out.select(*sheet, *order, "_col", "value", "reason")


def numbered(rows: DataFrame, sheet: list[str], order: list[str], name: str, first: int) -> DataFrame:
    """Rows with their number within their sheet by ``order``, from ``first`` on, without a window over a sheet.

    Rows are sorted in range partitions; a row's number is its place in its part of the sheet plus the sizes of the sheet's parts in
    the partitions before, which are as many as partitions and sheets.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *sheet, *order).sortWithinPartitions(*sheet, *order)
    placed = written(ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "numbered-rows")
    sizes = placed.groupBy(*sheet, "_part").agg(F.min("_at").alias("_start"), F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(W.partitionBy(*sheet).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.withColumn("_before", before).select(*(F.col(c).alias(f"_o_{c}") for c in sheet), F.col("_part").alias("_o_part"), "_start", "_before")
    same = [F.col("_part") == F.col("_o_part"), *(F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in sheet)]
    out = placed.join(offsets, same).withColumn(name, F.col("_at") - F.col("_start") + F.col("_before") + first)
    return out.drop("_part", "_at", "_start", "_before", "_o_part", *(f"_o_{c}" for c in sheet))


def clear_subcomments(rows: DataFrame, sheet: list[str], order: list[str], columns: tuple[str, ...] = SUBCOMMENTS) -> DataFrame:
    """The rows with those cells set to null; other cells keep their raw text."""
    key = [*sheet, *order]
    gone = cleared_cells(rows, sheet, order, columns).groupBy(*key).agg(F.collect_set("_col").alias("_gone"))  # at most one entry for each column
    both = rows.join(gone.withColumnsRenamed({k: f"_k_{i}" for i, k in enumerate(key)}), [F.col(k).eqNullSafe(F.col(f"_k_{i}")) for i, k in enumerate(key)], "left")
    keep = {c: F.when(F.array_contains(F.coalesce("_gone", F.array().cast("array<string>")), c), None).otherwise(F.col(f"`{c}`")) for c in columns}
    return both.withColumns(keep).drop("_gone", *(f"_k_{i}" for i in range(len(key))))


def clean_rows(rows: DataFrame, sheet: list[str], order: list[str], comment: str, likes: str | None, platform: str | None = None, clean_words: list[str] | None = None) -> DataFrame:
    """The whole cleaning stage: links out (one platform), rules, best of equal comments, subcomments."""
    if platform == "twitter-comments":
        rows = rows.withColumn(comment, strip_https(F.col(f"`{comment}`")))
    kept = with_reasons(rows, sheet, order, comment, likes, clean_words).where("_reason IS NULL").drop("_reason")
    return clear_subcomments(kept, sheet, order)


def event_log(rows: DataFrame, sheet: list[str], order: list[str], comment: str, likes: str | None, row_number: str, clean_words: list[str] | None = None) -> DataFrame:
    """(action, sheet..., row_number, column_header, reason, value): deleted rows by their original number, cleared cells by the
    number they have after the deletions. All ``delete_row`` events come first; sort by ``_event_order`` to write them."""
    marked = written(with_reasons(rows, sheet, order, comment, likes, clean_words), "events-marked")  # three branches read it
    deleted = marked.where("_reason IS NOT NULL").select(
        F.lit("delete_row").alias("action"), *sheet, F.col(row_number).cast("long").alias("row_number"), F.lit("").alias("column_header"),
        F.col("_reason").alias("reason"), F.col(f"`{comment}`").alias("value"),
    )
    kept = numbered(marked.where("_reason IS NULL"), sheet, order, "_new", 2)
    cells = cleared_cells(kept, sheet, ["_new"])
    cleared = cells.select(F.lit("clear_cell").alias("action"), *sheet, F.col("_new").cast("long").alias("row_number"), F.col("_col").alias("column_header"), "reason", "value")
    return deleted.unionByName(cleared)

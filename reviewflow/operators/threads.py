"""Comment threads: joining by comment id, flattening trees, merging roots, counts by level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.storage import written


class UnmatchedError(ValueError):
    """A row of the left table has no partner."""


def joined_by_id(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Exact join of every left row with its partner; fails where a left row has none, instead of dropping it."""
    checked = left.join(right.select(F.col(key).alias("_r"), *[c for c in right.columns if c != key]), F.col(key) == F.col("_r"), "left")
    sure = F.when(F.col("_r").isNull(), F.raise_error(F.lit("a comment id has no partner"))).otherwise(F.col("_r"))
    return checked.withColumn("_r", sure).where("_r IS NOT NULL").drop("_r")


def flattened(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, parent, root, level, is_reply, path) in pre-order by path, for trees of any depth.

    Pointer doubling: each node knows the stretch of its path from some ancestor down to itself; a round puts the ancestor's own
    stretch before it, so stretches double and a tree of depth d takes log2(d) rounds, each written. A node whose parent is absent is a
    root. Once a round completes no node, only nodes on or below a cycle are open: they have no level and don't come out.
    """
    n = nodes.select(F.col(node).alias("node"), F.col(parent).alias("parent")).groupBy("node").agg(F.min("parent").alias("parent"))
    known = n.select(F.col("node").alias("_known"))
    padded = F.lpad(F.col("node").cast("string"), 20, "0")
    start = n.join(known, F.col("parent") == F.col("_known"), "left")
    stretch = start.select("node", "parent", F.col("node").alias("top"), F.col("_known").alias("above"), F.lit(1).alias("size"), padded.alias("path"))
    stretch = written(stretch, "thread-stretches")
    before, left = stretch.count(), stretch.where("above IS NOT NULL").count()
    # A tree deeper than the last round's stretches has nodes of every depth, so each round completes some until all are complete.
    while 0 < left < before:
        upper = stretch.select(F.col("node").alias("_n"), F.col("top").alias("_top"), F.col("above").alias("_above"), F.col("size").alias("_size"), F.col("path").alias("_path"))
        joined = stretch.where("above IS NOT NULL").join(upper, F.col("above") == F.col("_n"))
        longer = joined.select("node", "parent", F.col("_top").alias("top"), F.col("_above").alias("above"), (F.col("size") + F.col("_size")).alias("size"), F.concat_ws("/", "_path", "path").alias("path"))
        stretch = written(stretch.where("above IS NULL").unionByName(longer), "thread-stretches")
        before, left = left, stretch.where("above IS NOT NULL").count()
    done = stretch.where("above IS NULL")
    level = F.col("size") - 1
    return done.select("node", "parent", F.col("top").alias("root"), level.alias("level"), "path", (level > 0).alias("is_reply"))


def level_summary(flat: DataFrame) -> DataFrame:
    return flat.groupBy("level").agg(F.count("*").alias("n"))


def merged_roots(primary: DataFrame, fallback: DataFrame, key: str, parent: str | None = None) -> DataFrame:
    """Upsert by id: the primary's values where it has any, the fallback's elsewhere. A node whose parent is in neither becomes a root."""
    cols = [c for c in primary.columns if c != key]
    f = fallback.select(key, *(F.col(c).alias(f"_f_{c}") for c in cols))
    both = primary.join(f, key, "full").select(key, *(F.coalesce(c, f"_f_{c}").alias(c) for c in cols))
    if parent is None:
        return both
    known = primary.select(F.col(key).alias("_p")).union(fallback.select(key)).distinct()
    return both.join(known, F.col(parent) == F.col("_p"), "left").withColumn(parent, F.col("_p")).drop("_p")

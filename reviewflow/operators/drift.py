"""Schemas that drift between files -> one consistent table, the changes of every file, and a failed-cast report.

Method: each record becomes path-value rows with the raw JSON type (``parse_json`` and ``variant_explode``, all inside the
JVM); path-type statistics are aggregated by file; typed columns are projected by casts whose failures are counted.

Defined results
* a payload that is null or no JSON object counts as a record without fields; it is a row of nulls in the table.
* a header whose values in a file are all null has no type there, so it is never ``retyped``; of several types of one header
  in a file the most frequent holds, ties by name.
* files of one feed with the same ``exported_at`` follow by file_id; files without any record take no part.
* the missing side of ``added`` and ``removed`` is the empty string.
* several gone and new headers of one output field are paired in the order of their names; the rest are removed or added.
* values that stand for no output field of the table are kept by their header in ``rest``: a map from header to the value's text and JSON
  type, nulls with type null; null for a record without any. In the cast report such headers have no field and no failures.
* records delivered twice (same file and row number) are one row of the table, the earliest received; ties by record_id.
* empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from reviewflow.storage import written

#: Output fields of the consistent table with the types that casts aim at.
TABLE_TYPES = {
    "评论日期": "string", "评论内容": "string", "产品名": "string", "电商平台评分": "double", "用户属性": "string",
    "点赞数": "decimal(38,0)", "子评论数/追评数": "decimal(38,0)", "一级评论": "string", "二级评论": "string", "三级评论": "string",
}


def bare(c: Column) -> Column:
    """A header without any white space: the form in which headers are compared."""
    return F.regexp_replace(c, r"(?U)[\s\x{1c}-\x{1f}\x{feff}\x{200b}]+", "")


def path_values(records: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., header, value, json_type): one row for each key of each payload, with its raw type."""
    parsed = records.select(*keep, F.try_parse_json("payload").alias("_v"))
    spark = records.sparkSession
    out = parsed.lateralJoin(spark.tvf.variant_explode_outer(F.col("_v").outer()))
    # F.schema_of_variant names SQL types; JSON knows one kind of number.
    sql_type = F.schema_of_variant("value")
    json_type = (
        F.when(sql_type == "VOID", None)
        .when(sql_type == "STRING", "string")
        .when(sql_type == "BOOLEAN", "boolean")
        .when(sql_type.startswith("ARRAY"), "array")
        .when(sql_type.startswith("OBJECT"), "object")
        .otherwise("number")
    )
    return out.select(*keep, F.col("key").alias("header"), "value", json_type.alias("json_type"))


def file_headers(records: DataFrame) -> DataFrame:
    """(file_id, header, json_type, n): the headers of each file with their prevailing type; partial counts before the shuffle."""
    counts = path_values(records, ["file_id"]).groupBy("file_id", "header", "json_type").count()
    typed = F.struct(F.when(F.col("json_type").isNotNull(), F.col("count")).alias("n"), F.col("json_type").alias("json_type"))
    best = F.max(F.struct(typed["n"].alias("n"), typed["json_type"].alias("t")))
    return counts.where("header IS NOT NULL").groupBy("file_id", "header").agg(best["t"].alias("json_type"), F.sum("count").alias("n"))


def output_fields(headers: DataFrame, standardizer: DataFrame, platforms: DataFrame) -> DataFrame:
    """(namespace, header, field): the output field of each header; ``headers`` has namespace and header.

    The two registries are configuration tables; their joins are left to the planner, which broadcasts by measured size.
    """
    by_platform = (
        platforms.select("namespace", F.explode(F.arrays_zip("header_signature", "mapped_headers")).alias("p"))
        .select("namespace", bare(F.col("p.header_signature")).alias("bare"), F.col("p.mapped_headers").alias("field"))
        .groupBy("namespace", "bare").agg(F.min("field").alias("field"))
    )
    by_alias = (
        standardizer.select(F.col("header").alias("field"), F.explode("aliases").alias("alias"))
        .select(bare(F.col("alias")).alias("bare"), "field")
        .groupBy("bare").agg(F.min("field").alias("alias_field"))
    )
    listed = platforms.select("namespace").distinct().withColumn("listed", F.lit(True))
    return (
        headers.select("namespace", "header").distinct().withColumn("bare", bare(F.col("header")))
        .join(listed, "namespace", "left").join(by_platform, ["namespace", "bare"], "left").join(by_alias, "bare", "left")
        .select("namespace", "header", F.when(F.col("listed"), F.col("field")).otherwise(F.col("alias_field")).alias("field"))
    )


def schema_changes(records: DataFrame, files: DataFrame, standardizer: DataFrame, platforms: DataFrame) -> DataFrame:
    """(file_id, change, old_field, new_field) of each file against its feed's previous file."""
    headers = written(file_headers(records), "file-headers")
    present = headers.select("file_id").distinct()
    order = W.partitionBy("feed_id").orderBy("exported_at", "file_id")
    seq = (
        files.where(F.col("feed_id").isNotNull()).select("file_id", "feed_id", "namespace", "exported_at")
        .join(present, "file_id", "left_semi")
        .withColumn("prev_id", F.lag("file_id").over(order)).where("prev_id IS NOT NULL").select("file_id", "prev_id", "namespace")
    )
    new = seq.join(headers.select("file_id", "header", F.col("json_type").alias("new_type")), "file_id")
    old = seq.join(headers.select(F.col("file_id").alias("prev_id"), "header", F.col("json_type").alias("old_type")), "prev_id")
    flag = F.lit(True)
    both = (
        new.select("file_id", "namespace", "header", "new_type", flag.alias("is_new"))
        .join(old.select("file_id", "namespace", "header", "old_type", flag.alias("is_old")), ["file_id", "namespace", "header"], "full")
    )
    stays = F.col("is_new") & F.col("is_old")
    retyped = both.where(stays & (F.col("new_type") != F.col("old_type"))).select(
        "file_id", F.lit("retyped").alias("change"), F.col("header").alias("old_field"), F.col("header").alias("new_field")
    )
    moved = both.where(F.col("is_new").isNull() | F.col("is_old").isNull()).withColumn("side", F.when(F.col("is_new"), "new").otherwise("old"))
    moved = moved.join(output_fields(moved, standardizer, platforms), ["namespace", "header"], "left")
    # A header without output field pairs with nothing: its own name keeps its group apart.
    group = F.coalesce(F.concat(F.lit("f:"), "field"), F.concat(F.lit("h:"), "header"))
    ranked = moved.withColumn("g", group).withColumn("k", F.row_number().over(W.partitionBy("file_id", "g", "side").orderBy("header")))
    pairs = ranked.groupBy("file_id", "g", "k").agg(
        F.max(F.when(F.col("side") == "old", F.col("header"))).alias("old_field"), F.max(F.when(F.col("side") == "new", F.col("header"))).alias("new_field")
    )
    change = F.when(F.col("old_field").isNull(), "added").when(F.col("new_field").isNull(), "removed").otherwise("renamed")
    filled = [F.coalesce(c, F.lit("")).alias(c) for c in ("old_field", "new_field")]
    return pairs.select("file_id", change.alias("change"), *filled).unionByName(retyped)


def _mapped_values(records: DataFrame, files: DataFrame, standardizer: DataFrame, platforms: DataFrame) -> DataFrame:
    """(file_id, row_no, record_id, header, field, text, json_type) of the first delivery of each record."""
    first = F.min(F.struct("received_at", "record_id"))
    keep = records.groupBy("file_id", "row_no").agg(first["record_id"].alias("record_id")).select("record_id")
    once = records.join(keep, "record_id", "left_semi")
    values = path_values(once, ["file_id", "row_no", "record_id"]).join(files.select("file_id", "namespace"), "file_id", "left")
    fields = output_fields(values, standardizer, platforms).withColumnsRenamed({"namespace": "ns", "header": "h"})
    same = F.col("namespace").eqNullSafe(F.col("ns")) & (F.col("header") == F.col("h"))
    text = F.coalesce(F.expr("try_variant_get(value, '$', 'string')"), F.when(F.col("json_type").isNotNull(), F.to_json("value")))
    return values.join(fields, same, "left").select("file_id", "row_no", "record_id", "header", "field", text.alias("text"), "json_type")


def _typed(c: Column, kind: str) -> Column:
    return c if kind == "string" else F.regexp_replace(F.trim(c), ",", "").try_cast(kind)


def consistent_table(records: DataFrame, files: DataFrame, standardizer: DataFrame, platforms: DataFrame) -> DataFrame:
    """One row for each record with the typed output fields; several headers of one field are joined in header order.

    ``rest`` keeps every other header's value and JSON type.
    """
    m = _mapped_values(records, files, standardizer, platforms)
    parts = lambda f: F.array_sort(F.collect_list(F.when((F.col("field") == f) & F.col("text").isNotNull(), F.struct("header", "text"))))
    # A record's fields are few, so the collected list is bounded by the width of one record.
    text = lambda f: F.nullif(F.concat_ws("\n\n", F.transform(parts(f), lambda x: x["text"])), F.lit(""))
    left_over = F.col("header").isNotNull() & ~F.coalesce(F.col("field").isin(*TABLE_TYPES), F.lit(False))
    entries = F.array_sort(F.collect_list(F.when(left_over, F.struct("header", F.struct(F.col("text").alias("value"), "json_type")))))
    rest = F.when(F.size(entries) > 0, F.map_from_entries(entries)).alias("rest")
    return m.groupBy("file_id", "row_no", "record_id").agg(*(_typed(text(f), k).alias(f) for f, k in TABLE_TYPES.items()), rest)


def cast_report(records: DataFrame, files: DataFrame, standardizer: DataFrame, platforms: DataFrame) -> DataFrame:
    """(file_id, header, field, json_type, n_values, n_failed): casts to the consistent table's types, by file and header.

    ``field`` is null for a header without output field; its values are kept as they are in ``rest``.
    """
    m = _mapped_values(records, files, standardizer, platforms).where("text IS NOT NULL")
    failed = F.lit(False)
    for f, k in TABLE_TYPES.items():
        if k != "string":
            failed = failed | (F.col("field").eqNullSafe(f) & _typed(F.col("text"), k).isNull())
    return m.groupBy("file_id", "header", "field", "json_type").agg(F.count("*").alias("n_values"), F.sum(failed.cast("long")).alias("n_failed"))

"""One query for each operator over the test tables. Every query reads its tables whole."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.functions import dates, numbers, text
from reviewflow.operators import audit, combine, compare, dedup, headers, identity, platforms, rules, threads
from reviewflow.plans.oracles import ORACLES  # noqa: F401
from reviewflow.storage import ship_package

#: Reference date of all relative dates here, and a key that is public and protects nothing.
REF = date(2026, 7, 28)
TEST_PROJECT = identity.Project("project-screenbar", 1, b"k" * 32)
CLEAN_WORDS = ["包装盒", "manual", "フィルター"]
KEYWORDS = ["Lid", "电池", "screw", "ランプ"]
SHEET, ORDER = ["file_id", "sheet"], ["row_number", "comment_id"]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _threads(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "thread_comments")


def _comment() -> F.Column:
    return dedup.stripped_comment(F.col("评论内容"))


def script_group(spark: SparkSession, d: str) -> DataFrame:
    return _threads(spark, d).select("comment_id", text.script_group(_comment()).alias("script"))


def word_count(spark: SparkSession, d: str) -> DataFrame:
    return _threads(spark, d).select("comment_id", text.word_count(_comment()).alias("words"))


def delete_length(spark: SparkSession, d: str) -> DataFrame:
    return _threads(spark, d).select("comment_id", rules.length_reason(_comment()).alias("reason"))


def delete_placeholder(spark: SparkSession, d: str) -> DataFrame:
    """Every comment as it is and a placeholder with blanks around it in its place, chosen by its number; the first rule's reason decides."""
    names = F.from_json(F.lit(json.dumps(rules.V.PLACEHOLDERS, ensure_ascii=False)), "array<string>")
    placed = F.concat(F.lit(" "), F.element_at(names, (F.col("comment_id") % len(rules.V.PLACEHOLDERS) + 1).cast("int")), F.lit("\u3000"))
    both = F.explode(F.array(F.struct(F.lit("own").alias("kind"), F.col("评论内容").alias("text")), F.struct(F.lit("placed").alias("kind"), placed.alias("text"))))
    t = _threads(spark, d).select("comment_id", both.alias("x")).select("comment_id", "x.*")
    return t.select("comment_id", "kind", rules.placeholder_reason(dedup.stripped_comment(F.col("text"))).alias("reason")).where("reason IS NOT NULL")


def delete_clean_word(spark: SparkSession, d: str) -> DataFrame:
    return _threads(spark, d).select("comment_id", rules.clean_word_reason(_comment(), CLEAN_WORDS).alias("reason")).where("reason IS NOT NULL")


def delete_fixed_terms(spark: SparkSession, d: str) -> DataFrame:
    """Every comment with one of the terms after it, chosen by its number, so that every term meets every script."""
    terms = (*rules.V.TERMS_EXACT, *rules.V.TERMS_ANY_CASE)
    term = F.element_at(F.from_json(F.lit(json.dumps(terms, ensure_ascii=False)), "array<string>"), (F.col("comment_id") % len(terms) + 1).cast("int"))
    t = _threads(spark, d).select("comment_id", F.concat(_comment(), F.lit(" "), term).alias("c"))
    return t.select("comment_id", rules.fixed_term(F.col("c")).alias("term")).where("term IS NOT NULL")


def delete_random_alnum(spark: SparkSession, d: str) -> DataFrame:
    return _threads(spark, d).where(rules.is_random_heap(_comment())).select("comment_id")


def delete_reason_first(spark: SparkSession, d: str) -> DataFrame:
    return _threads(spark, d).select("comment_id", rules.deletion_reason(_comment(), CLEAN_WORDS).alias("reason"))


def dedup_max_likes(spark: SparkSession, d: str) -> DataFrame:
    return dedup.best_rows(_threads(spark, d), SHEET, ORDER, "评论内容", "点赞数").select("comment_id")


def dedup_events(spark: SparkSession, d: str) -> DataFrame:
    log = dedup.event_log(_threads(spark, d), SHEET, ORDER, "评论内容", "点赞数", "row_number")
    return log.select("action", "file_id", "sheet", "row_number", F.col("column_header"), "reason", F.col("value"))


def subcomment_clear(spark: SparkSession, d: str) -> DataFrame:
    gone = dedup.cleared_cells(_threads(spark, d), SHEET, ORDER)
    return gone.select("comment_id", F.col("_col").alias("column_header"), "reason")


def strip_urls(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", text.strip_https(F.col("text")).alias("stripped"))


def strip_reply_prefix(spark: SparkSession, d: str) -> DataFrame:
    t = _threads(spark, d)
    marked = F.when(F.col("comment_id") % 3 == 0, F.concat(F.lit(" 回复 @用户"), F.col("row_number").cast("string"), F.lit("："), F.col("评论内容"))).otherwise(F.col("评论内容"))
    return t.select("comment_id", text.strip_reply_prefix(marked).alias("body"))


def keep_keywords(spark: SparkSession, d: str) -> DataFrame:
    return _threads(spark, d).where(text.keep_by_keywords(F.col("评论内容"), KEYWORDS)).select("comment_id")


def merge_union_order(spark: SparkSession, d: str) -> DataFrame:
    t = _threads(spark, d)
    sheets = ["总表", "comments", "Sheet1"]
    lineage = [F.col("file_id").alias("_file_idx"), F.concat(F.lit("in/"), F.col("file_id").cast("string"), F.lit(".csv")).alias("_file")]
    own = [F.col("评论内容").alias(" comment "), F.col("一级评论").alias("reply")]
    parts = []
    for i, s in enumerate(sheets):
        part = t.where(F.col("sheet") == s).select(*lineage, F.lit(i).alias("_sheet_idx"), F.col("sheet").alias("_sheet"), F.col("row_number").alias("_row"), *own)
        parts.append(part.withColumnRenamed(" comment ", "comment") if i else part)
    out = combine.merged(parts, add_source_columns=True)
    return out.select("_file_idx", "_sheet_idx", "_row", F.col(" comment ").alias("comment"), "reply", "source_file", "source_sheet")


def inventory_counts(spark: SparkSession, d: str) -> DataFrame:
    t = _threads(spark, d)
    return combine.inventory(t, t, ["评论内容", "一级评论", "二级评论", "三级评论"], ["file_id", "sheet"])


def unix_to_beijing(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "reviews").select("review_id", dates.unix_date(F.col("评论日期")).alias("day")).where("day IS NOT NULL")


def relative_dates(spark: SparkSession, d: str) -> DataFrame:
    n = F.regexp_replace(text.pystrip(F.col("评论日期")), rf"(?i)(?:{text.SPACE}+\(edited\)|{text.SPACE}*（修改过）){text.SPACE}*$", "")
    return _t(spark, d, "reviews").select("review_id", dates.relative_date(n, REF).alias("day")).where("day IS NOT NULL")


def platform_dates(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "reviews").select("review_id", dates.platform_date(F.col("评论日期"), REF).alias("day"))


def date_product_split(spark: SparkSession, d: str) -> DataFrame:
    r = _t(spark, d, "reviews").where("date_header = '评论日期与产品'")
    return r.select("review_id", dates.split_date(F.col("评论日期")).alias("day"), dates.split_product(F.col("评论日期")).alias("product"))


def normalize_rating(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "reviews").select("review_id", numbers.normalize_rating(F.col("电商平台评分")).alias("rating"))


def normalize_likes(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "reviews").select("review_id", numbers.normalize_likes(F.col("点赞数")).alias("likes"))


def likes_ranking(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "reviews").select("review_id", numbers.likes_for_ranking(F.col("点赞数")).cast("double").alias("likes"))


def composite_attribute(spark: SparkSession, d: str) -> DataFrame:
    """Gender and age as the attribute field has them, apart: each row has either, both or none."""
    parts = F.split(F.regexp_replace(F.col("用户属性"), "[,，/|｜]", " "), " +", 2)
    r = _t(spark, d, "reviews").select("review_id", "用户属性", F.get(parts, 0).alias("gender"), F.get(parts, 1).alias("age"))
    direct = F.when(F.col("review_id") % 3 == 0, F.col("用户属性"))
    return r.select("review_id", numbers.attribute(direct, F.col("gender"), F.col("age")).alias("attribute"))


def product_fallback(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "reviews").select("review_id", numbers.product_or(F.col("产品名"), "未命名").alias("product"))


def join_trimmed(spark: SparkSession, d: str) -> DataFrame:
    return _threads(spark, d).select("comment_id", platforms.join_trimmed(F.col("一级评论"), F.col("二级评论"), F.col("三级评论")).alias("joined"))


def _payload(spark: SparkSession, d: str, *keys: str) -> DataFrame:
    r = _t(spark, d, "raw_exports")
    got = [F.get_json_object("payload", f"$['{k}']").alias(k) for k in keys]
    return r.select("record_id", *got)


def rakuten_ops(spark: SparkSession, d: str) -> DataFrame:
    p = _payload(spark, d, "レビュー投稿日", "参考になった数", "レビュアー属性", "レビュー投稿者").where("`レビュアー属性` IS NOT NULL OR `レビュー投稿者` IS NOT NULL")
    return p.select(
        "record_id", platforms.rakuten_review_date(F.col("レビュー投稿日")).alias("day"), platforms.rakuten_helpful_count(F.col("参考になった数")).alias("likes"),
        platforms.rakuten_user_attribute(F.col("レビュアー属性")).alias("attribute"), platforms.rakuten_display_name(F.col("レビュー投稿者")).alias("name"),
    )


def amazon_ops(spark: SparkSession, d: str) -> DataFrame:
    p = _payload(spark, d, "查看", "aiconalt", "asizebase", "标题", "查看1").where("aiconalt IS NOT NULL OR `查看` IS NOT NULL")
    return p.select(
        "record_id", platforms.amazon_review_date(F.col("查看")).alias("day"), platforms.amazon_star_rating(F.col("aiconalt")).alias("rating"),
        platforms.amazon_helpful_count(F.col("asizebase")).alias("likes"), platforms.join_trimmed(F.col("标题"), F.col("查看1")).alias("body"),
    )


def hash_account(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    c = _t(spark, d, "customer")
    return c.select("c_custkey", identity.pseudonyms(F.col("c_custkey").cast("string"), TEST_PROJECT, "youtube", False).alias("hash"))


def hash_display(spark: SparkSession, d: str) -> DataFrame:
    ship_package(spark)
    c = _t(spark, d, "customer")
    return c.select("c_custkey", identity.pseudonyms(F.col("c_name"), TEST_PROJECT, "bilibili", True).alias("hash"))


def identity_choice(spark: SparkSession, d: str) -> DataFrame:
    """Which identity column each file's sheet would use: account ids if any is usable, else display names."""
    r = _t(spark, d, "reviews").select("file_id", F.lit("  ").alias("author_channel_id"), F.when(F.col("platform") != "jd", F.col("哈希id")).alias("authorChannelId"), F.col("产品名").alias("author"))
    return identity.choices(r, "youtube", ["author_channel_id", "authorChannelId", "author"], ["file_id"]).withColumnRenamed("header", "chosen")


def _standard(spark: SparkSession, d: str) -> DataFrame:
    src = _t(spark, d, "thread_comments").select("comment_id", *headers_of_threads())
    return headers.standardized(src, REF, ["comment_id"], product_name="未命名")


def headers_of_threads() -> list[str]:
    return ["评论日期", "评论内容", "点赞数", "子评论数/追评数", "一级评论", "二级评论", "三级评论"]


def standardize_11(spark: SparkSession, d: str) -> DataFrame:
    return _standard(spark, d).withColumnRenamed("哈希ID", "hash_id")


def audit_counts(spark: SparkSession, d: str) -> DataFrame:
    return audit.value_counts(_t(spark, d, "reviews"), "哈希id", "点赞数")


def audit_mapping(spark: SparkSession, d: str) -> DataFrame:
    """A standardized table in which four fields were changed afterwards, each in other rows."""
    n = F.col("comment_id")
    x = lambda c: F.concat(F.lit("x"), F.coalesce(F.col(f"`{c}`"), F.lit("")))
    changes = {
        "评论内容": F.when(n % 7 == 0, x("评论内容")), "评论日期": F.when(n % 11 == 0, F.lit("1999-12-31")), "点赞数": F.when(n % 13 == 0, F.lit("0.50")), "一级评论": F.when(n % 17 == 0, x("一级评论")),
        "二级评论": F.when(n % 19 == 0, F.lit(" ")),
    }
    changed = _standard(spark, d).withColumns({c: F.coalesce(v, F.col(f"`{c}`")) for c, v in changes.items()})
    src = _t(spark, d, "thread_comments").select("comment_id", *headers_of_threads())
    return audit.mapping_mismatches(changed, src, ["comment_id"], REF)


def audit_sheets(spark: SparkSession, d: str) -> DataFrame:
    """The counts of every sheet: all threads of a file against their source, of which every fifth file lost its last rows, and in
    which every third file has changed likes."""
    t = _t(spark, d, "thread_comments").select(F.col("file_id").cast("string").alias("_sheet"), F.col("comment_id").alias("_row"), *headers_of_threads())
    std = headers.standardized(t, REF, ["_sheet", "_row"])
    sheet = F.col("_sheet").cast("long")
    likes = F.when((sheet % 3 == 0) & (F.col("_row") % 2 == 0), F.lit("-1")).when(F.col("_row") % 10 == 0, F.lit("  ")).otherwise(F.col("点赞数"))
    hashed = F.when(F.col("_row") % 4 == 0, F.lit("no hash")).when(F.col("_row") % 4 == 1, F.sha2("评论内容", 256))
    std = std.withColumns({"点赞数": likes, "哈希ID": hashed}).where(~((sheet % 5 == 0) & (F.col("_row") % 6 == 0)))
    counts, _ = audit.sheet_counts(std, t, "_sheet", "_row", REF)
    return counts


def multiset_diff(spark: SparkSession, d: str) -> DataFrame:
    t = _threads(spark, d).select(F.col("评论内容").alias("comment"), F.col("sheet"))
    left, right = t.where("sheet = '总表'").select("comment"), t.where("sheet <> '总表'").select("comment")
    a, b = compare.multiset_difference(left, right)
    return a.withColumn("side", F.lit("left")).unionByName(b.withColumn("side", F.lit("right")))


def sequence_diff(spark: SparkSession, d: str) -> DataFrame:
    r = _threads(spark, d).groupBy("file_id", "row_number").agg(F.min("评论内容").alias("评论内容"), F.min("一级评论").alias("一级评论"))
    keyed = r.withColumn("row", F.concat_ws("-", F.col("file_id").cast("string"), F.col("row_number").cast("string")))
    left, right = keyed.select("row", F.col("评论内容").alias("v")), keyed.select("row", F.coalesce("一级评论", "评论内容").alias("v"))
    return compare.sequence_mismatches(left, right, "row", "v")


def duplicate_summary(spark: SparkSession, d: str) -> DataFrame:
    return compare.duplicate_summary(_threads(spark, d), "评论内容", "comment_id")


def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    return compare.duplicate_groups(_threads(spark, d), "评论内容", "comment_id")


def row_hash(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "nation")
    return n.select("n_nationkey", text.row_hash([F.col("n_name"), F.col("n_regionkey").cast("string")]).alias("row_hash"))


def end_to_end_clean(spark: SparkSession, d: str) -> DataFrame:
    """Merge order, reply marks, standard columns, rules, best of equal comments, subcomments: one lineage, no files between."""
    t = _threads(spark, d).withColumn("评论内容", text.strip_reply_prefix(F.col("评论内容")))
    keep = [*SHEET, *ORDER]
    std = headers.standardized(t.select(*keep, *headers_of_threads()), REF, keep)
    cleaned = dedup.clean_rows(std, SHEET, ORDER, "评论内容", "点赞数")
    named = {"评论日期": "day", "评论内容": "comment", "点赞数": "likes", "一级评论": "sub1", "二级评论": "sub2", "三级评论": "sub3"}
    return cleaned.select("comment_id", *(F.col(k).alias(v) for k, v in named.items()))


def _tree(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a forest: every order answers the one of half its number, unless that is missing."""
    parent = F.when(F.col("o_orderkey") > 1, F.floor(F.col("o_orderkey") / 2).cast("long"))
    return _t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), parent.alias("parent"))


def x_tree_flatten(spark: SparkSession, d: str) -> DataFrame:
    flat = threads.flattened(_tree(spark, d), "id", "parent")
    return flat.select("node", "root", "level", "is_reply")


def x_level_summary(spark: SparkSession, d: str) -> DataFrame:
    return threads.level_summary(threads.flattened(_tree(spark, d), "id", "parent"))


def x_links(spark: SparkSession, d: str) -> DataFrame:
    """Every text with links put into it, one of them twice and one in brackets."""
    n = F.col("doc_id").cast("string")
    a, b = F.concat(F.lit("https://example.org/d/"), n), F.concat(F.lit("http://example.net/q?x="), n)
    put = F.concat_ws(" ", F.col("text"), F.concat(F.lit("["), n, F.lit("]("), a, F.lit(")")), b, F.when(F.col("doc_id") % 2 == 0, a))
    return _t(spark, d, "documents").select("doc_id", text.link_list(put).alias("links")).where("links <> ''")


def x_id_join(spark: SparkSession, d: str) -> DataFrame:
    left = _t(spark, d, "thread_comments").select("comment_id", "file_id")
    files = _t(spark, d, "export_files").select("file_id", "namespace", "file_name")
    return threads.joined_by_id(left, files, "file_id").select("comment_id", "namespace", "file_name")


def x_merge_roots(spark: SparkSession, d: str) -> DataFrame:
    """First and last delivery of each root: the first's values where it has any, the last's elsewhere, under the parent that is there."""
    values = F.struct("review_id", F.col("产品名").alias("product"), F.col("电商平台评分").alias("rating"))
    r = _t(spark, d, "reviews").groupBy("file_id", "row_number").agg(F.min(values).alias("a"), F.max(values).alias("b"))
    key = F.concat_ws("-", F.col("file_id").cast("string"), F.col("row_number").cast("string")).alias("key")
    parent = F.concat_ws("-", F.col("file_id").cast("string"), (F.col("row_number") - 1).cast("string")).alias("parent")
    primary = r.select(key, parent, "a.product", "a.rating")
    fallback = r.select(key, parent, F.coalesce("b.product", F.lit("?")).alias("product"), F.coalesce("b.rating", F.lit("0")).alias("rating"))
    return threads.merged_roots(primary, fallback, "key", "parent")


QUERIES = {
    f.__name__: f
    for f in (
        script_group, word_count, delete_length, delete_placeholder, delete_clean_word, delete_fixed_terms, delete_random_alnum, delete_reason_first,
        dedup_max_likes, dedup_events, subcomment_clear, strip_urls, strip_reply_prefix, keep_keywords, merge_union_order, inventory_counts,
        unix_to_beijing, relative_dates, platform_dates, date_product_split, normalize_rating, normalize_likes, likes_ranking, composite_attribute,
        product_fallback, join_trimmed, rakuten_ops, amazon_ops, hash_account, hash_display, identity_choice, standardize_11, audit_counts,
        audit_mapping, audit_sheets, multiset_diff, sequence_diff, duplicate_summary, duplicate_groups, row_hash, end_to_end_clean,
        x_tree_flatten, x_level_summary, x_links, x_id_join, x_merge_roots,
    )
}

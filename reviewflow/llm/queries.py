"""Queries of the operators on text over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.llm import encoding, formatcopies, lookalike, mixture, nearcopies, personal, sentences, tokens
from reviewflow.llm.oracle import ORACLES  # noqa: F401


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every garbled field with the chain it went through and its restored text."""
    return encoding.garbled_fields(_read(spark, d, "reviews"), "review_id", "platform", ["评论内容", "产品名"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_repaired(spark, d).select("review_id", "field")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    found = nearcopies.near_pairs(_read(spark, d, "thread_comments"), "comment_id", "评论内容")
    return found.withColumnsRenamed({"id_a": "comment_id_a", "id_b": "comment_id_b"})


def p2_classes(spark: SparkSession, d: str) -> DataFrame:
    return nearcopies.near_groups(_read(spark, d, "thread_comments"), "comment_id", "评论内容")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found = lookalike.same_look_pairs(_read(spark, d, "reviews"), "review_id", "评论内容")
    return found.withColumnsRenamed({"id_a": "review_id_a", "id_b": "review_id_b"})


def p4_forms(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.consistent_texts(_read(spark, d, "reviews"), "review_id", "评论内容")


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.look_classes(_read(spark, d, "reviews"), "review_id", "评论内容")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return formatcopies.format_copies(_read(spark, d, "thread_comments"), "comment_id", "评论内容", "一级评论")


def p5_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return formatcopies.collapsed(_read(spark, d, "thread_comments"), "comment_id", "评论内容", "一级评论")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return personal.personal_kinds(_read(spark, d, "reviews"), "review_id", ["评论内容", "二级评论"])


def p7_redacted(spark: SparkSession, d: str) -> DataFrame:
    return personal.redacted_texts(_read(spark, d, "reviews"), "review_id", ["评论内容", "二级评论"])


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_ids(_read(spark, d, "documents"), "doc_id", "text")


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    return tokens.decoded_texts(p8_ids(spark, d), "doc_id", "ids")


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mixed_documents(_read(spark, d, "documents"), _read(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.share_report(_read(spark, d, "documents"), _read(spark, d, "mix_targets"))


def p10_sentences(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(_read(spark, d, "documents"), "doc_id", "text")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_sentences(spark, d).select("doc_id", "start_pos")


QUERIES = {f.__name__: f for f in (p1_found, p1_repaired, p2_found, p2_classes, p4_found, p4_forms, p4_classes, p5_found, p5_collapsed, p7_found, p7_redacted, p8_ids, p8_decoded, p9_mixture, p9_shares, p10_found, p10_sentences)}

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from reviewflow.functions import dates, numbers, text
from reviewflow.operators import audit, headers, identity, platforms

REF = date(2026, 7, 28)


def values(spark, fn, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", fn(F.col("x")).alias("y")).collect()}
    return [got[i] for i in range(len(inputs))]


def test_dates(spark):
    cases = {
        "1 year ago (edited)": "2025", "三年前（修改过）": "2023", "9个月前": "2025-10", "20260709": "2026-07-09", "20261399": "20261399", "2026-07-08T23:30:00Z": "2026-07-09",
        "2026/7/7 08:24:05": "2026-07-07", "2026年1月5日": "2026-01-05", "1688044852963": "2023-06-29", "昨天": "2026-07-27", "十二天前": "2026-07-16", "2 weeks ago": "2026-07-14",
        "2024-05": "2024-05", "hello": "hello", "  ": None, None: None,
    }
    assert values(spark, lambda c: dates.platform_date(c, REF), list(cases)) == list(cases.values())
    assert values(spark, lambda c: dates.dated_by_header(c, "评论时间", REF), ["2026/01/05", "2026/7/7 08:24:05"]) == ["2026/01/05", "2026-07-07"]
    combined = ["2026年6月21日 已购：触摸开关 / 黑", "no date", None]
    assert values(spark, dates.split_date, combined) == ["2026年6月21日", "no date", None]
    assert values(spark, dates.split_product, combined) == ["触摸开关 / 黑", None, None]


def test_numbers(spark):
    assert values(spark, numbers.normalize_rating, ["5.0 out of 5 stars", "4.0 颗星，最多 5 颗星", "7", "", None, "3", "4.50"]) == ["5", "4", "7", None, None, "3", "4.5"]
    likes = ["3 people found this helpful", "One person found this helpful", "1 person found this helpful", "8 个人发现此评论有用", "   ", None, "3.0", "1.2万", "=1+1", "１２"]
    assert values(spark, numbers.normalize_likes, likes) == ["3", "1", "1 person found this helpful", "8", "0", "0", "3.0", "1.2万", "=1+1", "12"]


def test_texts(spark):
    assert values(spark, text.strip_reply_prefix, ["  回复 @阿珍 爱上了阿强：[滑稽]  ", "plain", None]) == ["[滑稽]  ", "plain", None]
    assert values(spark, text.strip_https, ["a https://x.y b", "https://x", "http://x"]) == ["a  b", "", "http://x"]
    assert values(spark, text.pystrip, ["　 a \x1f"]) == ["a"]
    assert text.normalize_keywords([" A", "a ", "", "B"]) == ["a", "b"]
    with pytest.raises(ValueError):
        text.normalize_keywords([" "])
    assert values(spark, lambda c: text.keep_by_keywords(c, ["STRASSE"]), ["die Straße", None, "x"]) == [True, False, False]


def test_platform_operations(spark):
    assert values(spark, platforms.rakuten_user_attribute, ["男性 50代｜自分用", "男性, 70代以上", "x", None]) == ["男性 50代", "男性 70代以上", None, None]
    assert values(spark, platforms.rakuten_display_name, ["購入者さん", " 花子 ", None]) == [None, "花子", None]
    assert values(spark, platforms.rakuten_review_date, ["7/8/2026", "2026-7-8", "2026/13/1", None]) == ["2026-07-08", "2026-07-08", "2026/13/1", None]
    assert values(spark, platforms.amazon_review_date, ["2026年13月8日在日本发布评论", "x"]) == ["2026-13-08", "x"]
    assert values(spark, platforms.amazon_star_rating, ["4.0 颗星，最多 5 颗星", "9 颗星，最多 5 颗星"]) == ["4.0", "9 颗星，最多 5 颗星"]
    with pytest.raises(platforms.LayoutError):
        platforms.detect(list(platforms.V.LAYOUTS["twitter"][0][1]))
    assert platforms.detect(list(platforms.V.LAYOUTS["twitter"][0][1]), "X").platform == "twitter"


def test_standard_table_and_audit(spark):
    src = spark.createDataFrame([(1, "2026/01/05", "好的内容", "女", " 20代 ", None)], "k int, `评论 时间` string, text string, `性别` string, `年龄` string, likes string")
    std = headers.standardized(src, REF, ["k"], product_name="灯")
    row = std.first()
    assert std.columns[1:] == list(headers.V.ALIASES)
    assert (row["评论日期"], row["产品名"], row["用户属性"], row["点赞数"], row["哈希ID"]) == ("2026/01/05", "灯", "女 20代", "0", None)
    assert audit.audit(headers.standardized(src, REF, ["k"]), src, ["k"], REF)["passed"]
    wrong = headers.standardized(src, REF, ["k"]).withColumn("评论内容", F.lit("x")).withColumn("哈希ID", F.lit("zz")).withColumn("点赞数", F.lit(" "))
    assert set(audit.audit(wrong, src, ["k"], REF)["issues"]) == {"mapped_value_mismatch", "invalid_hash_id_format", "blank_likes_value"}
    with pytest.raises(headers.HeaderError):
        headers.select_columns(["date", "time", "text"])
    with pytest.raises(headers.HeaderError):
        headers.select_columns(["date"])


def test_pseudonyms(spark):
    p1, p2 = identity.Project("project-screenbar", 1, b"k" * 32), identity.Project("project-screenbar-e2e", 1, b"e" * 32)
    df = spark.createDataFrame([("UC-secret-user", "user1"), (" none ", None)], "a string, d string")
    out = df.select(identity.pseudonyms(F.col("a"), p1, "youtube", False).alias("a"), identity.pseudonyms(F.col("d"), p2, "bilibili", True).alias("d"))
    rows = out.collect()
    assert rows[0].a == "72bd4fc68258026ac244e1cfbb758e603455defca92af91c577ed9f9b23082c9"
    assert rows[0].d == "cad6b15fb4291d29dc08a17581aec2fa0726ea09b1786dd1ef5bf95b5b224b45"
    assert rows[1].a is None and rows[1].d is None
    plan = out._jdf.queryExecution().toString()
    assert "kkkkkkkk" not in plan and "6B6B6B6B" not in plan and "k" * 32 not in repr(p1)
    bad = spark.createDataFrame([("=SECRET()",)], "a string").select(identity.pseudonyms(F.col("a"), p1, "youtube", False))
    with pytest.raises(Exception, match="formula") as e:
        bad.collect()
    assert "SECRET" not in str(e.value)


def test_identity_choice(spark):
    df = spark.createDataFrame([("None", "alice"), ("None", "bob")], "author_channel_id string, author string")
    assert identity.choose_identity(df, "YouTube", df.columns) == ("author", True)
    used = spark.createDataFrame([("None", "alice"), ("UC1", "bob")], "author_channel_id string, author string")
    assert identity.choose_identity(used, "YouTube", used.columns) == ("author_channel_id", False)

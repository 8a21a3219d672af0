from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewflow.operators import dedup, rules

REASONS = [
    ("照明最高です", None), ("最高です", "非中文无空格短文本长度小于等于 4"), ("不错", "评论长度小于 8"), ("1234567", "评论长度小于 8"), ("", "非中文无空格短文本长度小于等于 4"),
    ("This works", "非中文评论词数小于等于 2"), ("muy bueno", "非中文评论词数小于等于 2"), ("This works well", None),
    ("此用户未填写评价内容", "评论等于占位文案"), ("这个产品的链接在哪里呢", "评论包含固定删除词: 链接"), ("see http://example.org now", "评论包含固定删除词: http://"),
    ("it is jdsklafjskl", "评论为无中文随机英文/数字堆砌"), ("123123123", "评论为无中文随机英文/数字堆砌"), ("it is abc123xyz9", "评论为无中文随机英文/数字堆砌"), ("jdsklafjskl", "非中文评论词数小于等于 2"), ("这是一个 jdsklafjskl 的盒子", None),
    ("Which BRAND? is this one", "评论包含固定删除词: brand?"), ("mi caféprecio es alto hoy", None), ("el precio es alto hoy", "评论包含固定删除词: precio"),
    ("これは割引でしたね", "评论包含固定删除词: 割引"), ("这个割引真的很不错呀", None), ("I like the lid of it", "评论包含清理词: lid"),
]


def test_reasons(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(REASONS)], "i int, t string")
    got = {r.i: r.reason for r in df.select("i", rules.deletion_reason(F.col("t"), ["lid"]).alias("reason")).collect()}
    assert {REASONS[i][0]: got[i] for i in got} == dict(REASONS)


@pytest.fixture
def comments(spark):
    rows = [
        ("A", 2, "这个产品真的非常好用呀", "10", "重复的子评论内容", None, "short"), ("A", 3, " 这个产品真的非常好用呀 ", "2", None, "重复的子评论内容", "重复的子评论内容"),
        ("B", 2, "这个产品真的非常好用呀", "5", None, None, None), ("B", 3, "这个产品真的非常好用呀", "5", "另外一个子评论内容", " ", None), ("B", 4, "坏", "=1+1", None, None, None),
    ]
    return spark.createDataFrame(rows, "sheet string, row_number int, c string, likes string, `一级评论` string, `二级评论` string, `三级评论` string")


def test_best_row_wins_by_likes_then_later_row_within_its_sheet(comments):
    got = {(r.sheet, r.row_number) for r in dedup.best_rows(comments, ["sheet"], ["row_number"], "c", "likes").collect()}
    assert got == {("A", 2), ("B", 3)}
    last = {(r.sheet, r.row_number) for r in dedup.best_rows(comments, ["sheet"], ["row_number"], "c", None).collect()}
    assert last == {("A", 3), ("B", 3)}


def test_subcomments_keep_the_last_of_one_pool(comments):
    out = {(r.sheet, r.row_number): r for r in dedup.clear_subcomments(comments, ["sheet"], ["row_number"]).collect()}
    assert out["A", 2]["一级评论"] is None and out["A", 3]["二级评论"] is None and out["A", 3]["三级评论"] == "重复的子评论内容"
    assert out["A", 2]["三级评论"] is None and out["B", 3]["二级评论"] == " "


def test_events_use_both_row_numbers(comments):
    log = [tuple(r) for r in dedup.event_log(comments, ["sheet"], ["row_number"], "c", "likes", "row_number").collect()]
    assert ("delete_row", "B", 4, "", "评论长度小于 8", "坏") in log
    assert ("clear_cell", "A", 2, "三级评论", "子评论长度小于 6: 三级评论", "short") in log
    assert dedup.event_log(comments.limit(0), ["sheet"], ["row_number"], "c", "likes", "row_number").count() == 0


def test_rows_are_numbered_across_partitions(spark):
    from reviewflow.operators import dedup

    rows = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('s', id % 5) END sheet", "id * 7 % 5003 o")
    got = dedup.numbered(rows, ["sheet"], ["o"], "n", 2).collect()
    assert len(got) == 5000
    for sheet in {r.sheet for r in got}:
        own = sorted((r.o, r.n) for r in got if r.sheet == sheet)
        assert [n for _, n in own] == list(range(2, len(own) + 2))
    assert dedup.numbered(rows.limit(0), ["sheet"], ["o"], "n", 2).count() == 0

from __future__ import annotations

from datetime import datetime

import pytest

from reviewflow.operators import drift

STD = [("评论日期", ["评论时间", "date"]), ("评论内容", ["评论", "text"]), ("点赞数", ["likes"]), ("电商平台评分", ["score"])]
PLAT = [("shop", "v1", ["標題", "星"], ["评论内容", None])]


@pytest.fixture
def inputs(spark):
    def make(records, files):
        return (
            spark.createDataFrame(records, "record_id long, file_id long, row_no int, payload string, received_at timestamp"),
            spark.createDataFrame(files, "file_id long, feed_id long, namespace string, exported_at timestamp"),
            spark.createDataFrame(STD, "header string, aliases array<string>"),
            spark.createDataFrame(PLAT, "namespace string, variant_name string, header_signature array<string>, mapped_headers array<string>"),
        )

    return make


T = datetime(2024, 1, 1)
FILES = [(1, 7, "x", datetime(2024, 1, 1)), (2, 7, "x", datetime(2024, 1, 2)), (3, 7, "x", datetime(2024, 1, 3)), (4, None, "x", T), (5, 8, "shop", T), (6, 8, "shop", datetime(2024, 2, 1))]
RECORDS = [
    (1, 1, 2, '{"评论": "a", "likes": 1, "extra": true}', T),
    (2, 1, 3, '{"评论": "b", "likes": null}', T),
    (3, 2, 2, '{"text": "a", "likes": "1,200", "score": "five"}', T),
    (4, 2, 2, '{"text": "late copy", "likes": "7"}', datetime(2024, 3, 1)),
    (5, 3, 2, '{"te xt": "c", "likes": [1], "score": 4.5}', T),
    (6, 3, 3, None, T), (7, 3, 4, "not json", T), (8, 4, 2, '{"a": 1}', T),
    (9, 5, 2, '{"標題": "h", "星": 3}', T), (10, 6, 2, '{"標 題": "h", "星星": 3}', T),
]


def test_changes(inputs):
    got = {tuple(r) for r in drift.schema_changes(*inputs(RECORDS, FILES)).collect()}
    assert got == {
        (2, "renamed", "评论", "text"), (2, "retyped", "likes", "likes"), (2, "removed", "extra", ""), (2, "added", "", "score"),
        (3, "renamed", "text", "te xt"), (3, "retyped", "likes", "likes"), (3, "retyped", "score", "score"),
        (6, "renamed", "標題", "標 題"), (6, "removed", "星", ""), (6, "added", "", "星星"),
    }


def test_table_and_report(inputs):
    args = inputs(RECORDS, FILES)
    rows = {(r.file_id, r.row_no): r for r in drift.consistent_table(*args).collect()}
    assert rows[2, 2]["评论内容"] == "a" and rows[2, 2]["点赞数"] == 1200 and rows[2, 2]["电商平台评分"] is None
    assert rows[1, 3]["点赞数"] is None and (3, 3) in rows and (3, 4) in rows
    failed = {(r.file_id, r.header): r.n_failed for r in drift.cast_report(*args).collect()}
    assert failed[2, "score"] == 1 and failed[2, "likes"] == 0 and failed[3, "likes"] == 1


def test_values_without_output_field_are_kept(inputs):
    args = inputs([*RECORDS, (11, 4, 3, '{"b": null, "c": [1, {"d": 2}], "likes": "9", "": false}', T), (12, 99, 1, '{"lost": "x"}', T)], FILES)
    rows = {(r.file_id, r.row_no): r.rest and {h: tuple(v) for h, v in r.rest.items()} for r in drift.consistent_table(*args).collect()}
    assert rows[1, 2] == {"extra": ("true", "boolean")} and rows[1, 3] is None and rows[3, 4] is None
    assert rows[5, 2] == {"星": ("3", "number")} and rows[99, 1] == {"lost": ("x", "string")}
    assert rows[4, 3] == {"b": (None, None), "c": ('[1,{"d":2}]', "array"), "": ("false", "boolean")}
    report = {(r.file_id, r.header): (r.field, r.n_values, r.n_failed) for r in drift.cast_report(*args).collect()}
    assert report[1, "extra"] == (None, 1, 0) and report[5, "星"] == (None, 1, 0) and report[2, "score"][2] == 1


def test_empty(inputs, spark):
    records, files, std, plat = inputs(RECORDS, FILES)
    for f in (drift.schema_changes, drift.consistent_table, drift.cast_report):
        assert f(records.limit(0), files, std, plat).count() == 0
        assert f(records, files.limit(0), std, plat).count() >= 0

from __future__ import annotations

from datetime import date

from reviewflow.streaming import stages


def test_stages_on_a_stream(spark, tmp_path):
    rows = [("A", 2, "2026/7/7 08:24:05", "这个产品真的非常好用呀", "2", None), ("A", 3, "昨天", "这个产品真的非常好用呀", "9", "很好的子评论"), ("A", 4, "", "坏", "1", None)]
    df = spark.createDataFrame(rows, "sheet string, row int, `评论时间` string, `评论内容` string, `点赞数` string, `一级评论` string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    std = stages.standardized_stream(stream, date(2026, 7, 28), ["sheet", "row"])
    query = stages.cleaned_batches(stages.kept_by_rules(std, "评论内容"), str(tmp_path / "out"), ["sheet"], ["row"], "评论内容", "点赞数")
    run = query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.row, r["评论日期"], r["一级评论"]) for r in got] == [(3, "昨天", "很好的子评论")]

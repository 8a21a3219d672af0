from __future__ import annotations

from pathlib import Path

import pytest

from reviewflow.llm import queries

COLUMNS = {
    "p1_found": ["review_id", "field"], "p2_found": ["comment_id_a", "comment_id_b"], "p4_found": ["review_id_a", "review_id_b"], "p5_found": ["first_id", "copy_id"],
    "p7_found": ["review_id", "field", "kind"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id", "start_pos"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, tiny, name):
    df = queries.QUERIES[name](spark, tiny)
    assert df.columns == COLUMNS[name] and df.count() > 0


def test_sql_counterpart(spark, tiny):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in Path(tiny).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    for name, sql in queries.ORACLES.items():
        assert sorted(map(tuple, queries.QUERIES[name](spark, tiny).collect())) == sorted(con.execute(sql).fetchall())

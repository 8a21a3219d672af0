"""Every catalog query against its SQL counterpart over whole tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from reviewflow import core_queries
from reviewflow.plans import catalog

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def sql(tiny):
    con = duckdb.connect()
    for p in Path(tiny).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


QUERIES, ORACLES = catalog.QUERIES | core_queries.QUERIES, catalog.ORACLES | core_queries.ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, tiny, sql, name):
    df = QUERIES[name](spark, tiny)
    found = sql.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(found.fetchall(), columns)

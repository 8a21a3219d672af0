from __future__ import annotations

import pytest

from reviewflow.operators import compare, threads


def test_multisets(spark):
    left = spark.createDataFrame([(2, "a"), (3, "a"), (4, "b")], "row int, c string")
    right = spark.createDataFrame([(2, "a"), (3, "x")], "row int, c string")
    r = compare.report(left, right, "row", ["c"], "c")
    assert (r["only_left"], r["only_right"], r["sequence_mismatches"]) == (2, 1, 1)
    assert r["duplicates"]["left"] == {"duplicate_rows": 1, "duplicate_groups": 1}
    assert sorted(x["source_row"] for x in r["samples"]) == [2, 4]


def test_trees(spark):
    nodes = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 99), (5, 6), (6, 5), (2, 1)], "id long, parent long")
    flat = {r.node: (r.root, r.level, r.is_reply) for r in threads.flattened(nodes, "id", "parent").collect()}
    assert flat == {1: (1, 0, False), 2: (1, 1, True), 3: (1, 2, True), 4: (4, 0, False)}


def test_joined_by_id_fails_on_an_unmatched_row(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "a")], "k int, v string")
    assert threads.joined_by_id(left.where("k = 1"), right, "k").first().v == "a"
    with pytest.raises(Exception, match="no partner"):
        threads.joined_by_id(left, right, "k").collect()


def test_merged_roots(spark):
    a = spark.createDataFrame([(1, "p"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, "f"), (3, "g")], "k int, v string")
    assert {r.k: r.v for r in threads.merged_roots(a, b, "k").collect()} == {1: "p", 2: "f", 3: "g"}


def test_a_thread_deeper_than_64_levels_is_whole(spark):
    df = spark.createDataFrame([(i, i - 1 if i > 1 else None) for i in range(1, 68)], "id long, parent long")
    got = {r.node: (r.root, r.level) for r in threads.flattened(df, "id", "parent").select("node", "root", "level").collect()}
    assert got == {i: (1, i - 1) for i in range(1, 68)}


def test_a_deep_chain_comes_out_whole(spark):
    chain = spark.range(1, 1001).selectExpr("id node", "id - 1 parent")
    loop = spark.createDataFrame([(2001, 2002), (2002, 2001), (2003, 2001)], "node long, parent long")
    got = {r.node: r for r in threads.flattened(chain.unionByName(loop), "node", "parent").collect()}
    assert set(got) == set(range(1, 1001))
    assert got[1000].level == 999 and got[1000].root == 1 and not got[1].is_reply
    assert [r.node for r in sorted(got.values(), key=lambda r: r.path)] == list(range(1, 1001))

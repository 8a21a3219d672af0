from __future__ import annotations

import random
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewflow.llm import formatcopies, lookalike, nearcopies
from reviewflow.llm.text import letters


def fold(s):
    return "".join(c for c in (s or "").lower() if unicodedata.category(c)[0] in "LN")


def brute_pairs(rows, threshold=0.6, least=60):
    sets = {i: {f[k : k + 3] for k in range(len(f) - 2)} for i, t in rows if len(f := fold(t)) >= least}
    ids = sorted(sets)
    return {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if threshold <= len(sets[a] & sets[b]) / len(sets[a] | sets[b]) < 1}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        i = rng.randrange(len(out))
        out[i : i + rng.randrange(3)] = [rng.choice("alpha beta gamma delta 电池 包装 颜色 ランプ".split())]
    return " ".join(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    rows, n = [], 0
    for _ in range(25):
        base = ["".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(rng.randrange(3, 9))) for _ in range(rng.randrange(14, 40))]
        for k in range(6):
            rows.append((n := n + 1, edited(rng, base, k)))
    rows += [(1001, None), (1002, ""), (1003, "short"), (1004, rows[0][1]), (1005, rows[0][1].upper() + "!!"), (1006, rows[3][1] * 400), (1007, "ΟΔΟΣ ΣΑΣ " * 12), (1008, "οδος σας " * 12)]
    return rows


def test_near_pairs_equal_brute_force(spark, texts):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in texts], "id long, text string, k string, a string")
    got = {tuple(r) for r in nearcopies.near_pairs(df, "id", "text").collect()}
    assert got == brute_pairs(texts) and got
    assert nearcopies.near_pairs(df.limit(0), "id", "text").count() == 0
    summary = {r.id: r for r in nearcopies.near_summary(df, "id", "text").collect()}
    assert summary[1004].class_id == summary[1].class_id == 1 and 1003 not in summary


def test_near_groups_are_components_over_all_rows(spark, texts):
    df = spark.createDataFrame(texts, "id long, text string")
    parent = {i: i for i, _ in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def join(x, y):
        x, y = sorted((root(x), root(y)))
        parent[y] = x

    sets = {}
    for i, t in texts:
        if len(f := fold(t)) >= 60:
            join(i, sets.setdefault(frozenset(f[k : k + 3] for k in range(len(f) - 2)), i))
    for x, y in brute_pairs(texts):
        join(x, y)
    got = {r.id: r for r in nearcopies.near_groups(df, "id", "text").collect()}
    assert {i: r.class_id for i, r in got.items()} == {i: root(i) for i, _ in texts}
    assert got[1].class_id == got[2].class_id and got[2].n_links > 0 and got[1003].class_id == 1003 and got[1001].n_links == 0
    assert nearcopies.near_groups(df.limit(0), "id", "text").count() == 0


def test_components_of_a_long_chain(spark):
    order = random.Random(3).sample(range(200), 200)
    chain = [(order[i], order[i + 1]) for i in range(199)] + [(900, 901), (901, 900)]
    got = dict(tuple(r) for r in nearcopies._components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 200)} | {901: 900}


def test_large_buckets_are_split_without_loss(spark, texts, monkeypatch):
    monkeypatch.setattr(nearcopies, "SPLIT", 2)
    df = spark.createDataFrame(texts, "id long, text string")
    # The limit is read where the buckets are made, so it is set in the workers' function too.
    import pyarrow as pa

    least = 60
    labels = [0]
    blocks = list(nearcopies._block_batches(least, labels)(iter([pa.RecordBatch.from_arrays([pa.array([t for _, t in texts], pa.string())], names=["t"])])))
    first = list(nearcopies._bucket_batches(nearcopies.radius_for(0.6))(iter(blocks)))
    rows = [r for b in first for r in b.to_pylist()]
    work = [r for r in rows if r["work"] is not None]
    assert work
    pairs = {(r["a"], r["b"]) for r in rows if r["work"] is None}
    # Blocks meet by their numbers: every pair of a bucket's blocks once.
    met = nearcopies._block_pairs(spark.createDataFrame([(r["bucket"], r["block"], r["blocks"], r["work"]) for r in work], "bucket long, block int, blocks int, work binary"), 4).collect()
    sizes = {r["bucket"]: r["blocks"] for r in work}
    assert len(met) == sum(max(1, n * (n - 1) // 2) for n in sizes.values())
    two = pa.RecordBatch.from_arrays([pa.array([None if r[k] is None else bytes(r[k]) for r in met], pa.binary()) for k in ("one", "two")], names=["one", "two"])
    more = nearcopies._work_batches(nearcopies.radius_for(0.6))(iter([two]))
    pairs |= {(a, b) for x in more for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True)}
    rows, grams, ends = nearcopies.gram_sets([t for _, t in texts], least)
    key = {texts[r][0]: int(k) for r, k in zip(rows, nearcopies.class_keys(grams, ends), strict=True)}
    need = {tuple(sorted((key[a], key[b]))) for a, b in brute_pairs(texts)}
    assert need <= pairs
    assert df.count() == len(texts)


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    n = 700
    sk = rng.integers(0, 256, (n, nearcopies.BITS // 8), dtype=np.uint8)
    sk[1::2] = sk[::2]
    sk[1::2, :8] ^= rng.integers(0, 256, (n // 2, 8), dtype=np.uint8)
    keys = np.arange(n, dtype=np.int64)
    for radius in (0, 20, 40, 110, 127):
        found = nearcopies._distinct_pairs(nearcopies.bucket_links(keys, sk, np.array([400, 200, 100]), radius))
        bits = np.unpackbits(sk, axis=1).astype(int)
        want = set()
        for a, z in ((0, 400), (400, 600), (600, 700)):
            d = np.abs(bits[a:z, None] - bits[None, a:z]).sum(axis=2)
            want |= {(a + i, a + j) for i, j in zip(*np.nonzero(d <= radius), strict=True) if i < j}
        assert {tuple(map(int, x)) for x in found} == want


COPIES = [
    (1, "Hello, World! 你好", "Second text"), (2, "hello world 你好", "SECOND TEXT!"), (3, "second-text", "HELLO WORLD…你好"), (4, "hello word 你好", "second text"),
    (5, None, None), (6, "", None), (7, "short", None), (8, "!!!", None), (9, "ΟΔΟΣ ΟΔΟΣ ΟΔΟΣ", None), (10, "οδος οδος οδος", ""), (11, "x" * 200000, "y"), (12, "X " * 200000, "Y"), (13, "İstanbul şehri güzel", None), (14, "İSTANBUL ŞEHRİ GÜZEL", None),
]


def test_format_copies_equal_brute_force(spark):
    df = spark.createDataFrame([(*r, "x") for r in COPIES * 1], "id long, one string, two string, k1 string")
    got = {tuple(r) for r in formatcopies.format_copies(df, "id", "one", "two").collect()}
    groups = {}
    for i, a, b in COPIES:
        key = tuple(sorted((fold(a), fold(b))))
        if sum(map(len, key)) >= 12:
            groups.setdefault(key, []).append(i)
    assert got == {(g[0], i) for g in groups.values() for i in g[1:]} and (1, 3) in got and (11, 12) in got
    kept = {r.id: r.n_copies for r in formatcopies.collapsed(df, "id", "one", "two").collect()}
    assert kept[1] == 3 and 2 not in kept and kept[5] == 1
    assert formatcopies.format_copies(df.limit(0), "id", "one", "two").count() == 0


def test_two_pointers_and_hash_agree():
    rng = random.Random(2)
    alphabet = "aAbB.,! ςΣσ你１1ßİ\U0001d7d8"
    for _ in range(300):
        a, b = ("".join(rng.choice(alphabet) for _ in range(rng.randrange(6))) for _ in range(2))
        assert formatcopies.same_letters(a, b) == (fold(a) == fold(b))
        p, o = letters([a, b])
        x, y = formatcopies.rolling_hashes(p, o)
        assert (x == y) == (fold(a) == fold(b))


SAME = [
    ("Ａｂｃ１２", "Abc12"), ("café", "café"), ("a​b", "ab"), ("a b", "a b"), ("Саfе", "Cafe"), ("ｶﾞｷﾞ", "ガギ"), ("한글", unicodedata.normalize("NFD", "한글")), ("№5", "No5"), ("⼿機", "手機"), ("so­ft", "soft"), ("！", "!"),
    ("e​́", "é"),
]
OTHER = [("Abc", "abc"), ("a!", "a?"), ("👍", "👏"), ("a b", "ab"), ("0", "O"), ("👨‍👩", "👨👩")]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same_look(a, b):
    assert lookalike.consistent_form(a) == lookalike.consistent_form(b)


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_other_look(a, b):
    assert lookalike.consistent_form(a) != lookalike.consistent_form(b)


def test_the_mapping_has_no_conflicts():
    lookalike.compiled()


def test_same_look_pairs(spark):
    rows = [(1, "好用Ａ"), (2, "好用A"), (3, "好用A"), (4, "好用А"), (5, None), (6, " "), (7, " "), (8, ""), (9, "x" * 100000 + "​"), (10, "x" * 100000)]
    df = spark.createDataFrame([(*r, "q") for r in rows], "id long, text string, form string")
    assert {tuple(r) for r in lookalike.same_look_pairs(df, "id", "text").collect()} == {(1, 2), (1, 3), (1, 4), (2, 4), (3, 4), (9, 10)}
    assert lookalike.same_look_pairs(df.limit(0), "id", "text").count() == 0
    assert {r.id: r.form for r in lookalike.consistent_texts(df, "id", "text").collect()}[5] is None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=12) | st.sampled_from(["ΟΔΟΣ", "ΣΑΣ. Σ", "İΣ", "é😀字", ""]), max_size=6))
def test_streamed_bytes_give_the_letters(texts):
    import pyarrow as pa

    from reviewflow.llm.text import code_points, folded_stream

    column = pa.array(["x", *texts, "y"], pa.string()).slice(1, len(texts))
    points, offsets = code_points(column)
    assert ["".join(map(chr, points[a:z])) for a, z in zip(offsets[:-1], offsets[1:], strict=True)] == [t or "" for t in texts]
    folded, offsets = folded_stream(column)
    expected, ends = letters(texts)
    assert folded[folded != 0].tolist() == expected.tolist()
    hashes, sizes = formatcopies.stream_hashes(folded, offsets)
    assert sizes.tolist() == np.diff(ends).tolist() and hashes.tolist() == formatcopies.rolling_hashes(expected, ends).tolist()


def test_hot_group_is_verified_in_slices(spark, monkeypatch):
    monkeypatch.setattr(formatcopies, "SLICE", 7)
    rows = [(i, "Same text, over and over!" if i % 3 else f"other text number {i}", None) for i in range(300)]
    got = formatcopies.format_copies(spark.createDataFrame(rows, "id long, a string, b string"), "id", "a", "b").collect()
    assert sorted(r.copy_id for r in got) == [i for i in range(2, 300) if i % 3] and {r.first_id for r in got} == {1}


def test_look_classes(spark):
    rows = [(1, "Café"), (2, "Café"), (3, "Ｃａｆé"), (4, "Café"), (5, None), (6, " "), (7, "tea"), (8, "Cafe")]
    got = {r.id: (r.class_id, r.n_rows, r.n_texts) for r in lookalike.look_classes(spark.createDataFrame(rows, "id long, t string"), "id", "t").collect()}
    assert got == dict.fromkeys((1, 2, 3, 4), (1, 4, 3)) | {7: (7, 1, 1), 8: (8, 1, 1)}

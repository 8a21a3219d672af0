"""Near-duplicate records with small edits -> links between texts, classes, and pairs of rows.

Two texts are linked if the sets of letter k-grams of their letters have a Jaccard similarity of at least ``threshold``.

Method: bit-sliced comparison. Every distinct gram set has a sketch of 256 one-bit minima. Sets that share a band of minima
meet in a bucket; there the sketches are stored as vertical bit planes, the planes are compared with themselves shifted by
d places, so that one word operation serves 64 distances, differences are summed with carry-save adders, and words are
abandoned once all their distances exceed the radius. Survivors are verified exactly on their gram sets.

Candidates: 64 bands of 5 minima find a pair of similarity 0.6 with probability 0.994, 0.65 with 0.9996, 0.7 with 0.99999;
the radius lets through all but 1 in 100,000 pairs of similarity 0.6. Links are exact: no pair below the threshold comes out.

Scale: a bucket is never compared by one task beyond ``SPLIT`` sets; larger ones come out as blocks, each once, and pairs of block
numbers are spread over tasks that fetch both blocks. Equal texts meet as one set, so a text held by a third of all rows costs no more than any other.

Defined results
* null, blank and shorter texts (fewer than ``least`` letters) have no links.
* rows with equal gram sets are one class; ``near_pairs`` does not list pairs of one class (their similarity is 1).
* ``near_groups`` has one row for each row: groups are the connected components of the links, so two rows of a group may be less
  similar than the threshold; a row without enough letters, or without link and equal, is a group of its own.
* an empty table gives no rows; whole texts are used; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.llm.text import letters, mix
from reviewflow.storage import ship_package, written

BANDS, ROWS = 64, 5
BITS = 256
SPLIT = 2048
#: Entries whose planes are made at once.
CHUNK = 1 << 16
#: Bytes that a task of the bucket stage should receive.
TASK_BYTES = 64 << 20

_U = np.uint64
_rng = np.random.default_rng(20240229)
_MULTIPLIERS = (_rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_SUMMANDS = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def gram_sets(texts: list[str | None], least: int, k: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that have enough letters, flat 48-bit gram hashes distinct within each row, offset of each row's grams)."""
    points, offsets = letters(texts)
    length = np.diff(offsets)
    rows = np.flatnonzero(length >= max(least, k))
    if not len(rows):
        return rows, np.zeros(0, dtype=_U), np.zeros(1, dtype=np.int64)
    code = points[: len(points) - k + 1].astype(_U)
    for i in range(1, k):
        code = (code << _U(21)) | points[i : len(points) - k + 1 + i].astype(_U)
    n = length[rows] - k + 1
    start = np.cumsum(n) - n
    at = np.arange(int(n.sum())) - np.repeat(start, n) + np.repeat(offsets[:-1][rows], n)
    doc = np.repeat(np.arange(len(rows), dtype=_U), n)
    out, ends, done = [], [0], 0
    # The row's number in the high bits keeps the rows apart in one sort; it has 16 bits.
    for a in range(0, len(rows), 1 << 16):
        z = min(a + (1 << 16), len(rows))
        lo, hi = int(start[a]), int(start[z - 1] + n[z - 1])
        key = ((doc[lo:hi] - _U(a)) << _U(48)) | (mix(code[at[lo:hi]]) >> _U(16))
        key.sort()
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        ends.extend((done + np.searchsorted(key >> _U(48), np.arange(z - a, dtype=_U), side="right")).tolist())
        done += len(key)
        out.append(key & _U((1 << 48) - 1))
    return rows, np.concatenate(out), np.array(ends, dtype=np.int64)


def class_keys(grams: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit key of each gram set, independent of order."""
    if len(ends) == 1:
        return np.zeros(0, dtype=np.int64)
    return mix(np.add.reduceat(mix(grams ^ _U(0x9E3779B97F4A7C15)), ends[:-1])).view(np.int64)


def minima(grams: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of BANDS * ROWS minima for each gram set; worked off in pieces that stay in cache."""
    n = len(ends) - 1
    out = np.empty((BANDS * ROWS, n), dtype=np.uint32)
    base = (mix(grams) >> _U(32)).astype(np.uint32)
    step = max(1, 65536 * n // max(1, len(grams)))
    for a in range(0, n, step):
        z = min(a + step, n)
        piece, starts = base[ends[a] : ends[z]], ends[a:z] - ends[a]
        buffer = np.empty_like(piece)
        for j in range(BANDS * ROWS):
            np.multiply(piece, _MULTIPLIERS[j], out=buffer)
            np.add(buffer, _SUMMANDS[j], out=buffer)
            # The low bits of a product are weak; the minimum is taken by the mixed high bits.
            out[j, a:z] = np.minimum.reduceat(buffer, starts)
    return out.T


def sketches(m: np.ndarray) -> np.ndarray:
    """256 bits of each set: one bit of each minimum, mixed."""
    x = m[:, :BITS].astype(_U)
    bits = (mix(x + (np.arange(BITS, dtype=_U) << _U(32))) & _U(1)).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little")


def band_keys(m: np.ndarray) -> np.ndarray:
    x = m.reshape(len(m), BANDS, ROWS).astype(_U)
    key = np.broadcast_to(np.arange(BANDS, dtype=_U), x.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key * _U(0x9E3779B97F4A7C15) + x[:, :, r])
    return key


def _block_batches(least: int, labels: list[int]):
    parts = len(labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 30000):
                _, grams, ends = gram_sets(b.column(0).slice(lo, 30000).to_pylist(), least)
                keys = class_keys(grams, ends)
                if not len(keys):
                    continue
                _, first = np.unique(keys, return_index=True)
                m = minima(grams, ends)[first]
                keys, sk, bands = keys[first], sketches(m), band_keys(m)
                part = ((bands >> _U(32)) % _U(parts)).astype(np.int64).ravel()
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                short = (bands & _U(0xFFFFFFFF)).astype(np.uint32).ravel()
                ids, blobs = [], []
                for p in range(parts):
                    at = order[cuts[p] : cuts[p + 1]]
                    if len(at):
                        docs, local = np.unique(at // BANDS, return_inverse=True)
                        ids.append(labels[p])
                        blobs.append(_pack(keys[docs], sk[docs], short[at], local))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

    return run


def _pack(keys: np.ndarray, sk: np.ndarray, bucket: np.ndarray, local: np.ndarray) -> bytes:
    head = np.array([len(keys), len(bucket)], dtype=np.int64)
    return b"".join((head.tobytes(), keys.tobytes(), np.ascontiguousarray(sk).tobytes(), bucket.tobytes(), local.astype(np.uint16).tobytes()))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    d, e = np.frombuffer(blob, np.int64, 2)
    at = 16
    keys = np.frombuffer(blob, np.int64, d, at)
    sk = np.frombuffer(blob, np.uint8, d * (BITS // 8), at := at + 8 * d).reshape(d, BITS // 8)
    bucket = np.frombuffer(blob, np.uint32, e, at := at + d * (BITS // 8))
    local = np.frombuffer(blob, np.uint16, e, at + 4 * e)
    return keys, sk, bucket, local


# ---- bit-sliced comparison -------------------------------------------------------------------------------------------


def _planes(sk: np.ndarray) -> np.ndarray:
    """Vertical bit planes: one row of words for each sketch bit, one lane for each entry, with a word to spare."""
    n = len(sk)
    bits = np.unpackbits(sk, axis=1, bitorder="little").T
    packed = np.packbits(bits, axis=1, bitorder="little")
    out = np.zeros((BITS, (n + 63) // 64 * 8 + 8), dtype=np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(_U)


def _add(groups: dict[int, list[np.ndarray]], planes: np.ndarray) -> None:
    """Carry-save adding of many planes at once; ``groups`` holds the vertical sums by weight, one plane for each."""
    todo, weight = planes, 0
    while len(todo) or groups.get(weight) is not None:
        old = groups.get(weight)
        if old is not None:
            todo = np.concatenate([todo, old[None]]) if len(todo) else old[None]
        carries = []
        while len(todo) >= 3:
            k = len(todo) // 3
            a, b, c = todo[:k], todo[k : 2 * k], todo[2 * k : 3 * k]
            u = a ^ b
            carries.append((a & b) | (u & c))
            todo = np.concatenate([u ^ c, todo[3 * k :]])
        if len(todo) == 2:
            carries.append((todo[0] & todo[1])[None])
            todo = (todo[0] ^ todo[1])[None]
        if len(todo):
            groups[weight] = todo[0]
        todo = np.concatenate(carries) if carries else np.zeros((0, planes.shape[1]), dtype=_U)
        weight += 1


def _exceeds(groups: dict[int, np.ndarray], radius: int, width: int) -> np.ndarray:
    """A bit for each lane: is its vertical sum greater than the radius."""
    over, equal = np.zeros(width, dtype=_U), np.full(width, ~_U(0))
    for weight in reversed(range(max([*groups, radius.bit_length() - 1]) + 1)):
        c = groups.get(weight)
        if c is None:
            c = np.zeros(width, dtype=_U)
        if radius >> weight & 1:
            equal &= c
        else:
            over |= equal & c
            equal &= ~c
    return over


def close_lanes(planes: np.ndarray, shift: int, words: np.ndarray, valid: np.ndarray, radius: int, step: int = 64) -> np.ndarray:
    """Lanes i (as numbers) of the given words whose distance to lane i + shift is at most the radius."""
    whole, bits = divmod(shift, 64)
    groups: dict[int, np.ndarray] = {}
    for lo in range(0, BITS, step):
        part = planes[lo : lo + step]
        there = part[:, words + whole]
        if bits:
            there = (there >> _U(bits)) | (part[:, words + whole + 1] << _U(64 - bits))
        _add(groups, part[:, words] ^ there)
        valid = valid & ~_exceeds(groups, radius, len(words))
        live = valid != 0
        if not live.all():  # words of which all lanes exceed the radius are abandoned
            words, valid = words[live], valid[live]
            groups = {w: g[live] for w, g in groups.items()}
        if not len(words):
            break
    if not len(words):
        return np.zeros(0, dtype=np.int64)
    lanes = np.unpackbits(valid.view(np.uint8), bitorder="little").reshape(len(words), 64)
    at, lane = np.nonzero(lanes)
    return words[at] * 64 + lane


def radius_for(threshold: float) -> int:
    """Sketch bits in which all but 1 in 100,000 pairs of that similarity differ at most."""
    p = (1 - threshold) / 2
    return math.ceil(BITS * p + 4.3 * math.sqrt(BITS * p * (1 - p)))


def bucket_links(keys: np.ndarray, sk: np.ndarray, size: np.ndarray, radius: int) -> list[np.ndarray]:
    """Pairs of keys within the radius, in buckets that lie after each other; ``size``: of each bucket, in falling order."""
    found, start = [], 0
    ends = np.cumsum(size)
    i = 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(ends, start + CHUNK, side="right")))
        stop = int(ends[j - 1])
        k, own = keys[start:stop], size[i:j]
        planes = _planes(sk[start:stop])
        bucket_end = np.repeat(np.cumsum(own), own)
        left = bucket_end - np.arange(stop - start) - 1  # partners after each entry in its bucket
        planes = np.pad(planes, ((0, 0), (0, int(own[0]) // 64 + 2)))
        for d in range(1, int(own[0])):
            n = int(np.cumsum(own)[np.searchsorted(-own, -d, side="left") - 1])  # buckets of more than d entries come first
            ok = np.packbits(left[:n] >= d, bitorder="little")
            valid = np.zeros((n + 63) // 64 * 8, dtype=np.uint8)
            valid[: len(ok)] = ok
            valid = valid.view(_U)
            words = np.flatnonzero(valid)
            lanes = close_lanes(planes, d, words, valid[words], radius)
            if len(lanes):
                a, b = k[lanes], k[lanes + d]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
        start, i = stop, j
    return found


def _distinct_pairs(found: list[np.ndarray]) -> np.ndarray:
    if not found:
        return np.zeros((0, 2), dtype=np.int64)
    x = np.concatenate(found)
    x = x[x[:, 0] != x[:, 1]]
    order = np.lexsort((x[:, 1], x[:, 0]))
    x = x[order]
    return x[np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)])] if len(x) else x


_LINKS = "a long, b long, bucket long, block int, blocks int, work binary"
_NO_LINKS = np.zeros((0, 2), dtype=np.int64)


def _link_batch(pairs: np.ndarray, bucket: int = 0, work: list[bytes] = ()) -> pa.RecordBatch:
    """Links, or the blocks of a bucket."""
    k, n = len(pairs), len(work)
    ints = lambda values: pa.array([None] * k + values, pa.int32())
    cols = [pa.array(np.concatenate([pairs[:, i], np.zeros(n, dtype=np.int64)])) for i in (0, 1)]
    cols += [pa.array([None] * k + [bucket] * n, pa.int64()), ints(list(range(n))), ints([n] * n), pa.array([None] * k + list(work), pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=["a", "b", "bucket", "block", "blocks", "work"])


def _bucket_batches(radius: int):
    """One part: buckets of one task's size are compared here, larger ones come out as blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, label = [], None
        for b in batches:
            label = b.column(0)[0].as_py() if label is None and b.num_rows else label
            parts += [_unpack(x) for x in b.column(1).to_pylist()]
        if not parts:
            return
        base = np.cumsum([0] + [len(p[0]) for p in parts])
        keys, sk = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        bucket = np.concatenate([p[2] for p in parts])
        entry = np.concatenate([p[3].astype(np.int64) + base[i] for i, p in enumerate(parts)])
        del parts
        order = np.lexsort((keys[entry], bucket))
        bucket, entry = bucket[order], entry[order]
        new = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (keys[entry[1:]] != keys[entry[:-1]])])
        bucket, entry = bucket[new], entry[new]
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        size = np.diff(np.append(starts, len(bucket)))
        many = np.flatnonzero(size > 1)
        many = many[np.argsort(-size[many], kind="stable")]
        big = many[size[many] > SPLIT]
        for s, n in zip(starts[big], size[big], strict=True):
            at = (entry[s + i : s + min(i + SPLIT, n)] for i in range(0, n, SPLIT))
            yield _link_batch(_NO_LINKS, label << 32 | int(bucket[s]), [_pack_block(keys, sk, x) for x in at])
        small = many[size[many] <= SPLIT]
        s, n = starts[small], size[small]
        at = entry[np.repeat(s - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        yield _link_batch(_distinct_pairs(bucket_links(keys[at], sk[at], n, radius)))

    return run


def _pack_block(keys: np.ndarray, sk: np.ndarray, at: np.ndarray) -> bytes:
    return np.array([len(at)], dtype=np.int64).tobytes() + keys[at].tobytes() + sk[at].tobytes()


def _unpack_block(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    (n,) = np.frombuffer(blob, np.int64, 1)
    return np.frombuffer(blob, np.int64, n, 8), np.frombuffer(blob, np.uint8, n * (BITS // 8), 8 + 8 * n).reshape(n, BITS // 8)


def _work_batches(radius: int):
    """Two blocks of a large bucket, all against all; a block alone (no second one) against itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for one, two in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                keys, sk = _unpack_block(one)
                if two is not None:
                    more = _unpack_block(two)
                    keys, sk = np.concatenate([keys, more[0]]), np.concatenate([sk, more[1]])
                yield _link_batch(_distinct_pairs(bucket_links(keys, sk, np.array([len(keys)]), radius)))

    return run


def _block_pairs(blocks: DataFrame, parts: int) -> DataFrame:
    """(one, two): every pair of blocks of a bucket once, and every block of a bucket that has no other with null.

    Pairs are numbers until both blocks are fetched by (bucket, block), so no task holds more than the blocks it compares. A pair
    also compares the blocks within themselves.
    """
    refs = blocks.select("bucket", F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"), "blocks")
    refs = refs.where("i < j OR blocks = 1").repartition(parts)
    one = blocks.select("bucket", F.col("block").alias("i"), F.col("work").alias("one"))
    two = blocks.select("bucket", F.col("block").alias("j"), F.col("work").alias("two"))
    both = refs.join(one, ["bucket", "i"]).join(two, ["bucket", "j"])
    return both.select("one", F.when(F.col("i") < F.col("j"), F.col("two")).alias("two"))


# ---- the operator ----------------------------------------------------------------------------------------------------


def _labels(spark: SparkSession, parts: int) -> list[int]:
    """A label for each shuffle partition that Spark's hash sends just there."""
    there = spark.range(40 * parts + 200).select(F.col("id").cast("int").alias("id"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("p"))
    found = {r.p: r.m for r in there.groupBy("p").agg(F.min("id").alias("m")).collect()}
    spare = iter(range(10**6, 10**6 + parts))
    return [found[p] if p in found else next(spare) for p in range(parts)]


def _member_batches(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, grams, ends = gram_sets(b.column(1).to_pylist(), least)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(class_keys(grams, ends), pa.int64())], names=["id", "k"])

    return run


def _verify_batches(threshold: float):
    """Exact: the gram sets of both texts are intersected, grams as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist() + b.column(3).to_pylist()
            place: dict[str, int] = {}
            at = [place.setdefault(t, len(place)) for t in texts]
            points, offsets = letters(list(place))
            s = points.tobytes().decode("utf-32-le", "surrogatepass")
            sets = [frozenset(s[i : i + 3] for i in range(x, y - 2)) for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
            n = b.num_rows
            common = [len(sets[at[i]] & sets[at[n + i]]) for i in range(n)]
            sim = [c / (len(sets[at[i]]) + len(sets[at[n + i]]) - c) for i, c in enumerate(common)]
            keep = pa.array([threshold <= x < 1 for x in sim], pa.bool_())
            out = pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sim, pa.float64())], names=["a", "b", "similarity"])
            yield out.filter(keep)

    return run


def near_classes(rows: DataFrame, row_id: str, text: str, threshold: float, least: int) -> tuple[DataFrame, DataFrame]:
    """(members, links): members (id, k) gives the class of each row with enough letters; links (a, b, similarity) the linked classes."""
    spark = rows.sparkSession
    ship_package(spark)
    named = rows.select(F.col(f"`{row_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    radius = radius_for(threshold)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() * BANDS * (BITS // 8 + 14) // TASK_BYTES))
    labels = _labels(spark, parts)
    blocks = named.select("text").mapInArrow(_block_batches(least, labels), "part int, blob binary").repartition(parts, "part")
    first = written(blocks.mapInArrow(_bucket_batches(radius), _LINKS), "near-links")
    work = _block_pairs(first.where("work IS NOT NULL"), parts)
    links = first.where("work IS NULL").select("a", "b").union(work.mapInArrow(_work_batches(radius), _LINKS).select("a", "b")).distinct()
    links = written(links, "near-candidates")
    members = written(named.mapInArrow(_member_batches(least), "id long, k long"), "near-members")
    linked = links.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    reps = members.join(linked, "k", "left_semi").groupBy("k").agg(F.min("id").alias("id"))
    texts = written(named.join(reps, "id").select("k", "text"), "near-texts")
    both = links.join(texts.select(F.col("k").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("k").alias("b"), F.col("text").alias("tb")), "b")
    sure = both.select("a", "b", "ta", "tb").mapInArrow(_verify_batches(threshold), "a long, b long, similarity double")
    return members, written(sure, "near-sure")


def near_pairs(rows: DataFrame, row_id: str, text: str, threshold: float = 0.6, least: int = 60) -> DataFrame:
    """(id_a, id_b), a < b: pairs of rows whose similarity is at least the threshold and below 1."""
    members, links = near_classes(rows, row_id, text, threshold, least)
    a = members.select(F.col("id").alias("x"), F.col("k").alias("a"))
    b = members.select(F.col("id").alias("y"), F.col("k").alias("b"))
    both = links.select("a", "b").join(a, "a").join(b, "b")
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def near_summary(rows: DataFrame, row_id: str, text: str, threshold: float = 0.6, least: int = 60) -> DataFrame:
    """(row_id, class_id, n_links): the class of each row, named by its smallest row, and how many other classes it is linked to."""
    members, links = near_classes(rows, row_id, text, threshold, least)
    n = links.select(F.explode(F.array("a", "b")).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    classes = members.groupBy("k").agg(F.min("id").alias("class_id")).join(n, "k", "left")
    out = members.join(classes, "k").select(F.col("id").alias(row_id), "class_id", F.coalesce("n", F.lit(0)).alias("n_links"))
    return out


def _components(links: DataFrame) -> DataFrame:
    """(k, c): the smallest member c of the connected component of each k in ``links`` (a, b), but for c itself.

    Large-star and small-star rounds, each written: every vertex hands its neighbours to its least one until only stars are left.
    """
    edges = written(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).where("v != m").distinct(), "near-stars")
    while True:
        both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.least("v", F.min("m")).alias("c"))
        large = both.join(least, "v").where("m > v").select(F.col("m").alias("v"), F.col("c").alias("m"))
        large = written(large.distinct(), "near-stars")
        least = large.groupBy("v").agg(F.min("m").alias("c"))
        small = large.join(least, "v").where("m != c").select(F.col("m").alias("v"), F.col("c").alias("m"))
        edges = written(small.unionByName(least.select("v", F.col("c").alias("m"))).distinct(), "near-stars")
        centres = edges.select(F.col("m").alias("v")).distinct()
        loose = edges.groupBy("v").count().where("count > 1").select("v").unionByName(edges.select("v").join(centres, "v", "left_semi"))
        if loose.isEmpty():
            return edges.select(F.col("v").alias("k"), F.col("m").alias("c"))


def near_groups(rows: DataFrame, row_id: str, text: str, threshold: float = 0.6, least: int = 60) -> DataFrame:
    """(row_id, class_id, n_links) of every row: its group of linked and equal rows, named by its smallest row, and how many other
    sets of grams its own is linked to."""
    members, links = near_classes(rows, row_id, text, threshold, least)
    n = links.select(F.explode(F.array("a", "b")).alias("k")).groupBy("k").agg(F.count("*").alias("n_links"))
    sets = members.groupBy("k").agg(F.min("id").alias("first")).join(_components(links), "k", "left").join(n, "k", "left")
    sets = written(sets.select("k", "first", F.coalesce("c", "k").alias("c"), "n_links"), "near-sets")
    classes = sets.join(sets.groupBy("c").agg(F.min("first").alias("class_id")), "c").select("k", "class_id", "n_links")
    found = members.join(classes, "k").select("id", "class_id", "n_links")
    every = rows.select(F.col(f"`{row_id}`").cast("long").alias("id")).join(found, "id", "left")
    return every.select(F.col("id").alias(row_id), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))

"""Duplicates hidden by formatting differences -> one record for each group and its number of copies.

Method: the bytes of both fields stream through a skip-and-fold lookup table into rolling polynomial hashes: a character that is
skipped adds nothing and moves no power, so no canonical string is made. Rows whose hashes collide are verified against the first row of their group with a two-pointer
comparison that skips and folds while it walks both texts.

Two rows are copies if the unordered pair of the letters of both fields is equal and the two have at least ``least``
letters together. Letters: lower case, only Unicode L and N.

Defined results
* null counts as empty; two empty fields never reach ``least``, so such rows stay alone.
* the first of a group is the row with the smallest id; every other row is one copy.
* rows of one hash that verification tells apart form groups of their own, by their letters.
* an empty table gives no rows; very long texts are hashed whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.text import folded_stream, letter_table, letters
from reviewflow.storage import ship_package, written

#: Rows of a group that are verified together.
SLICE = 50_000
#: Two primes under 2^31 and a base for each: a character below 2^21 times a power stays below 2^52.
PRIMES = ((2147483647, 911382323), (2147483629, 972663749))


def stream_hashes(folded: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(62-bit polynomial hash, number of letters) of each text of a folded stream; a text without letters has 0 and 0."""
    length = np.diff(offsets)
    out, size = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
    some = length > 0
    if not some.any():
        return out, size
    starts = offsets[:-1][some]
    rank = np.concatenate([[0], np.cumsum(folded != 0)])
    size[some] = rank[offsets[1:][some]] - rank[starts]
    place = rank[:-1] - np.repeat(rank[starts], length[some])
    for prime, base in PRIMES:
        powers = _powers(int(size.max()) + 1, prime, base)
        terms = np.where(folded != 0, (folded.astype(np.uint64) + 1) * powers[place] % prime, 0)
        # Sums of fewer than 2^32 terms below 2^31 fit.
        sums = np.add.reduceat(terms, starts) % prime
        out[some] = (out[some] << 31) | sums.astype(np.int64)
    return out, size


def rolling_hashes(folded: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return stream_hashes(folded, offsets)[0]


def _powers(n: int, prime: int, base: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo prime, by doubling."""
    p, step = np.ones(1, dtype=np.uint64), base
    while len(p) < n:
        p = np.concatenate([p, p * np.uint64(step) % np.uint64(prime)])
        step = step * step % prime
    return p[:n]


def same_letters(a: str | None, b: str | None) -> bool:
    """Two-pointer comparison: both texts are walked at once, skipping and folding, until they differ or end."""
    table = letter_table()
    if "Σ" in (a or "") or "Σ" in (b or ""):
        a, b = (a or "").lower(), (b or "").lower()
    a, b = a or "", b or ""
    i = j = 0
    while True:
        while i < len(a) and not table[ord(a[i])]:
            i += 1
        while j < len(b) and not table[ord(b[j])]:
            j += 1
        if i == len(a) or j == len(b):
            return i == len(a) and j == len(b)
        if a[i] != b[j] and table[ord(a[i])] != table[ord(b[j])]:
            return False
        i, j = i + 1, j + 1


def _same_row(x: tuple, y: tuple) -> bool:
    if x == y or (x[1], x[0]) == y:
        return True
    return (same_letters(x[0], y[0]) and same_letters(x[1], y[1])) or (same_letters(x[0], y[1]) and same_letters(x[1], y[0]))


def _hash_batches(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (one, size_one), (two, size_two) = (stream_hashes(*folded_stream(b.column(k))) for k in (1, 2))
            size = size_one + size_two
            enough = size >= least
            # The pair is unordered: the smaller hash first. The number of letters belongs to the key too.
            cols = [b.column(0), pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)), pa.array(size)]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "k1", "k2", "n"]).filter(pa.array(enough))

    return run


def _verify_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v = [b.column(i).to_pylist() for i in range(2, 6)]
        same = [_same_row((a, c), (x, y)) for a, c, x, y in zip(*v, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(same, pa.bool_())], names=["first_id", "copy_id", "same"])


def format_copies(rows: DataFrame, row_id: str, field_one: str, field_two: str, least: int = 12) -> DataFrame:
    """(first_id, copy_id) of every copy but the first of its group."""
    ship_package(rows.sparkSession)
    named = rows.select(F.col(f"`{row_id}`").cast("long").alias("id"), F.col(f"`{field_one}`").alias("one"), F.col(f"`{field_two}`").alias("two"))
    keys = written(named.mapInArrow(_hash_batches(least), "id long, k1 long, k2 long, n long"), "format-hashes")
    key = ["k1", "k2", "n"]
    # Partial minima before the shuffle: a hot group costs one row for each task.
    groups = keys.groupBy(*key).agg(F.min("id").alias("first_id"), F.count("*").alias("rows")).where("rows > 1")
    # The rows of a hot group are verified in slices: its first row's text goes to each of them.
    slices = F.ceil(F.col("rows") / SLICE).cast("int")
    found = keys.join(groups.withColumn("slices", slices), key).where("id != first_id")
    candidates = found.select("first_id", F.col("id").alias("copy_id"), F.pmod(F.xxhash64("id"), F.col("slices")).cast("int").alias("slice"))
    texts = named.select("id", "one", "two")
    of_first = groups.select(F.col("first_id").alias("id"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    first = texts.join(of_first, "id").select(F.col("id").alias("first_id"), "slice", F.col("one").alias("a1"), F.col("two").alias("a2"))
    copy = texts.select(F.col("id").alias("copy_id"), F.col("one").alias("b1"), F.col("two").alias("b2"))
    both = candidates.join(copy, "copy_id").join(first, ["first_id", "slice"]).select("first_id", "copy_id", "a1", "a2", "b1", "b2")
    checked = written(both.mapInArrow(_verify_batches, "first_id long, copy_id long, same boolean"), "format-checked")
    return checked.where("same").select("first_id", "copy_id").unionByName(_told_apart(checked, texts))


def _told_apart(checked: DataFrame, texts: DataFrame) -> DataFrame:
    """Groups among the rows whose hash collided without equal letters: exact, on the letters themselves.

    Two 62-bit hashes and the length collide for different letters about never, so this is about always empty.
    """
    odd = checked.where("NOT same").select(F.col("copy_id").alias("id")).join(texts, "id")
    exact = odd.mapInArrow(_letter_batches, "id long, pair string")
    groups = exact.groupBy("pair").agg(F.min("id").alias("first_id"))
    return exact.join(groups, "pair").where("id != first_id").select("first_id", F.col("id").alias("copy_id"))


def _letter_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = b.num_rows
        points, offsets = letters(b.column(1).to_pylist() + b.column(2).to_pylist())
        text = [points[a:z].tobytes().decode("utf-32-le", "surrogatepass") for a, z in zip(offsets[:-1], offsets[1:], strict=True)]
        pair = ["\0".join(sorted((text[i], text[n + i]))) for i in range(n)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pair, pa.string())], names=["id", "pair"])


def collapsed(rows: DataFrame, row_id: str, field_one: str, field_two: str, least: int = 12) -> DataFrame:
    """One record for each group: all columns of its first row, and ``n_copies``, how many rows the group has."""
    copies = written(format_copies(rows, row_id, field_one, field_two, least), "format-copies")
    name = "n_copies" if "n_copies" not in rows.columns else "n_copies_found"
    counted = copies.groupBy(F.col("first_id").alias("_first")).agg((F.count("*") + 1).alias("_n"))
    kept = rows.join(copies, F.col(f"`{row_id}`") == F.col("copy_id"), "left_anti")
    out = kept.join(counted, F.col(f"`{row_id}`") == F.col("_first"), "left")
    return out.withColumn(name, F.coalesce("_n", F.lit(1))).drop("_first", "_n")

"""Visually identical text with different characters -> one consistent form, and pairs of rows that look the same.

Method: a longest-match transducer over grapheme clusters (a base character with its combining marks). Its mapping is
compiled once, on the driver, from rules for widths, compatibility forms, accents, spaces, invisible characters and look-alike
letters: the form of every single character, and of every base with one mark that has a form of its own. It is checked for conflicts:
every output must be a fixed point of the mapping, so that one pass is enough. Workers get the finished mapping. A text is read once;
runs of characters that map to themselves are copied as they are, other clusters are looked up; a cluster of several marks, of which
there is no end, is composed from its entries and kept.

Defined results
* null gives null; empty and blank texts give themselves with their spaces unified, and take no part in pairs.
* a joiner between two emoji belongs to the emoji and stays; elsewhere joiners are invisible and go.
* pairs are all pairs of rows with one consistent form but different characters; rows with the very same text are no pair.
* an empty table gives no rows; whole texts are read; other columns are not read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.storage import ship_package, written

# Letters of other scripts that look like a Latin letter, by the Latin letter.
LOOK_ALIKES = {
    "A": "АΑᎪ", "B": "ВΒᏴ", "C": "СϹᏟ", "E": "ЕΕᎬ", "F": "Ϝ", "G": "ԌᏀ", "H": "НΗᎻ", "I": "ІΙӀ", "J": "ЈͿᎫ", "K": "КΚᏦ", "L": "Ꮮ",
    "M": "МΜϺᎷ", "N": "Ν", "O": "ОΟՕ", "P": "РΡᏢ", "Q": "Ԛ", "S": "ЅՏᏚ", "T": "ТΤᎢ", "U": "Ս", "V": "ѴᏙ", "W": "ԜᎳ",
    "X": "ХΧ", "Y": "ҮΥУ", "Z": "ΖᏃ", "a": "аα", "b": "Ь", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡ", "h": "һհ", "i": "іι", "j": "јϳ",
    "k": "κк", "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "u": "սυ", "v": "ѵν", "w": "ԝ", "x": "хχ", "y": "уγү",
    "ı": "ɩ", "ß": "β", "ə": "ә", "æ": "ӕ", "Æ": "Ӕ",
}
# Characters without any ink besides those of category Cf.
BLANKS = "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ"
# Visible marks that compatibility forms leave apart though they look the same.
SAME_MARKS = {"〜": "~", "∣": "|", "∶": ":", "∕": "/", "‐": "-", "−": "-", "·": "・", "⸱": "・", "‧": "・"}
JOINER = "‍"


def _invisible(c: str) -> bool:
    return (unicodedata.category(c) == "Cf" and not 0x600 <= ord(c) <= 0x6DD) or c in BLANKS or "︀" <= c <= "️" or 0xE0100 <= ord(c) <= 0xE01EF


@lru_cache(maxsize=1)
def _letters() -> dict[str, str]:
    return {c: latin for latin, alike in LOOK_ALIKES.items() for c in alike}


@lru_cache(maxsize=200_000)
def cluster_form(cluster: str) -> str:
    """The consistent form of one grapheme cluster, by rule."""
    if all(map(_invisible, cluster)):
        return ""
    s = unicodedata.normalize("NFKC", "".join(c for c in cluster if not _invisible(c)))
    alike = _letters()
    s = unicodedata.normalize("NFD", s)
    s = "".join(SAME_MARKS.get(c, alike.get(c, " " if unicodedata.category(c) == "Zs" or c == "\t" else c)) for c in s)
    return unicodedata.normalize("NFC", unicodedata.normalize("NFKC", s))


class _Level(dict):
    """Forms of single characters by code point; a character that isn't there is its own form."""

    def __missing__(self, point: int) -> int:
        self[point] = point
        return point


class Transducer(NamedTuple):
    """The compiled mapping: forms of single characters by code point, of clusters by their text, and the pattern of what is active."""

    single: _Level
    clusters: dict[str, str]
    pattern: str
    #: A text without any of these has no cluster longer than one character and no joiner.
    starts: frozenset[str]


def _marked_pairs() -> Iterator[str]:
    """Every base with one mark that Unicode composes, in its composed spelling's parts, and half-width kana with their marks."""
    for i in range(0xA0, 0x30000):
        parts = unicodedata.normalize("NFD", chr(i))
        if len(parts) == 2 and unicodedata.category(parts[1])[0] == "M":
            yield parts
    for base in range(0xFF66, 0xFF9E):
        yield from (chr(base) + mark for mark in "ﾞﾟ")


@lru_cache(maxsize=1)
def compiled() -> Transducer:
    """The mapping, once for a driver. Conflict check: the form of every entry must be its own form again; one that fails raises."""
    active: list[int] = []
    single: dict[int, str] = _Level()
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        kind = unicodedata.category(c)
        if kind in ("Cs", "Co", "Cn"):
            continue
        form = cluster_form(c) if i >= 128 or c == "\t" else c
        if form != c or kind[0] == "M":
            active.append(i)
            single[i] = form
            if cluster_form_of_text(form) != form:
                raise ValueError(f"the mapping of U+{i:04X} isn't stable")
    clusters = {pair: cluster_form(pair) for pair in _marked_pairs()}
    if unstable := [p for p, form in clusters.items() if _applied(form, single, clusters) != form]:
        raise ValueError(f"the mapping of {unstable[0]!r} isn't stable")
    ranges: list[list[int]] = []
    for i in active:
        if ranges and ranges[-1][1] == i - 1:
            ranges[-1][1] = i
        else:
            ranges.append([i, i])
    cls = lambda rs: "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in rs) + "]"
    marks = cls([r for r in _ranges(lambda c: unicodedata.category(c)[0] == "M")])
    jamo = "[ᄀ-ᄒ][ᅡ-ᅵ][ᆨ-ᇂ]?"
    kana = "[ｦ-ﾝ][ﾞﾟ]"
    hidden = cls([r for r in _ranges(_invisible)])
    # A base keeps the marks that follow it even where invisible characters stand between.
    base = f"(?:{jamo}|{kana}|.)"
    pattern = f"{base}(?:{hidden}*{marks})+{hidden}*|{jamo}|{kana}|{cls(ranges)}"
    found = _ranges(lambda c: c == JOINER or "ᄀ" <= c <= "ᇿ" or "ｦ" <= c <= "ﾟ" or unicodedata.category(c)[0] == "M" and not _invisible(c))
    return Transducer(single, clusters, pattern, frozenset(chr(i) for a, b in found for i in range(a, b + 1)))


def _applied(s: str, single: dict[int, str], clusters: dict[str, str]) -> str:
    """A form put through the mapping again, cluster by cluster."""
    parts = unicodedata.normalize("NFD", s)
    return clusters.get(parts, "".join(single.get(ord(c), c) for c in s)) if len(parts) == 2 else "".join(single.get(ord(c), c) for c in s)


def _ranges(test) -> list[list[int]]:  # noqa: ANN001
    out: list[list[int]] = []
    for i in range(sys.maxunicode + 1):
        if not 0xD800 <= i < 0xE000 and test(chr(i)):
            if out and out[-1][1] == i - 1:
                out[-1][1] = i
            else:
                out.append([i, i])
    return out


def cluster_form_of_text(s: str) -> str:
    return "".join(map(cluster_form, s))


@lru_cache(maxsize=1)
def _pictures() -> re.Pattern:
    return re.compile("[←-⯿〰〽\U0001f000-\U0001faff]")


@lru_cache(maxsize=2)
def _regex(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.S)


def consistent_form(text: str | None, t: Transducer | None = None) -> str | None:
    """The text with every cluster in its consistent form, in one pass."""
    if text is None or text.isascii() and "\t" not in text:
        return text
    t = t or compiled()
    if t.starts.isdisjoint(text):
        return text.translate(t.single)
    single, clusters = t.single, t.clusters

    def one(m: re.Match) -> str:
        c = m.group()
        if len(c) == 1 and c != JOINER:
            form = single.get(ord(c), c)
            return c if isinstance(form, int) else form
        if c == JOINER:
            a, z = m.span()
            before = text[a - 2 : a - 1] if text[a - 1 : a] == "️" else text[a - 1 : a]
            return JOINER if _pictures().match(before) and _pictures().match(text[z : z + 1]) else single[ord(c)]
        form = clusters.get(c)
        return cluster_form(c) if form is None else form

    return _regex(t.pattern).sub(one, text)


def _form_batches(t: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            forms = [consistent_form(x, t.value) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(forms, pa.string())], names=["id", "form"])

    return run


def _key_batches(mapping: Broadcast):
    """Rows that aren't blank with 128-bit digests of their form and of their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = mapping.value
        for b in batches:
            ids, form, raw = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if t and (f := consistent_form(t, own)) and not f.isspace():
                    ids.append(i)
                    form.append(xxhash.xxh3_128_digest(f.encode("utf-8", "surrogatepass")))
                    raw.append(xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(form, pa.binary()), pa.array(raw, pa.binary())], names=["id", "form", "raw"])

    return run


def _mapping(rows: DataFrame) -> Broadcast:
    """The compiled mapping for the workers: some ten thousand entries, bounded by Unicode."""
    return rows.sparkSession.sparkContext.broadcast(compiled())


def consistent_texts(rows: DataFrame, row_id: str, text: str) -> DataFrame:
    """(row_id, form) of every row."""
    ship_package(rows.sparkSession)
    named = rows.select(F.col(f"`{row_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    return named.mapInArrow(_form_batches(_mapping(rows)), "id long, form string").withColumnRenamed("id", row_id)


def same_look_pairs(rows: DataFrame, row_id: str, text: str) -> DataFrame:
    """(id_a, id_b), a < b: rows that look the same but differ in characters.

    Work is done on the distinct texts of each form: pairs of texts first, then their rows on either side, so no pair of
    rows with the same text is ever made and the cost follows the result.
    """
    ship_package(rows.sparkSession)
    named = rows.select(F.col(f"`{row_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    keys = written(named.mapInArrow(_key_batches(_mapping(rows)), "id long, form binary, raw binary"), "look-keys")
    mixed = keys.groupBy("form").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo != hi").select("form")
    members = written(keys.join(mixed, "form", "left_semi"), "look-members")
    texts = members.select("form", "raw").distinct()
    pairs = texts.select("form", F.col("raw").alias("raw_a")).join(texts.select("form", F.col("raw").alias("raw_b")), "form").where("raw_a < raw_b")
    a = members.select(F.col("id").alias("x"), F.col("raw").alias("raw_a"))
    b = members.select(F.col("id").alias("y"), F.col("raw").alias("raw_b"))
    both = pairs.select("raw_a", "raw_b").join(a, "raw_a").join(b, "raw_b")
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def look_classes(rows: DataFrame, row_id: str, text: str) -> DataFrame:
    """(row_id, class_id, n_rows, n_texts) of every row that isn't blank: the class of rows that look the same, named by its smallest
    row, with how many rows and how many different texts it has. No pair is made, however large a class is."""
    ship_package(rows.sparkSession)
    named = rows.select(F.col(f"`{row_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    keys = written(named.mapInArrow(_key_batches(_mapping(rows)), "id long, form binary, raw binary"), "look-keys")
    # Texts are counted before classes, so a hot text costs one row for each task.
    texts = keys.groupBy("form", "raw").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    classes = texts.groupBy("form").agg(F.min("first").alias("class_id"), F.sum("n").alias("n_rows"), F.count("*").alias("n_texts"))
    return keys.join(classes, "form").select(F.col("id").alias(row_id), "class_id", "n_rows", "n_texts")

"""Garbled text from wrong character encoding -> affected fields and their original text.

Method: expectation-maximisation with latent encoding chains per source and field. A chain (T read as W, or several one after
the other) turns a text's bytes in T into other characters of W; undoing it gives a candidate. Every field that holds anything
unlikely gives its evidence for every chain that would change it: the gain in log likelihood of the candidate over the text
as it stands, weak and negative evidence too. Which chain a field went through, if any, is latent: EM over all records estimates
the chains' shares in each (source, field), so that weak evidence is pooled, and each record is then repaired by its posterior.

Likelihood: a character model (folded bigrams, transitions of case) over all rows whose text has no bare sign of garbling. What
garbled rows put into it is taken off by symbol: where a chain turns a common character into x, only what exceeds a share of that
character's uses, in the same place, is counted as x's own use. A text that stands may also be an unusual but correct language:
a word of one script then costs what letters of its alphabet cost, after a cost of leaving the languages of the corpus.

Sizes: the model is bounded by its parameters (Unicode, 2^19 bigram cells). EM's steps are aggregations in Spark over a histogram
of (source, field, evidence of all chains in bins); the shares, one row for each source, field and chain, are written in each round.
Texts are searched for chains in groups of TOGETHER characters, a longer text alone; a text's evidence does not depend on its group.

Defined results
* null, empty and pure ASCII texts are clean; replacement, private-use and control characters are evidence of a chain of their
  own, ``lost``, by which nothing can be restored; ``repaired`` then is the text as it stands.
* an empty table gives no rows; whole texts are read; a source that is null is a source of its own.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.lookalike import LOOK_ALIKES
from reviewflow.llm.text import SIZE, flat
from reviewflow.storage import ship_package, written

CELLS = 1 << 19
#: Evidence (nats) is binned by this width, between these bounds.
BIN, BOTTOM, TOP = 1.0, -20, 60
EM_ROUNDS = 6
#: Pseudo-count of records that a source starts with, and the share of them that is garbled.
PRIOR_ROWS, PRIOR_SHARE = 50.0, 0.02

SINGLE = ("cp1252", "cp1251", "mac_roman", "cp437", "cp850", "cp866", "koi8_r", "cp1250", "cp1253", "cp874")
WIDE = ("gb18030", "big5", "cp932", "cp949", "euc_jp")
#: Single-byte chains that replace letter by letter: read as -> may have been.
_LETTERWISE = {
    "cp1252": ("mac_roman", "cp850", "cp437", "cp1250", "cp1251", "koi8_r", "cp866"),
    "mac_roman": ("cp1252", "cp850", "cp1251"),
    "cp1251": ("cp1252", "mac_roman", "koi8_r"),
    "cp850": ("cp1252",),
    "cp437": ("cp1252",),
    "koi8_r": ("cp1251", "cp1252"),
    "cp866": ("cp1251",),
    "cp1250": ("cp1252",),
}
#: What a letter costs right after a letter of another alphabet, unless the two look alike.
SWITCH = -15.0
#: What it costs to leave the languages of the corpus, and a letter there.
FOREIGN, LETTER = -10.0, -4.2
#: What a character costs more where it is a look-alike of the expected one.
ALIKE = -2.5
#: A character less likely than this after its predecessor asks for a closer look.
UNLIKELY = -8.5
#: Uses of a character from which on its own pairs count more than the frequency of what follows.
BACK_OFF = 1000.0
#: A symbol's uses are its own beyond this share of the uses of any character that a chain turns into it.
USED = 0.1
#: What may have been made by garbling alone has at most this share of the uses of what it may have been.
RARER = 1 / 3
#: What a character costs where bytes were lost.
LOST = -6.0
#: A gain (nats) from which other chains need not be tried.
CERTAIN = 120.0
#: How many characters are searched for chains together.
TOGETHER = 1 << 13
#: What each chain but the first costs in a composition.
COMPOSED = -6.0


@lru_cache(maxsize=64)
def _high(codec: str) -> dict[str, int]:
    """The characters of a codec's bytes 80 to FF; bytes it leaves open are the control characters of that number."""
    out = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        out.setdefault(c, b)
    if codec == "cp1252":
        for b in range(128, 256):
            out.setdefault(chr(b), b)
    return out


@lru_cache(maxsize=1)
def _code_page_letters() -> frozenset[str]:
    """The characters that any single-byte codec has beyond ASCII."""
    return frozenset(c for w in SINGLE for c in _high(w) if c > "\x7f")


@lru_cache(maxsize=64)
def _table(codec: str) -> dict[int, int]:
    """For str.translate: characters of the codec to characters of the byte's number (latin-1)."""
    return {ord(c): b for c, b in _high(codec).items()}


def _class(codec: str, lo: int, hi: int) -> str:
    return "[" + "".join(re.escape(c) for c, b in _high(codec).items() if lo <= b <= hi) + "]"


@lru_cache(maxsize=64)
def _utf8_in(codec: str) -> re.Pattern:
    """Runs of characters of a single-byte codec whose bytes are valid multi-byte UTF-8."""
    k = _class(codec, 0x80, 0xBF)
    two, three, four = _class(codec, 0xC2, 0xDF), _class(codec, 0xE0, 0xEF), _class(codec, 0xF0, 0xF4)
    return re.compile(f"(?:{two}{k}|{three}{k}{k}|{four}{k}{k}{k})+")


@lru_cache(maxsize=64)
def _wide_in(codec: str) -> re.Pattern:
    """Runs of characters of a single-byte codec that may be double-byte text; second bytes may be ASCII."""
    h = _class(codec, 0x80, 0xFF)[1:-1]
    return re.compile(f"[{h}][@-~{h}]*[{h}][@-~{h}]*|[{h}][@-~]")


_CHUNK = re.compile("[^\\x00-\\x7f。，！？、；：“”‘’「」～…♪（）]+")
_WORD = re.compile(r"\w*[^\W\d_a-zA-Z]\w*|[^\x00-\x7f\w]+")
#: Letterwise chains to Cyrillic make whole words, never single letters in words of another script.
_CYRILLIC = re.compile("[\u0400-\u045f]{3,}")
#: Bare signs of garbling; rows that have one stay out of the character model.
_SIGNS = re.compile("[\x80-\x84\x86-\x9f�-]|[Â-ôВГД][\x80-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]|[¡-ÿ]{3}|[ｦ-ﾟ][一-鿿]|[縺繧繝]|[A-Za-zÀ-ÿ][\u0370-\u04ff]|[\u0370-\u04ff][A-Za-zÀ-ÿ]")



@lru_cache(maxsize=1)
def _disguised() -> re.Pattern:
    """UTF-8 read as a single-byte code page: a sequence of three bytes, or one of two in code pages other than Latin ones."""
    out = []
    for w in ("cp1252", "cp1251", "mac_roman", "cp437", "koi8_r"):
        k = _class(w, 0x80, 0xBF)
        out.append(f"{_class(w, 0xE0, 0xEF)}{k}{k}|{_class(w, 0xC3, 0xC3)}{k}")
    return re.compile("|".join(out))


@lru_cache(maxsize=1)
def _signing() -> np.ndarray:
    """Characters of which every text has one that has a bare sign of garbling: those that each branch of the two patterns asks for."""
    out = np.zeros(SIZE, dtype=bool)
    for lo, hi in ((0x80, 0x100), (0x370, 0x500), (0xE000, 0xF900), (0xFF66, 0xFFA0)):
        out[lo:hi] = True
    for c in "�縺繧繝" + "".join(c for w in ("cp1252", "cp1251", "mac_roman", "cp437", "koi8_r") for c, b in _high(w).items() if b == 0xC3 or b >> 4 == 0xE):
        out[ord(c)] = True
    return out


def _unsigned(texts: list[str]) -> list[str]:
    """The texts without bare signs of garbling; the patterns look only at those that may have one."""
    points, offsets = flat(texts)
    may = np.diff(np.concatenate([[0], np.cumsum(_signing()[points])])[offsets]) > 0
    return [t for t, m in zip(texts, may.tolist(), strict=True) if not (m and (_SIGNS.search(t) or _disguised().search(t)))]


# ---- character model -------------------------------------------------------------------------------------------------


def _cells(points: np.ndarray, before: np.ndarray) -> np.ndarray:
    x = points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + before.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(45)).astype(np.int64)


def _before(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.empty_like(points)
    out[1:] = points[:-1]
    out[starts[starts < len(points)]] = 10
    return out


@lru_cache(maxsize=1)
def _fold() -> np.ndarray:
    """The lower case of each character that has one character for it."""
    out = np.arange(SIZE, dtype=np.uint32)
    for i in range(0x20, 0x1F000):
        low = chr(i).lower()
        if len(low) == 1:
            out[i] = ord(low)
    return out


@lru_cache(maxsize=1)
def _kind() -> np.ndarray:
    """Lower-case letters 1, capitals 2, anything else 0."""
    out = np.zeros(SIZE, dtype=np.int8)
    for i in range(0x20, 0x1F000):
        c = chr(i)
        out[i] = 1 if c.islower() else 2 if c.isupper() else 0
    return out


@lru_cache(maxsize=1)
def _alike() -> np.ndarray:
    """The character that one looks like: its compatibility form of one character, or the Latin letter."""
    out = np.arange(SIZE, dtype=np.uint32)
    for i in range(0xA0, 0x1F000):
        form = unicodedata.normalize("NFKC", chr(i))
        if len(form) == 1:
            out[i] = ord(form)
    for latin, like in LOOK_ALIKES.items():
        for c in like:
            out[ord(c)] = ord(latin)
    return out


@lru_cache(maxsize=1)
def _ideograph() -> np.ndarray:
    """Ideographs, kana and Hangul 1, Latin letters -1."""
    out = np.zeros(SIZE, dtype=np.int8)
    for lo, hi, n in ((0x2E80, 0xA000, 1), (0xAC00, 0xD7B0, 1), (0x41, 0x5B, -1), (0x61, 0x7B, -1), (0xC0, 0x250, -1)):
        out[lo:hi] = n
    out[0x3000:0x3021] = 0
    return out


def _few_ideographs(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text whether a few ideographs stand in a text of Latin letters."""
    kind = _ideograph()[points]
    east, latin = (np.concatenate([[0], np.cumsum(kind == k)])[offsets] for k in (1, -1))
    east, latin = np.diff(east), np.diff(latin)
    return (east > 0) & (east * 5 < latin)


@lru_cache(maxsize=1)
def _pairs() -> list[tuple[np.ndarray, np.ndarray]]:
    """For each double-byte code page that UTF-8 is read as without lookalikes of other signs: both bytes of each character."""
    out = []
    for w in ("gb18030", "big5", "cp949"):
        hi, lo = np.zeros(SIZE, dtype=np.uint8), np.zeros(SIZE, dtype=np.uint8)
        for i in range(0xA0, 0x10000):
            if not 0xD800 <= i < 0xE000:
                raw = _encoded(chr(i), w)
                if raw and len(raw) == 2:
                    hi[i], lo[i] = raw
        out.append((hi, lo))
    return out


def _paired_utf8(points: np.ndarray) -> np.ndarray:
    """Where three characters are, in a double-byte code page, the six bytes of two UTF-8 characters."""
    hit = np.zeros(len(points), dtype=bool)
    for hi, lo in _pairs():
        a, b = hi[points], lo[points]
        lead, more = (lambda x: x >> 4 == 0xE), (lambda x: x >> 6 == 2)
        if len(points) > 2:
            hit[:-2] |= lead(a[:-2]) & more(b[:-2]) & more(a[1:-1]) & lead(b[1:-1]) & more(a[2:]) & more(b[2:])
    return hit


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each character, each transition of case and each bigram cell that a task saw: keys from 0, from SIZE, and below 0."""
    chars, cells, cases = np.zeros(SIZE, dtype=np.int64), np.zeros(CELLS, dtype=np.int64), np.zeros(9, dtype=np.int64)
    fold, kind = _fold(), _kind()
    for b in batches:
        for col in b.columns:
            texts = _unsigned([t for t in col.to_pylist() if t])
            if texts:
                points, offsets = flat(texts)
                signs = np.concatenate([[0], np.cumsum(_paired_utf8(points))])[offsets]
                mixed = np.repeat(_few_ideographs(points, offsets) | (np.diff(signs) > 0), np.diff(offsets))
                before = _before(points, offsets[:-1])
                points, before = points[~mixed], before[~mixed]
                chars += np.bincount(points, minlength=SIZE)
                cells += np.bincount(_cells(fold[points], fold[before]), minlength=CELLS)
                cases += np.bincount(3 * kind[before] + kind[points], minlength=9)
    keys = np.concatenate([np.flatnonzero(chars), SIZE + np.flatnonzero(cases), -1 - np.flatnonzero(cells)])
    n = np.concatenate([chars[chars > 0], cases[cases > 0], cells[cells > 0]])
    for i in range(0, len(keys), 50000):
        yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 50000]), pa.array(n[i : i + 50000])], names=["key", "n"])


class CharModel:
    """Log likelihoods of characters after their predecessor, from counts bounded by Unicode and CELLS."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        chars, cases = np.zeros(SIZE, dtype=np.float32), np.zeros(9)
        self.cells = np.zeros(CELLS, dtype=np.float32)
        char, case = (keys >= 0) & (keys < SIZE), keys >= SIZE
        chars[keys[char]] = counts[char]
        np.add.at(cases, keys[case] - SIZE, counts[case])
        np.add.at(self.cells, -1 - keys[keys < 0], counts[keys < 0])
        self.total = float(chars.sum()) + 1.0
        cases = cases.reshape(3, 3)
        turn = (cases + 0.5) / (cases[:, 1:].sum(1, keepdims=True) + 1.0)
        turn[:, 0] = 1.0
        self.case = np.log(turn).astype(np.float32).reshape(9)
        self.folded = np.bincount(_fold(), weights=chars, minlength=SIZE).astype(np.float32)
        self._symbols(chars)
        self.own = self.folded[_fold()]
        x = np.flatnonzero(self.slot)
        self.own[x] -= USED * chars[self.other[self.slot[x]]].max(1)
        self.own = np.maximum(self.own, 0)
        self._ideographs(chars)

    def _symbols(self, chars: np.ndarray) -> None:
        """For each symbol x that a letterwise chain may have made, the characters that it may have been, as a matrix."""
        made: dict[int, set[int]] = {}
        for w, tos in _LETTERWISE.items():
            for to in tos:
                for x, y in _letter_table(to, w).items():
                    if y != "�" and ord(y) != x and ord(y) >= 0xA0 and x < 0x3000:
                        made.setdefault(x, set()).add(ord(y))
        # Only a symbol that is far rarer than what it may have been can be made by garbling alone.
        made = {x: ys for x, ys in ((x, sorted(y for y in ys if chars[x] <= RARER * chars[y] and self.folded[_fold()[x]] <= self.folded[_fold()[y]])) for x, ys in made.items()) if ys}
        self.slot = np.zeros(0x3000, dtype=np.int16)
        self.other = np.zeros((len(made) + 1, max(map(len, made.values()), default=1)), dtype=np.uint32)
        for k, (x, ys) in enumerate(sorted(made.items()), 1):
            self.slot[x] = k
            self.other[k, : len(ys)] = ys

    def _ideographs(self, chars: np.ndarray) -> None:
        """The same for double-byte chains, which turn ideographs into ideographs: for each, the chain that explains it best."""
        seen = [int(i) for i in np.flatnonzero(chars[:0x10000]) if i >= 0x2000 and not 0xD800 <= i < 0xE000]
        self.chain, self.was, most = np.zeros(0x10000, dtype=np.int8), [], np.zeros(0x10000)
        for w in WIDE:
            for to in WIDE:
                if to != w:
                    was = np.arange(0x10000, dtype=np.uint32)
                    for x in seen:
                        raw = _encoded(chr(x), w)
                        y, lost = _decoded(raw, to) if raw else ("", 0)
                        if len(y) == 1 and not lost and ord(y) < 0x10000:
                            was[x] = ord(y)
                    self.was.append(was)
                    n = np.where(was != np.arange(0x10000), chars[was], 0)
                    better = (n > most) & (chars[:0x10000] <= USED * n)
                    self.chain[better], most = len(self.was), np.where(better, n, most)
        self.own[:0x10000] = np.maximum(self.own[:0x10000] - USED * most, 0)

    def scores(self, points: np.ndarray, before: np.ndarray) -> np.ndarray:
        fold, kind = _fold(), _kind()
        f, fb = fold[points], fold[before]
        pair = self.cells[_cells(f, fb)]
        some = np.flatnonzero((points > 127) & (points < 0x3000))
        some = some[self.slot[points[some]] > 0]
        if len(some):
            cells = self.cells[_cells(fold[self.other[self.slot[points[some]]]], fb[some][:, None])]
            pair[some] -= USED * cells.max(1)
        some = np.flatnonzero((points > 0x1FFF) & (points < 0x10000))
        chain = self.chain[points[some]]
        for k in np.unique(chain[chain > 0]):
            one = some[chain == k]
            was, prev = self.was[k - 1], np.minimum(before[one], 0xFFFF)
            pair[one] -= USED * self.cells[_cells(was[points[one]], fold[was[prev]])]
        # A hashed cell may hold other pairs too; what chance puts into a cell is taken off.
        pair = np.clip(pair - self.total / CELLS * 0.02, 0, self.folded[f])
        own = (self.own[points] + 0.05) / (self.total + 5000)
        # The more often the predecessor was seen, the less a pair that was not seen with it is worth.
        back = BACK_OFF / (self.folded[fb] + BACK_OFF)
        return np.log((1 - back) * pair / (self.folded[fb] + 4.0) + back * own) + self.case[3 * kind[before] + kind[points]]


@lru_cache(maxsize=1)
def _plain() -> np.ndarray:
    """Characters that are odd but readable: other widths, compatibility forms, spaces, invisible characters, marks."""
    out = np.zeros(SIZE, dtype=bool)
    for i in range(0xA0, 0x30000):
        c = chr(i)
        kind = unicodedata.category(c)
        if kind in ("Zs", "Cf", "Mn"):
            out[i] = True
        elif i > 0x2000 and kind[0] in "LNSP":
            form = unicodedata.normalize("NFKC", c)
            out[i] = form != c and len(form) <= 3
    # What code pages have beside their letters is no variant, but for spaces and ligatures.
    for w in SINGLE:
        for c in _high(w):
            if unicodedata.category(c) not in ("Zs", "Cf") and not "ﬀ" <= c <= "ﬆ":
                out[ord(c)] = False
    return out


@lru_cache(maxsize=1)
def _script() -> np.ndarray:
    """Latin 1, Greek 2, Cyrillic 3, anything else and letters that look like Latin ones 0."""
    out = np.zeros(SIZE, dtype=np.int8)
    for lo, hi, n in ((0x41, 0x5B, 1), (0x61, 0x7B, 1), (0xC0, 0x250, 1), (0x370, 0x400, 2), (0x400, 0x530, 3)):
        out[lo:hi] = n
    for c in "".join(LOOK_ALIKES.values()):
        out[ord(c)] = 0
    return out


@lru_cache(maxsize=1)
def _floor() -> np.ndarray:
    """What a character costs at most where it stands: readable variants little, an ideograph or another sign much."""
    out = np.full(SIZE, -14.0, dtype=np.float32)
    for i in range(0x20, 0x30000):
        kind = unicodedata.category(chr(i))
        if kind[0] == "L" and i >= 0x2E80:
            out[i] = -4.5 if 0x3041 <= i <= 0x30FE else -8.5
        elif kind[0] in "NP":
            out[i] = -8.0 if i < 0x80 or 0x2E80 <= i < 0xFF00 else -11.0
        elif i < 0x2E80:
            out[i] = -18.0
    out[0xA1:0xC0] = -13.0  # signs that texts of any language have now and then
    out[[0xAA, 0xB5, 0xBA]] = -18.0
    out[[0xD7, 0xF7]] = -13.0
    out[_plain()] = -4.5
    out[_lost()] = -18.0
    for c in "“”‘’„–—…•€¡¿«»":
        out[ord(c)] = -9.0
    return out


@lru_cache(maxsize=1)
def _lost() -> np.ndarray:
    """Characters that stand for bytes without meaning: replacement, private use, controls."""
    out = np.zeros(SIZE, dtype=bool)
    out[0x80:0xA0] = True
    out[0x85] = False
    out[0xE000:0xF900] = True
    out[0xFFFD] = True
    return out


# ---- chains ----------------------------------------------------------------------------------------------------------


def _decoded(raw: bytes, codec: str) -> tuple[str, int]:
    """The text of some bytes, and how many bytes gave none."""
    s = raw.decode(codec, "replace")
    if "�" not in s:
        return s, 0
    try:  # the character of replacement may stand in the bytes themselves
        return raw.decode(codec), 0
    except UnicodeDecodeError:
        return s.replace("�", ""), s.count("�")


def _encoded(s: str, codec: str) -> bytes | None:
    try:
        return s.replace("�", "").encode(codec)
    except UnicodeEncodeError:
        return None


_FOREIGN_WORD = re.compile(r"[^\W\d_]+")


class _Text:
    """A text with the cost of its characters as they stand, so that any span is scored by a difference."""

    def __init__(self, text: str, low: list[int], score: np.ndarray, letter: np.ndarray, lost: np.ndarray | None) -> None:
        self.text, self.low = text, low
        cost = self._settled(score, letter)
        self.lost = float((LOST - cost[lost]).sum()) if lost is not None else 0.0
        self.cost = np.concatenate([[0.0], np.cumsum(cost)]).tolist()
        self._runs: dict[re.Pattern, list[tuple[int, int, str]]] = {}
        self._words: str | None = None
        self._letters: set[str] | None = None
        self.chars = set(text)
        odd = self.chars & _code_page_letters()
        #: The bytes of the text's characters in each single-byte codec that has any of them.
        self.own = {w: [high[c] for c in odd if c in high] for w in SINGLE for high in (_high(w),)}
        #: What pieces are scored so far: how many bytes each loses, its characters with those beside it, and their scores.
        self.pieces: dict[tuple[int, int, str], int] = {}
        self.sizes: list[int] = []
        self.scores = np.empty(0, dtype=np.float32)

    def _settled(self, score: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The cheapest reading: words of the corpus's languages, or stretches of words that just are letters of an alphabet."""
        text, low = self.text, self.low
        if not low[-1]:
            return score
        words = [m.span() for m in _FOREIGN_WORD.finditer(text)]
        words = [(a, z) for a, z in words if text[a] < "⺀"]
        if not any(low[z] != low[a] for a, z in words):
            return score
        own, free = (np.concatenate([[0.0], np.cumsum(x)]).tolist() for x in (score, letter))
        # Two states by word: at home, or abroad since some word; costs are log likelihoods.
        home, abroad, came = 0.0, -1e9, []
        for a, z in words:
            in_home, in_abroad, enter = own[z] - own[a], free[z] - free[a], home + FOREIGN > abroad
            away = max(abroad, home + FOREIGN) + in_abroad
            back = home >= abroad
            home, abroad = max(home, abroad) + in_home, away
            came.append((enter, back))
        out, state = score, int(abroad > home)
        for (a, z), (enter, back) in zip(reversed(words), reversed(came), strict=True):
            if state:
                out = out if out is not score else score.copy()
                whole = free[z] - free[a] + (FOREIGN if enter else 0.0)
                odd = np.flatnonzero(score[a:z] < UNLIKELY) + a
                if len(odd):  # what is unlikely bears what the word costs more, so that undoing it gains that
                    out[odd] = (whole - (own[z] - own[a] - float(score[odd].sum()))) / len(odd)
                else:
                    out[a:z] = whole / (z - a)
                state = int(not enter)
            elif not back:
                state = 1
        return out

    def runs(self, pattern: re.Pattern) -> list[tuple[int, int, str]]:
        """The runs of a pattern that hold something unlikely; chains of one kind share them."""
        if pattern not in self._runs:
            low, spans = self.low, (m.span() for m in pattern.finditer(self.text))
            self._runs[pattern] = [(a, z, self.text[a:z]) for a, z in spans if low[z] != low[a]] if low[-1] else []
        return self._runs[pattern]

    def words(self) -> str:
        """The words that hold something unlikely, one a line."""
        if self._words is None:
            self._words = "\n".join([run for _, _, run in self.runs(_WORD)])
        return self._words

    def letters(self) -> set[str]:
        """The characters of those words."""
        if self._letters is None:
            self._letters = set(self.words())
        return self._letters


def _texts(texts: list[str], model: CharModel) -> list[_Text]:
    """Texts with the costs of their characters, which are scored all at once."""
    p, at = flat(texts)
    starts = at[:-1][at[:-1] < len(p)]
    before = _before(p, starts)
    score = model.scores(p, before)
    low = np.concatenate([[0], np.cumsum((p > 127) & (score < UNLIKELY) & ~_plain()[p])])
    lost, like = _lost()[p], _alike()[p]
    other = like != p
    # Only a look-alike and what follows it can score better by the form that it looks like.
    near = np.flatnonzero(other | np.concatenate([[False], other[:-1]]))
    score = score.astype(np.float64)
    score[near] = np.maximum(score[near], model.scores(like[near], _before(like, starts)[near]) + ALIKE * other[near])
    script, east = _script()[p], _ideograph()[p] > 0
    switch = np.concatenate([[False], (script[1:] != script[:-1]) & (script[1:] > 0) & (script[:-1] > 0)])
    # An ideograph of a language that the corpus hardly has stands among others.
    left, right = np.concatenate([[False], east[:-1]]), np.concatenate([east[1:], [False]])
    switch[starts], left[starts], right[starts[1:] - 1] = False, False, False
    score = np.maximum(score, np.where(switch | (east & ~left & ~right), SWITCH, _floor()[p]))
    kind = _kind()
    letter = LETTER + model.case[3 * kind[before] + kind[p]] + np.where(switch, SWITCH, 0.0)
    some_lost, some_other = (np.diff(np.concatenate([[0], np.cumsum(x)])[at]) > 0 for x in (lost, other))
    out = []
    for text, a, z, is_lost, is_other in zip(texts, at[:-1].tolist(), at[1:].tolist(), some_lost.tolist(), some_other.tolist(), strict=True):
        own = score[a:z] if is_other else score[a:z].astype(np.float32)
        out.append(_Text(text, (low[a : z + 1] - low[a]).tolist(), own, letter[a:z], lost[a:z] if is_lost else None))
    return out


#: A piece of a text that a chain would change: its span, what it becomes, and how many bytes give nothing.
_Piece = tuple[int, int, str, int]


def _utf8_chains(t: _Text, only: str | None = None) -> Iterator[tuple[str, list[_Piece]]]:
    """(chain, pieces) for every chain, or one, whose bytes must be valid UTF-8."""
    for w in SINGLE:
        own = t.own[w]
        if own and max(own) >= 0xC2 and min(own) < 0xC0:
            if only in (None, f"utf-8>{w}"):
                yield f"utf-8>{w}", _changed(t, _utf8_in(w), lambda s, k=_table(w): _decoded(s.translate(k).encode("latin-1"), "utf-8"))
            if w in ("cp1252", "mac_roman") and only in (None, f"utf-8>{w} twice"):
                yield f"utf-8>{w} twice", _changed(t, _utf8_in(w), lambda s, w=w: _twice(s, w))


def _other_chains(t: _Text, only: str | None = None) -> Iterator[tuple[str, list[_Piece]]]:
    """(chain, pieces) for every other chain, or one, that would change the text."""
    for w in ("cp1252", "mac_roman", "cp1251", "cp850", "koi8_r"):
        if len(t.own[w]) > 1:
            raw = {run: run.translate(_table(w)).encode("latin-1", "ignore") for _, _, run in t.runs(_wide_in(w))}
            for to in WIDE if raw else ():
                if only in (None, f"{to}>{w}"):
                    yield f"{to}>{w}", _changed(t, _wide_in(w), lambda s, raw=raw, c=to: _widened(raw[s], len(s), c))
    for w in WIDE if max(t.chars) > "\u2e7f" else ():
        raw = {run: _encoded(run, w) for _, _, run in t.runs(_CHUNK)}
        for to in ("utf-8", *WIDE) if any(raw.values()) else ():
            if to != w and only in (None, f"{to}>{w}"):
                yield f"{to}>{w}", _changed(t, _CHUNK, lambda s, raw=raw, c=to: _wide(raw[s], c))
    for w, tos in _LETTERWISE.items():
        if t.own[w]:
            for to in tos:
                if only in (None, f"{to}>{w}"):
                    yield f"{to}>{w}", _letterwise(t, to, w)


def _changed(t: _Text, runs: re.Pattern, undo) -> list[_Piece]:  # noqa: ANN001
    """The chain undone in every run that holds something unlikely."""
    out = []
    for a, z, run in t.runs(runs):
        x = undo(run)
        if x is not None and x[0] and x[0] != run:
            out.append((a, z, x[0], x[1]))
    return out


@lru_cache(maxsize=64)
def _letter_table(t: str, w: str) -> dict[int, str]:
    """For str.translate: a character of w to the character that its byte is in t."""
    out = {}
    for c, b in _high(w).items():
        try:
            out[ord(c)] = bytes([b]).decode(t)
        except UnicodeDecodeError:
            out[ord(c)] = "�"
    return out


@lru_cache(maxsize=64)
def _turned(t: str, w: str) -> frozenset[str]:
    """The characters of w that are others in t."""
    return frozenset(chr(x) for x, y in _letter_table(t, w).items() if chr(x) != y)


def _letterwise(t: _Text, to: str, w: str) -> list[_Piece]:
    """Each run with the bytes of its letters read in the other codec; all runs are translated at once."""
    runs = t.runs(_WORD)
    if not runs or t.letters().isdisjoint(_turned(to, w)):
        return []
    made = t.words().translate(_letter_table(to, w)).split("\n")
    cyrillic = to in ("cp1251", "koi8_r", "cp866")
    pieces = zip(runs, made, strict=True)
    return [(a, z, s, 0) for (a, z, run), s in pieces if s != run and "�" not in s and not (cyrillic and not _CYRILLIC.fullmatch(s))]


def _twice(s: str, w: str) -> tuple[str, int] | None:
    once = s.translate(_table(w)).encode("latin-1").decode("utf-8", "ignore")
    again = lambda m: m.group().translate(_table(w)).encode("latin-1").decode("utf-8", "ignore")
    twice = _utf8_in(w).sub(again, once)
    return (twice, 0) if twice != once else None


_TWO_WIDE = re.compile("[⺀-￯]{2}")


def _widened(raw: bytes, size: int, t: str) -> tuple[str, int] | None:
    """Double-byte text read as single bytes; one ideograph alone among other letters is chance."""
    out = _decoded(raw, t)
    return out if out[1] * 6 <= size and _TWO_WIDE.search(out[0]) else None


def _wide(raw: bytes | None, t: str) -> tuple[str, int] | None:
    if not raw:
        return None
    out, lost = _decoded(raw, t)
    return (out, lost) if lost * 8 <= len(raw) + 8 else None


def _gains(asked: list[tuple[_Text, list[tuple[str, list[_Piece]]]]], model: CharModel) -> list[dict[tuple[int, int, str], float]]:
    """The gain of every piece of each text's chains and of those asked for before, each scored once where it stands: after the
    character before it, and with the one that follows. The pieces of all texts are scored at once."""
    followed, firsts, begun = [], [], []
    for t, chains in asked:
        text, known = t.text, len(t.pieces)
        t.pieces.update([((a, z, s), n) for _, pieces in chains for a, z, s, n in pieces])
        new = [*islice(t.pieces, known, None)]
        parts = [f"{s}{text[z : z + 1]}\n" for _, z, s in new]
        followed += parts
        firsts += [ord(text[a - 1]) if a else 10 for a, _, _ in new]
        begun.append(len(t.sizes))
        t.sizes += map(len, parts)
    p = np.frombuffer("".join(followed).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    before = np.concatenate([[np.uint32(10)], p[:-1]])
    before[np.cumsum([0, *map(len, followed)])[:-1]] = firsts
    scores = model.scores(p, before)
    out, at = [], 0
    for (t, _), k in zip(asked, begun, strict=True):
        size = sum(t.sizes[k:])
        t.scores = np.concatenate([t.scores, scores[at : at + size]])
        at += size
        cost, last = t.cost, len(t.text)
        ends = np.cumsum(t.sizes)
        starts = ends - t.sizes
        score = np.concatenate([[0.0], np.cumsum(t.scores)])
        score = (score[ends - 1] - score[starts]).tolist()
        out.append({k: x - 7.0 * n - (cost[min(k[1] + 1, last)] - cost[k[0]]) for (k, n), x in zip(t.pieces.items(), score, strict=True)})
    return out


def _best(pieces: list[_Piece], gains: dict[tuple[int, int, str], float]) -> tuple[float, list[_Piece]]:
    """The gain of a chain in every run that gains by it, or else in the run that loses least."""
    better = [gains[a, z, s] for a, z, s, _ in pieces]
    least, kept = max(better), []
    for piece, b in zip(pieces, better, strict=True):
        if (b > 0 or b == least) and (not kept or piece[0] >= kept[-1][0][1]):
            kept.append((piece, b))
    return sum(b for _, b in kept), [piece for piece, _ in kept]


def _replaced(text: str, pieces: list[_Piece]) -> str:
    at, out = 0, []
    for a, z, s, _ in pieces:
        out += [text[at:a], s]
        at = z
    return "".join(out) + text[at:]


class _Search:
    """How far a text's chains are undone."""

    def __init__(self, now: _Text) -> None:
        self.now, self.prefix, self.total = now, "", 0.0
        self.found = [(now.lost, "lost")] if now.lost else []
        self.chains: list[tuple[str, list[_Piece]]] = []

    def explained(self, gains: dict[tuple[int, int, str], float]) -> bool:
        """Whether bytes of valid UTF-8 explain everything, so that no other chain comes near."""
        top, pieces = max((_best(x, gains) for _, x in self.chains), key=lambda b: b[0])
        low = self.now.low
        return top > CERTAIN and sum(low[z] - low[a] for a, z, _, _ in pieces) == low[-1]

    def step(self, gains: dict[tuple[int, int, str], float]) -> str | None:
        """Notes what the chains gain; the text by the best of them, if undoing goes on from there."""
        cost = COMPOSED if self.prefix else 0.0
        best = [_best(pieces, gains) for _, pieces in self.chains]
        step = [(self.total + cost + b[0], self.prefix + c) for (c, _), b in zip(self.chains, best, strict=True)]
        k = max(range(len(step)), key=step.__getitem__)
        top = step[k]
        if self.prefix and top[0] <= self.total:
            return None
        self.found += [x for x in step if not self.prefix or x[0] > self.total]
        if top[0] <= self.total:
            return None
        self.total, self.prefix = top[0], f"{top[1]}+"
        return _replaced(self.now.text, best[k][1])


def evidence(texts: list[str], model: CharModel) -> list[tuple[list[tuple[float, str]], str]]:
    """For each text (gain, chain) of every chain that would change it, and the text by the best of them.

    Chains one after the other: whatever is left unlikely after the best chain is undone again, for as long as that gains; every
    such composition is a chain too. Each step must make the text as it stands likelier, so no text comes twice and the steps end.
    All texts take each step together, as scoring few characters at a time costs far more than many.
    """
    every = active = [_Search(t) for t in _texts(texts, model)]
    while active:
        for s in active:
            s.chains = [x for x in _utf8_chains(s.now) if x[1]]
        some = [s for s in active if s.chains]
        gains = _gains([(s.now, s.chains) for s in some], model)
        done = {id(s) for s, g in zip(some, gains, strict=True) if s.explained(g)}
        more = [[] if id(s) in done else [x for x in _other_chains(s.now) if x[1]] for s in active]
        for s, chains in zip(active, more, strict=True):
            s.chains += chains
        some = [(s, chains) for s, chains in zip(active, more, strict=True) if s.chains]
        gains = _gains([(s.now, chains) for s, chains in some], model)
        after = [(s, text) for (s, _), g in zip(some, gains, strict=True) if (text := s.step(g)) is not None]
        likelier = [(s, t) for (s, _), t in zip(after, _texts([text for _, text in after], model), strict=True) if t.cost[-1] > s.now.cost[-1]]
        for s, t in likelier:
            s.now = t
        active = [s for s, t in likelier if t.low[-1]]
    return [(s.found, s.now.text) for s in every]


def restored(text: str, model: CharModel) -> tuple[str, float, str]:
    """(chain, gain, restored text) by a text's own evidence only; ('', 0, text) where no chain gains."""
    found, best = evidence([text], model)[0]
    gain, chain = max(found, default=(0.0, ""))
    return (chain, gain, best) if gain > 0 else ("", 0.0, text)


def undone(text: str, chain: str, model: CharModel) -> str:
    """The text with the chains undone one after the other."""
    for name in chain.split("+"):
        t = _texts([text], model)[0]
        chains = [(c, pieces) for c, pieces in (*_utf8_chains(t, name), *_other_chains(t, name)) if pieces]
        if chains:
            text = _replaced(text, _best(chains[0][1], _gains([(t, chains)], model)[0])[1])
    return text


def _evidence_batches(model: Broadcast, fields: list[str]):
    """(id, source, field, text, best chain by its own evidence, text by it, chains, bins) of fields with any evidence; a row without id counts a task's other fields."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: CharModel = model.value
        clean: dict[tuple, int] = {}
        for b in batches:
            ids, sources = b.column(0).to_pylist(), b.column(1).to_pylist()
            out: list[tuple] = []
            for f, col in zip(fields, b.columns[2:], strict=True):
                texts = col.to_pylist()
                for i in range(len(texts)):
                    if texts[i]:
                        key = (sources[i], f)
                        clean[key] = clean.get(key, 0) + 1
                for i, (found, better) in _suspected(texts, m):
                    found, best = sorted((c, g) for g, c in found), max(found, default=(0.0, ""))
                    if found:
                        clean[(sources[i], f)] -= 1
                        # Beyond the top only the differences between the chains matter.
                        above = max(0.0, max(g for _, g in found) - TOP * BIN)
                        bins = [int(max(BOTTOM, min(TOP, (g - above) // BIN))) for _, g in found]
                        out.append((ids[i], sources[i], f, texts[i], best[1], better if best[0] > 0 else None, [c for c, _ in found], bins, 1))
            yield _batch(out)
        yield _batch([(None, s, f, None, None, None, [], [], n) for (s, f), n in clean.items() if n])

    return run


def _suspected(texts: list[str | None], m: CharModel) -> Iterator[tuple[int, tuple[list[tuple[float, str]], str]]]:
    """The rows that may gain by a chain with their evidence, taken together up to a number of characters; a longer text is alone."""
    group, size = [], 0
    for i in _suspects(texts, m):
        if group and size + len(texts[i]) > TOGETHER:
            yield from zip(group, evidence([texts[k] for k in group], m), strict=True)
            group, size = [], 0
        group.append(i)
        size += len(texts[i])
    yield from zip(group, evidence([texts[k] for k in group], m), strict=True)


_EVIDENCE = "id long, source string, field string, text string, best string, better string, chains array<string>, bins array<int>, n long"
_TYPES = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int64())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["id", "source", "field", "text", "best", "better", "chains", "bins", "n"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_TYPES)], names=names)


def _repair_batches(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: CharModel = model.value
        for b in batches:
            names = ("text", "chain", "best", "better")
            rows = zip(*(b.column(b.schema.get_field_index(n)).to_pylist() for n in names), strict=True)
            # By its own evidence most records went through the chain that the posterior says, too.
            out = [t if c == "lost" else better if c == best and better is not None else undone(t, c, m) for t, c, best, better in rows]
            yield b.set_column(b.schema.get_field_index("text"), "text", pa.array(out, pa.string()))

    return run


@lru_cache(maxsize=1)
def _odd_table() -> np.ndarray:
    """Characters below the East Asian scripts, of private use, or of half width: one that is unlikely in its place is enough."""
    out = np.zeros(SIZE, dtype=bool)
    out[0x80:0x2E80] = True
    out[0xE000:0xF900] = True
    out[0xFFF0:0x10000] = True
    out[_plain()] = False
    return out


def _suspects(texts: list[str | None], m: CharModel, window: int = 4, low: float = -7.5) -> list[int]:
    """Rows that may gain by a chain: with an odd character, or an ideograph among Latin letters, that is unlikely where it stands, or
    with a window of unlikely characters."""
    points, offsets = flat(texts)
    if not len(points):
        return []
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(texts)), sizes)
    score = np.full(len(points), -3.0, dtype=np.float32)
    asked = np.flatnonzero((points > 127) & ~_plain()[points])
    score[asked] = m.scores(points[asked], _before(points, offsets[:-1])[asked])
    few = np.repeat(_few_ideographs(points, offsets), sizes) & (_ideograph()[points] > 0)
    hit = (_odd_table()[points] | few) & (score < UNLIKELY)
    sums = np.cumsum(score)
    if len(points) > window:
        hit[window:] |= ((sums[window:] - sums[:-window]) < low * window) & (row[window:] == row[:-window])
    # Short texts: two unlikely characters after each other are enough.
    hit[1:] |= (score[1:] + score[:-1] < -21) & (row[1:] == row[:-1])
    return np.unique(row[hit]).tolist()


# ---- EM --------------------------------------------------------------------------------------------------------------


def _posteriors(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """Rows with the odds of each of their chains against no chain, by their evidence and the shares of their (source, field)."""
    s = shares.withColumnsRenamed({"source": "s", "field": "f"})
    joined = rows.join(s, F.col("source").eqNullSafe(F.col("s")) & (F.col("field") == F.col("f")), "left").drop("s", "f")
    share = lambda c: F.coalesce(F.element_at("share", c), F.col("unseen"))
    odds = F.zip_with("chains", "bins", lambda c, b: share(c) * F.exp((b + 0.5) * BIN) / F.col("clean_share"))
    joined = joined.withColumn("odds", odds).withColumn("all_odds", F.aggregate("odds", F.lit(0.0), lambda a, x: a + x))
    return joined.withColumn("posterior", F.col("all_odds") / (1 + F.col("all_odds")))


def _shares(expected: DataFrame, totals: DataFrame) -> DataFrame:
    """One row for each (source, field): its chains' shares, that of no chain, and that of a chain without any record."""
    by = expected.groupBy("source", "field").agg(F.map_from_entries(F.collect_list(F.struct("chain", "mass"))).alias("mass"), F.sum("mass").alias("garbled"), F.count(F.lit(1)).alias("k"))
    t = totals.withColumnsRenamed({"source": "s", "field": "f"})
    joined = t.join(by, F.col("source").eqNullSafe(F.col("s")) & (F.col("field") == F.col("f")), "left")
    prior, size = F.lit(PRIOR_ROWS * PRIOR_SHARE) / F.greatest("k", F.lit(1)), F.col("total") + PRIOR_ROWS
    share = F.transform_values("mass", lambda _, v: (v + prior) / size)
    clean = (size - PRIOR_ROWS * PRIOR_SHARE - F.coalesce("garbled", F.lit(0.0))) / size
    return joined.select(F.col("s").alias("source"), F.col("f").alias("field"), share.alias("share"), (prior / size).alias("unseen"), clean.alias("clean_share"))


def chain_shares(found: DataFrame) -> DataFrame:
    """EM over the records' evidence: (source, field, share of each chain, unseen, clean_share)."""
    histogram = written(found.where("id IS NOT NULL").groupBy("source", "field", "chains", "bins").agg(F.sum("n").cast("double").alias("n")), "encoding-histogram")
    totals = written(found.groupBy("source", "field").agg(F.sum("n").cast("double").alias("total")), "encoding-totals")
    # The start: every chain that any record has evidence for has the same small mass.
    start = histogram.select("source", "field", F.explode("chains").alias("chain")).distinct().withColumn("mass", F.lit(0.0))
    shares = written(_shares(start, totals), "encoding-shares")
    for _ in range(EM_ROUNDS):
        weighed = _posteriors(histogram, shares).select("source", "field", F.explode(F.arrays_zip("chains", "odds")).alias("c"), "n", "all_odds")
        mass = weighed.groupBy("source", "field", F.col("c.chains").alias("chain")).agg(F.sum(F.col("n") * F.col("c.odds") / (1 + F.col("all_odds"))).alias("mass"))
        shares = written(_shares(mass, totals), "encoding-shares")
    return shares


def char_model(rows: DataFrame, fields: list[str]) -> CharModel:
    """The model from all rows; what comes to the driver is bounded by Unicode and CELLS."""
    texts = rows.select(*(F.col(f"`{f}`") for f in fields))
    counts = texts.mapInArrow(_count_batches, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    return CharModel(counts.column(0).to_numpy(), counts.column(1).to_numpy())


def garbled_fields(rows: DataFrame, row_id: str, source: str, fields: list[str]) -> DataFrame:
    """(row_id, source, field, chain, posterior, repaired) of every field that is garbled with posterior over one half."""
    spark = rows.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(char_model(rows, fields))
    named = rows.select(F.col(f"`{row_id}`").cast("long").alias("id"), F.col(f"`{source}`").cast("string").alias("source"), *(F.col(f"`{f}`").alias(f"f{i}") for i, f in enumerate(fields)))
    found = written(named.mapInArrow(_evidence_batches(model, fields), _EVIDENCE), "encoding-evidence")
    scored = _posteriors(found.where("id IS NOT NULL"), chain_shares(found)).where("posterior > 0.5")
    chain = F.element_at("chains", F.array_position("odds", F.array_max("odds")).cast("int"))
    likely = scored.select(F.col("id").alias(row_id), "source", "field", chain.alias("chain"), "posterior", "text", "best", "better")
    return likely.mapInArrow(_repair_batches(model), likely.schema).withColumnRenamed("text", "repaired").drop("best", "better")

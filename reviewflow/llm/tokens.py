"""Encoding of a corpus with a public byte-level BPE vocabulary, and decoding.

Method: a bounded-lookahead streaming transducer. Text is cut into pieces by the vocabulary's splitting pattern while it streams in;
each piece's bytes run through a transducer that keeps, for the last ``lookahead`` positions only, the last token of the
encoding of the prefix that ends there. A token is emitted as soon as the prefixes of all positions in that window agree on
it, for no byte to come can change it then. The sufficient lookahead is computed from the merge list: a token can't be longer
than the longest merge result, so every later prefix is built on a prefix in the window. What is kept is the window and the stretch
before it on which its prefixes don't agree yet; it doesn't grow with the piece, unless a vocabulary leaves a piece undecided to its end.
The tokens that end at a position come from an automaton over the merge results, longest first.
Decoding is an incremental byte-to-text state machine.

Defined results
* null and empty texts give an empty list; special tokens' strings are ordinary text; no special tokens are added.
* lone surrogates, which no UTF-8 text can hold, are read as U+FFFD.
* an empty table gives no rows; whole texts are read; other columns are not read.
"""

from __future__ import annotations

import codecs
import json
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.storage import ship_package

#: Where the public vocabulary lies; a parameter of every operator here.
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: The splitting pattern that belongs to this family of vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces whose ids a worker remembers at most.
REMEMBERED = 300_000


def byte_alphabet() -> dict[str, int]:
    """The printable characters by which these files write bytes: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens by bytes, and for each merged token the pair it is made of."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = byte_alphabet()
        raw = {t: bytes(alphabet[c] for c in t) for t in model["vocab"] if all(c in alphabet for c in t)}
        self.ids = {raw[t]: i for t, i in model["vocab"].items() if t in raw}
        self.bytes = {i: b for b, i in self.ids.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.pair: dict[int, tuple[int, int]] = {}
        self.order = dict.fromkeys((self.ids[bytes([b])] for b in range(256)), -1)
        merged = {-1}
        for n, m in enumerate(model["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            a, b, c = model["vocab"][left], model["vocab"][right], self.ids[raw[left] + raw[right]]
            self.rank[a, b] = n
            if c not in self.pair:
                self.pair[c], self.order[c] = (a, b), n
                merged.add(c)
        self.whole = {b: i for b, i in self.ids.items() if i in merged or len(b) == 1}
        #: The sufficient lookahead: the longest token in bytes.
        self.lookahead = max(map(len, self.whole))
        # All tokens that end at a position, longest first; bytes stand as the characters of their numbers.
        self.ends = ahocorasick.Automaton()
        for b, i in self.whole.items():
            self.ends.add_word(b.decode("latin-1"), (i, len(b)))
        self.ends.make_automaton()
        self._fits: dict[int, bool] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether two tokens side by side are what their joined bytes are encoded to.

        The merges inside both tokens are undone from the latest to the earliest; at every moment the two tokens that touch
        must not have had an earlier merge of their own than the merge that is undone next.
        """
        known = self._fits.get(a << 32 | b)
        if known is None:
            known = self._fits[a << 32 | b] = self._touch(a, b)
        return known

    def encoded(self, raw: bytes) -> tuple[int, ...]:
        """The ids of a piece that is no longer than the window, at once."""
        known, fits, done = self._fits, self.fits, -1
        token, size = [0] * (len(raw) + 1), [0] * (len(raw) + 1)
        for end, (t, n) in self.ends.iter(raw.decode("latin-1")):
            if end == done:
                continue
            at = end + 1 - n
            if at:
                before = token[at]
                ok = known.get(before << 32 | t)
                if ok is None:
                    ok = fits(before, t)
                if not ok:
                    continue
            done = end
            token[end + 1], size[end + 1] = t, n
        out, at = [], len(raw)
        while at:
            out.append(token[at])
            at -= size[at]
        return tuple(reversed(out))

    def _touch(self, a: int, b: int) -> bool:
        order, pair, rank = self.order, self.pair, self.rank
        limit = 1 << 60
        while True:
            n = rank.get((a, b))
            if n is not None and n < limit:
                return False
            oa, ob = order[a], order[b]
            if oa < 0 and ob < 0:
                return True
            # Later merges are undone first. Of equal ones the left happened first, so a tie on the right side counts as later.
            if oa > ob:
                limit, a = oa, pair[a][1]
            else:
                limit, b = ob + 1, pair[b][0]


class Transducer:
    """Encodes one piece, byte by byte, with a window."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.reset()

    def reset(self) -> None:
        self.found = self.v.ends.iter("")
        self.last: deque[tuple[int, int]] = deque()  # (token, its length) that ends at each position of the window
        self.before = -1  # the last token that is out
        self.done = 0  # position up to which tokens are out
        self.at = 0

    def feed(self, data: Iterable[int]) -> Iterator[int]:
        """Ids that are stable after some more bytes; a few thousand bytes at a time are given to the automaton."""
        v, data = self.v, bytes(data)
        step = v.lookahead
        for lo in range(0, len(data), step):
            part = data[lo : lo + step]
            base, fixed = self.at, self.at
            self.found.set(part.decode("latin-1"))
            for end, (token, n) in self.found:
                # The automaton counts from its first byte; a longer token that ended here was taken already.
                if end < fixed:
                    continue
                at = end + 1 - n
                if at < self.done:
                    continue
                if at:
                    before = self.before if at == self.done else self.last[at - self.done - 1][0]
                    if not v.fits(before, token):
                        continue
                self.last.append((token, n))
                fixed = end + 1
            self.at = base + len(part)
            if len(self.last) > 2 * step:
                yield from self._stable()

    def _path(self, end: int) -> Iterator[tuple[int, int]]:
        """Boundaries and tokens of the encoding of the prefix that ends at a position, backwards to what is out."""
        first = self.at - len(self.last)
        while end > self.done:
            token, n = self.last[end - first - 1]
            yield end, token
            end -= n

    def _stable(self) -> Iterator[int]:
        """Emit what the prefixes of the whole window agree on."""
        low = self.at - self.v.lookahead
        agreed: set[int] | None = None
        for end in range(low + 1, self.at + 1):
            ends = {e for e, _ in self._path(end) if e <= low}
            agreed = ends if agreed is None else agreed & ends
        if agreed:
            yield from self._emit(max(agreed))

    def _emit(self, end: int) -> Iterator[int]:
        tokens = [t for _, t in self._path(end)]
        if tokens:
            self.before = tokens[0]
            yield from reversed(tokens)
        drop = end - (self.at - len(self.last))
        for _ in range(drop):
            self.last.popleft()
        self.done = end

    def finish(self) -> list[int]:
        out = list(self._emit(self.at))
        self.reset()
        return out


class Encoder:
    """Texts to ids; remembers the ids of short pieces up to a fixed number."""

    def __init__(self, path: str = DEFAULT_VOCABULARY) -> None:
        self.v = Vocabulary(path)
        self.transducer = Transducer(self.v)
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, tuple[int, ...]] = {}

    def piece(self, s: str) -> tuple[int, ...]:
        got = self.known.get(s)
        if got is None:
            raw = s.encode("utf-8", "replace") if s.isascii() else s.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode("utf-8")
            whole = self.v.whole.get(raw)
            if whole is not None:
                got = (whole,)
            elif len(raw) <= self.v.lookahead:
                got = self.v.encoded(raw)
            else:
                got = (*self.transducer.feed(raw), *self.transducer.finish())
            if len(s) <= 64:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[s] = got
        return got

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        for m in self.pattern.finditer(text):
            out.extend(self.piece(m.group()))
        return out


class Decoder:
    """Ids to text, incrementally: bytes that don't yet make a character wait."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> Iterator[str]:
        for i in ids:
            if s := self.state.decode(self.v.bytes[i]):
                yield s

    def finish(self) -> str:
        rest = self.state.decode(b"", True)
        self.state.reset()
        return rest


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _id_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            # Long texts: a few thousand rows at a time keep the lists of a batch small.
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                ids = [e.ids(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    return run


def _size_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            n = [len(e.ids(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["id", "n_tokens"])

    return run


def _text_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = Decoder(encoder(path).v)
        for b in batches:
            out = ["".join(d.feed(ids)) + d.finish() if ids is not None else None for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["id", "text"])

    return run


def _named(rows: DataFrame, row_id: str, column: str) -> DataFrame:
    ship_package(rows.sparkSession)
    return rows.select(F.col(f"`{row_id}`").cast("long").alias("id"), F.col(f"`{column}`").alias("x"))


def token_ids(rows: DataFrame, row_id: str, text: str, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(row_id, ids array<int>) of every row."""
    return _named(rows, row_id, text).mapInArrow(_id_batches(path), "id long, ids array<int>").withColumnRenamed("id", row_id)


def token_counts(rows: DataFrame, row_id: str, text: str, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(row_id, n_tokens) of every row; the ids themselves never leave the worker."""
    return _named(rows, row_id, text).mapInArrow(_size_batches(path), "id long, n_tokens long").withColumnRenamed("id", row_id)


def decoded_texts(rows: DataFrame, row_id: str, ids: str, path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(row_id, text) from ids; null ids give null."""
    return _named(rows, row_id, ids).mapInArrow(_text_batches(path), "id long, text string").withColumnRenamed("id", row_id)

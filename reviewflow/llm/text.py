"""Texts of an Arrow batch as one flat array of code points, and vectorised work on it."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

SIZE = sys.maxunicode + 1


def flat(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts after each other, and the offset of each text (one more than texts). Null is empty."""
    joined = "".join(t for t in texts if t)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) if t else 0 for t in texts], out=offsets[1:])
    return points, offsets


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Skip-and-fold table: the lower-case code point of each letter or digit (Unicode L and N), 0 for what is skipped.

    Lower case of one character may be several; what remains of them after skipping is one letter for every character of
    Unicode, which is asserted. The one rule of lower case that looks at neighbours, the final sigma, is left to callers.
    """
    table = np.zeros(SIZE, dtype=np.uint32)
    for i in range(SIZE):
        if 0xD800 <= i < 0xE000:
            continue
        c = chr(i)
        if unicodedata.category(c)[0] in "LN":
            table[i] = i
        low = c.lower()
        if low != c:
            kept = [x for x in low if unicodedata.category(x)[0] in "LN"]
            assert len(kept) <= 1
            table[i] = ord(kept[0]) if kept else 0
    return table


SIGMA = "Σ"


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of each text as flat code points with offsets: lower case, without anything but letters and digits."""
    # A capital sigma is folded by its neighbours, which a table can't do; such texts are lowered as a whole first.
    texts = [t.lower() if t and SIGMA in t else t for t in texts]
    points, offsets = flat(texts)
    folded = letter_table()[points]
    kept = folded != 0
    ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
    return folded[kept], ends


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of an Arrow text column, read from its UTF-8 bytes, and the offset of each text. Null is empty."""
    wide = pa.types.is_large_string(texts.type)
    _, ends, data = texts.buffers()
    n = len(texts)
    at = np.frombuffer(ends, np.int64 if wide else np.int32, n + 1, texts.offset * (8 if wide else 4)).astype(np.int64) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    lead = raw & 0xC0 != 0x80
    starts = np.flatnonzero(lead)
    b = np.concatenate([raw, np.zeros(3, np.uint8)])
    first = b[starts].astype(np.uint32)
    more = [(b[starts + k] & 0x3F).astype(np.uint32) for k in (1, 2, 3)]
    points = np.where(
        first < 0x80, first,
        np.where(first < 0xE0, (first & 0x1F) << 6 | more[0],
                 np.where(first < 0xF0, (first & 0x0F) << 12 | more[0] << 6 | more[1], (first & 0x07) << 18 | more[0] << 12 | more[1] << 6 | more[2])),
    ).astype(np.uint32)
    return points, np.concatenate([[0], np.cumsum(lead)])[at]


def folded_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What the skip-and-fold table says of each code point of the texts, 0 for what is skipped, and the texts' offsets."""
    points, offsets = code_points(texts)
    folded = letter_table()[points]
    # A capital sigma folds by its neighbours; only the texts that have one are looked at as texts.
    places = np.flatnonzero(points == ord(SIGMA))
    for place, row in zip(places.tolist(), (np.searchsorted(offsets, places, side="right") - 1).tolist(), strict=True):
        t, i = texts[row].as_py(), place - int(offsets[row])
        folded[place] = ord(t.lower()[len(t[:i].lower())])
    return folded, offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function, wrapping around."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))

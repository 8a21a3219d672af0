"""CSV as spreadsheets read it: encodings tried in order, quoting with embedded line breaks, empty lines kept, all cells text."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

ENCODINGS = ("utf-8-sig", "utf-16", "gb18030")


class CsvDecodeError(ValueError):
    """None of the encodings fits."""


def decoded(raw: bytes) -> tuple[str, str]:
    """(text, encoding). UTF-16 is tried only where a byte order mark says so."""
    marked = raw[:2] in (b"\xff\xfe", b"\xfe\xff")
    for e in ENCODINGS:
        if e == "utf-16" and not marked:
            continue
        try:
            return raw.decode(e), e
        except UnicodeDecodeError:
            continue
    raise CsvDecodeError(f"CSV 解码失败，已尝试编码: {', '.join(ENCODINGS)}")


def rows(raw: bytes) -> Iterator[list[str]]:
    text, _ = decoded(raw)
    yield from csv.reader(io.StringIO(text, newline=""))

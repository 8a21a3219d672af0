"""Reading and writing of .xlsx with the standard library only: ZIP and XML, row by row."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta
from pathlib import Path
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: Built-in number formats that show dates or times.
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}
_DAY_ZERO = datetime(1899, 12, 30)


def _texts(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    for _, e in ET.iterparse(z.open("xl/sharedStrings.xml")):
        if e.tag == f"{_M}si":
            # Phonetic readings are no part of the text.
            out.append("".join(t.text or "" for t in e.iter(f"{_M}t")) if e.find(f"{_M}rPh") is None else "".join(t.text or "" for r in (e, *e.findall(f"{_M}r")) for t in r.findall(f"{_M}t")))
            e.clear()
    return out


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.parse(z.open("xl/styles.xml")).getroot()
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{_M}numFmt")}
    plain = lambda code: re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code).lower()
    dates = _DATE_FORMATS | {i for i, code in own.items() if re.search("[ymdhs]", plain(code))}
    xfs = root.find(f"{_M}cellXfs")
    return {i for i, x in enumerate(xfs if xfs is not None else ()) if int(x.get("numFmtId", 0)) in dates}


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def _cell(c: ET.Element, shared: list[str], date_styles: set[int], formulas: bool) -> tuple[str | None, str | None]:
    """(text as Python writes it, one-letter type): s text, n number, b boolean, d date, f formula, e error."""
    kind, f, v = c.get("t", "n"), c.find(f"{_M}f"), c.find(f"{_M}v")
    if f is not None and formulas:
        return "=" + (f.text or ""), "f"
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(f"{_M}t")), "s"
    if v is None or v.text is None:
        return None, None
    if kind == "s":
        return shared[int(v.text)], "s"
    if kind == "str":
        return v.text, "s"
    if kind == "b":
        return ("True" if v.text == "1" else "False"), "b"
    if kind == "e":
        return v.text, "e"
    if int(c.get("s", 0)) in date_styles:
        at = _DAY_ZERO + timedelta(days=float(v.text))
        return (at + timedelta(microseconds=500)).replace(microsecond=0).isoformat(sep=" "), "d"
    number = float(v.text)
    return (str(int(number)) if re.fullmatch(r"[+-]?\d+", v.text) else str(number)), "n"


def sheets(raw: bytes, formulas: bool = True) -> Iterator[tuple[str, Iterator[tuple[list[str | None], list[str | None]]]]]:
    """(title, rows) of every sheet in order; a row is (texts, types)."""
    z = zipfile.ZipFile(io.BytesIO(raw))
    rels = {r.get("Id"): r.get("Target") for r in ET.parse(z.open("xl/_rels/workbook.xml.rels")).getroot()}
    shared, dates = _texts(z), _date_styles(z)
    for s in ET.parse(z.open("xl/workbook.xml")).getroot().iter(f"{_M}sheet"):
        target = rels[s.get(f"{_R}id")]
        yield s.get("name"), _rows(z, target.lstrip("/") if target.startswith("/") else f"xl/{target}", shared, dates, formulas)


def _rows(z: zipfile.ZipFile, name: str, shared: list[str], dates: set[int], formulas: bool) -> Iterator[tuple[list[str | None], list[str | None]]]:
    at = 0
    for _, e in ET.iterparse(z.open(name)):
        if e.tag != f"{_M}row":
            continue
        number = int(e.get("r", at + 1))
        for _ in range(at + 1, number):
            yield [], []
        at = number
        texts: list[str | None] = []
        types: list[str | None] = []
        for i, c in enumerate(e.findall(f"{_M}c")):
            k = _column(c.get("r")) if c.get("r") else i
            texts += [None] * (k - len(texts))
            types += [None] * (k - len(types))
            t, kind = _cell(c, shared, dates, formulas)
            texts.append(t)
            types.append(kind)
        yield texts, types
        e.clear()


# The parts that a minimal workbook consists of.
_TYPES = '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{}</Types>'
_ROOT = '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>'
_BOOK = '<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{}</sheets></workbook>'
_BOOK_RELS = '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{}</Relationships>'
_NO_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿\ud800-\udfff]")


def write(path: Path, tables: Iterable[tuple[str, Iterable[Iterable[object]]]]) -> None:
    """One workbook; text stays text, also where it begins with '='. Rows stream into the archive."""
    names = []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for i, (title, rows) in enumerate(tables, 1):
            names.append(title)
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as out:
                out.write(b'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
                for row in rows:
                    out.write(("<row>" + "".join(map(_written, row)) + "</row>").encode())
                out.write(b"</sheetData></worksheet>")
        over = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", _TYPES.format(over))
        z.writestr("_rels/.rels", _ROOT)
        z.writestr("xl/workbook.xml", _BOOK.format("".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))))
        z.writestr("xl/_rels/workbook.xml.rels", _BOOK_RELS.format("".join(f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1))))


def _written(v: object) -> str:
    if v is None:
        return "<c/>"
    if isinstance(v, bool):
        return f'<c t="b"><v>{int(v)}</v></c>'
    if isinstance(v, int | float):
        return f"<c><v>{v}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_NO_XML.sub("", str(v)))}</t></is></c>'

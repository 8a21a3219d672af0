"""Files as one raw table with lineage, and raw sheets as tables with resolved headers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.sources import csv_exact, xlsx_xml
from reviewflow.sources.paths import CSV, checked, sheet_title
from reviewflow.storage import ship_package, written

RAW = "_file_idx int, _file string, _sheet_idx int, _sheet string, _row long, cells array<string>, types array<string>"
#: Rows that a reader hands over at once.
BATCH = 5000


def _file_rows(path: str, raw: bytes, formulas: bool) -> Iterator[tuple[int, str, int, list, list]]:
    if Path(path).suffix.lower() in CSV:
        for n, cells in enumerate(csv_exact.rows(raw), 1):
            yield 0, sheet_title(path), n, cells, ["s"] * len(cells)
    else:
        for i, (title, rows) in enumerate(xlsx_xml.sheets(raw, formulas)):
            for n, (cells, types) in enumerate(rows, 1):
                yield i, title, n, cells, types


def _plain(path: str) -> str:
    """A path as one text, whatever form of address it has: ``file:/a``, ``file:///a`` and ``/a`` are the same."""
    scheme, colon, rest = path.partition(":")
    return path if not colon or "/" in scheme or scheme != "file" else "/" + rest.lstrip("/")


def _reader(index: dict[str, int], formulas: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RAW.split(", ")]
        for f in frames:
            for path, content in zip(f["path"], f["content"], strict=True):
                own = _plain(path)
                own = own if own in index else unquote(own)
                batch = []
                for sheet_i, sheet, n, cells, types in _file_rows(own, content, formulas):
                    batch.append((index[own], own, sheet_i, sheet, n, cells, types))
                    if len(batch) >= BATCH:
                        yield pd.DataFrame(batch, columns=names)
                        batch = []
                if batch:
                    yield pd.DataFrame(batch, columns=names)

    return run


def read_raw(spark: SparkSession, paths: list[str | Path], formulas: bool = True) -> DataFrame:
    """Every row of every sheet of every file, header rows included; one file is one task's work.

    The raw table is written once, so that every file is read and parsed once, however many sheets and stages follow.
    """
    ship_package(spark)
    files = [str(p) for p in checked(paths)]
    exact = [f"file://{re.sub(r'([][{}*?\\])', r'\\\1', p)}" for p in files]  # a name is no pattern
    content = spark.read.format("binaryFile").load(exact).select("path", "content")
    rows = content.repartition(len(files), "path").mapInPandas(_reader({p: i for i, p in enumerate(files)}, formulas), RAW)
    return written(rows, "raw-sheets")


def read_bulk_csv(spark: SparkSession, paths: list[str], columns: list[str] | None = None) -> DataFrame:
    """Well-formed UTF-8 CSV files of one header at any address, split among tasks: all columns text, quotes doubled, empty as null.

    For many large files; lineage is the file's name, and the order of a file's rows is that of its parts.
    """
    t = spark.read.option("header", True).option("multiLine", False).option("escape", '"').option("inferSchema", False).csv(paths)
    return t.select(*(F.col(f"`{c}`") for c in columns or t.columns), F.col("_metadata.file_path").alias("_file"))


def sheet_headers(raw: DataFrame) -> list[dict]:
    """Header and width of each sheet, in order; as many rows as there are sheets."""
    keys = ["_file_idx", "_file", "_sheet_idx", "_sheet"]
    g = raw.groupBy(*keys).agg(F.max(F.size("cells")).alias("width"), F.min_by("cells", "_row").alias("header"))
    return [r.asDict() for r in g.orderBy("_file_idx", "_sheet_idx").collect()]


def _names(header: list, width: int) -> list[str]:
    """Columns without header, or with one that occurred before, get their number as name."""
    names: list[str] = []
    for i in range(width):
        h = header[i] if i < len(header) else None
        names.append(h if h is not None and h != "" and h not in names else f"_{i + 1}")
    return names


def tables(raw: DataFrame) -> list[DataFrame]:
    """Sheets as tables with lineage and one text column for each header; ragged rows are filled up with nulls.

    Sheets of one layout are one table, in the order in which layouts first occur: rows know their sheet by their lineage.
    """
    layouts: dict[tuple[str, ...], list[dict]] = {}
    for s in sheet_headers(raw):
        layouts.setdefault(tuple(_names(s["header"], s["width"])), []).append(s)
    out = []
    for names, sheets in layouts.items():
        own = F.struct("_file_idx", "_sheet_idx").isin(*(F.struct(F.lit(s["_file_idx"]), F.lit(s["_sheet_idx"])) for s in sheets)) if len(layouts) > 1 else F.lit(True)
        cells = [F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)]
        out.append(raw.where((F.col("_row") > 1) & own).select("_file_idx", "_file", "_sheet_idx", "_sheet", "_row", *cells))
    return out

"""The stages over files, each one lazy until its sink, with summaries. ``plans.catalog`` has the same stages over tables."""

from __future__ import annotations

import json
from datetime import date, datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow import sinks
from reviewflow.conf import values as V
from reviewflow.functions import text
from reviewflow.operators import audit as audits
from reviewflow.operators import combine, compare, dedup, headers, identity, platforms
from reviewflow.sources import tabular

KEYS = list(combine.LINEAGE)
ORDER = ["_file_idx", "_sheet_idx", "_row"]
SHEET = ["_file_idx", "_sheet_idx"]


def _own(t: DataFrame) -> list[str]:
    return [c for c in t.columns if c not in KEYS]


def merge(spark: SparkSession, paths: list[Path], add_source_columns: bool = False) -> DataFrame:
    return combine.merged(tabular.tables(tabular.read_raw(spark, paths)), add_source_columns)


def inventory(spark: SparkSession, paths: list[Path]) -> list[dict]:
    """Rows that aren't blank of each sheet; a sheet whose header is blank has none."""
    raw = tabular.read_raw(spark, paths)
    data = raw.where("_row > 1").where(F.exists("cells", lambda c: text.nonblank(c).isNotNull()))
    counts = {(r._file_idx, r._sheet_idx): r.n for r in data.groupBy(*SHEET).agg(F.count("*").alias("n")).collect()}
    out = []
    for s in tabular.sheet_headers(raw):
        n = counts.get((s["_file_idx"], s["_sheet_idx"]), 0) if any(h and h.strip() for h in s["header"]) else 0
        out.append({"file": s["_file"], "sheet": s["_sheet"], "rows": n})
    return out


def preprocess(spark: SparkSession, paths: list[Path], platform: str | None = None) -> DataFrame:
    return platforms.project_all(tabular.tables(tabular.read_raw(spark, paths)), KEYS, platform)


def strip_replies(t: DataFrame, target: str = "content") -> DataFrame:
    c = headers.one_column(_own(t), target, headers.folded)
    return t.withColumn(c, text.strip_reply_prefix(F.col(f"`{c}`")))


def standardize(t: DataFrame, ref: date, platform: str | None = None, project: identity.Project | None = None, product_name: str | None = None) -> DataFrame:
    """One layout; its sheets choose their identity columns each for itself."""
    hashed = identity.identity_column(t, platform, project, _own(t), [c for c in SHEET if c in t.columns])
    return headers.standardized(t, ref, KEYS, product_name, hashed)


def standardize_sheets(ts: list[DataFrame], ref: date, platform: str | None = None, project: identity.Project | None = None, product_name: str | None = None) -> DataFrame:
    """All sheets of a workbook, each mapped by its own headers, as one standard table."""
    return reduce(DataFrame.unionByName, (standardize(t, ref, platform, project, product_name) for t in ts))


def keep_keywords(t: DataFrame, keywords: list[str], target: str = "评论内容") -> DataFrame:
    c = headers.one_column(_own(t), target)
    return t.where(text.keep_by_keywords(F.col(f"`{c}`"), keywords))


def clean(t: DataFrame, target: str = "评论内容", platform: str | None = None, clean_words: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, event log)."""
    c = headers.one_column(_own(t), target)
    if platform == "twitter-comments":
        t = t.withColumn(c, text.strip_https(F.col(f"`{c}`")))
    likes = next((h for h in _own(t) if headers.without_space(h) == "点赞数"), None)
    subs = tuple(h for h in _own(t) if headers.without_space(h) in dedup.SUBCOMMENTS)
    marked = dedup.with_reasons(t, SHEET, ["_row"], c, likes, clean_words)
    kept = marked.where("_reason IS NULL").drop("_reason")
    out = dedup.clear_subcomments(kept, SHEET, ["_row"], subs) if subs else kept
    sheet = F.col("_sheet").alias("sheet")
    log = marked.where("_reason IS NOT NULL").select(
        F.lit("delete_row").alias("action"), sheet, F.col("_row").alias("row_number"), F.lit("").alias("column_header"), F.col("_reason").alias("reason"), dedup.stripped_comment(F.col(f"`{c}`")).alias("value")
    )
    if subs:
        cells = dedup.cleared_cells(dedup.numbered(kept, SHEET, ["_row"], "_new", 2), [*SHEET, "_sheet"], ["_new"], subs)
        log = log.unionByName(cells.select(F.lit("clear_cell").alias("action"), sheet, F.col("_new").cast("long").alias("row_number"), F.col("_col").alias("column_header"), "reason", "value"))
    return out, log


def first_sheet(t: DataFrame) -> DataFrame:
    """Only the first sheet reaches a CSV file."""
    return t.where((F.col("_file_idx") == 0) & (F.col("_sheet_idx") == 0))


def sheets_of(ts: list[DataFrame]) -> list[tuple[str, DataFrame, list[str]]]:
    """(name, rows, columns) of every sheet in order; as many as the workbook has."""
    found = []
    for t in ts:
        for n in t.select("_file_idx", "_sheet_idx", "_sheet").distinct().collect():
            own = t.where((F.col("_file_idx") == n._file_idx) & (F.col("_sheet_idx") == n._sheet_idx))
            found.append(((n._file_idx, n._sheet_idx), n._sheet, own, _own(t)))
    return [x[1:] for x in sorted(found, key=lambda x: x[0])]


def write_table(t: DataFrame | list[DataFrame], path: Path, title: str | None = None) -> None:
    """An .xlsx with all sheets (or one, if a title is given), a .csv with the first, or else a Parquet folder for further stages."""
    ts = t if isinstance(t, list) else [t]
    if path.suffix == ".xlsx":
        sinks.write_xlsx([(title, ts[0], _own(ts[0]))] if title else sheets_of(ts), path, ORDER)
    elif path.suffix == ".csv":
        first = ts[0] if title else first_sheet(ts[0])
        sinks.write_csv(first, path, ORDER, _own(ts[0]))
    elif len(ts) == 1:
        ts[0].write.mode("errorifexists").parquet(str(path))
    else:
        raise headers.HeaderError("sheets of several layouts are no single table; name an .xlsx")


def read_sheets(spark: SparkSession, path: Path) -> list[DataFrame]:
    """One file of any supported form, a table for each layout of its sheets; or a Parquet folder of a former stage."""
    return [spark.read.parquet(str(path))] if path.is_dir() else tabular.tables(tabular.read_raw(spark, [path]))


def read_table(spark: SparkSession, path: Path) -> DataFrame:
    """A file whose sheets have one layout."""
    ts = read_sheets(spark, path)
    if len(ts) != 1:
        raise headers.HeaderError(f"the sheets of {path.name} have {len(ts)} layouts")
    return ts[0]



def audit_files(spark: SparkSession, std: Path, source: Path | None, ref: date) -> dict:
    """Every sheet of a standardized file against the sheet of the same name of its source: codes and counts, never values.

    Rows are compared by their position in their sheet; files never share a path, so a path is no key. All sheets are counted by one
    job for each pair of layouts.
    """
    sides = [(raw := tabular.read_raw(spark, [p]), tabular.sheet_headers(raw)) if p is not None else None for p in (std, source)]
    std_sheets = sides[0][1]
    src_of = {s["_sheet"]: s for s in sides[1][1]} if sides[1] else {}
    issues: list[tuple[str, str | None]] = audits.sheet_issues(list(src_of), [s["_sheet"] for s in std_sheets]) if sides[1] else []
    pairs: dict[tuple, list[str]] = {}
    layout = lambda s: (tuple(s["header"]), s["width"]) if s else None
    for s in std_sheets:
        pairs.setdefault((layout(s), layout(src_of.get(s["_sheet"]))), []).append(s["_sheet"])
    counts: dict[str, dict] = {}
    for (_, src_layout), names in pairs.items():
        side = lambda raw: tabular.tables(raw.where(F.col("_sheet").isin(names)))[0].drop("_file_idx", "_file", "_sheet_idx")
        left = side(sides[0][0])
        found, checked = audits.sheet_counts(left, side(sides[1][0]) if src_layout else None, "_sheet", "_row", ref)
        rows = {r.sheet: r.asDict() for r in found.collect()}
        for n in names:
            counts[n] = rows.get(n, {"n_rows": 0, "n_source": 0, "bad_hash": 0, "blank_likes": 0, "mismatches": 0}) | {"checked": checked, "has_source": bool(src_layout)}
    sheets = []
    for s in std_sheets:
        name, c = s["_sheet"], counts[s["_sheet"]]
        own = ["" if h is None else str(h) for h in s["header"]]
        issues += [(code, name) for code in audits.header_issues(own)]
        wrong = (("invalid_hash_id_format", c["bad_hash"]), ("blank_likes_value", c["blank_likes"]), ("data_row_count_mismatch", c["has_source"] and c["n_rows"] != c["n_source"]), ("mapped_value_mismatch", c["mismatches"]))
        issues += [(code, name) for code, n in wrong if n]
        sheets.append({
            "sheet_name": name, "header_matches": own == list(V.ALIASES), "standardized_data_rows": c["n_rows"], "source_data_rows": c["n_source"] if c["has_source"] else None,
            "invalid_hash_id_count": c["bad_hash"], "blank_likes_count": c["blank_likes"], "mapped_value_mismatch_count": c["mismatches"], "source_mapping_checked": c["checked"],
            "unexpected_headers": [h for h in own if h not in V.ALIASES], "missing_headers": [h for h in V.ALIASES if h not in own],
        })
    return {
        "input_path": str(std), "source_path": str(source) if source else None, "reference_date": ref.isoformat(), "passed": not issues, "issue_count": len(issues),
        "expected_headers": list(V.ALIASES), "issues": [{"code": code, "sheet_name": sheet} for code, sheet in issues], "sheets": sheets,
    }


def audit(std: DataFrame, source: DataFrame, ref: date) -> dict:
    return audits.audit(std, source.select(*KEYS, *_own(source)), KEYS, ref)


def audit_reference_date(standardized: Path) -> date | None:
    """The reference date that the standardizing run wrote into its summary."""
    for s in (standardized.with_suffix(".standardized.summary.json"), standardized.with_suffix(".summary.json")):
        if s.exists():
            found = json.loads(s.read_text(encoding="utf-8")).get("reference_date")
            if isinstance(found, str):
                return date.fromisoformat(found)
    return None


def compare_files(spark: SparkSession, left: Path, right: Path, comment_column: int = 3, sheet: str | None = None, labels: tuple[str, str] = ("left", "right"), folder: Path | None = None) -> dict:
    """Two sheets, the first ones or those of a name; with a folder the whole bundle is written there."""
    raws = [tabular.read_raw(spark, [p]) for p in (left, right)]
    listed = [tabular.sheet_headers(r) for r in raws]
    found = []
    for raw, sheets in zip(raws, listed, strict=True):
        names = [s["_sheet"] for s in sheets]
        if not names or sheet is not None and sheet not in names:
            raise headers.HeaderError(f"no sheet {sheet or ''}")
        found.append((sheet or names[0], names, tabular.tables(raw.where(F.col("_sheet") == (sheet or names[0])))[0]))
    (left_name, left_names, a), (right_name, right_names, b) = found
    cols = _own(a)
    about = {"left_label": labels[0], "right_label": labels[1], "left_path": str(left), "right_path": str(right), "sheet_left": left_name, "sheet_right": right_name, "sheet_names_left": left_names, "sheet_names_right": right_names}
    if cols != _own(b):
        return {"headers_equal": False, "left": cols, "right": _own(b)} | about
    out = {"headers_equal": True} | about | compare.report(a, b, "_row", cols, cols[comment_column - 1])
    if folder is None:
        return out
    return out | sinks.write_comparison(out, {"left": compare.excess_rows(a, b, "_row", cols), "right": compare.excess_rows(b, a, "_row", cols)}, folder)


def product_tables(spark: SparkSession, paths: list[Path]) -> list[DataFrame]:
    return [t.select(*(f"`{c}`" for c in _own(t))) for t in tabular.tables(tabular.read_raw(spark, paths, formulas=False))]


def sheet_summaries(ts: list[DataFrame]) -> list[dict]:
    """Rows and columns of every sheet, in order."""
    out = []
    for t in ts:
        out += [(r._file_idx, r._sheet_idx, r._sheet, r.n, _own(t)) for r in t.groupBy("_file_idx", "_sheet_idx", "_sheet").agg(F.count("*").alias("n")).collect()]
    return [{"sheet": s, "rows": n, "columns": cols} for _, _, s, n, cols in sorted(out, key=lambda x: x[:2])]


def mapping_summary(ts: list[DataFrame]) -> dict:
    """For every layout: which header each field came from, and the privacy headers that the result left out."""
    return {"mappings": [{"fields": {s.field: s.source or list(filter(None, s.parts)) or None for s in headers.select_columns(_own(t))}, "dropped_headers": headers.dropped_headers(_own(t)), "source_headers": _own(t)} for t in ts]}


def event_counts(log: DataFrame) -> dict:
    """Deleted rows and cleared cells by reason; reasons are a closed set and configured words, never texts."""
    found = log.groupBy("action", "reason").agg(F.count("*").alias("n")).orderBy("action", "reason").collect()
    return {"events": [r.asDict() for r in found], "deleted_rows": sum(r.n for r in found if r.action == "delete_row"), "cleared_cells": sum(r.n for r in found if r.action == "clear_cell")}


def summary(rows_in: int, rows_out: int, columns: list[str], **more: object) -> dict:
    at = datetime.now(sinks.BEIJING).isoformat(timespec="seconds")
    return {"created_at": at, "rows_in": rows_in, "rows_out": rows_out, "columns": columns, "fields": list(V.ALIASES), **more}

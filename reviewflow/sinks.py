"""Named output files, their guards, and cleaning up what lies between. Rows stream through the driver in order."""

from __future__ import annotations

import csv
import json
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from pathlib import Path

from pyspark.sql import DataFrame

from reviewflow.sources import xlsx_xml

LOG_FIELDS = ("action", "sheet", "row_number", "column_header", "reason", "value")
BEIJING = timezone(timedelta(hours=8))


class OutputError(ValueError):
    """An output that would overwrite or destroy something."""


def beijing_day(now: datetime | None = None) -> str:
    now = now or datetime.now(BEIJING)
    return (now.replace(tzinfo=BEIJING) if now.tzinfo is None else now.astimezone(BEIJING)).strftime("%Y%m%d")


def unique(paths: list[Path]) -> list[Path]:
    out = [Path(p).resolve() for p in paths]
    if len(set(out)) < len(out):
        raise OutputError("an output is named twice")
    return out


def guard(inputs: list[Path], outputs: list[Path], overwrite: bool = False, confirmed: list[Path] | None = None) -> list[Path]:
    """Outputs that may be written: never an input; existing ones only with ``overwrite`` and an exact confirmation of each."""
    outs, sure = unique(outputs), set(unique(confirmed or []))
    if sure and not overwrite:
        raise OutputError("a confirmation needs overwrite")
    if taken := set(outs) & {Path(p).resolve() for p in inputs}:
        raise OutputError(f"an output is an input: {sorted(taken)[0]}")
    there = {p for p in outs if p.exists()}
    if there and not overwrite:
        raise OutputError(f"output exists: {sorted(there)[0]}")
    if stray := sure - there:
        raise OutputError(f"confirmed, but no existing output: {sorted(stray)[0]}")
    if open_ := there - sure:
        raise OutputError(f"output exists and isn't confirmed: {sorted(open_)[0]}")
    return outs


@contextmanager
def staged(path: Path) -> Iterator[Path]:
    """A sibling to write to, which takes the target's place only once it is complete."""
    path = Path(path).resolve()
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.stem}.{uuid.uuid4().hex}.part{path.suffix}")
    try:
        yield part
        if not part.is_file():
            raise OutputError(f"nothing was written for {path}")
        os.replace(part, path)
    finally:
        part.unlink(missing_ok=True)


def write_csv(df: DataFrame, path: Path, order: list[str], columns: list[str]) -> None:
    """UTF-8 with mark, CRLF, null as empty; partition after partition through the driver."""
    with staged(path) as part, part.open("w", newline="", encoding="utf-8-sig") as f:
        out = csv.writer(f)
        out.writerow(columns)
        for r in df.orderBy(*order).select(*(f"`{c}`" for c in columns)).toLocalIterator():
            out.writerow(["" if v is None else v for v in r])


def write_xlsx(sheets: list[tuple[str, DataFrame, list[str]]], path: Path, order: list[str]) -> None:
    """(title, rows, columns) of every sheet, each with its own columns."""

    def rows(df: DataFrame, columns: list[str]) -> Iterator[list]:
        yield columns
        for r in df.orderBy(*order).select(*(f"`{c}`" for c in columns)).toLocalIterator():
            yield list(r)

    with staged(path) as part:
        xlsx_xml.write(part, [(title, rows(df, columns)) for title, df, columns in sheets])


def write_comparison(report: dict, differences: dict[str, DataFrame], folder: Path) -> dict[str, str]:
    """The bundle of a comparison: the report as JSON and as a workbook of five sheets, and each side's excess rows as CSV."""
    names = {"summary_path": "comparison-summary.json", "only_left_csv": "only-in-left.csv", "only_right_csv": "only-in-right.csv", "report_xlsx": "comparison-report.xlsx"}
    paths = {k: Path(folder) / n for k, n in names.items()}
    left, right = report["left_label"], report["right_label"]
    lead = ["source_row", "row_hash"]
    excess = {side: [[r[c] for c in [*lead, *report["header"]]] for r in report[key]] for side, key in (("left", "samples"), ("right", "samples_right"))}
    pair = lambda name, key, notes="": [name, report[f"{key}_left"], report[f"{key}_right"], notes]
    sheets = [
        ("Summary", [
            ["Metric", left, right, "Notes"], pair("Sheet name", "sheet"), pair("Data rows", "rows"), pair("Columns", "columns"), ["Headers match", str(report["headers_equal"]), str(report["headers_equal"]), ""],
            pair("Whole-row only count", "only", "Compared as full row values"), pair("Comment-only count", "comments_only", "Compared by configured comment column"),
            ["Sequence mismatch count", report["sequence_mismatches"], report["sequence_mismatches"], "Rows differ at same row number"],
            ["Duplicate comment extra rows", *(report["duplicates"][side]["duplicate_rows"] for side in ("left", "right")), "Configured comment-column duplicates after cleaning"],
        ]),
        ("Only in Left", [[*lead, *report["header"]], *excess["left"]]), ("Only in Right", [[*lead, *report["header"]], *excess["right"]]),
        ("Comment Diff", [["side", "comment"], *([left, c] for c in report["comment_samples_left"]), *([right, c] for c in report["comment_samples_right"])]),
        ("Sequence Diff", [["row_number", left, right], *([r["row_number"], r["left"], r["right"]] for r in report["sequence_samples"])]),
    ]
    write_json(report, paths["summary_path"])
    for side in ("left", "right"):
        write_csv(differences[side], paths[f"only_{side}_csv"], ["source_row"], differences[side].columns)
    with staged(paths["report_xlsx"]) as part:
        xlsx_xml.write(part, sheets)
    return {k: str(p) for k, p in paths.items()}


def write_event_log(events: DataFrame, path: Path) -> None:
    """Deleted rows first, by sheet and falling number; then cleared cells by sheet, number and header."""
    with staged(path) as part, part.open("w", newline="", encoding="utf-8-sig") as f:
        out = csv.writer(f)
        out.writerow(LOG_FIELDS)
        for action, *order in (("delete_row", "sheet", events["row_number"].desc()), ("clear_cell", "sheet", "row_number", "column_header")):
            for r in events.where(events["action"] == action).orderBy(*order).select(*LOG_FIELDS).toLocalIterator():
                out.writerow(["" if v is None else v for v in r])


def write_json(value: object, path: Path) -> None:
    with staged(path) as part:
        part.write_text(json.dumps(value, ensure_ascii=False, indent=2, default=str), encoding="utf-8")


def output_paths(source: Path, stage: str, folder: Path | None = None, now: datetime | None = None) -> dict[str, Path]:
    """Default names of a stage's files beside the input or in a folder."""
    source = Path(source)
    stem = (folder or source.parent) / f"{beijing_day(now)}_{source.stem}"
    kinds = {
        "standardized": (".standardized.xlsx", ".standardized.summary.json"),
        "preprocessed": (".preprocessed.xlsx", ".preprocessed.summary.json"),
        "cleaned": (".cleaned.xlsx", ".cleaned.csv", ".deletions.csv", ".summary.json"),
        "filtered": (".filtered.xlsx", ".filtered.summary.json"),
        "replies": (".replies.xlsx", ".replies.summary.json"),
        "merged": (".merged.xlsx", ".merged.summary.json"),
        "audit": (".audit.json",),
    }
    return {k: Path(f"{stem}{k}") for k in kinds[stage]}


def refuse_restoring(final_xlsx: Path) -> None:
    """A finished result whose log or summary was taken away isn't written again in part."""
    final = Path(final_xlsx)
    if final.exists() and not all(final.with_suffix(s).exists() for s in (".deletions.csv", ".summary.json")):
        raise OutputError("the result is final, its log or summary is gone")


def clean_up(intermediate: list[Path], protected: list[Path], final: list[Path], summary: Path | None = None) -> dict[str, list[str]]:
    """Delete exactly the listed files; one .xlsx and one .csv must exist as protected results, and folders are refused."""
    keep, finals, gone = unique(protected), unique(final), unique(intermediate)
    if not keep:
        raise OutputError("nothing is protected")
    if sorted(p.suffix.lower() for p in finals) != [".csv", ".xlsx"] or not all(p.is_file() for p in finals) or not set(finals) <= set(keep):
        raise OutputError("one .xlsx and one .csv must exist as protected results")
    if set(gone) & set(keep):
        raise OutputError("a protected file is listed for deletion")
    if any(p.is_dir() for p in gone):
        raise OutputError("folders are not deleted")
    if summary is not None:
        s = Path(summary).resolve()
        if s in keep or s in gone or s.name.lower().endswith(".deletions.csv") or s in {f.with_suffix(x) for f in finals for x in (".deletions.csv", ".summary.json")}:
            raise OutputError("the summary would take the place of another file")
    out = {"deleted": [str(p) for p in gone if p.exists()], "missing": [str(p) for p in gone if not p.exists()]}
    for p in gone:
        p.unlink(missing_ok=True)
    if summary is not None:
        write_json(out | {"protected": [str(p) for p in keep], "final": [str(p) for p in finals]}, Path(summary))
    return out

"""Which input files are accepted, and what their sheets are called."""

from __future__ import annotations

import re
from pathlib import Path

EXCEL, CSV = (".xlsx", ".xlsm"), (".csv",)
UNSUPPORTED = "当前工具支持 .xlsx、.xlsm 和 .csv；老版 .xls 请先另存为 .xlsx"


class InputError(ValueError):
    """A list of inputs that can't be read."""


def supported(path: str | Path) -> bool:
    return Path(path).suffix.lower() in EXCEL + CSV


def sheet_title(path: str | Path) -> str:
    """The sheet name of a file that has no sheets: its stem without characters that sheet names can't have."""
    return (re.sub(r"[\[\]:*?/\\]", "_", Path(path).stem).strip() or "Sheet1")[:31]


def checked(paths: list[str | Path]) -> list[Path]:
    """Existing, supported, distinct files in the given order; lock files of an office program are passed over."""
    if not paths:
        raise InputError("no input file")
    out: list[Path] = []
    for p in map(Path, paths):
        if p.name.startswith("~$"):
            continue
        if p.is_dir():
            raise InputError(f"a folder is no input file: {p}")
        if not p.exists():
            raise InputError(f"input file is missing: {p}")
        if not supported(p):
            raise InputError(UNSUPPORTED)
        if p.resolve() in out:
            raise InputError(f"input file is given twice: {p}")
        out.append(p.resolve())
    if not out:
        raise InputError("no input file")
    return out

"""Keyed pseudonyms. The key travels only inside the worker function, never as a column or literal of a plan."""

from __future__ import annotations

import hashlib
import hmac
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.conf import values as V
from reviewflow.functions.text import pystrip

# Literals by which spreadsheets show errors; they are no identities.
SHEET_ERRORS = (
    "#NULL!", "#DIV/0!", "#VALUE!", "#REF!", "#NAME?", "#NUM!", "#N/A", "#GETTING_DATA", "#SPILL!", "#CALC!", "#FIELD!", "#DATA!", "#BLOCKED!", "#UNKNOWN!", "#CONNECT!",
)
BAD_IDENTITY = "an identity is a formula or an error literal"


class IdentityError(ValueError):
    """A platform or project that can't be used."""


@dataclass(frozen=True)
class Project:
    """A project's key with its version; the key is kept out of every text form."""

    project_id: str
    key_version: int
    secret: bytes = field(repr=False)

    def __post_init__(self) -> None:
        if not isinstance(self.project_id, str) or not self.project_id.strip():
            raise IdentityError("a project needs an id")
        if not isinstance(self.secret, bytes) or len(self.secret) != 32:
            raise IdentityError("a key has 32 bytes")
        if isinstance(self.key_version, bool) or not isinstance(self.key_version, int) or self.key_version < 1:
            raise IdentityError("a key version is a positive whole number")

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(self.secret).hexdigest()[:16]


def platform_of(name: str) -> str:
    """The platform of a name or alias; letter case counts."""
    for platform, x in V.IDENTITIES.items():
        if name.strip() == platform or name.strip() in x["names"]:
            return platform
    raise IdentityError(f"unknown platform {name}")


def account_value(c: Column) -> Column:
    """A usable account id or null; formulas and error literals stop the job without showing the value."""
    t = _usable(c)
    return F.when(F.lower(t) != "none", t)


def display_value(c: Column) -> Column:
    return _usable(c)


def _usable(c: Column) -> Column:
    t = F.nullif(pystrip(c.cast("string")), F.lit(""))
    # A whole number that came as a float has the same form as the integer.
    t = F.regexp_replace(t, r"^([+-]?[0-9]+)\.0$", "$1")
    return F.when(t.startswith("=") | t.isin(*SHEET_ERRORS), F.raise_error(F.lit(BAD_IDENTITY))).otherwise(t)


def message_prefix(project: Project, platform: str, display: bool) -> bytes:
    parts = [V.ALGORITHM, project.project_id, str(project.key_version), platform, *(["display_name"] if display else [])]
    return b"".join(map(_framed, parts))


def _framed(s: str) -> bytes:
    b = s.encode("utf-8")
    return struct.pack(">I", len(b)) + b


def pseudonym(value: str, project: Project, platform: str, display: bool) -> str:
    return hmac.new(project.secret, message_prefix(project, platform, display) + _framed(value), hashlib.sha256).hexdigest()


def pseudonyms(c: Column, project: Project, platform: str, display: bool) -> Column:
    """Keyed digests of usable values, Arrow batch by batch; the digest of the fixed prefix is prepared once."""
    platform = platform_of(platform)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = hmac.new(project.secret, message_prefix(project, platform, display), hashlib.sha256)

        def one(v: str | None) -> str | None:
            if v is None or v != v:
                return None
            h = own.copy()
            h.update(_framed(v))
            return h.hexdigest()

        for s in batches:
            yield s.map(one)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")(display_value(c) if display else account_value(c))


def choices(rows: DataFrame, platform: str, headers: list[str], sheet: list[str]) -> DataFrame:
    """(sheet..., header, display) of every sheet: its first account header with any usable value, else its first display header.

    One aggregate over the account headers; never a choice row by row. A sheet without either has a null header.
    """
    x = V.IDENTITIES[platform_of(platform)]
    accounts = [h for h in x["accounts"] if h in headers]
    shown = next((h for h in x["display"] if h in headers), None)

    def usable(h: str) -> Column:
        t = F.lower(pystrip(F.col(f"`{h}`").cast("string")))
        return F.max(F.coalesce((t != "") & (t != "none"), F.lit(False)))

    used = rows.groupBy(*sheet).agg(F.count(F.lit(1)), *(usable(h).alias(f"_c{i}") for i, h in enumerate(accounts)))
    account = F.coalesce(*(F.when(F.col(f"_c{i}"), h) for i, h in enumerate(accounts)), F.lit(None).cast("string"))
    header = F.coalesce(account, F.lit(shown).cast("string"))
    return used.select(*sheet, header.alias("header"), (account.isNull() & header.isNotNull()).alias("display"))


def choose_identity(rows: DataFrame, platform: str, headers: list[str]) -> tuple[str, bool] | None:
    """(header, is display name) for a table that is one sheet."""
    one = choices(rows, platform, headers, []).first()
    return (one.header, one.display) if one is not None and one.header is not None else None


def identity_column(rows: DataFrame, platform: str | None, project: Project | None, headers: list[str], sheet: list[str] | None = None) -> Column:
    """The pseudonym column of a table, chosen sheet by sheet; a table with identity headers needs platform and project."""
    if platform is None:
        return F.lit(None).cast("string")
    chosen: dict[tuple[str, bool], list[tuple]] = {}
    for r in choices(rows, platform, headers, sheet or []).collect():  # one row for each sheet of a workbook
        if r.header is not None:
            chosen.setdefault((r.header, r.display), []).append(tuple(r[c] for c in sheet or []))
    if not chosen:
        return F.lit(None).cast("string")
    if project is None:
        raise IdentityError("a table with identities needs a project")
    made = {k: pseudonyms(F.col(f"`{k[0]}`"), project, platform, k[1]) for k in chosen}
    if len(made) == 1:
        return next(iter(made.values()))
    own = lambda keys: F.struct(*sheet).isin(*(F.struct(*map(F.lit, k)) for k in keys))
    return F.coalesce(*(F.when(own(keys), made[k]) for k, keys in chosen.items()))

"""Mixed timestamp formats and time zones -> one UTC instant per row.

Method: the raw strings are reduced to a dictionary of distinct (value, zone, locale); every entry is parsed once by an
exhaustive parser; the dictionary is kept as a table to which later runs only add unseen strings; the instants are joined
back to the rows.

Defined results
* null, blank, relative, impossible or date-only values, and values without zone in a row without zone: ``utc_time`` null.
* fractions of a second are cut off, missing seconds are 00; a count of days is the spreadsheet day number in local time.
* a local hour that occurs twice means its first pass, a skipped one is read with the offset before the change.
* an empty table gives an empty result; repeated rows give repeated results; other columns, also ones named like the
  operator's own, are not touched because the operator works on renamed columns.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.storage import ship_package, written

EXACT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"

# Month names and their usual short forms.
MONTHS = {
    1: "january jan enero ene janvier janv januar jänner janeiro",
    2: "february feb febrero février févr fevrier februar fevereiro fev",
    3: "march mar marzo mars märz maerz março marco mrz",
    4: "april apr abril abr avril avr",
    5: "may mayo mai maio",
    6: "june jun junio juin juni junho",
    7: "july jul julio juillet juil juli julho",
    8: "august aug agosto ago août aout",
    9: "september sep sept septiembre septembre setembro set",
    10: "october oct octubre octobre oktober okt outubro out",
    11: "november nov noviembre novembre novembro",
    12: "december dec diciembre dic décembre déc decembre dezember dez dezembro",
}
# Offsets in minutes of zone abbreviations that the row's own zone does not use.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "Z": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "IST": 330, "CST": -360, "CDT": -300, "EST": -300, "EDT": -240, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
    "AKST": -540, "AKDT": -480, "HST": -600, "BRT": -180, "ART": -180, "JST": 540, "KST": 540, "HKT": 480, "SGT": 480,
    "AWST": 480, "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
}
# Words for the half of the day.
BEFORE_NOON = ("am", "上午", "午前", "오전", "早上", "凌晨", "清晨")
AFTER_NOON = ("pm", "下午", "午後", "오후", "晚上", "傍晚", "中午")

_MONTH = {w: n for n, words in MONTHS.items() for w in words.split()}
_HALF = "|".join(BEFORE_NOON[1:] + AFTER_NOON[1:])
_TIME = (
    rf"(?:(?P<h1>{_HALF})\s*)?(?P<H>\d{{1,2}})\s*(?:[:h]|[时時点點시])\s*(?P<M>\d{{1,2}})\s*[分분]?"
    r"(?:\s*:?\s*(?P<S>\d{1,2})(?:[.,](?P<f>\d+))?\s*[秒초]?)?(?:\s*(?P<h2>[ap]\.?\s?m\.?)(?![a-z]))?(?:\s*h(?![a-z]))?"
)
_ZONE = r"(?:\s*(?P<z>z|(?:utc|gmt)?\s*[+-]\d{1,2}(?::?\d{2})?|[a-z]{2,5}))?"
_NAME = "|".join(sorted(map(re.escape, _MONTH), key=len, reverse=True))
_FORMS = [
    re.compile(p, re.I)
    for p in (
        rf"(?P<Y>\d{{4}})\s*[-/.年년]\s*(?P<m>\d{{1,2}})\s*[-/.月월]\s*(?P<d>\d{{1,2}})\s*[日일.]?(?:\s*\(?[月火水木金土日一二三四五六]\)|\s*t)?\s*{_TIME}{_ZONE}",
        rf"(?P<a>\d{{1,2}})\s*[-/.]\s*(?P<b>\d{{1,2}})\s*[-/.]\s*(?P<Y>\d{{4}})\s*(?:,|at|às|à|a las|um|t)?\s*{_TIME}{_ZONE}",
        rf"(?:[^\W\d]{{2,9}}\.?,?\s+)?(?P<n>{_NAME})\.?\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<Y>\d{{4}}),?\s*(?:at\s+)?{_TIME}{_ZONE}",
        rf"(?:[^\W\d]{{2,9}}\.?,?\s+)?(?P<d>\d{{1,2}})\.?(?:\s+de)?[\s-]+(?P<n>{_NAME})\.?,?(?:\s+de)?[\s-]+(?P<Y>\d{{4}}),?\s*(?:at|à|às|a las|um)?\s*{_TIME}{_ZONE}",
        rf"[^\W\d]{{2,9}}\.?,?\s+(?P<n>{_NAME})\s+(?P<d>\d{{1,2}})\s+{_TIME}{_ZONE}\s+(?P<Y>\d{{4}})",
        rf"(?P<Y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}})t?(?P<H>\d{{2}})(?P<M>\d{{2}})(?P<S>\d{{2}})?(?:[.,](?P<f>\d+))?(?P<h1>)(?P<h2>){_ZONE}",
    )
]
_COUNT = re.compile(r"[+-]?(\d+)(?:[.,](\d+))?")
_DAY_ZERO = datetime(1899, 12, 30)
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_EDITED = re.compile(r"\s*[(（](?:edited|修改过|已编辑|編集済み)[)）]\s*$", re.I)
_INVISIBLE = {c: None for c in (*range(0x200B, 0x2010), *range(0x202A, 0x202F), 0x2060, 0xFEFF, 0xAD)}


@lru_cache(maxsize=1024)
def _zone(name: str | None) -> ZoneInfo | None:
    try:
        return ZoneInfo(name) if name else None
    except (KeyError, ValueError, OSError):
        return None


@lru_cache(maxsize=1024)
def _own_abbreviations(name: str | None) -> dict[str, timedelta]:
    """The abbreviations that a zone itself uses, with their offsets; the latest use wins."""
    zone, found = _zone(name), {}
    if zone:
        for month in range(12 * 40):
            at = datetime(1995 + month // 12, month % 12 + 1, 15, 12, tzinfo=zone)
            found[at.tzname()] = at.utcoffset()
    return found


def _offset(text: str, zone_name: str | None) -> timedelta | None:
    z = text.strip().upper()
    m = re.fullmatch(r"(?:UTC|GMT)?\s*([+-])(\d{1,2})(?::?(\d{2}))?", z)
    if m:
        hours, minutes = int(m[2]), int(m[3] or 0)
        return timedelta(minutes=(hours * 60 + minutes) * (-1 if m[1] == "-" else 1)) if hours <= 15 and minutes < 60 else None
    own = _own_abbreviations(zone_name)
    if z in own:
        return own[z]
    return timedelta(minutes=ABBREVIATIONS[z]) if z in ABBREVIATIONS else None


def _text(at: datetime) -> str:
    return at.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")


def parse_instant(value: str | None, zone_name: str | None, locale: str | None) -> str | None:
    """The instant of one raw string as ``yyyy-MM-ddTHH:mm:ssZ``, or None where it gives none."""
    if value is None:
        return None
    s = _EDITED.sub("", unicodedata.normalize("NFKC", value).translate(_INVISIBLE).strip())
    if not s or not any(c.isdigit() for c in s):
        return None
    try:
        if m := _COUNT.fullmatch(s):
            got = _counted(s, m, zone_name)
            if got is not None or len(m[1]) not in (12, 14):
                return got
        for form in _FORMS:
            if m := form.fullmatch(s):
                return _dated(m.groupdict(), zone_name, locale)
    except (ValueError, OverflowError):
        pass
    return None


def _counted(s: str, m: re.Match, zone_name: str | None) -> str | None:
    whole, digits = int(m[1]), len(m[1])
    if s[0] == "-":
        return None
    if digits in (13, 16, 19) and not m[2]:
        return _text(_EPOCH + timedelta(seconds=whole // 10 ** (digits - 10)))
    if digits in (9, 10):
        return _text(_EPOCH + timedelta(seconds=whole))
    if digits == 13:
        return _text(_EPOCH + timedelta(seconds=whole // 1000))
    if digits == 5 and m[2] and (zone := _zone(zone_name)):
        seconds = int(float("0." + m[2]) * 86400 + 0.0005)  # the written places leave under a thousandth of a second open
        return _text((_DAY_ZERO + timedelta(days=whole, seconds=seconds)).replace(tzinfo=zone))
    return None


def _dated(g: dict[str, str | None], zone_name: str | None, locale: str | None) -> str | None:
    year = int(g["Y"])
    if g.get("a"):
        first, second = int(g["a"]), int(g["b"])
        month, day = (first, second) if (locale or "").endswith("US") else (second, first)
    else:
        month, day = _MONTH[g["n"].lower()] if g.get("n") else int(g["m"]), int(g["d"])
    hour, minute, second = int(g["H"]), int(g["M"]), int(g["S"] or 0)
    half = (g.get("h1") or g.get("h2") or "").lower().replace(".", "").replace(" ", "")
    if half:
        if not 0 <= hour <= 12:
            if not (hour < 24 and half in AFTER_NOON):
                return None
        elif half in AFTER_NOON:
            hour = hour % 12 + 12
        else:
            hour %= 12
    at = datetime(year, month, day, hour, minute, second)
    if g.get("z"):
        offset = _offset(g["z"], zone_name)
        return None if offset is None else _text(at.replace(tzinfo=timezone(offset)))
    zone = _zone(zone_name)
    return _text(at.replace(tzinfo=zone)) if zone else None


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v, z, loc = (b.column(i).to_pylist() for i in range(3))
        out = pa.array([parse_instant(*x) for x in zip(v, z, loc, strict=True)], pa.string())
        yield pa.RecordBatch.from_arrays([*b.columns, out], names=["value", "zone", "locale", "utc_time"])


def instant_dictionary(raw: DataFrame, path: str | None = None) -> DataFrame:
    """(value, zone, locale, utc_time) of each distinct raw string of ``raw`` (value, zone, locale).

    With ``path`` the dictionary lives there as a table: strings it already holds are not parsed again, new ones are added. Two runs
    that add at the same time may both add a string; parsing is a function, so the entries are equal and one is read.
    """
    spark = raw.sparkSession
    ship_package(spark)
    keys = raw.select("value", "zone", "locale").distinct()
    schema = "value string, zone string, locale string, utc_time string"
    if path:
        entries = lambda: spark.read.schema(schema).parquet(path).groupBy("value", "zone", "locale").agg(F.max("utc_time").alias("utc_time"))
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            known = entries()
            same = [keys[c].eqNullSafe(known[c]) for c in ("value", "zone", "locale")]
            keys = keys.join(known, same, "left_anti")
        keys.mapInArrow(_parse_batches, schema).write.mode("append").parquet(path)
        return entries()
    return written(keys.mapInArrow(_parse_batches, schema), "instants")


def normalise_instants(rows: DataFrame, row_id: str, value: str, zone: str, locale: str, path: str | None = None) -> DataFrame:
    """(row_id, utc_time) of every row of ``rows``; utc_time is null where the value gives no instant."""
    quoted = lambda c: F.col(f"`{c}`")
    raw = rows.select(quoted(row_id).alias("row_id"), quoted(value).alias("value"), quoted(zone).alias("zone"), quoted(locale).alias("locale"))
    # A value without any digit of any script gives no instant: such rows, nulls among them, need no entry and no join.
    has_digit = F.coalesce(F.col("value").rlike(r"\p{Nd}|[\p{No}\p{Nl}]"), F.lit(False))
    digits = raw.where(has_digit)
    known = instant_dictionary(digits, path)
    same = [digits[c].eqNullSafe(known[c]) if c != "value" else digits[c] == known[c] for c in ("value", "zone", "locale")]
    found = digits.join(known, same, "left").select(digits["row_id"].alias(row_id), known["utc_time"])
    return found.unionByName(raw.where(~has_digit).select(F.col("row_id").alias(row_id), F.lit(None).cast("string").alias("utc_time")))

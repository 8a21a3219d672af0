from __future__ import annotations

import pytest

from reviewflow.operators.instants import instant_dictionary, normalise_instants, parse_instant

CASES = [
    ("2024-03-10 02:30:00", "America/New_York", "en-US", "2024-03-10T07:30:00Z"),  # skipped hour: the offset before the change
    ("2024-11-03 01:30:00", "America/New_York", "en-US", "2024-11-03T05:30:00Z"),  # hour that occurs twice: its first pass
    ("2024-11-03 01:30:00 EST", "America/New_York", "en-US", "2024-11-03T06:30:00Z"),
    ("2024-05-01 10:00:00 CST", "Asia/Shanghai", "zh-CN", "2024-05-01T02:00:00Z"),  # the abbreviation as used there
    ("02/03/2024 10:00", "America/New_York", "en-US", "2024-02-03T15:00:00Z"),
    ("02/03/2024 10:00", "Europe/London", "en-GB", "2024-03-02T10:00:00Z"),
    ("13/13/2024 10:00", "Europe/London", "en-GB", None),
    ("２０２４／０５／１２ ００：１０", "Asia/Shanghai", "zh-CN", "2024-05-11T16:10:00Z"),
    ("2025-05-19 下午4:49", "Asia/Shanghai", "zh-CN", "2025-05-19T08:49:00Z"),
    ("2024. 3. 28. 오전 12:02", "Asia/Seoul", "ko-KR", "2024-03-27T15:02:00Z"),
    ("1688044852963", None, None, "2023-06-29T13:20:52Z"),
    ("1703277561.17", None, None, "2023-12-22T20:39:21Z"),
    ("45564.5", "UTC", "en-US", "2024-09-29T12:00:00Z"),
    ("20240511115250", "Asia/Shanghai", "zh-CN", "2024-05-11T03:52:50Z"),
    ("Sun Nov 03 01:03:01 -0700 2024", "America/Los_Angeles", "en-US", "2024-11-03T08:03:01Z"),
    ("Mar 8, 2026 at 2:16 a.m.", "America/New_York", "en-US", "2026-03-08T07:16:00Z"),
    ("19/06/2023 às 03h46", "America/Sao_Paulo", "pt-BR", "2023-06-19T06:46:00Z"),
    ("2024-06-01", "UTC", "en-US", None), ("20240601", "UTC", "en-US", None), ("yesterday", "UTC", "en-US", None), ("3天前", "UTC", "zh-CN", None),
    ("2025-13-05 08:15", "UTC", "en-US", None), ("25:61", "UTC", "en-US", None), ("", "UTC", "en-US", None), (None, "UTC", "en-US", None),
    ("2024-06-01 10:00", None, None, None), ("2024-06-01 10:00", "No/Where", None, None), ("9" * 5000, "UTC", "en-US", None),
]


@pytest.mark.parametrize(("value", "zone", "locale", "expected"), CASES)
def test_parse(value, zone, locale, expected):
    assert parse_instant(value, zone, locale) == expected


def test_rows_come_back_whole(spark):
    rows = [(i, v, z, loc, "x", "y") for i, (v, z, loc, _) in enumerate(CASES * 2)]
    # Columns named like the operator's own must not matter.
    df = spark.createDataFrame(rows, "id long, raw string, tz string, loc string, utc_time string, value string")
    got = {r.id: r.utc_time for r in normalise_instants(df, "id", "raw", "tz", "loc").collect()}
    assert got == {i: e for i, (*_, e) in enumerate(CASES * 2)}
    assert normalise_instants(df.limit(0), "id", "raw", "tz", "loc").count() == 0


def test_dictionary_grows_only_by_new_strings(spark, tmp_path):
    path = f"file://{tmp_path}/dictionary"
    schema = "value string, zone string, locale string"
    one = spark.createDataFrame([("2024-06-01 10:00", "UTC", None), ("2024-06-01 10:00", "UTC", None)], schema)
    assert instant_dictionary(one, path).count() == 1
    two = one.union(spark.createDataFrame([("2024-06-01 11:00", "UTC", None)], schema))
    found = instant_dictionary(two, path).collect()
    assert sorted(r.utc_time for r in found) == ["2024-06-01T10:00:00Z", "2024-06-01T11:00:00Z"]

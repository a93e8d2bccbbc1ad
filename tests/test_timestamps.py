"""p1: literal cases, a brute-force comparison with the standard library, and edge tables."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from pagemill.operators import timestamps as ts
from pagemill.operators.timestamps import day_number, found_instants, parse_stamp


def utc(*a):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp())


@pytest.mark.parametrize(
    ("stamp", "zone", "order", "want"),
    [
        ("Thu, 31 Aug 2023 13:53:09 +1000", None, None, utc(2023, 8, 31, 3, 53, 9)),
        ("2024-10-27T03:34:51+01:00", None, None, utc(2024, 10, 27, 2, 34, 51)),
        ("2024-05-24T15:27:14.896Z", None, None, utc(2024, 5, 24, 15, 27, 14)),
        ("2024-02-10T10:00:00,5 +13:45", None, None, utc(2024, 2, 9, 20, 15)),
        ("20241220T055448+0100", None, None, utc(2024, 12, 20, 4, 54, 48)),
        ("2020-W47-6T15:15:15+05:45", None, None, utc(2020, 11, 21, 9, 30, 15)),
        ("2020-087T10:19:57+01:00", None, None, utc(2020, 3, 27, 9, 19, 57)),
        ("5 October 2022 10:16:20 UTC-7", None, None, utc(2022, 10, 5, 17, 16, 20)),
        ("1 April 2022 00:09:23 GMT+2", None, None, utc(2022, 3, 31, 22, 9, 23)),
        ("Sat, 18 Dec 2021 01:09:16 +0100 (EST)", None, None, utc(2021, 12, 18, 0, 9, 16)),
        ("Sun, 19 Jan 25 15:13:44 +0100", None, None, utc(2025, 1, 19, 14, 13, 44)),
        ("Mon, 16 Mar 2020 06:37:17 CST", "Asia/Shanghai", None, utc(2020, 3, 16, 12, 37, 17)),
        ("Sat, 16 May 2020 06:21:33 IST", "Asia/Kolkata", None, utc(2020, 5, 16, 0, 51, 33)),
        ("Sat, 16 May 2020 06:21:33 IST", None, None, None),
        ("2024-03-13T18:14:16+02:00[Asia/Tokyo]", None, None, utc(2024, 3, 13, 16, 14, 16)),
        ("2024-03-09 17:42:21 Europe/London", None, None, utc(2024, 3, 9, 17, 42, 21)),
        ("25. Juni 2020, 23:41 Uhr", "Europe/Berlin", None, utc(2020, 6, 25, 21, 41)),
        ("29 septembre 2021 à 14h10", "Europe/Paris", None, utc(2021, 9, 29, 12, 10)),
        ("27 de octubre de 2024, 12:07", "Europe/Madrid", None, utc(2024, 10, 27, 11, 7)),
        ("2 апреля 2024 г., 11:35", "Europe/Kaliningrad", None, utc(2024, 4, 2, 9, 35)),
        ("2025年1月26日 22時07分", "Asia/Tokyo", None, utc(2025, 1, 26, 13, 7)),
        ("March 19, 2020 12:31 a.m.", "UTC", None, utc(2020, 3, 19, 0, 31)),
        ("Dec 27, 2023 at 4:54PM", "UTC", None, utc(2023, 12, 27, 16, 54)),
        ("10/11/2021 14:03", "UTC", "dmy", utc(2021, 11, 10, 14, 3)),
        ("10/11/2021 14:03", "UTC", "mdy", utc(2021, 10, 11, 14, 3)),
        ("10/11/2021 14:03", "UTC", None, None),
        ("11.11.2021 14:03", "UTC", None, utc(2021, 11, 11, 14, 3)),
        ("10/31/2021 14:03", "UTC", None, utc(2021, 10, 31, 14, 3)),
        ("10/31/2021 14:03", "UTC", "dmy", None),
        ("Wed Jun 17 16:31:52 2020", "UTC", None, utc(2020, 6, 17, 16, 31, 52)),
        ("Sun, 16 Jul 2023  04:01:40 GMT", None, None, utc(2023, 7, 16, 4, 1, 40)),
        ("1712328214", None, None, 1712328214),
        ("1681877005847", None, None, 1681877005),
        ("1709030310838702", None, None, 1709030310),
        ("1625656861.76", None, None, 1625656861),
        ("2024-01-22T20:24:44", None, None, None),
        ("2024-03-31 02:30", "Europe/Berlin", None, None),  # does not occur
        ("2024-10-27 02:30", "Europe/Berlin", None, None),  # occurs twice
        ("2024-04-07T01:45:00", "Australia/Lord_Howe", None, None),  # half-hour clock change
        ("2023-02-30T10:00:00Z", None, None, None),
        ("2020-W54-1T00:00:00Z", None, None, None),
        ("2023-366T00:00:00Z", None, None, None),
        ("2020-11-28", "UTC", None, None),
        ("20201128", "UTC", None, None),
        ("12:30", "UTC", None, None),
        ("3 hours ago", "UTC", None, None),
        ("25:00 1 Jan 2020", "UTC", None, None),
        ("1 Jan 2020 24:00:00 GMT", None, None, None),
        ("13/13/2020 10:00", "UTC", None, None),
        ("", "UTC", None, None),
        (None, "UTC", None, None),
        ("x" * 100_000, "UTC", None, None),
    ],
)
def test_cases(stamp, zone, order, want):
    assert parse_stamp(stamp, zone, order) == want


@settings(max_examples=400, deadline=None)
@given(st.datetimes(datetime(1971, 1, 1), datetime(2099, 1, 1)), st.sampled_from(["Europe/Berlin", "America/St_Johns", "Australia/Lord_Howe", "Asia/Kathmandu", "America/Sao_Paulo", "UTC"]))
def test_local_time_against_brute_force(t, zone):
    t = t.replace(microsecond=0)
    z = ZoneInfo(zone)
    # every whole quarter hour of offset is tried; the instants whose local time is t are counted
    hits = [u for q in range(-60, 61) if (u := t.replace(tzinfo=timezone.utc) - timedelta(minutes=15 * q)).astimezone(z).replace(tzinfo=None) == t]
    assert parse_stamp(t.isoformat(), zone) == (int(hits[0].timestamp()) if len(hits) == 1 else None)


@given(st.dates())
def test_day_number(d):
    assert day_number(d.year, d.month, d.day) == d.toordinal() - 719163


def test_tables(spark):
    results = spark.createDataFrame([(1, "a", "2024-05-24T15:27:14Z", 1), (1, "a", "2024-05-24T15:27:14Z", 1), (2, None, "2024-05-24 15:27", 1), (3, "a", None, 1), (4, "a", "", 1), (None, "a", "1712328214", 1)], "result_id long, host string, published string, utc_second int")
    rss = spark.createDataFrame([(7, "a", "24/05/2024 10:00", "gestern")], "item_id long, host string, pub_date string, dc_date string")
    atom = spark.createDataFrame([], "entry_id long, host string, updated string")
    sites = spark.createDataFrame([("a", "Asia/Tokyo", "dmy", "x"), (None, "UTC", "dmy", "x"), ("b", None, None, "x")], "host string, tz_name string, date_order string, stamp string")
    got = {tuple(r) for r in found_instants(results, rss, atom, sites).collect()}
    assert got == {("result.published", 1, 1716564434), ("result.published", None, 1712328214), ("rss.pub_date", 7, 1716512400)}
    assert found_instants(results.limit(0), rss.limit(0), atom, sites.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("stamp", "plain", "extended"),
    [
        ("2024-05-06T07:08:09.123456789123Z", (1714979289, 123456789), (1714979289, 123456789)), ("1714979289.5", (1714979289, 500_000_000), (1714979289, 500_000_000)), ("1714979289123.25", (1714979289, 123_250_000), (1714979289, 123_250_000)),
        ("1714979289123456", (1714979289, 123_456_000), (1714979289, 123_456_000)), ("1714979289123456789", None, (1714979289, 123_456_789)), ("2016-12-31T23:59:60Z", None, (1483228800, 0)), ("2024-05-06T24:00Z", None, (1715040000, 0)),
        ("2024-05-06T24:00:01Z", None, None), ("Sun, 06 Nov 94 08:49:37 GMT", (utc(2094, 11, 6, 8, 49, 37), 0), (784111777, 0)), ("Sun, 06 Nov 24 08:49:37 GMT", (1730882977, 0), (1730882977, 0)),
    ],
)
def test_instants(stamp, plain, extended):
    assert ts.parse_instant(stamp) == plain and ts.parse_instant(stamp, extended=True) == extended


def test_fractions(spark):
    df = spark.createDataFrame([(1, "2024-05-06T07:08:09.5Z"), (2, None), (3, "no date")], "i long, s string")
    got = ts.normalise_stamps(df, F.col("s"), F.lit(None), F.lit(None), [F.col("i")], fractions=True).collect()
    assert [tuple(r) for r in sorted(got)] == [(1, 1714979289, 500_000_000), (2, None, None), (3, None, None)]

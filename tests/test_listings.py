"""Listings of feeds and search results by brute force, with the dates as Go's time.Parse reads their layouts."""

import calendar
import html
import re

import pytest
from pyspark.sql import functions as F

from pagemill.functions import text as tx
from pagemill.plans.reference import atom_page, feed_page, search_format, search_topk

MONTHS = [m.lower() for m in calendar.month_abbr]
CLOCK = r"(?:1?\d|0\d|2[0-3]):[0-5]\d:[0-5]\d(?:[.,]\d+)?"
ZONE = r"(?:[+-](?:[01]\d|2[0-4])(?:[0-5]\d|60)|UTC|GMT(?:[+-](?:1?\d|2[0-3]))?|[+-](?:[01]?\d|2[0-3])|ChST|MeST|[A-Z]{3}|[A-Z]{3}T|WITA|[A-Z]{4}T)"
RFC3339 = rf"(?P<y>\d{{4}})-(?P<m>\d\d)-(?P<d>\d\d)T{CLOCK}(?:Z|[+-](?:[01]\d|2[0-4]):(?:[0-5]\d|60))"
DATE, DATETIME = r"(?P<y>\d{4})-(?P<m>\d\d)-(?P<d>\d\d)", rf"(?P<y>\d{{4}})-(?P<m>\d\d)-(?P<d>\d\d) +{CLOCK}"
MAIL = rf"(?i:Mon|Tue|Wed|Thu|Fri|Sat|Sun), +(?P<d>DAY) +(?P<m>(?i:{'|'.join(MONTHS[1:])})) +(?P<y>\d{{4}}) +{CLOCK} +{ZONE}"
SHORT, FEED = (RFC3339, DATE, DATETIME, MAIL.replace("DAY", r"\d\d")), (RFC3339, DATE, MAIL.replace("DAY", r"\d\d?"))


def day(s: str, layouts) -> str | None:
    for m in filter(None, (re.fullmatch(p, s, re.A) for p in layouts)):
        month = int(m["m"]) if m["m"].isdigit() else MONTHS.index(m["m"].lower())
        if 1 <= month <= 12 and 1 <= int(m["d"]) <= (28 + (calendar.isleap(int(m["y"]))) if month == 2 else calendar.mdays[month]):
            return f"{m['y']}-{month:02}-{int(m['d']):02}"
    return None


def one_line(s: str | None, cap: int) -> str:
    s = " ".join((s or "").split())
    return s[:cap] + "…" if len(s) > cap else s


def feed_date(s: str | None) -> str:
    return day((s or "").strip(), FEED) or " ".join((s or "").split())


def summary(s: str | None) -> str:
    s = re.sub(r"(?is)<(script|style|noscript|template)\b.*?</(script|style|noscript|template)\s*>", "\n", s or "")
    return one_line(html.unescape(re.sub(r"(?s)<[^>]*>", " ", s)), 400)


def listing(entries: list[tuple]) -> str:
    texts = [f"\n- **{one_line(t, 300) or '(untitled)'}**" + (f" — {d}" if d else "") + "\n" + (f"  {u}\n" if u else "") + (f"  {s}\n" if s else "") for t, u, d, s in entries[:100]]
    return f"Feed with {len(entries)} entries{' (showing the first 100)' if len(entries) > 100 else ''}:\n{''.join(texts)}".strip()


@pytest.mark.parametrize(("query", "name", "key", "dates", "body"), [(feed_page, "rss_items", "item_id", ("pub_date", "dc_date"), "description"), (atom_page, "atom_entries", "entry_id", ("published", "updated"), "summary")])
def test_feeds(spark, small, query, name, key, dates, body):
    feeds: dict = {}
    for r in {r[key]: r for r in spark.read.parquet(f"{small}/{name}.parquet").orderBy(key).collect()}.values():
        feeds.setdefault(r.feed_url, []).append((r.title, r.link, feed_date(r[dates[0]] or r[dates[1]]), summary(r[body])))
    got = {r.feed_url: r.listing for r in query(spark, small).collect()}
    assert got == {k: listing(v) for k, v in feeds.items()}
    assert any("** — 20" in x for x in got.values())


STAMPS = ("Sat,  16 Jan 2021 07:34:26  +0530", "Sun,\xa016 Jul 2023 04:01:40 CST", "Sat, 9 Nov 2024 00:07:37 EST", "Sun, 16 Mar 2025 09:17:34 -0300", "2024-09-14T02:01:40Z", "2023-02-29", "1645826339", " 2021-09-22 ", "Sun, 30 Feb 2025 09:17:34 GMT", None, "", "28 March\n2021, 01:29")


def test_feed_dates(spark, small):
    """All stamps of the feeds, and a few more."""
    t = lambda n, c: [r[0] for r in spark.read.parquet(f"{small}/{n}.parquet").select(c).collect()]
    stamps = [*STAMPS, *t("rss_items", "pub_date"), *t("rss_items", "dc_date"), *t("atom_entries", "published"), *t("atom_entries", "updated")]
    got = spark.createDataFrame([(s,) for s in stamps], "s string").select("s", tx.feed_date(F.col("s")).alias("d")).collect()
    assert [(r.s, r.d) for r in got] == [(s, feed_date(s)) for s in stamps]


def short_date(s: str | None) -> str:
    return day((s or "").strip(), SHORT) or one_line(s, 300).encode()[:20].decode("utf-8", "replace")


def search_listing(query: str, results: list) -> str:
    out = 'Search results for "{}":\n'.format(query.replace('"', '\\"'))
    for i, r in enumerate(results, 1):
        date, snippet = short_date(r.published), one_line(r.snippet, 300)
        out += f"\n{i}. {one_line(r.title, 300)}" + (f" ({date})" if date else "") + f"\n   {one_line(r.url, 10**9)}\n" + (f"   {snippet}\n" if snippet else "")
    return out.strip()


def test_search_listings(spark, small):
    """The ranked results, each with the date of its stamp."""
    results = {r.result_id: r for r in spark.read.parquet(f"{small}/results.parquet").collect()}
    queries = {r.query_id: (r.query_text or "").strip() for r in spark.read.parquet(f"{small}/queries.parquet").collect()}
    lists: dict = {}
    for r in sorted(search_topk(spark, small).collect(), key=lambda r: r.place):
        lists.setdefault(r.query_id, []).append(results[r.result_id])
    got = {r.query_id: r.listing for r in search_format(spark, small).collect()}
    assert got == {k: search_listing(queries[k], v) for k, v in lists.items()}
    assert any(" (20" in x for x in got.values())


def test_short_dates(spark, small):
    stamps = [*STAMPS, "2022年6月7日 11時46分", "19 апреля 2021 г., 08:18", "2024-03-11  11:54:01", *(r[0] for r in spark.read.parquet(f"{small}/results.parquet").select("published").collect())]
    got = spark.createDataFrame([(s,) for s in stamps], "s string").select("s", tx.short_date(F.col("s")).alias("d")).collect()
    assert [(r.s, r.d) for r in got] == [(s, short_date(s)) for s in stamps]

"""Normalisation of written timestamps to UTC instants.

Every accepted format is one branch of a single compiled alternation whose
branches share group names, so a stamp is matched once and its components are
read once. Calendar ranges are then checked, and the instant is put together
from integer day arithmetic. Text never passes through a lenient date parser.

Results, case by case: null, empty and unrecognised stamps, impossible dates,
dates without a time and times without a date give null. A stamp without a zone
needs the zone of its host and gives null if that is unknown or if the local time
occurs twice or not at all there.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.session import bounded_broadcast

# Month names of the languages that stamps are written in.
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
    "january": 1, "february": 2, "march": 3, "april": 4, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "januar": 1, "jänner": 1, "februar": 2, "märz": 3, "mai": 5, "juni": 6, "juli": 7, "oktober": 10, "dezember": 12,
    "janvier": 1, "février": 2, "mars": 3, "avril": 4, "juin": 6, "juillet": 7, "août": 8, "septembre": 9, "octobre": 10, "novembre": 11, "décembre": 12,
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
    "января": 1, "февраля": 2, "марта": 3, "апреля": 4, "мая": 5, "июня": 6, "июля": 7, "августа": 8, "сентября": 9, "октября": 10, "ноября": 11, "декабря": 12,
}

# Zones of RFC 822 in minutes east of UTC; military letters other than Z denote nothing reliable.
RFC822_ZONES = {"UT": 0, "GMT": 0, "Z": 0, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420}

_DAY = r"(?P<d>\d{1,2})"
_NAME = r"(?P<mon>[^\W\d_]{3,12})\.?"
_WEEKDAY = r"(?:[^\W\d_]{2,12}\.?,? )?"
_TIME = r"(?P<H>\d{1,2}):(?P<M>\d{2})(?::(?P<S>\d{2})(?:[.,](?P<frac>\d+))?)?"
_TIME2 = r"(?P<H>\d{2}):(?P<M>\d{2})(?::(?P<S>\d{2})(?:[.,](?P<frac>\d+))?)?"
_AMPM = r" ?(?P<ap>[ap])\.?m\.?"
_OFFSET = r"(?P<sign>[+\-−])(?P<oh>\d{1,2})(?::?(?P<om>\d{2}))?"
_ISO_ZONE = rf"(?: ?(?:(?P<zulu>z)|{_OFFSET}))?(?: ?\[(?P<beside>[^\]]+)\]| (?P<region>[a-z_]+(?:/[a-z_+\-0-9]+)+)| (?P<abbr>[a-z]{{2,5}}))?"
_MAIL_ZONE = rf"(?: (?:(?:(?:gmt|utc|ut)(?=[+\-−]))?{_OFFSET}|(?P<region>[a-z_]+(?:/[a-z_+\-0-9]+)+)|(?P<abbr>[a-z]{{1,5}}))(?: ?\((?P<beside>[^)]*)\))?)?"

#: The branches, most specific first. Stamps reach them trimmed, with inner white space as single spaces.
_BRANCHES = (
    r"(?P<epoch>\d{10,19})(?:\.(?P<frac>\d*))?",
    rf"(?P<y>\d{{4}})(?P<sep>[-/])(?P<m>\d{{1,2}})(?P=sep)(?P<d>\d{{1,2}})(?:t| |, | at ){_TIME}{_ISO_ZONE}",
    rf"(?P<y>\d{{4}})(?P<m>\d{{2}})(?P<d>\d{{2}})[t ](?P<H>\d{{2}}):?(?P<M>\d{{2}})(?::?(?P<S>\d{{2}})(?:[.,](?P<frac>\d+))?)?{_ISO_ZONE}",
    rf"(?P<y>\d{{4}})-?w(?P<week>\d{{2}})-?(?P<wd>\d)[t ]{_TIME2}{_ISO_ZONE}",
    rf"(?P<y>\d{{4}})-?(?P<yd>\d{{3}})[t ]{_TIME2}{_ISO_ZONE}",
    rf"{_WEEKDAY}{_DAY}[ \-]{_NAME}[ \-](?P<y>\d{{4}}|\d{{2}}),? {_TIME}{_MAIL_ZONE}",
    rf"{_WEEKDAY}{_NAME} {_DAY} {_TIME} (?:(?P<abbr>[a-z]{{2,5}}) )?(?P<y>\d{{4}})",
    rf"{_WEEKDAY}{_NAME} {_DAY}(?:st|nd|rd|th)?,? (?P<y>\d{{4}}),?(?: at)? {_TIME}(?:{_AMPM})?{_MAIL_ZONE}",
    rf"{_WEEKDAY}{_DAY}\.? (?:de )?{_NAME} (?:de )?(?P<y>\d{{4}})(?: г\.?)?,?(?: (?:um|à|a las|в|at))? {_TIME}(?: uhr)?",
    rf"{_WEEKDAY}{_DAY}(?:er)? {_NAME} (?P<y>\d{{4}}),? à (?P<H>\d{{1,2}}) ?h ?(?P<M>\d{{2}})",
    r"(?P<y>\d{4})年 ?(?P<m>\d{1,2})月 ?(?P<d>\d{1,2})日 ?(?P<H>\d{1,2})時 ?(?P<M>\d{1,2})分(?: ?(?P<S>\d{1,2})秒)?",
    rf"(?P<n1>\d{{1,2}})(?P<sep>[-/.])(?P<n2>\d{{1,2}})(?P=sep)(?P<y>\d{{4}}|\d{{2}}),?(?: at)? {_TIME}(?:{_AMPM})?{_ISO_ZONE}",
)

_DAYS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)


def _compiled():
    import regex

    return regex.compile("|".join(f"(?:{b})" for b in _BRANCHES), regex.IGNORECASE | regex.VERSION0), regex.compile(r"\s+")


def day_number(y: int, m: int, d: int) -> int:
    """Days from 1970-01-01 to a date of the proleptic Gregorian calendar."""
    y -= m <= 2
    era_year = y % 400
    year_day = (153 * (m + (-3 if m > 2 else 9)) + 2) // 5 + d - 1
    return y // 400 * 146097 + era_year * 365 + era_year // 4 - era_year // 100 + year_day - 719468


def _leap(y: int) -> bool:
    return y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)


def _valid(y: int, m: int, d: int) -> bool:
    return y >= 1 and 1 <= m <= 12 and 1 <= d <= _DAYS[m - 1] + (m == 2 and _leap(y))


@lru_cache(maxsize=1024)
def _zone(name: str):
    """The offset changes of an IANA zone as (starts, offsets before and after, abbreviations), or None."""
    from datetime import datetime, timedelta, timezone
    from zoneinfo import ZoneInfo

    try:
        z = ZoneInfo(name)
    except Exception:  # not a zone: the stamp has no known zone
        return None
    utc, step = timezone.utc, timedelta(days=7)
    at, end = datetime(1969, 12, 1, tzinfo=utc), datetime(2100, 1, 1, tzinfo=utc)
    off = lambda t: int(t.astimezone(z).utcoffset().total_seconds())
    starts, offsets, names = [], [off(at)], {}
    while at < end:
        for t in (at,):
            if t.year >= 2000:
                names.setdefault(t.astimezone(z).tzname().upper(), off(t))
        nxt = at + step
        if off(nxt) != offsets[-1]:
            lo, hi = int(at.timestamp()), int(nxt.timestamp())
            while hi - lo > 1:
                mid = (lo + hi) // 2
                if off(datetime.fromtimestamp(mid, utc)) == offsets[-1]:
                    lo = mid
                else:
                    hi = mid
            starts.append(hi)
            offsets.append(off(nxt))
        at = nxt
    return starts, offsets, names


def _local_instant(local: int, zone: str | None) -> int | None:
    """The only UTC second at which clocks of ``zone`` show ``local``; None if there is none or more than one."""
    table = _zone(zone) if zone else None
    if table is None:
        return None
    starts, offsets, _ = table
    found = None
    k = bisect_right(starts, local)
    for i in range(max(0, k - 1), min(len(starts), k + 1) + 1):
        t = local - offsets[i]
        if (i == 0 or t >= starts[i - 1]) and (i == len(starts) or t < starts[i]):
            if found is not None:
                return None
            found = t
    return found


def parse_stamp(stamp: str | None, tz_name: str | None = None, date_order: str | None = None) -> int | None:
    """The whole UTC second that one stamp denotes, or None if it doesn't denote exactly one."""
    found = parse_instant(stamp, tz_name, date_order)
    return None if found is None else found[0]


def parse_instant(stamp: str | None, tz_name: str | None = None, date_order: str | None = None, extended: bool = False, _re: list = []) -> tuple[int, int] | None:
    """(UTC second, nanoseconds) that one stamp denotes, or None if it doesn't denote exactly one. Digits beyond nanoseconds are cut off.

    ``extended`` reads more: a leap second as the second after it, 24:00 as the next day's
    midnight, bare numbers of nanoseconds, and two-digit years from 50 on as 19xx.
    """
    second = _second_of(stamp, tz_name, date_order, extended, _re)
    if second is None:
        return None
    g = second[1]
    nanos = int(((g["frac"] or "") + "0" * 9)[:9])
    if g["epoch"]:
        n = len(g["epoch"])
        digits = 0 if n < 12 else 3 if n < 15 else 6 if n < 18 else 9
        nanos = int((g["epoch"][n - digits :] + (g["frac"] or "") + "0" * 9)[:9])
    return second[0], nanos


def _second_of(stamp: str | None, tz_name: str | None, date_order: str | None, extended: bool, _re: list) -> tuple[int, dict] | None:
    if not stamp:
        return None
    if not _re:
        _re.extend(_compiled())
    g = _re[0].fullmatch(_re[1].sub(" ", stamp).strip())
    if g is None:
        return None
    g = g.groupdict()
    if g["epoch"]:
        n = g["epoch"]
        if len(n) > 17:
            return (int(n) // 1_000_000_000, g) if extended else None
        return int(n) // (1 if len(n) < 12 else 1_000 if len(n) < 15 else 1_000_000), g
    y = int(g["y"])
    if len(g["y"]) == 2:
        y += 1900 if extended and y >= 50 else 2000
    hour, minute, second = int(g["H"]), int(g["M"]), int(g["S"] or 0)
    if g["ap"]:
        if not 1 <= hour <= 12:
            return None
        hour = hour % 12 + 12 * (g["ap"] in "pP")
    later = 0
    if extended and hour == 24 and minute == second == 0 and not int(g["frac"] or 0):
        hour, later = 0, 86400
    if extended and second == 60 and minute == 59:
        second, later = 59, later + 1
    if hour > 23 or minute > 59 or second > 59:
        return None
    if g["yd"]:
        if not 1 <= int(g["yd"]) <= 365 + _leap(y):
            return None
        day = day_number(y, 1, 1) + int(g["yd"]) - 1
    elif g["week"]:
        jan4 = day_number(y, 1, 4)
        first = jan4 - (jan4 + 3) % 7  # the Monday of week 1
        week, wd = int(g["week"]), int(g["wd"])
        nxt = day_number(y + 1, 1, 4)
        if not (1 <= wd <= 7 and week >= 1 and first + 7 * (week - 1) < nxt - (nxt + 3) % 7):
            return None
        day = first + 7 * (week - 1) + wd - 1
    elif g["n1"]:
        a, b = int(g["n1"]), int(g["n2"])
        days = set()
        if date_order != "mdy" and _valid(y, b, a):
            days.add(day_number(y, b, a))
        if date_order != "dmy" and _valid(y, a, b):
            days.add(day_number(y, a, b))
        if len(days) != 1:
            return None
        day = days.pop()
    else:
        m = int(g["m"]) if g["m"] else MONTHS.get(g["mon"].lower())
        if m is None or not _valid(y, m, int(g["d"])):
            return None
        day = day_number(y, m, int(g["d"]))
    local = day * 86400 + hour * 3600 + minute * 60 + second
    utc = _utc_of(local, g, tz_name)
    return None if utc is None else (utc + later, g)


def _utc_of(local: int, g: dict, tz_name: str | None) -> int | None:
    """A local second in UTC by what the stamp says of its zone, else by its site's zone."""
    if g["zulu"]:
        return local
    if g["sign"]:
        oh, om = int(g["oh"]), int(g["om"] or 0)
        if oh > 15 or om > 59:
            return None
        return local - (1 if g["sign"] == "+" else -1) * (oh * 3600 + om * 60)
    named = g["region"] or g["beside"]
    if named and not g["abbr"]:
        return local if named.upper() in ("UTC", "GMT", "Z") else _local_instant(local, named)
    if g["abbr"]:
        abbr = g["abbr"].upper()
        if abbr == "UTC":
            return local
        if abbr in RFC822_ZONES:
            return local - RFC822_ZONES[abbr] * 60
        table = _zone(tz_name) if tz_name else None
        offset = table[2].get(abbr) if table else None
        return None if offset is None else local - offset
    return _local_instant(local, tz_name)


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        stamps, zones, orders = (b.column(i).to_pylist() for i in range(3))
        out = pa.array([parse_stamp(*x) for x in zip(stamps, zones, orders)], pa.int64())
        yield pa.RecordBatch.from_arrays([*b.columns[3:], out], names=[*b.schema.names[3:], "utc_second"])


def _instant_batches(extended: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [parse_instant(*x, extended) for x in zip(*(b.column(i).to_pylist() for i in range(3)))]
            cols = [pa.array([f and f[0] for f in found], pa.int64()), pa.array([f and f[1] for f in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([*b.columns[3:], *cols], names=[*b.schema.names[3:], "utc_second", "nanos"])

    return run


def normalise_stamps(df: DataFrame, stamp: Column, tz_name: Column, date_order: Column, keep: list[Column], fractions: bool = False, extended: bool = False) -> DataFrame:
    """The columns ``keep`` and ``utc_second`` (long, null where the stamp isn't one instant), a row for each row of ``df``.

    With ``fractions`` there is ``nanos`` (int), too; ``extended`` is that of ``parse_instant``.
    """
    picked = df.select(stamp.cast("string").alias("__stamp"), tz_name.cast("string").alias("__zone"), date_order.cast("string").alias("__order"), *keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[3:])
    if fractions or extended:
        found = picked.mapInArrow(_instant_batches(extended), f"{schema}, utc_second long, nanos int")
        return found if fractions else found.drop("nanos")
    return picked.mapInArrow(_parse_batches, f"{schema}, utc_second long")


def found_instants(results: DataFrame, rss_items: DataFrame, atom_entries: DataFrame, sites: DataFrame) -> DataFrame:
    """One row (field_name, rec_id, utc_second) for each stamp of the three tables that denotes one instant.

    Repeated rows count once. Hosts that are null or not in ``sites`` leave zone and
    date order unknown. ``sites`` is broadcast only if it is small.
    """
    parts = [
        results.select(F.lit("result.published").alias("field_name"), F.col("result_id").alias("rec_id"), "host", F.col("published").alias("stamp")),
        rss_items.select(F.lit("rss.pub_date").alias("field_name"), F.col("item_id").alias("rec_id"), "host", F.col("pub_date").alias("stamp")),
        rss_items.select(F.lit("rss.dc_date").alias("field_name"), F.col("item_id").alias("rec_id"), "host", F.col("dc_date").alias("stamp")),
        atom_entries.select(F.lit("atom.updated").alias("field_name"), F.col("entry_id").alias("rec_id"), "host", F.col("updated").alias("stamp")),
    ]
    stamps = parts[0]
    for p in parts[1:]:
        stamps = stamps.unionByName(p)
    zones = sites.groupBy("host").agg(F.min("tz_name").alias("tz_name"), F.min(F.lower("date_order")).alias("date_order"))
    joined = stamps.where("stamp is not null and stamp <> ''").join(bounded_broadcast(zones), "host", "left")
    parsed = normalise_stamps(joined, F.col("stamp"), F.col("tz_name"), F.col("date_order"), [F.col("field_name"), F.col("rec_id")])
    return parsed.where("utc_second is not null").distinct()

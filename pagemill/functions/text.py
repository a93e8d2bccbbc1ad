"""Line-safe text: white space, caps, plain text of markup, sizes and dates, as Column expressions.

Null counts as the empty string everywhere. Lengths are code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: Unicode white space, written out as a class that Java and RE2 read alike.
SPACE = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def trim_space(c: Column) -> Column:
    return F.regexp_replace(text(c), f"^{SPACE}+|{SPACE}+$", "")


def one_line(c: Column, cap: int | None = None) -> Column:
    """White space collapsed, and cut after ``cap`` characters with an ellipsis."""
    flat = trim_space(F.regexp_replace(text(c), f"{SPACE}+", " "))
    return flat if cap is None else F.when(F.length(flat) > cap, F.concat(F.substring(flat, 1, cap), F.lit("…"))).otherwise(flat)


def title_line(c: Column) -> Column:
    return one_line(c, 300)


#: Fixed value: the length limit of rendered text.
RENDER_CAP = 500_000


def cap_text(c: Column, cap: int = RENDER_CAP) -> Column:
    """The struct (text, capped): text beyond the cap is cut, with a note."""
    note = F.lit(f"\n\n…[Markdown output capped at {cap} runes]")
    over = F.length(text(c)) > cap
    return F.struct(F.when(over, F.concat(F.substring(text(c), 1, cap), note)).otherwise(text(c)).alias("text"), over.alias("capped"))


def plain_of_markup(c: Column) -> Column:
    """Readable text of markup without a parser: scripts out, tags to spaces, common references resolved, lines trimmed."""
    s = F.regexp_replace(text(c), r"(?is)<(script|style|noscript|template)\b.*?</(script|style|noscript|template)\s*>", "\n")
    s = F.regexp_replace(s, r"(?s)<[^>]*>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        s = F.replace(s, F.lit(name), F.lit(char))
    s = F.regexp_replace(s, r"[ \t]+", " ")
    s = F.regexp_replace(s, r"(?m)^ +| +$", "")
    return trim_space(F.regexp_replace(s, r"\n{3,}", "\n\n"))


def human_bytes(c: Column) -> Column:
    step = lambda k, unit: F.format_string(f"%.1f {unit}", F.bround(c.cast("double") / F.lit(float(1024**k)), 1))
    return (
        F.when(c < 1024, F.concat(c.cast("string"), F.lit(" B"))).when(c < 1024**2, step(1, "KiB")).when(c < 1024**3, step(2, "MiB")).when(c < 1024**4, step(3, "GiB")).otherwise(step(4, "TiB"))
    )


#: English month names of mail dates.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
_RFC3339 = r"^(\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01]))T(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:[.,]\d+)?(?:Z|[+-](?:[01]\d|2[0-3]):[0-5]\d)$"
_DATE = r"^(\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01]))$"
_DATETIME = r"^(\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])) +(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:[.,]\d+)?$"
_MAIL = r"^(?i:Mon|Tue|Wed|Thu|Fri|Sat|Sun), +(\d{2}) +(?i:(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)) +(\d{4}) +(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d +(?:[+-]\d{4}|GMT[+-]\d{1,2}|[+-]\d{2}|ChST|MeST|WITA|[A-Z]{3}|[A-Z]{3,4}T)$"


def _real(day: Column) -> Column:
    return F.when(F.try_to_date(day, "yyyy-MM-dd").isNotNull(), day)


def _lexical_date(s: Column, patterns: list[str], mail: str) -> Column:
    found = [F.when(s.rlike(p), _real(F.regexp_extract(s, p, 1))) for p in patterns]
    month = F.lpad(F.array_position(F.array(*map(F.lit, MONTHS)), F.initcap(F.regexp_extract(s, mail, 2))).cast("string"), 2, "0")
    day = F.lpad(F.regexp_extract(s, mail, 1), 2, "0")
    return F.coalesce(*found, F.when(s.rlike(mail), _real(F.concat_ws("-", F.regexp_extract(s, mail, 3), month, day))))


def short_date(c: Column) -> Column:
    """The calendar date a search result's stamp is written with; other text stays, on one line, up to 20 bytes; a character that this cuts in two becomes U+FFFD."""
    s = trim_space(c)
    return F.coalesce(_lexical_date(s, [_RFC3339, _DATE, _DATETIME], _MAIL), F.make_valid_utf8(F.substring(one_line(s, 300).cast("binary"), 1, 20).cast("string")))


def feed_date(c: Column) -> Column:
    """The calendar date of a feed entry's stamp; one-digit days are accepted, other text stays on one line."""
    s = trim_space(c)
    return F.coalesce(_lexical_date(s, [_RFC3339, _DATE], _MAIL.replace(r"(\d{2}) +(?i:", r"(\d{1,2}) +(?i:")), one_line(s))

"""Separating the main body of web pages from what surrounds it, by template deduction.

A page is a sequence of lines; a line's token is its visible text with digits
masked, a line of the form "label: ..." or "start › ..." also has the token of that
label. Over the pages of a host:

1. ``page_rows`` parses each page once and keeps hashes of its lines' tokens with
   their places; no text leaves the parse. ``host_tokens`` gives each token's occurrence
   vector (as a hash over the pages it stands on and how often).
2. Tokens of a host with one vector form an equivalence class. A class is valid if it is
   large, has support among the host's pages, and is *ordered*: its tokens follow each
   other in one order on the pages they share. A class too small to prove itself is
   valid if it is *nested*: it keeps to one side of the main slot on the pages that have
   it, or stands as a short line within the slot.
3. Classes that hold paragraphs and stand within the main slot are content that stands on
   several pages (a print version, a second address), not template, unless a large share of
   the host's pages has them. What valid classes of many of the hosts that have it agree
   on is template on the other hosts, too.
4. The template nests around the page's main slot: the slot opens at the headline and
   closes at the first template token after which pages have no further body. What
   remains are the slots: lines outside the main slot are dropped, and inside it those
   that are tokens of the template themselves.

All steps are joins and aggregations of hashes by host and token; a host of any size is
spread over tasks, and no step moves a page's text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, chain

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.documents.charset import decode
from pagemill.llm.lookalikes import clean, prototype
from pagemill.operators.pages import gunzip
from pagemill.session import BROADCAST_LIMIT, bounded_broadcast, stored

#: Share of a host's pages, and the fewest pages, that make a small class' support.
SHARE, PAGES = 0.045, 3
#: Tokens from which a class is large; it needs the share, but two pages only.
CLASS_SIZE = 3
#: Share of the pages of a large class on which its tokens must have one order.
ORDERED = 0.9
#: Share of a token's pages on which it must be on one side of the main slot to be nested outside it.
NESTED = 0.9
#: Share of a host's pages from which paragraphs within the main slot are template.
PARAGRAPHS = 0.3
#: Share of the hosts which have a token (on two pages or more) that must find it valid for it to be valid everywhere.
LENT = 0.1
#: Share of the pages of the hosts that have it, from which a token of many hosts is valid.
POOLED = 0.03
#: Share of its pages on which no body may follow a token that closes the main slot.
CLOSING = 0.93
#: Characters from which a line is too long to vary in a name only, and to be kept for when it comes again.
SHORT = 120
#: Share of its occurrences in a headline, or next after it, from which a label belongs to the content.
TITLE, BYLINE = 0.01, 0.5

_TAG = re.compile(r"<[^>]*>")
_HIDDEN = re.compile(r"<(script|style|title|noscript)\b.*?(?:</\1>|$)", re.I | re.S)
_LINK = re.compile(r"!?\[((?:[^\[\]]|\[[^\]]*\])*)\]\([^()\s]*(?:\s+\"[^\"]*\")?\)")
_MARK = re.compile(r"^\s*(?:[-+*•]\s+|\d{1,3}[.)]\s+|#{1,6}\s+|>\s?)+")
_RULE = re.compile(r"^[\s*_=\-|:+~`>#]*$")
_DIGITS = re.compile(r"\d+")
_LABEL = re.compile(r"^([^:：|›»]{1,28}?\S)\s?[:：](?=\s|[^\x00-\x7f])")
_TRAIL = re.compile(r"^([^›»/|]{1,30}?) [›»/] ")
_NAME = re.compile(r"\b[A-Z][\w’']*")
_SMALL_WORD = re.compile(r"\b[a-zß-ÿ]\w*")
_STOP = re.compile(r"[.!?…](?=\s|$)|[。！？]")
_H1 = re.compile(r"<h1\b", re.I)


@dataclass(slots=True)
class Line:
    no: int
    text: str
    heading: bool
    held: bool  # tables, images, quotations and code belong to the content whatever they say
    code: bool = False


def page_text(markdown: str | None, raw_gzip: bytes | None, content_type: str | None) -> tuple[str | None, bool]:
    """(the page's text, whether it is HTML): the markdown, or where that is null the decompressed and decoded body."""
    if markdown is not None:
        return markdown, False
    if raw_gzip is None:
        return None, False
    body = gunzip(raw_gzip)
    if body is None:
        return None, True
    return decode(body, content_type), True


def token_of(text: str) -> str:
    return _DIGITS.sub("0", text.casefold())


def page_lines(text: str, is_html: bool) -> list[Line]:
    """The lines that show text, split at U+000A only and numbered from 0."""
    out, fenced, hidden = [], False, None
    for no, raw in enumerate(text.split("\n")):
        if not raw:
            continue
        held = heading = code = False
        if is_html:
            if hidden:
                end = raw.lower().find(f"</{hidden}")
                if end < 0:
                    continue
                raw, hidden = raw[end:], None
            for m in _HIDDEN.finditer(raw):
                if not m[0].lower().endswith(f"</{m[1].lower()}>"):
                    hidden = m[1].lower()
            heading = bool(_H1.search(raw))
            low = raw.lstrip()[:12].lower()
            held = low.startswith(("<tr", "<td", "<th", "<pre", "<code", "<blockquote", "<img", "<figure", "<table"))
            code = low.startswith(("<pre", "<code"))
            shown = html.unescape(_TAG.sub(" ", _HIDDEN.sub("", raw)))
        elif raw[0].isalpha():
            held = code = fenced
            shown = _LINK.sub(r"\1", raw) if "](" in raw else raw
        else:
            if raw.lstrip().startswith("```"):
                fenced = not fenced
                continue
            heading = raw.startswith("# ")
            code = fenced or raw.startswith(("    ", "\t"))
            held = fenced or raw.startswith(("|", "    ", "\t", ">", "[image:", "!["))
            shown = _LINK.sub(r"\1", raw) if "](" in raw else raw
            shown = _MARK.sub("", shown) if not fenced else shown
            if _RULE.match(shown):
                continue
        shown = " ".join(shown.split())
        if shown:
            out.append(Line(no, shown, heading, held, code))
    return out


def label_of(text: str) -> str | None:
    """The token of the label or trail with which a line begins."""
    m, trail = _LABEL.match(text), _TRAIL.match(text)
    return token_of(trail[1]) + " ›" if trail else token_of(m[1]) + ":" if m else None


def headline_at(lines: list[Line], title: str | None) -> int | None:
    """The line that is the page's headline: marked as such, else equal to the title."""
    for i, x in enumerate(lines):
        if x.heading:
            return i
    if title:
        want = prototype(clean(title)).casefold()
        for i, x in enumerate(lines):
            if want and prototype(clean(x.text)).casefold() == want:
                return i
    return None


def is_body(text: str) -> bool:
    """A paragraph of the kind that main text has: several sentences, or one long."""
    size = len(text.encode("utf-8", "replace"))
    return size > 260 or size >= 95 and _STOP.search(text.rstrip(" .!?…。！？")) is not None


_NUMBER_BEFORE = re.compile(r"^[(（]?(?:[^\W\d]+\.?º? ?)?[#№]?\s?0[)）]?\s?[号號]?[:：]?\s")
_NUMBER_AFTER = re.compile(r"\s(?:[(（]0[)）]|(?:[^\W\d]+\.?[º°]?\s?)?[#№°]?\s?0|第0[号號]|n\.?\s?[º°]\s?0)$")


def headline_core(token: str) -> str:
    """A headline's token without the number that sets it apart from others of its kind."""
    return _NUMBER_AFTER.sub("", _NUMBER_BEFORE.sub("", token)).strip()


def masked(text: str) -> str | None:
    """The token with names masked too, for lines that vary in a name only; None if little else is left."""
    if len(text) >= SHORT:
        return None
    slots, n = _NAME.subn("N", text)
    return "~" + token_of(slots) if n and len(_SMALL_WORD.findall(slots)) >= 2 else None


def core_text(text: str) -> str:
    """``headline_core`` with letters as written."""
    return _NUMBER_AFTER.sub("", _NUMBER_BEFORE.sub("", _DIGITS.sub("0", text))).strip()


def hash_of(token: str) -> int:
    """A token as a signed 64-bit number: what is compared and kept of it."""
    h = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _line_hashes(text: str) -> tuple[tuple[int, ...], bool]:
    return tuple(hash_of(t) for t in (token_of(text), label_of(text), masked(text)) if t), is_body(text)


_short_line_hashes = lru_cache(maxsize=50_000)(_line_hashes)


def line_hashes(text: str) -> tuple[tuple[int, ...], bool]:
    """(hashes of the line's token and of its other tokens, whether it is a body); templates repeat short lines, which are kept."""
    return _short_line_hashes(text) if len(text) < SHORT else _line_hashes(text)


#: Bits of a line and of a token's places on a page.
BEFORE, TOP, AFTER_TOP, HELD, BODY, CODE, CLOSES = 1, 2, 4, 8, 16, 32, 64

#: What a caller may compute of each line besides: a number and hashes.
Extra = Callable[[Line], tuple[int, Sequence[int]]]

PAGE = pa.schema([
    ("is_html", pa.bool_()), ("page_id", pa.int64()), ("host", pa.int64()), ("page", pa.int64()), ("doc", pa.int64()),
    ("seen", pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int32()), ("first", pa.int32()), ("bits", pa.int32())]))),
    ("lines", pa.list_(pa.struct([("no", pa.int32()), ("bits", pa.int32()), ("tokens", pa.list_(pa.int64())), ("extra", pa.int32()), ("hashes", pa.list_(pa.int64()))]))),
])
ROWS = "is_html boolean, page_id long, host long, page long, doc long, seen array<struct<token: long, n: int, first: int, bits: int>>, lines array<struct<no: int, bits: int, tokens: array<long>, extra: int, hashes: array<long>>>"


def parsed_page(text: str, is_html: bool, title: str | None, extra: Extra | None = None) -> tuple[dict[int, list[int]], list[tuple]]:
    """(what each token does on the page: token -> n, first, bits; the page's lines: no, bits, tokens, extra, hashes)."""
    lines = page_lines(text, is_html)
    top = headline_at(lines, title)
    told = [line_hashes(x.text) for x in lines]
    bodies = [i for i, (_, body) in enumerate(told) if body]
    last = bodies[-1] if bodies else -1
    opens = top if top is not None else bodies[0] if bodies else 0
    seen: dict[int, list[int]] = {}
    out = []
    for i, (x, (names, body)) in enumerate(zip(lines, told)):
        bits = (HELD if x.held else 0) | (BODY if body else 0) | (CODE if x.code else 0)
        if top is not None and i <= top + 1:
            bits |= BEFORE if i < top else TOP if i == top else AFTER_TOP
        tokens = names[:1] if body else names
        if i == top:
            core = headline_core(token_of(x.text))
            names += tuple(hash_of(t) for t in (core, masked(core_text(x.text)) if core else None) if t)
        # a token closes the slot of this page if it stands after the headline and no body follows it
        keep = (CLOSES if i > last and (top is None or i > top) else 0) | (BEFORE if i < opens else 0) | TOP | AFTER_TOP | BODY
        more = bits & (TOP | AFTER_TOP | BODY)
        for t in set(names):
            v = seen.get(t)
            if v is None:
                v = seen[t] = [0, i, CLOSES | BEFORE]
            v[0] += 1
            v[2] = (v[2] | more) & keep
        number, hashes = extra(x) if extra else (0, ())
        out.append((x.no, bits, tokens, number, hashes))
    return seen, out


def _lists(values: list, kind: pa.ListType) -> pa.ListArray:
    """The array of ``kind`` of lists of numbers or of structs, which come as tuples; column by column, without an object for each struct."""
    offsets, flat = pa.array([0, *accumulate(map(len, values))], pa.int32()), list(chain.from_iterable(values))
    inner = kind.value_type
    if not pa.types.is_struct(inner):
        return pa.ListArray.from_arrays(offsets, pa.array(flat, inner))
    columns = list(zip(*flat)) or [()] * inner.num_fields
    parts = [_lists(c, f.type) if pa.types.is_list(f.type) else pa.array(c, f.type) for c, f in zip(columns, inner)]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(parts, fields=list(inner)))


def _page_batches(extra: Extra | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for page_id, host, page, title, markdown, raw, kind in zip(*(b.column(i).to_pylist() for i in range(7))):
                text, is_html = page_text(markdown, raw, kind)
                if text is not None:
                    seen, lines = parsed_page(text, is_html, title, None if is_html else extra)
                    rows.append((is_html, page_id, host, page, hash_of(f"{page_id} {host} {is_html} {title} {text}"), [(t, *v) for t, v in seen.items()], lines))
            columns = list(zip(*rows)) or [()] * len(PAGE)
            yield pa.RecordBatch.from_arrays([_lists(c, f.type) if pa.types.is_list(f.type) else pa.array(c, f.type) for c, f in zip(columns, PAGE)], schema=PAGE)

    return run


def _host() -> "F.Column":
    return F.xxhash64(F.coalesce("host", F.lit("")))


def _page() -> "F.Column":
    return F.xxhash64(F.coalesce("cache_key", F.col("page_id").cast("string")))


def page_rows(pages: DataFrame, extra: Extra | None = None) -> DataFrame:
    """A row of hashes for each page that has text; ``page`` is one for the copies of a page under one cache_key."""
    named = pages.select("page_id", _host().alias("host"), _page().alias("page"), "title", "markdown", "raw_gzip", "content_type")
    return named.mapInArrow(_page_batches(extra), ROWS)


def _occurrences(rows: DataFrame) -> DataFrame:
    """(host, token, page, n, first, bits), once for each page; of several versions of a page the fullest counts."""
    each = rows.select("host", "page", F.explode("seen").alias("s")).select("host", "page", "s.*")
    both = lambda bit: F.when(F.bool_and(F.col("bits").bitwiseAND(bit) != 0), bit).otherwise(0)
    some = lambda bit: F.when(F.bool_or(F.col("bits").bitwiseAND(bit) != 0), bit).otherwise(0)
    bits = both(CLOSES) + both(BEFORE) + some(TOP) + some(AFTER_TOP) + some(BODY)
    return each.groupBy("host", "token", "page").agg(F.max("n").alias("n"), F.min("first").alias("first"), bits.alias("bits"))


def host_tokens(rows: DataFrame) -> DataFrame:
    """Each token of each host with its occurrence vector (hashed) and what is known of its places."""
    count = lambda bit, name: F.count_if(F.col("bits").bitwiseAND(bit) != 0).alias(name)
    return _occurrences(rows).groupBy("host", "token").agg(
        F.count("*").alias("pages"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"), count(TOP, "headline"), count(AFTER_TOP, "byline"), count(CLOSES, "closing"), count(BEFORE, "before"), count(BODY, "body")
    )


def classes(kept: DataFrame, rows: DataFrame, pages_of_host: DataFrame) -> DataFrame:
    """(host, token) of the tokens of valid classes; see the module's steps 2 and 3."""
    outside = F.greatest("closing", "before") >= NESTED * F.col("pages")
    several = kept.where("pages >= 2").join(bounded_broadcast(pages_of_host), "host")
    grouped = several.groupBy("host", "vector").agg(F.count("*").alias("size"), F.max("pages").alias("support"), F.max("of_host").alias("of_host"), F.bool_or((F.col("body") > 0) & ~outside).alias("paragraphs"))
    supported = grouped.where((F.col("support") >= SHARE * F.col("of_host")) & (~F.col("paragraphs") | (F.col("support") >= PARAGRAPHS * F.col("of_host"))))
    members = several.join(supported.select("host", "vector", "size"), ["host", "vector"]).select("host", "token", "vector", "size", "pages", (outside | (F.col("body") == 0)).alias("nested"), F.col("of_host"))
    large = members.where(F.col("size") >= CLASS_SIZE)
    placed = _occurrences(rows).join(large.select("host", "token", "vector"), ["host", "token"])
    sequence = placed.groupBy("host", "vector", "page").agg(F.xxhash64(F.array_sort(F.collect_list(F.struct("first", "token")))["token"]).alias("sequence"))
    orders = sequence.groupBy("host", "vector", "sequence").agg(F.count("*").alias("n")).groupBy("host", "vector").agg((F.max("n") >= ORDERED * F.sum("n")).alias("ordered"))
    valid = F.coalesce("ordered", F.lit(False)) | (F.col("nested") & (F.col("pages") >= PAGES)) | (F.col("pages") >= F.greatest(F.lit(float(PAGES)), PARAGRAPHS * F.col("of_host")))
    return members.join(orders, ["host", "vector"], "left").where(valid).select("host", "token")


def templates(rows: DataFrame, pages_of_host: DataFrame) -> DataFrame:
    """(host, token, closes): the tokens of each host's template."""
    kept = stored(host_tokens(rows))
    valid = stored(classes(kept, rows, pages_of_host))
    named = valid.groupBy("token").agg(F.count("*").alias("hosts_valid"))
    # what a valid token does on all hosts that have it, valid there or not
    pooled = kept.join(named, "token").join(bounded_broadcast(pages_of_host), "host").groupBy("token").agg(
        F.max("hosts_valid").alias("hosts_valid"), F.count_if(F.col("pages") >= 2).alias("hosts"), F.sum("pages").alias("all_pages"), F.sum("of_host").alias("all_of_host"),
        F.sum("headline").alias("all_headline"), F.sum("byline").alias("all_byline"), F.sum("closing").alias("all_closing"),
    )
    content = (F.col("all_headline") >= TITLE * F.col("all_pages")) | (F.col("all_byline") >= BYLINE * F.col("all_pages"))
    anywhere = (F.col("hosts_valid") >= 2) & (F.col("hosts_valid") >= LENT * F.col("hosts")) & (F.col("all_pages") >= POOLED * F.col("all_of_host"))
    good = pooled.where(~content).select("token", anywhere.alias("anywhere"), (F.col("all_closing") >= CLOSING * F.col("all_pages")).alias("closes"))
    own = valid.join(good, "token").select("host", "token", "closes")
    lent = kept.select("host", "token").join(good.where("anywhere"), "token").select("host", "token", "closes")
    return own.unionByName(lent).distinct()


def classified_lines(pages: DataFrame, extra: Extra | None = None, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """(field_name, page_id, host, line_no, bits, drop, extra, hashes) of every line that shows text.

    ``pages`` has page_id, host, cache_key, title, content_type, markdown and raw_gzip;
    ``host`` comes out as its hash. ``extra`` gives a number and hashes of each line of
    markdown. Repeated rows give one set of lines. Pages without text have no lines; null
    hosts are one host. Without a template (one page, no other host like it) only what
    stands before the headline is dropped. The template is broadcast within ``limit``
    bytes; beyond it, the hashes are shuffled to it, and texts never are.
    """
    pages = pages.select("page_id", "host", "cache_key", "title", "content_type", "markdown", "raw_gzip")
    pages_of_host = stored(pages.groupBy(_host().alias("host")).agg(F.count_distinct(_page()).alias("of_host")))
    rows = stored(page_rows(pages, extra))
    template = stored(templates(rows, pages_of_host))
    lines = rows.select("is_html", "page_id", "host", "doc", F.explode("lines").alias("l")).select("is_html", "page_id", "host", "doc", "l.*")
    each = lines.select("is_html", "page_id", "host", "doc", "no", "bits", "extra", "hashes", F.explode_outer("tokens").alias("token"))
    joined = each.join(bounded_broadcast(template, limit), ["host", "token"], "left").repartition("doc")
    named = joined.groupBy("doc", "no").agg(
        *[F.first(c).alias(c) for c in ("is_html", "page_id", "host", "bits", "extra", "hashes")], F.bool_or(F.col("closes").isNotNull()).alias("hit"), F.bool_or(F.coalesce("closes", F.lit(False))).alias("closes")
    )
    bit = lambda b: F.col("bits").bitwiseAND(b) != 0
    free = ~bit(BEFORE) & ~bit(TOP) & ~bit(HELD)
    closed = F.min(F.when(free & F.col("closes"), F.col("no"))).over(Window.partitionBy("doc"))
    drop = bit(BEFORE) | (~bit(TOP) & F.coalesce(F.col("no") > closed, F.lit(False))) | (free & F.col("hit"))
    return named.select(F.when(F.col("is_html"), "page.raw_gzip").otherwise("page.markdown").alias("field_name"), "page_id", "host", F.col("no").alias("line_no"), "bits", drop.alias("drop"), "extra", "hashes")


def boilerplate_lines(pages: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """(field_name, page_id, line_no) of each line to be dropped, once each."""
    return classified_lines(pages, limit=limit).where("drop").select("field_name", "page_id", "line_no").distinct()

"""RSS (0.9x, 1.0, 2.0) and Atom feeds as lists of entries."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date
from html import unescape
from xml.parsers import expat

from pagemill.documents.charset import decode
from pagemill.documents.dom import one_line, trim

# Limits of a listing.
MAX_ITEMS, SUMMARY = 100, 400

_BARE = re.compile(r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#x[0-9a-fA-F]+);)")
_NAMED = re.compile(r"&([A-Za-z][A-Za-z0-9]*);")
_DECLARATION = re.compile(r"^\s*<\?xml\b[^>]*\?>")
_BAD_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


@dataclass(slots=True)
class Entry:
    title: str = ""
    link: str = ""
    date: str = ""
    summary: str = ""


@dataclass(slots=True)
class Feed:
    title: str = ""
    subtitle: str = ""
    entries: list[Entry] = field(default_factory=list)


class _Element:
    __slots__ = ("name", "attrs", "text", "children")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs, self.text = name, attrs, ""
        self.children: list[_Element] = []

    def last(self, *names: str) -> str:
        """The text of the last child with the first of these names that has one."""
        for name in names:
            if t := next((c.text for c in reversed(self.children) if c.name == name), ""):
                return t
        return ""

    def each(self, name: str) -> list["_Element"]:
        return [c for c in self.children if c.name == name]


def _tree(text: str) -> _Element:
    parser = expat.ParserCreate()
    parser.buffer_text = True
    top = _Element("", {})
    stack = [top]

    def start(name: str, attrs: dict[str, str]) -> None:
        e = _Element(name.rsplit(":", 1)[-1], {k.rsplit(":", 1)[-1]: v for k, v in attrs.items()})
        stack[-1].children.append(e)
        stack.append(e)

    def chars(data: str) -> None:
        stack[-1].text += data

    parser.StartElementHandler, parser.CharacterDataHandler = start, chars
    parser.EndElementHandler = lambda name: stack.pop()
    # no entity of a document's own is expanded
    parser.EntityDeclHandler = lambda *a: (_ for _ in ()).throw(ValueError("entities aren't read"))
    parser.Parse(text, True)
    return top.children[0]


def xml_tree(body: bytes, content_type: str | None = None) -> _Element | None:
    """The document's tree, mended once where it isn't well-formed (bare ampersands, HTML's entities, control characters), or None."""
    text = _DECLARATION.sub("", decode(body, content_type)).lstrip("\ufeff \t\r\n")
    if not text.startswith("<"):
        return None
    for mend in (False, True):
        if mend:
            text = _BAD_XML.sub("", _BARE.sub("&amp;", _NAMED.sub(lambda m: m[0] if m[1] in ("amp", "lt", "gt", "quot", "apos") else unescape(m[0]), text)))
        try:
            return _tree(text)
        except (expat.ExpatError, ValueError, RecursionError):
            continue
    return None


def may_be_feed(content_type: str | None) -> bool:
    kind = (content_type or "").lower()
    return not kind or "rss" in kind or "atom" in kind or "xml" in kind or kind.startswith("text/")


_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_MAIL = re.compile(r"(?i:mon|tue|wed|thu|fri|sat|sun), +(\d{1,2}) +([A-Za-z]{3}) +(\d{4}) +(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d +(?:[+-]\d{4}|GMT[+-]\d{1,2}|[+-]\d{2}|ChST|MeST|WITA|[A-Z]{3}|[A-Z]{3,4}T)", re.A)
_RFC3339 = re.compile(r"(\d{4}-\d\d-\d\d)T(\d\d):(\d\d):(\d\d)(?:[.,]\d+)?(?:Z|[+-](\d\d):(\d\d))")
_DAY = re.compile(r"\d{4}-\d\d-\d\d")


def feed_date(stamp: str) -> str:
    """The day as written (in the stamp's own zone) of the layouts that feeds use, else the stamp on one line."""
    stamp = trim(stamp)
    m, mail = _RFC3339.fullmatch(stamp), _MAIL.fullmatch(stamp)
    sound = m is not None and int(m[2]) < 24 and int(m[3]) < 60 and int(m[4]) < 60 and (m[5] is None or int(m[5]) < 24 and int(m[6]) < 60)
    try:
        if sound or _DAY.fullmatch(stamp):
            return date.fromisoformat(stamp[:10]).isoformat()
        if mail and mail[2].lower() in _MONTHS:
            return date(int(mail[3]), _MONTHS.index(mail[2].lower()) + 1, int(mail[1])).isoformat()
    except ValueError:
        pass
    return one_line(stamp)


_HIDDEN = re.compile(r"<(?:script|style|noscript|template)\b[^>]*>.*?</(?:script|style|noscript|template)\s*>", re.I | re.S)
_TAG = re.compile(r"<[^>]+>", re.S)


def plain_of_markup(markup: str) -> str:
    """Markup without tags, scripts and references, its lines trimmed."""
    text = unescape(_TAG.sub(" ", _HIDDEN.sub("\n", markup)))
    lines = (trim(re.sub("[ \t]+", " ", x)) for x in text.split("\n"))
    return trim(re.sub(r"\n{3,}", "\n\n", "\n".join(lines)))


def summary_of(markup: str) -> str:
    text = one_line(plain_of_markup(markup))
    return text[:SUMMARY] + "…" if len(text) > SUMMARY else text


def _atom_link(entry: _Element) -> str:
    found = entry.each("link")
    best = next((x for x in found if x.attrs.get("rel", "") in ("", "alternate")), found[0] if found else None)
    return trim(best.attrs.get("href", "")) if best else ""


def read_feed(content_type: str | None, body: bytes) -> Feed | None:
    """The feed that a body holds, or None if it is none."""
    if not may_be_feed(content_type):
        return None
    root = xml_tree(body, content_type)
    if root is None:
        return None
    if root.name in ("rss", "RDF"):
        channel = next(iter(reversed(root.each("channel"))), _Element("channel", {}))
        items = channel.each("item") or root.each("item")
        entries = [Entry(trim(i.last("title")), trim(i.last("link")), feed_date(i.last("pubDate", "date")), summary_of(i.last("description"))) for i in items]
        return Feed(trim(channel.last("title")), channel.last("description"), entries)
    if root.name == "feed":
        entries = [Entry(trim(e.last("title")), _atom_link(e), feed_date(e.last("published", "updated")), summary_of(e.last("summary", "content"))) for e in root.each("entry")]
        return Feed(trim(root.last("title")), root.last("subtitle"), entries)
    return None


def listing(feed: Feed) -> str:
    """A feed as text: its subtitle, how many entries it has, and the first hundred; titles come on one line."""
    shown = feed.entries[:MAX_ITEMS]
    head = f"Feed with {len(feed.entries)} entries" + (f" (showing the first {len(shown)})" if len(feed.entries) > len(shown) else "") + ":\n"
    out = [one_line(feed.subtitle) + "\n" if one_line(feed.subtitle) else "", "\n", head]
    for e in shown:
        out.append(f"\n- **{one_line(e.title) or '(untitled)'}**" + (f" — {e.date}" if e.date else "") + (f"\n  {e.link}" if e.link else "") + (f"\n  {e.summary}" if e.summary else "") + "\n")
    return trim("".join(out))

"""Served bytes as text: the declared charset, else a declaration within the body, else a guess."""

from __future__ import annotations

import codecs
import re

# Labels that mean another encoding than their name says, as browsers read them.
ALIASES = {
    "iso-8859-1": "cp1252", "latin1": "cp1252", "l1": "cp1252", "ascii": "cp1252", "us-ascii": "cp1252", "iso8859-1": "cp1252", "windows-1252": "cp1252", "x-cp1252": "cp1252", "iso-8859-9": "cp1254", "latin5": "cp1254",
    "shift_jis": "cp932", "shift-jis": "cp932", "sjis": "cp932", "x-sjis": "cp932", "windows-31j": "cp932", "ms_kanji": "cp932", "euc-kr": "cp949", "ks_c_5601-1987": "cp949", "korean": "cp949",
    "gb2312": "gbk", "gb_2312-80": "gbk", "x-gbk": "gbk", "chinese": "gbk", "big5": "big5hkscs", "big5-hkscs": "big5hkscs", "x-x-big5": "big5hkscs", "tis-620": "cp874", "iso-8859-11": "cp874", "windows-874": "cp874", "utf8": "utf-8", "unicode-1-1-utf-8": "utf-8",
    "x-mac-roman": "mac_roman", "macintosh": "mac_roman", "x-mac-cyrillic": "mac_cyrillic", "koi8": "koi8_r", "koi": "koi8_r", "utf-16": "utf-16-le", "ucs-2": "utf-16-le", "unicode": "utf-16-le",
}

_PARAM = re.compile(r"charset\s*=\s*[\"']?\s*([^\s;\"'>]+)", re.I)
_META = re.compile(rb"<meta\b[^>]*?charset\s*=\s*[\"']?\s*([\w.:\-]+)", re.I)
_XML = re.compile(rb"^\s*<\?xml\b[^>]*?encoding\s*=\s*[\"']([\w.:\-]+)[\"']", re.I)
_BOMS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
#: Bytes within which a page must declare its charset, by the standard.
PRESCAN = 1024


def codec_of(label: str) -> str | None:
    """The codec that a charset's label stands for, or None."""
    label = label.strip().lower()
    try:
        return codecs.lookup(ALIASES.get(label, label)).name
    except (LookupError, UnicodeError, ValueError):
        return None


def charset_of(body: bytes, content_type: str | None) -> str:
    """The codec of a body: byte order mark, the type's charset, a declaration in the body, else UTF-8 if it is that, else windows-1252."""
    for mark, name in _BOMS:
        if body.startswith(mark):
            return name
    m = _PARAM.search(content_type or "")
    if m and (found := codec_of(m[1])):
        return found
    inside = _META.search(body[:PRESCAN]) or _XML.match(body[:PRESCAN])
    if inside and (found := codec_of(inside[1].decode("ascii", "replace"))):
        return "utf-8" if found.startswith("utf-16") else found
    try:
        body.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError:
        return "cp1252"


def decode(body: bytes, content_type: str | None = None) -> str:
    """The body as text; bytes that the charset doesn't have become U+FFFD, those windows-1252 leaves open are controls."""
    name = charset_of(body, content_type)
    if name == "cp1252":
        return body.decode("cp1252", "pagemill.open")
    for mark, marked in _BOMS:
        if marked == name and body.startswith(mark):
            body = body[len(mark) :]
    return body.decode(name, "replace")


def _open_bytes(e: UnicodeError):
    if isinstance(e, UnicodeDecodeError):
        return "".join(map(chr, e.object[e.start : e.end])), e.end
    raise e


codecs.register_error("pagemill.open", _open_bytes)

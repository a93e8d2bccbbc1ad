"""The text layer of PDF documents: flate streams, simple fonts and Unicode maps; no recognition of images."""

from __future__ import annotations

import re
import zlib

_OBJECT = re.compile(rb"(?<!\d)(\d+)\s+(\d+)\s+obj\b(.*?)(?:endobj|(?=\d+\s+\d+\s+obj\b)|\Z)", re.S)
_STREAM = re.compile(rb"stream\r?\n")
_REF = re.compile(rb"(\d+)\s+\d+\s+R\b")
_KIDS = re.compile(rb"/Kids\s*\[(.*?)\]", re.S)
_CONTENTS = re.compile(rb"/Contents\s*(?:\[(.*?)\]|(\d+)\s+\d+\s+R)", re.S)
_FONTS = re.compile(rb"/Font\s*(?:<<(.*?)>>|(\d+)\s+\d+\s+R)", re.S)
_RESOURCES = re.compile(rb"/Resources\s+(\d+)\s+\d+\s+R")
_NAMED = re.compile(rb"/([^\s/<>\[\]()]+)\s+(\d+)\s+\d+\s+R")
_TOKEN = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\))*\)|<[0-9A-Fa-f\s]*>|/[^\s/<>\[\]()]*|[\[\]]|[+-]?(?:\d+\.?\d*|\.\d+)|[A-Za-z'\"*]+|<<|>>", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f", b"(": b"(", b")": b")", b"\\": b"\\"}
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|\r\n|.)", re.S)
#: Bytes to which one stream may inflate.
MAX_STREAM = 64 << 20


def is_pdf(content_type: str | None, body: bytes) -> bool:
    return (content_type or "").split(";", 1)[0].strip().lower() == "application/pdf" or body.startswith(b"%PDF-")


def _stream(data: bytes) -> bytes | None:
    """The inflated stream of an object, or None."""
    m = _STREAM.search(data)
    if m is None:
        return None
    head, raw = data[: m.start()], data[m.end() :]
    end = raw.rfind(b"endstream")
    raw = raw[: end if end >= 0 else len(raw)]
    if b"/Filter" not in head:
        return raw
    if b"/FlateDecode" not in head or re.search(rb"/(?:DCT|JPX|CCITTFax|JBIG2|LZW|ASCII85|ASCIIHex)Decode", head):
        return None
    d = zlib.decompressobj()
    out = d.decompress(raw, MAX_STREAM)
    return None if d.unconsumed_tail else out


def _objects(body: bytes) -> dict[int, bytes]:
    """All objects by number, the last of a number counts; those in object streams, too."""
    found = {int(m[1]): m[3] for m in _OBJECT.finditer(body)}
    for data in list(found.values()):
        if b"/ObjStm" in data and (inner := _stream(data)):
            n, first = re.search(rb"/N\s+(\d+)", data), re.search(rb"/First\s+(\d+)", data)
            if n and first:
                numbers = list(map(int, inner[: int(first[1])].split()))[: 2 * int(n[1])]
                starts = numbers[1::2] + [len(inner)]
                for k, number in enumerate(numbers[::2]):
                    found.setdefault(number, inner[int(first[1]) + starts[k] : int(first[1]) + starts[k + 1] if k + 1 < len(numbers) // 2 else len(inner)])
    return found


def _pages(objects: dict[int, bytes]) -> list[bytes]:
    """The page objects in the order of the page tree, else by number."""
    order: list[bytes] = []
    roots = [d for d in objects.values() if re.search(rb"/Type\s*/Pages\b", d) and b"/Parent" not in d]
    stack, seen = list(reversed(roots)), set()
    while stack:
        d = stack.pop()
        if id(d) in seen:
            continue
        seen.add(id(d))
        if kids := _KIDS.search(d):
            stack.extend(objects[int(k)] for k in reversed(_REF.findall(kids[1])) if int(k) in objects)
        elif re.search(rb"/Type\s*/Page\b", d):
            order.append(d)
    return order or [d for _, d in sorted(objects.items()) if re.search(rb"/Type\s*/Page\b(?!s)", d)]


def _literal(token: bytes) -> bytes:
    def one(m: re.Match) -> bytes:
        x = m[1]
        if x.isdigit() and x[:1] in b"01234567":
            return bytes([int(x, 8) & 255])
        return b"" if x in (b"\n", b"\r", b"\r\n") else _ESCAPES.get(x, x)

    return _ESCAPE.sub(one, token[1:-1])


def _string(token: bytes) -> bytes:
    if token.startswith(b"("):
        return _literal(token)
    digits = re.sub(rb"\s", b"", token[1:-1])
    return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())


def _unicode_map(data: bytes) -> dict[int, str]:
    """Codes to text, of a font's map of Unicode."""
    out: dict[int, str] = {}
    text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
    for block in re.findall(rb"beginbfchar(.*?)endbfchar", data, re.S):
        for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            out[int(a, 16)] = text(b)
    for block in re.findall(rb"beginbfrange(.*?)endbfrange", data, re.S):
        for a, b, c in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            lo, hi, first = int(a, 16), int(b, 16), text(c)
            for k in range(min(hi - lo + 1, 65_536)):
                out[lo + k] = first[:-1] + chr(ord(first[-1]) + k) if first else ""
    return out


class _Font:
    def __init__(self, objects: dict[int, bytes], data: bytes):
        m = re.search(rb"/ToUnicode\s+(\d+)\s+\d+\s+R", data)
        self.map = _unicode_map(_stream(objects.get(int(m[1]), b"")) or b"") if m else {}
        self.wide = b"/Type0" in data

    def text(self, s: bytes) -> str:
        if self.map:
            step = 2 if self.wide else 1
            return "".join(self.map.get(int.from_bytes(s[k : k + step], "big"), "") for k in range(0, len(s), step))
        if s.startswith(b"\xfe\xff"):
            return s[2:].decode("utf-16-be", "replace")
        return "" if self.wide else s.decode("cp1252", "replace")


def _page_text(objects: dict[int, bytes], page: bytes) -> str:
    m = _CONTENTS.search(page)
    if m is None:
        return ""
    numbers = [int(x) for x in (_REF.findall(m[1]) if m[1] is not None else [m[2]])]
    content = b"\n".join(s for n in numbers if (s := _stream(objects.get(n, b""))))
    r = _RESOURCES.search(page)
    listed = _FONTS.search(objects.get(int(r[1]), b"") if r else page)
    names = _NAMED.findall((listed[1] if listed[1] is not None else objects.get(int(listed[2]), b"")) if listed else b"")
    fonts = {name: _Font(objects, objects.get(int(n), b"")) for name, n in names}
    font, plain = _Font({}, b""), _Font({}, b"")
    out: list[str] = []
    operands: list[bytes] = []
    for t in _TOKEN.finditer(content):
        x = t[0]
        if not (x[:1].isalpha() or x in (b"'", b'"', b"T*")):
            operands.append(x)
            continue
        strings = [s for s in operands if s[:1] in (b"(", b"<") and s not in (b"<<", b">>")]
        if x == b"Tf":
            font = next((fonts[o[1:]] for o in operands if o.startswith(b"/") and o[1:] in fonts), plain)
        elif x in (b"Tj", b"'", b'"'):
            out.append(("\n" if x != b"Tj" else "") + "".join(font.text(_string(s)) for s in strings[-1:]))
        elif x == b"TJ":
            for o in operands:
                if o[:1] in (b"(", b"<"):
                    out.append(font.text(_string(o)))
                elif o not in (b"[", b"]") and not o.startswith(b"/") and float(o) < -200:
                    out.append(" ")
        elif x in (b"T*", b"ET", b"TD", b"Td"):
            moved = x in (b"T*", b"ET") or len(operands) >= 2 and float(operands[-1]) != 0
            out.append("\n" if moved else " ")
        operands = []
    return re.sub(r"\n{2,}", "\n", "".join(out)).strip()


def pdf_text(body: bytes) -> tuple[str, int] | None:
    """(text with a mark before each page that has any, number of pages), or None if nothing can be read.

    Encrypted and malformed documents, and those of images only, give None.
    """
    try:
        if not body.lstrip()[:5] == b"%PDF-" or re.search(rb"/Encrypt\s+\d+\s+\d+\s+R", body):
            return None
        objects = _objects(body)
        pages = _pages(objects)
        texts = [(no, text) for no, page in enumerate(pages, 1) if (text := _page_text(objects, page))]
    except (ValueError, zlib.error, KeyError, IndexError, RecursionError, OverflowError):
        return None
    return ("\n\n".join(f"--- page {no} ---\n\n{text}" for no, text in texts), len(pages)) if texts else None

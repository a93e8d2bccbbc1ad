"""References resolved against a base by RFC 3986, with what isn't ASCII percent-encoded."""

from __future__ import annotations

import re
from functools import lru_cache
from urllib.parse import quote

from pagemill.documents.dom import trim

_PARTS = re.compile(r"(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?", re.S)
_BAD = re.compile("[\x00-\x1f\x7f]|%(?![0-9A-Fa-f]{2})")
_SAFE_PATH = "!$&'()*+,;=:@/[]%~-._"


@lru_cache(maxsize=10_000)
def split(url: str) -> tuple[str, str | None, str, str | None, str | None] | None:
    """(scheme, authority, path, query, fragment), or None if ``url`` is no reference."""
    m = _PARTS.fullmatch(url)
    if m is None:
        return None
    scheme, authority, path, query, fragment = m.groups()
    if _BAD.search(path) or re.search("[\x00-\x1f\x7f]", url) or (authority and re.search(r"[\s<>\"^`{|}\\]", authority)):
        return None
    if not scheme and authority is None and ":" in path.split("/", 1)[0]:
        return None
    return (scheme or "").lower(), authority, path, query, fragment


def without_dots(path: str) -> str:
    out: list[str] = []
    parts = path.split("/")
    for i, p in enumerate(parts):
        last = i == len(parts) - 1
        if p == "." or p == "..":
            if p == ".." and len(out) > 1:
                out.pop()
            if last:
                out.append("")
        else:
            out.append(p)
    joined = "/".join(out)
    return joined if joined.startswith("/") or not path.startswith("/") else "/" + joined


def resolve(reference: str, base: str) -> str:
    """``reference`` as an absolute address, or '' if it is none."""
    ref, b = split(reference), split(base)
    if ref is None or b is None:
        return ""
    scheme, authority, path, query, fragment = ref
    if scheme and authority is None and not path.startswith("/"):
        return f"{scheme}:{path}" + (f"?{query}" if query is not None else "") + (f"#{quote(fragment, safe=_SAFE_PATH + '?')}" if fragment else "")
    if not scheme:
        scheme = b[0]
        if authority is None:
            authority = b[1]
            if path == "":
                path = b[2]
                query = b[3] if query is None else query
            elif not path.startswith("/"):
                path = (b[2].rsplit("/", 1)[0] if "/" in b[2] else "") + "/" + path
    path = quote(without_dots(path), safe=_SAFE_PATH)
    if authority is not None and path and not path.startswith("/"):
        path = "/" + path
    out = (f"{scheme}:" if scheme else "") + (f"//{authority}" if authority is not None else "") + path
    return out + (f"?{query}" if query is not None else "") + (f"#{quote(fragment, safe=_SAFE_PATH + '?')}" if fragment else "")


def link_target(href: str, base: str) -> str:
    """The address of a link, or '' if it leads nowhere else (fragments, scripts, inline data)."""
    href = trim(href)
    if not href or href.startswith("#") or href.lower().startswith(("javascript:", "data:")):
        return ""
    return resolve(href, base)


def image_target(src: str, base: str) -> str:
    src = trim(src)
    return "" if not src or src.lower().startswith("data:") else resolve(src, base)


def path_of(url: str) -> str:
    parts = split(url)
    return parts[2] if parts else ""

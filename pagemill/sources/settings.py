"""Settings: defaults, then a config.json, then the environment, each number within its bounds."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

# Each number's default and upper bound, and whether 0 is a value of its own.
BOUNDS = {
    "fetch_max_bytes": (2 << 20, 32 << 20, False), "fetch_image_max_bytes": (5 << 20, 20 << 20, False), "fetch_timeout_sec": (25, 60, False),
    "fetch_cache_ttl_sec": (600, 3600, True), "fetch_cache_max_entries": (32, 128, True), "fetch_cache_max_bytes": (64 << 20, 256 << 20, True),
}
LOCAL = ("localhost", "127.0.0.1", "::1")
#: Environment variables and the settings they set; a host list adds to the list there is.
ENVIRONMENT = {
    "PAGEMILL_SEARCH_BACKEND": "search_backend", "TAVILY_API_KEY": "tavily_api_key", "PAGEMILL_SEARXNG_URL": "searxng_url", "PAGEMILL_USER_AGENT": "user_agent", "PAGEMILL_ALLOW_LOCAL_HOSTS": "allow_local_hosts",
    "PAGEMILL_FETCH_INLINE_IMAGES": "fetch_inline_images", **{f"PAGEMILL_{name.upper()}": name for name in BOUNDS},
}
_TRUTH = {**dict.fromkeys(("1", "t", "T", "TRUE", "true", "True"), True), **dict.fromkeys(("0", "f", "F", "FALSE", "false", "False"), False)}


@dataclass(frozen=True)
class Settings:
    search_backend: str = "tavily"
    tavily_api_key: str = ""
    searxng_url: str = ""
    fetch_max_bytes: int = 2 << 20
    fetch_image_max_bytes: int = 5 << 20
    fetch_timeout_sec: int = 25
    fetch_inline_images: bool = False
    fetch_cache_ttl_sec: int = 600
    fetch_cache_max_entries: int = 32
    fetch_cache_max_bytes: int = 64 << 20
    user_agent: str = ""
    allow_local_hosts: tuple[str, ...] = LOCAL


def bounded(name: str, n: int) -> int:
    default, most, zero = BOUNDS[name]
    if n < 0 or n == 0 and not zero:
        return 0 if zero else default
    return min(n, most)


def _from_file(folders: tuple[str, ...]) -> dict:
    """The values of the first config.json that can be read, those of a wrong type left out."""
    kinds = {f.name: type(f.default) for f in fields(Settings)}
    for folder in folders:
        try:
            with open(os.path.join(folder, "config.json"), encoding="utf-8") as f:
                text = f.read()
        except (OSError, UnicodeDecodeError):
            continue
        try:
            found = json.loads(text)
        except ValueError:
            return {}
        out = {}
        for name, value in (found if isinstance(found, dict) else {}).items():
            kind = kinds.get(name)
            if kind is tuple and isinstance(value, list) and all(isinstance(x, str) for x in value):
                out[name] = tuple(value)
            elif kind is not tuple and kind is not None and type(value) is kind:
                out[name] = value
        return out
    return {}


def load_settings(*folders: str, environ: Mapping[str, str] | None = None) -> Settings:
    """The settings in force. The first folder with a readable config.json counts alone; nothing is merged.

    A list of hosts in the file replaces the default list, one in the environment adds to
    it. Values of the environment that can't be read are passed over.
    """
    environ = os.environ if environ is None else environ
    s = replace(Settings(), **_from_file(tuple(f for f in folders if f)))
    changed: dict = {}
    for variable, name in ENVIRONMENT.items():
        value = environ.get(variable, "")
        if not value:
            continue
        if name in BOUNDS:
            digits = value.lstrip("+-")
            if digits.isascii() and digits.isdigit() and (int(value) > 0 or int(value) == 0 and BOUNDS[name][2]):
                changed[name] = int(value)
        elif name == "fetch_inline_images":
            if value in _TRUTH:
                changed[name] = _TRUTH[value]
        elif name == "allow_local_hosts":
            changed[name] = s.allow_local_hosts + tuple(h for x in value.split(",") if (h := x.strip()))
        else:
            changed[name] = value
    s = replace(s, **changed)
    return replace(s, search_backend=s.search_backend.strip().lower() or "tavily", **{name: bounded(name, getattr(s, name)) for name in BOUNDS})

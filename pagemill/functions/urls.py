"""URLs, domains and addresses as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.text import text, trim_space

# Ports that are never fetched, and parameters that only track.
BLOCKED_PORTS = (22, 23, 25, 110, 143, 445, 465, 587, 993, 995, 1433, 3306, 3389, 5432, 5900, 6379, 11211, 27017)
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "fbclid", "gclid", "dclid", "gbraid", "wbraid", "msclkid", "mc_cid", "mc_eid", "igshid")
URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]*)(?::(\d*))?((?:/[^?#]*)?)(\?[^#]*)?(#.*)?$"

# IPv4 ranges that are never fetched: private and local use, documentation, multicast, reserved.
BLOCKED_IPV4 = (
    "0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24", "192.0.2.0/24",
    "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4",
)


def url_part(url: Column, k: int) -> Column:
    """1 scheme, 2 host (without the brackets of an address), 3 port, 4 path, 5 query with '?', 6 fragment with '#'; empty where there is none or no URL."""
    part = F.regexp_extract(trim_space(url), URL, k)
    return F.regexp_replace(part, r"^\[|\]$", "") if k == 2 else part


def admission_error(url: Column) -> Column:
    """Why a URL may not be fetched, or the empty string."""
    u = trim_space(url)
    scheme, host, port = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)), url_part(url, 2), url_part(url, 3)
    # fixed values: the texts of the errors
    return (
        F.when(u.rlike(r"[\x00-\x1f\x7f]|^:|^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*[ <>\"]"), "invalid url")
        .when(~scheme.isin("http", "https"), F.concat(F.lit('unsupported scheme "'), scheme, F.lit('" (only http/https)')))
        .when(~u.rlike(URL), F.when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://."), "invalid url").otherwise("url has no host"))
        .when((host == "") & (port == ""), "url has no host")
        .when(port.isin(*map(str, BLOCKED_PORTS)), F.concat(F.lit("port "), port, F.lit(" is not permitted (it is a well-known non-web service port)")))
        .otherwise("")
    )


def _escape(c: Column) -> Column:
    """Form encoding as URL libraries write it: '*' escaped, '~' not."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def cache_key(url: Column) -> Column:
    """The URL without tracking parameters, the others sorted by name; unchanged if it has none. Pairs with bad escapes go."""
    query = F.regexp_replace(url_part(url, 5), r"^\?", "")
    pairs = F.transform(
        F.split(query, "&"),
        lambda p, i: F.struct(
            F.try_url_decode(F.substring_index(p, "=", 1)).alias("k"), i.alias("i"),
            F.when(F.instr(p, "=") > 0, F.try_url_decode(F.regexp_replace(p, r"^[^=]*=", ""))).otherwise("").alias("v"), p.alias("p"),
        ),
    )
    sound = F.filter(pairs, lambda x: x["k"].isNotNull() & x["v"].isNotNull() & ~F.contains(x["p"], F.lit(";")) & (x["p"] != ""))
    kept = F.array_sort(F.filter(sound, lambda x: ~x["k"].isin(*TRACKING)))
    again = F.array_join(F.transform(kept, lambda x: F.concat(_escape(x["k"]), F.lit("="), _escape(x["v"]))), "&")
    tracked = F.exists(sound, lambda x: x["k"].isin(*TRACKING))
    base = F.regexp_extract(url, r"^([^?#]*)", 1)
    return F.when(tracked, F.concat(base, F.when(again != "", F.concat(F.lit("?"), again)).otherwise(""), url_part(url, 6))).otherwise(text(url))


def clean_domains(domains: Column) -> Column:
    """Lower-case domains without schemes, paths and empties; null is the empty array."""
    bare = F.transform(F.coalesce(domains, F.array().cast("array<string>")), lambda d: F.regexp_replace(F.regexp_replace(F.lower(trim_space(d)), "^https://", ""), "^http://", ""))
    return F.filter(F.transform(bare, lambda d: F.regexp_replace(d, "(?s)/.*$", "")), lambda d: d != "")


def domain_permitted(url: Column, include: Column, exclude: Column) -> Column:
    """Whether a URL's host passes the lists (equal to a domain or under it); exclusion wins, empty lists admit all."""
    host = F.lower(url_part(url, 2))
    under = lambda ds: F.exists(ds, lambda d: (host == d) | F.endswith(host, F.concat(F.lit("."), d)))
    return ((F.size(include) == 0) & (F.size(exclude) == 0)) | ((host != "") & ~under(exclude) & ((F.size(include) == 0) | under(include)))


def ipv4_number(ip: Column) -> Column:
    """The address as a number, null if it isn't dotted IPv4."""
    sound = ip.rlike(r"^(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}$")
    byte = lambda k: F.split_part(ip, F.lit("."), F.lit(k)).cast("long")
    return F.when(sound, ((byte(1) * 256 + byte(2)) * 256 + byte(3)) * 256 + byte(4))


def within(number: Column, ranges: list[tuple[int, int]]) -> Column:
    """Whether a number lies in one of the ranges; the number is worked out once, whatever it is made of. Null for null."""
    inside = lambda n: reduce(lambda a, r: a | n.between(*r), ranges, F.lit(False))
    return F.when(number.isNotNull(), F.exists(F.array(number), inside))


def _range(cidr: str) -> tuple[int, int]:
    import ipaddress

    n = ipaddress.ip_network(cidr)
    return int(n[0]), int(n[-1])


def ipv4_blocked(ip: Column) -> Column:
    """Whether an address may not be dialled; what is no IPv4 address may not."""
    return F.coalesce(within(ipv4_number(ip), list(map(_range, BLOCKED_IPV4))), F.lit(True))


def bare_css_url(value: Column) -> Column:
    """What stands in CSS's ``url(...)``, without quotation marks."""
    inner = F.regexp_replace(trim_space(value), r"(?is)^url\(\s*(.*?)\s*\)$", "$1")
    return F.regexp_replace(inner, "^[\"']|[\"']$", "")


def first_of_srcset(value: Column) -> Column:
    """The first URL of a srcset, up to a comma or space."""
    return F.regexp_extract(trim_space(value), r"^([^,\s]*)", 1)


def user_agent(asked: Column, fallback: Column, browser: Column) -> Column:
    """The user agent that a request goes out with: the fallback if none is asked for, the browser's for 'browser'."""
    a = trim_space(asked)
    return F.when(a == "", fallback).when(F.lower(a) == "browser", browser).otherwise(a)

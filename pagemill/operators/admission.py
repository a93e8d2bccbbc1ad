"""Which hosts and addresses may be dialled: special ranges, and allow lists over them."""

from __future__ import annotations

import ipaddress
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.text import trim_space
from pagemill.functions.urls import BLOCKED_IPV4, ipv4_blocked, ipv4_number, within

# IPv6 ranges that are never dialled, with those that carry IPv4 addresses.
BLOCKED_IPV6 = ("::/128", "::1/128", "64:ff9b::/96", "64:ff9b:1::/48", "100::/64", "2001::/23", "2001:db8::/32", "2002::/16", "fc00::/7", "fe80::/10", "ff00::/8")


@dataclass(frozen=True)
class AllowList:
    """Hosts by name, and IPv4 and IPv6 networks; single addresses are networks of one."""

    hosts: tuple[str, ...]
    nets: tuple[str, ...]


def parse_allow_list(entries: list[str]) -> AllowList:
    """Each entry as a network, else as an address, else as a host name in lower case; blanks go."""
    hosts, nets = [], []
    for e in (x.strip() for x in entries):
        try:
            nets.append(str(ipaddress.ip_network(e, strict=False)))
        except ValueError:
            if e:
                hosts.append(e.lower())
    return AllowList(tuple(hosts), tuple(nets))


def host_allowed(host: Column, allow: AllowList) -> Column:
    """Whether the name is on the list; case and one dot at its end don't matter."""
    return F.coalesce(F.regexp_replace(F.lower(trim_space(host)), r"\.$", "").isin(*allow.hosts), F.lit(False)) if allow.hosts else F.lit(False)


def ipv4_allowed(ip: Column, allow: AllowList) -> Column:
    ranges = [(int(net[0]), int(net[-1])) for net in map(ipaddress.ip_network, allow.nets) if net.version == 4]
    return F.coalesce(within(ipv4_number(ip), ranges), F.lit(False))


def permitted(host: Column, ip: Column, allow: AllowList) -> Column:
    """Whether an IPv4 address of a host may be dialled."""
    return ~ipv4_blocked(ip) | host_allowed(host, allow) | ipv4_allowed(ip, allow)


def addresses(df: DataFrame, ip: Column, keep: list[Column], allow: AllowList = AllowList((), ())) -> DataFrame:
    """The columns ``keep`` with ``blocked`` and ``allowed`` for addresses of either version; no address is blocked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        never = [ipaddress.ip_network(n) for n in BLOCKED_IPV4 + BLOCKED_IPV6]
        nets = [ipaddress.ip_network(n) for n in allow.nets]
        for b in batches:
            blocked, allowed = [], []
            for text in b.column(0).to_pylist():
                try:
                    a = ipaddress.ip_address((text or "").strip())
                except ValueError:
                    blocked.append(True)
                    allowed.append(False)
                    continue
                a = getattr(a, "ipv4_mapped", None) or a
                blocked.append(any(a in n for n in never))
                allowed.append(any(a in n for n in nets))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(blocked, pa.bool_()), pa.array(allowed, pa.bool_())], names=[*b.schema.names[1:], "blocked", "allowed"])

    picked = df.select(ip.cast("string").alias("__ip"), *keep)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[1:])
    return picked.mapInArrow(run, f"{kinds}, blocked boolean, allowed boolean")


def allow_table(spark: SparkSession, allow: AllowList) -> DataFrame:
    """An allow list as (kind, host, lo, hi): names, and the IPv4 ranges as numbers; its size is that of the list."""
    rows = [("host", h, None, None) for h in allow.hosts]
    rows += [("net", None, int(n[0]), int(n[-1])) for n in map(ipaddress.ip_network, allow.nets) if n.version == 4]
    return spark.createDataFrame(rows, "kind string, host string, lo long, hi long")


def permitted_targets(targets: DataFrame, host: Column, ips: Column, allow: AllowList) -> DataFrame:
    """``targets`` with ``dial``: the first of the addresses ``ips`` of each host that may be dialled, null if none may.

    A host is admitted if any of its addresses is, in the order they were resolved.
    """
    first = F.filter(F.coalesce(ips, F.array().cast("array<string>")), lambda ip: permitted(host, ip, allow))
    return targets.withColumn("dial", F.get(first, 0))


# What callers are told of a refused host, and what only the log is.
BLOCKED = "web_fetch: host is blocked by SSRF protection; add it to allow_local_hosts in config.json or PAGEMILL_ALLOW_LOCAL_HOSTS to permit"
BLOCKED_DETAIL = 'ssrf block: "%s" resolves only to private/reserved addresses and is not on the allowlist'


def blocked_texts(host: Column, dial: Column) -> Column:
    """The struct (error, detail) of a target without an address to dial, empty for others; ``detail`` names the host and belongs in logs only."""
    return F.struct(F.when(dial.isNull(), BLOCKED).otherwise("").alias("error"), F.when(dial.isNull(), F.format_string(BLOCKED_DETAIL, host)).otherwise("").alias("detail"))

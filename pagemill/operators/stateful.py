"""Operators with a state for each key: admission rates, caches, sessions.

The keyed ones bring each key's rows together in order and pass over them as a
stream; a task holds the state of the key at hand and no more of its rows than an
Arrow batch, however many rows a key has.
"""

from __future__ import annotations

from collections import OrderedDict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _in_order(df: DataFrame, run, out: str, kind: pa.DataType, by: tuple[str, ...] = ("key",), order: tuple[str, ...] = ("at", "id")) -> DataFrame:
    """``run(state, row)`` over (key, at, id, ...) in the order of time and id, a new state for each value of ``by``; its results as the column ``out``."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, last = None, object()
        for b in it:
            rows = list(zip(*(c.to_pylist() for c in b.columns)))
            values = []
            for row in rows:
                if row[: len(by)] != last:
                    state, last = None, row[: len(by)]
                state, value = run(state, row[len(by) - 1 :])
                values.append(value)
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("id"), pa.array(values, kind)], names=["key", "id", out])

    kinds = dict(df.dtypes)
    ordered = df.select(*by, *[c for c in df.columns if c not in by]).repartition(*by).sortWithinPartitions(*by, *order)
    return ordered.mapInArrow(batches, f"key {kinds['key']}, id {kinds['id']}, {out} {'boolean' if kind == pa.bool_() else 'string'}")


#: Refill intervals of one bucket of a key's time, within which an idle gap is looked for.
BUCKET = 64


def idle_segments(calls: DataFrame, gap_ms: int) -> DataFrame:
    """``calls`` (key, at, id) with ``segment``: the time at which the key's last idle gap of ``gap_ms`` or more ended, null before any.

    Keys are cut into buckets of time, so that a hot key is many groups. The first gap of
    each bucket cuts; a bucket without one goes on with the segment before it. Only a key
    that is never idle stays whole.
    """
    c = F.col
    timed = calls.withColumn("__b", F.floor(F.coalesce("at", F.lit(0)) / (BUCKET * gap_ms)))
    last = F.lag("at").over(Window.partitionBy("key", "__b").orderBy("at"))
    gaps = timed.withColumn("__gap", F.when(c("at") - last >= gap_ms, c("at")))
    buckets = gaps.groupBy("key", "__b").agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.min("__gap").alias("gap"))
    of_key = Window.partitionBy("key").orderBy("__b")
    first = F.when(c("lo") - F.lag("hi").over(of_key) >= gap_ms, c("lo")).otherwise(c("gap"))
    cuts = buckets.select("key", "__b", first.alias("cut"))
    before = F.last("cut", ignorenulls=True).over(of_key.rowsBetween(Window.unboundedPreceding, -1))
    marked = cuts.select(c("key").alias("__key"), c("__b").alias("__of"), "cut", before.alias("before"))
    joined = timed.join(marked, c("key").eqNullSafe(c("__key")) & (c("__b") == c("__of")))
    return joined.withColumn("segment", F.when(c("at") >= c("cut"), c("cut")).otherwise(c("before"))).drop("__b", "__key", "__of", "cut", "before")


def rate_limited(calls: DataFrame, key: Column, at_ms: Column, call_id: Column, burst: int = 10, refill_ms: int = 5000) -> DataFrame:
    """(key, id, allowed): at most ``burst`` allowed calls of a key in any trailing ``refill_ms``; refused ones cost nothing.

    A token is back at exactly ``refill_ms`` after its use. Null times count as 0. Keys
    are cut at idle gaps of ``refill_ms``, where all tokens are back, so a hot key is
    spread over tasks unless it is never idle; a task holds ``burst`` times of one segment.
    """

    def run(used, row):
        used = used if used is not None else deque()
        at = row[1]
        while used and used[0] + refill_ms <= at:
            used.popleft()
        if len(used) < burst:
            used.append(at)
            return used, True
        return used, False

    timed = calls.select(key.alias("key"), F.coalesce(at_ms.cast("long"), F.lit(0)).alias("at"), call_id.alias("id"))
    segments = idle_segments(timed, refill_ms).select("key", "segment", "at", "id")
    return _in_order(segments, run, "allowed", pa.bool_(), ("key", "segment"))


class Cache:
    """A cache that drops what was read least recently, bounded by entries and bytes, with expiry from the time of storing."""

    def __init__(self, capacity: int, ttl_ms: int = 0, max_bytes: int = 0, entries: list[tuple[str, int, int]] = ()):
        self.capacity, self.ttl, self.max_bytes = capacity, ttl_ms, max_bytes
        self.entries: OrderedDict[str, tuple[int, int]] = OrderedDict((name, (stored, size)) for name, stored, size in entries)
        self.bytes = sum(size for _, size in self.entries.values())

    def _drop(self, name: str) -> None:
        self.bytes -= self.entries.pop(name)[1]

    def get(self, name: str, at: int) -> str:
        """hit, miss or expired; a hit renews an entry's recency, not its age."""
        found = self.entries.get(name) if self.capacity > 0 else None
        if found is None:
            return "miss"
        if self.ttl > 0 and at - found[0] > self.ttl:
            self._drop(name)
            return "expired"
        self.entries.move_to_end(name)
        return "hit"

    def put(self, name: str, at: int, size: int) -> None:
        """Stores an entry and drops others until all bounds hold; an entry above the bound of bytes stays alone."""
        if self.capacity <= 0:
            return
        if name in self.entries:
            self._drop(name)
        self.entries[name] = (at, size)
        self.bytes += size
        while len(self.entries) > 1 and (len(self.entries) > self.capacity or 0 < self.max_bytes < self.bytes):
            self._drop(next(iter(self.entries)))

    def clear(self) -> int:
        n = len(self.entries)
        self.entries.clear()
        self.bytes = 0
        return n

    def act(self, op: str | None, name: str | None, at: int, size: int) -> str:
        """What comes of one operation; see ``cache_hits``."""
        if op == "clear":
            return f"cleared {self.clear()}"
        if op == "list":
            return f"{len(self.entries)} entries, {self.bytes} bytes"
        outcome = "refresh" if op == "refresh" else self.get(name, at)
        if outcome != "hit":
            self.put(name, at, size)
        return outcome


def cache_hits(reads: DataFrame, scope: Column, at_ms: Column, read_id: Column, entry: Column, capacity: int = 32, ttl_ms: int = 0, size: Column | None = None, max_bytes: int = 0, op: Column | None = None) -> DataFrame:
    """(key, id, outcome): what comes of read-through reads of a cache for each scope, by ``Cache``'s rules.

    ``op`` is null or 'read' (hit, miss or expired; what isn't a hit is stored anew), 'refresh'
    (stored anew without being looked up), 'clear' ("cleared n") or 'list' ("n entries, m
    bytes", with what has expired and wasn't read since). A scope's reads depend on all
    before them, so a scope is one task's work; the task holds its ``capacity`` entries.
    """

    def run(cache, row):
        cache = cache if cache is not None else Cache(capacity, ttl_ms, max_bytes)
        return cache, cache.act(row[5], row[3], row[1] or 0, row[4] or 0)

    none = F.lit(None)
    rows = reads.select(scope.alias("key"), at_ms.cast("long").alias("at"), read_id.alias("id"), entry.alias("entry"), (size if size is not None else none).cast("long").alias("size"), (op if op is not None else none).cast("string").alias("op"))
    return _in_order(rows, run, "outcome", pa.string())


def load_through(requests: DataFrame, cached: DataFrame, as_of: Column, ttl_s: int = 600) -> tuple[DataFrame, DataFrame]:
    """(hits, misses) of requests (request_id, cache_key, user_agent) against stored pages (cache_key, stored, ...).

    The latest page of a key counts. A request for another user agent always misses, as does
    one for a page older than ``ttl_s`` seconds (0: pages don't age). Both keep all requests' rows.
    """
    c = F.col
    latest = cached.groupBy("cache_key").agg(F.max_by(F.struct(*cached.columns), "stored").alias("page"))
    fresh = latest if ttl_s <= 0 else latest.where(F.unix_timestamp(as_of) - F.unix_timestamp("page.stored") <= ttl_s)
    asked = requests.withColumn("__plain", F.coalesce(c("user_agent"), F.lit("")) == "")
    hits = asked.where("__plain").drop("__plain").join(fresh, "cache_key")
    misses = asked.where("__plain").drop("__plain").join(fresh.select("cache_key"), "cache_key", "left_anti").unionByName(asked.where("not __plain").drop("__plain"))
    return hits, misses


def as_of(events: DataFrame, scope: str, order: list[str], starts: Column, value: Column, bucket: Column | None = None) -> DataFrame:
    """``events`` with ``current``: the value of the scope's last starting event so far, '' included, null before any.

    ``bucket`` cuts a scope into groups of their own, so that a hot one is spread over
    tasks: it must not decrease in the order. The last value of each bucket is carried to
    those after it, which are few rows for a scope. It changes no row.
    """
    started = F.when(starts, F.struct(value.alias("v")))
    so_far = lambda *by: F.last(started, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    if bucket is None:
        return events.withColumn("current", so_far(scope)["v"])
    timed = events.withColumn("__b", bucket)
    ends = timed.groupBy(F.col(scope).alias("__scope"), F.col("__b").alias("__of")).agg(F.max_by(started, F.when(starts, F.struct(*order))).alias("end"))
    carried = F.last("end", ignorenulls=True).over(Window.partitionBy("__scope").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1))
    before = ends.select("__scope", "__of", carried.alias("__before"))
    own = timed.withColumn("__own", so_far(scope, "__b"))
    joined = own.join(before, F.col(scope).eqNullSafe(F.col("__scope")) & F.col("__b").eqNullSafe(F.col("__of")))
    return joined.withColumn("current", F.coalesce("__own", "__before")["v"]).drop("__b", "__own", "__scope", "__of", "__before")

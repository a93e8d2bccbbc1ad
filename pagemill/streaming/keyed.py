"""Streaming twins of the keyed operators.

Rows come in any number of batches; within a batch a key's rows are taken in the order of
time and id. A row whose time is before one already taken counts as of the later time, so
the rules hold on the stream as it was seen; a stream in order gives the same rows as the
table. State is bounded: ``burst`` times, ``capacity`` entries or one value for each key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagemill.operators.stateful import Cache


def _kind(df: DataFrame, name: str) -> str:
    return dict(df.dtypes)[name]


def rate_limited_stream(calls: DataFrame, key: Column, at_ms: Column, call_id: Column, burst: int = 10, refill_ms: int = 5000) -> DataFrame:
    """(key, id, allowed) of a stream of calls, by the rules of ``rate_limited``."""

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        used = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(frames)).sort_values(["at", "id"], kind="stable")
        allowed = []
        for at in rows["at"].tolist():
            at = max(at, used[-1]) if used else at
            used = [u for u in used if u + refill_ms > at]
            allowed.append(len(used) < burst)
            if allowed[-1]:
                used.append(at)
        state.update((used,))
        yield pd.DataFrame({"key": group[0], "id": rows["id"], "allowed": allowed})

    rows = calls.select(key.alias("key"), F.coalesce(at_ms.cast("long"), F.lit(0)).alias("at"), call_id.alias("id"))
    return rows.groupBy("key").applyInPandasWithState(run, f"key {_kind(rows, 'key')}, id {_kind(rows, 'id')}, allowed boolean", "used array<long>", "append", GroupStateTimeout.NoTimeout)


def cache_hits_stream(reads: DataFrame, scope: Column, at_ms: Column, read_id: Column, entry: Column, capacity: int = 32, ttl_ms: int = 0, size: Column | None = None, max_bytes: int = 0, op: Column | None = None) -> DataFrame:
    """(key, id, outcome) of a stream of reads, by the rules of ``cache_hits``."""

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names, stored, sizes = state.get if state.exists else ([], [], [])
        cache = Cache(capacity, ttl_ms, max_bytes, list(zip(names, stored, sizes)))
        rows = pd.concat(list(frames)).sort_values(["at", "id"], kind="stable")
        outcomes = [cache.act(o, e, at, z) for o, e, at, z in zip(rows["op"], rows["entry"], rows["at"].tolist(), rows["size"].tolist())]
        held = list(cache.entries.items())
        state.update(([n for n, _ in held], [s for _, (s, _) in held], [z for _, (_, z) in held]))
        yield pd.DataFrame({"key": group[0], "id": rows["id"], "outcome": outcomes})

    none = F.lit(None)
    rows = reads.select(
        scope.alias("key"), F.coalesce(at_ms.cast("long"), F.lit(0)).alias("at"), read_id.alias("id"), entry.alias("entry"),
        F.coalesce((size if size is not None else none).cast("long"), F.lit(0)).alias("size"), F.coalesce((op if op is not None else none).cast("string"), F.lit("read")).alias("op"),
    )
    return rows.groupBy("key").applyInPandasWithState(run, f"key {_kind(rows, 'key')}, id {_kind(rows, 'id')}, outcome string", "names array<string>, stored array<long>, sizes array<long>", "append", GroupStateTimeout.NoTimeout)


def as_of_stream(events: DataFrame, scope: Column, at: Column, event_id: Column, starts: Column, value: Column) -> DataFrame:
    """(key, id, current) of a stream of events, by the rules of ``as_of``: the scope's last starting event's value, null before any."""

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        current = state.get[0] if state.exists else None
        rows = pd.concat(list(frames)).sort_values(["at", "id"], kind="stable")
        out = []
        for start, v in zip(rows["start"].tolist(), rows["value"].tolist()):
            if start:
                current = v
            out.append(current)
        state.update((current,))
        yield pd.DataFrame({"key": group[0], "id": rows["id"], "current": pd.Series(out, index=rows.index, dtype=object)})

    rows = events.select(scope.alias("key"), at.alias("at"), event_id.alias("id"), F.coalesce(starts, F.lit(False)).alias("start"), value.cast("string").alias("value"))
    return rows.groupBy("key").applyInPandasWithState(run, f"key {_kind(rows, 'key')}, id {_kind(rows, 'id')}, current string", "current string", "append", GroupStateTimeout.NoTimeout)

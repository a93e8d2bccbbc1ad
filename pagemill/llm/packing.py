"""Filling containers of fixed capacity by vector best-fit.

An item takes up three capacities of its container: tokens (its size), documents
(one) and attention cost (the square of its size). The items go in by decreasing
size, each into the open bin where it fits under every constraint and leaves the
least residual norm. The norm's weights are lexicographic, tokens before attention
cost before documents, so the best bin is found by search instead of by scanning:
bins lie in classes of equal residual tokens, ordered by the other residuals.

Packing is done in shards of the parts, drawn by hash, so that no task holds all
of them; there are as many shards as the parts of a spec need. A shard's sizes are distributed as all sizes are; sharding costs at most
about one container's unused space for each shard.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterable
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.tokens import count_tokens
from pagemill.session import stored

#: Parts of one shard, in the mean.
SHARD_PARTS = 50_000


def best_fit(sizes: Iterable[int], limit: int, max_documents: int | None = None, max_attention: int | None = None) -> list[int]:
    """The bin of each item; ``sizes`` must be in decreasing order and none above ``limit``.

    By default the number of documents and the attention cost of a bin are limited
    only by its tokens (``limit`` documents, ``limit`` squared). An item whose own
    attention cost is above the capacity raises ValueError.
    """
    documents = limit if max_documents is None else max_documents
    attention = limit * limit if max_attention is None else max_attention
    classes: dict[int, list[tuple[int, int, int]]] = {}
    present = 0  # bit r: some open bin has r residual tokens
    placed, bins = [], 0
    for n in sizes:
        cost = n * n
        if n > limit or cost > attention or documents < 1:
            raise ValueError(f"an item of {n} tokens fits into no container")
        found = None
        rest = present >> n
        while rest and found is None:
            low = (rest & -rest).bit_length() - 1
            r = n + low
            own = classes[r]
            for k in range(bisect_left(own, (cost, 1, -1)), len(own)):
                if own[k][1] >= 1 and own[k][0] >= cost:
                    found = own.pop(k)
                    break
            if not own:
                del classes[r]
                present &= ~(1 << r)
            rest &= rest - 1
            rest = present >> n & ~((1 << low + 1) - 1)
        if found is None:
            at, left = bins, (limit - n, attention - cost, documents - 1)
            bins += 1
        else:
            at, left = found[2], (r - n, found[0] - cost, found[1] - 1)
        placed.append(at)
        if left[0] > 0 and left[2] > 0:
            insort(classes.setdefault(left[0], []), (left[1], left[2], at))
            present |= 1 << left[0]
    return placed


def part_limit(limit: int, max_attention: int | None = None) -> int:
    """The tokens that one part may have: the limit, and no more than its own attention cost allows."""
    return limit if max_attention is None else min(limit, isqrt(max_attention))


#: A container's capacities beside its tokens, from its limit.
Capacity = Callable[[int], int | None]


def pack(items: DataFrame, specs: list[tuple[int, int]], key: str = "doc_id", size: str = "n_tokens", shard_parts: int = SHARD_PARTS, max_documents: Capacity = lambda limit: None, max_attention: Capacity = lambda limit: None) -> DataFrame:
    """Containers for every (spec_id, limit) of ``specs``: (spec_id, container_id, key, part_no, token_start, n_tokens).

    Items of null, zero or negative size take part in none. An item above the limit, or
    above what the attention capacity admits alone, is cut into full parts and a rest,
    and nothing else is cut; ``part_no`` counts from 0. Repeated rows are items of their
    own. ``items`` should be a stored table, as its parts are counted first. Without items
    or specs the result is empty.
    """
    spec = F.array(*[F.struct(F.lit(int(s)).alias("spec_id"), F.lit(int(t)).alias("token_limit"), F.lit(int(part_limit(t, max_attention(t)))).alias("part")) for s, t in specs])
    spec = spec if specs else spec.cast("array<struct<spec_id:int,token_limit:int,part:int>>")
    kept = items.select(F.col(key).alias("__key"), F.col(size).cast("long").alias("__size")).where("__size > 0")
    each = kept.withColumn("__spec", F.explode(spec)).select("__key", "__size", "__spec.*")
    parts_of = F.ceil(F.col("__size") / F.col("part"))
    counted = {r.spec_id: r.parts for r in each.groupBy("spec_id").agg(F.sum(parts_of).alias("parts")).collect()}
    shards = F.lit(1)
    for s, _ in specs:
        shards = F.when(F.col("spec_id") == s, max(1, -(-counted.get(s, 0) // shard_parts))).otherwise(shards)
    parts = each.withColumn("part_no", F.explode(F.sequence(F.lit(0), ((F.col("__size") - 1) / F.col("part")).cast("int"))))
    start = F.col("part_no").cast("long") * F.col("part")
    rows = parts.select(
        "spec_id", "token_limit", F.pmod(F.xxhash64("__key", "part_no"), shards.cast("long")).alias("shard"), F.col("__key").alias("key"), "part_no",
        start.alias("token_start"), F.least(F.col("part").cast("long"), F.col("__size") - start).alias("n_tokens"),
    )

    def run(group: pa.Table) -> pa.Table:
        n = group.column("n_tokens").to_numpy()
        order = np.lexsort((group.column("part_no").to_numpy(), group.column("key").to_numpy(zero_copy_only=False), -n))
        group = group.take(pa.array(order))
        limit, shard = group.column("token_limit")[0].as_py(), group.column("shard")[0].as_py()
        at = best_fit(n[order].tolist(), limit, max_documents(limit), max_attention(limit))
        container = np.asarray(at, np.int64) + (shard << 32)
        return pa.table({"spec_id": group.column("spec_id"), "container_id": container, "key": group.column("key"), "part_no": group.column("part_no"), "token_start": group.column("token_start"), "n_tokens": group.column("n_tokens")})

    kind = dict(rows.dtypes)["key"]
    return rows.groupBy("spec_id", "shard").applyInArrow(run, f"spec_id int, container_id long, key {kind}, part_no int, token_start long, n_tokens long").withColumnRenamed("key", key)


def pack_texts(df: DataFrame, key: Column, text: Column, specs: list[tuple[int, int]], path: str | None = None, **capacities: Capacity) -> DataFrame:
    """``pack`` of texts by their tokens; null and empty texts take part in no container."""
    return pack(stored(count_tokens(df, key, text, path).where("n_tokens > 0")), specs, "key", **capacities).withColumnRenamed("key", "doc_id")


def spec_rows(size_specs: DataFrame, purpose: str, limit: int = 1000) -> list:
    """The distinct specs of a purpose, by id; more than ``limit`` raise ValueError, as each is work for all texts."""
    rows = size_specs.where((F.col("purpose") == purpose) & (F.col("token_limit") > 0)).select("spec_id", "token_limit", F.coalesce("overlap_tokens", F.lit(0)).alias("overlap_tokens")).distinct().orderBy("spec_id").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} size specs")
    return rows

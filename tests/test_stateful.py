"""The keyed operators against simulations of their rules, and edge tables."""

from collections import defaultdict

from pyspark.sql import functions as F

from pagemill.operators import stateful


def test_rate_limit(spark):
    rows = [(k, (i * 7919) % 30_000, i) for i in range(600) for k in ("a", "b", None)]
    df = spark.createDataFrame(rows, "k string, t long, i long")
    got = {(r.key, r.id): r.allowed for r in stateful.rate_limited(df, F.col("k"), F.col("t"), F.col("i"), 3, 500).collect()}
    used, want = defaultdict(list), {}
    for k, t, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        want[k, i] = sum(u > t - 500 for u in used[k]) < 3
        if want[k, i]:
            used[k].append(t)
    assert got == want
    assert stateful.rate_limited(df.limit(0), F.col("k"), F.col("t"), F.col("i")).count() == 0


def test_cache(spark):
    rows = [("s", i * 10, i, str((i * i) % 13)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t long, i long, e string")
    for capacity, ttl in ((4, 0), (4, 90), (100, 50)):
        got = {r.id: r.outcome for r in stateful.cache_hits(df, F.col("k"), F.col("t"), F.col("i"), F.col("e"), capacity, ttl).collect()}
        cache, want = [], {}  # [name, stored], least recent first
        for _, t, i, e in rows:
            old = next((x for x in cache if x[0] == e), None)
            fresh = old is not None and not (ttl and t - old[1] > ttl)
            want[i] = "hit" if fresh else "miss" if old is None else "expired"
            cache = [x for x in cache if x[0] != e] + [old if fresh else [e, t]]
            cache = cache[-capacity:]
        assert got == want


def test_idle_gaps_cut_keys(spark):
    """Segments begin where a key was idle long enough, wherever that is in the buckets of time, and nowhere else."""
    rows = [(k, t, i) for k in ("a", None) for i, t in enumerate([0, 50, 99, 200, 6500, 6501, 6700, 6750, 13_000, 13_099, 13_198, 20_000])]
    df = spark.createDataFrame(rows, "key string, at long, id long")
    got = {(r.key, r.at): r.segment for r in stateful.idle_segments(df, 100).collect()}
    for k in ("a", None):
        segments = [got[k, t] for t in (0, 50, 99, 200, 6500, 6501, 6700, 6750, 13_000, 13_099, 13_198, 20_000)]
        # a bucket is cut at its first gap only
        assert segments == [None, None, None, 200, 6500, 6500, 6500, 6500, 13_000, 13_000, 13_000, 20_000]


def test_bytes_and_operations(spark):
    ops = [("read", "a", 40), ("read", "b", 40), ("read", "a", 0), ("read", "c", 40), ("read", "b", 1), ("list", None, 0), ("read", "big", 500), ("list", None, 0), ("read", "a", 10), ("refresh", "a", 20), ("list", None, 0), ("clear", None, 0), ("read", "a", 1), (None, "a", 1)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(ops)], "i long, op string, e string, z long")
    got = [r.outcome for r in sorted(stateful.cache_hits(df, F.lit("s"), F.col("i"), F.col("i"), F.col("e"), 8, 0, F.col("z"), 100, F.col("op")).collect(), key=lambda r: r.id)]
    assert got == ["miss", "miss", "hit", "miss", "miss", "3 entries, 81 bytes", "miss", "1 entries, 500 bytes", "miss", "refresh", "1 entries, 20 bytes", "cleared 1", "miss", "hit"]
    off = stateful.cache_hits(df, F.lit("s"), F.col("i"), F.col("i"), F.col("e"), 0)
    assert {r.outcome for r in off.collect()} == {"miss"}


def test_load_through(spark):
    cached = spark.createDataFrame([("k", 100, "old"), ("k", 200, "new"), ("stale", 1, "x")], "cache_key string, at long, title string").select("cache_key", F.timestamp_seconds("at").alias("stored"), "title")
    asked = spark.createDataFrame([(1, "k", None), (2, "k", "browser"), (3, "stale", ""), (4, "none", None), (5, "k", None)], "request_id long, cache_key string, user_agent string")
    hits, misses = stateful.load_through(asked, cached, F.timestamp_seconds(F.lit(700)), 600)
    assert sorted((r.request_id, r.page.title) for r in hits.collect()) == [(1, "new"), (5, "new")] and sorted(r.request_id for r in misses.collect()) == [2, 3, 4]


def test_as_of_in_buckets(spark):
    rows = [(k, i, i % 7 == 3 and k != "none", None if i % 3 == 0 else f"v{i}") for k in ("a", "none", None) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, i long, s boolean, v string")
    plain, cut = (sorted((str(r.k), r.i, str(r.current)) for r in stateful.as_of(df, "k", ["i"], F.col("s"), F.col("v"), b).collect()) for b in (None, F.floor(F.col("i") / 5)))
    key = lambda r: r[:2]
    assert sorted(plain, key=key) == sorted(cut, key=key) and len({r[2] for r in cut}) > 4

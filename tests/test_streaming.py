"""Streams in order give the rows of the tables."""

import pytest
from pyspark.sql import functions as F

from pagemill.operators import stateful
from pagemill.streaming import keyed


@pytest.fixture(scope="module")
def calls(spark, tmp_path_factory):
    """Events in order, and a folder of files that hold them piece by piece."""
    rows = [(i, "abc"[i % 3], i * 37 + i // 50 * 4000, f"e{i * i % 13}", None if i % 3 else i, i % 17 == 0) for i in range(300)]
    df = spark.createDataFrame(rows, "i long, k string, t long, e string, z long, s boolean")
    folder = str(tmp_path_factory.mktemp("stream"))
    for n in range(5):
        df.where((F.col("i") >= 60 * n) & (F.col("i") < 60 * n + 60)).coalesce(1).write.mode("append").parquet(folder)
    return df, folder


def streamed(spark, calls, build, tmp_path):
    df, folder = calls
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(folder)
    out = str(tmp_path / "out")
    build(source).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return sorted(map(tuple, spark.read.parquet(out).collect()))


def test_rate_limit(spark, calls, tmp_path):
    args = (F.col("k"), F.col("t"), F.col("i"), 3, 600)
    want = sorted(map(tuple, stateful.rate_limited(calls[0], *args).collect()))
    assert streamed(spark, calls, lambda s: keyed.rate_limited_stream(s, *args), tmp_path) == want and {r[2] for r in want} == {True, False}


def test_cache(spark, calls, tmp_path):
    args = (F.col("k"), F.col("t"), F.col("i"), F.col("e"), 4, 3000, F.col("z"), 400, F.when(F.col("i") % 97 == 0, "clear"))
    want = sorted(map(tuple, stateful.cache_hits(calls[0], *args).collect()))
    assert streamed(spark, calls, lambda s: keyed.cache_hits_stream(s, *args), tmp_path) == want and {"hit", "miss"} < {r[2] for r in want}


def test_as_of(spark, calls, tmp_path):
    want = sorted((r.k, r.i, r.current) for r in stateful.as_of(calls[0], "k", ["i"], F.col("s"), F.col("e")).collect())
    got = streamed(spark, calls, lambda s: keyed.as_of_stream(s, F.col("k"), F.col("t"), F.col("i"), F.col("s"), F.col("e")), tmp_path)
    key = lambda r: (r[0], r[1])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_frames(spark, tmp_path):
    """A host's lines as they come; what is no frame is left out."""
    from pagemill.registry import default_registry
    from pagemill.sources import frames

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"type":"tool_call","id":"1","name":"no"}\nnot json\n{"type":"shutdown"}\n{"type":"tool_call","id":"2","name":"web_fetch"}\n{"broken\n')
    lines = spark.readStream.text(str(tmp_path / "in"))
    read = frames.read_frames(lines, F.lit("c"), F.xxhash64("value"), F.col("value"))
    out = str(tmp_path / "out")
    frames.refusals(read, default_registry()).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    got = sorted(r.reply for r in spark.read.parquet(out).collect())
    assert len(got) == 2 and got[0] == '{"type":"shutdown_ack"}' and 'no handler for tool \\"no\\"' in got[1]

"""Session settings and the helpers that every operator shares."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a side whose size Catalyst knows may be broadcast.
BROADCAST_LIMIT = 8 << 20


def build_session(cores: str = "*", memory: str = "8g") -> SparkSession:
    """A local session with the settings the operators expect (UTC, ANSI, AQE)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pagemill")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(os.cpu_count() or 8))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir`` (a file or a directory of parts)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def size_of(df: DataFrame) -> int:
    """Catalyst's estimate of the bytes of ``df``; of a stored table, the bytes of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df`` with a broadcast hint if Catalyst's size estimate is within ``limit``.

    Beyond the limit the frame comes back unchanged and the join shuffles, so a
    side that turns out larger than expected costs time but never memory.
    """
    return F.broadcast(df) if size_of(df) <= limit else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read from there.

    The folder is the one the session names in ``spark.checkpoint.dir``; only
    where that is unset (tests on one machine) a temporary folder is used.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="pagemill-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


#: Tables that ``stored`` has written from this driver.
_written: list[str] = []


def drop_stored(spark: SparkSession) -> int:
    """Deletes the tables that ``stored`` has written; for when no result that was built on them is read any more. How many there were."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = len(_written)
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
    return n


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the checkpoint folder and read from there.

    Against ``cut_lineage`` the files are compressed and Catalyst knows their size,
    so that ``bounded_broadcast`` can judge it.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="pagemill-stored-")
    path = f"{folder.rstrip('/')}/table-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

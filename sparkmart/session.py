"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: How tables are stored: keys and log positions as text take about half the room of the default.
STORED = {"compression": "zstd"}
#: Rows of a large table that a task should be given after a shuffle.
ROWS_PER_SHUFFLE_TASK = 250_000
#: Rows of a large table that a task should read: it may have to sort them before a shuffle.
ROWS_PER_SCAN_TASK = 500_000


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sparkmart")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def allow_for(spark: SparkSession, rows: int) -> None:
    """Let the session's shuffles start with enough partitions for a table of ``rows`` rows.

    A fixed number would give each task more rows as tables grow, until its sorts spill. It is
    the number that adaptive execution starts with; small shuffles are put together again. A
    higher number, given or set before, stays.
    """
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions")
    wanted = -(-rows // ROWS_PER_SHUFFLE_TASK)
    if wanted > int(now):
        spark.conf.set(initial, str(wanted))


def allow_scans(spark: SparkSession, rows: int) -> None:
    """Let the session cut the files of a table of ``rows`` rows into enough tasks.

    By default a task reads up to 128 MB of a file, which are millions of rows where they are
    stored well, and more than fits its memory where it sorts or groups them before a shuffle
    (``latest_state`` does). A higher number, given or set before, stays.
    """
    name = "spark.sql.files.minPartitionNum"
    now = spark.conf.get(name, None) or spark.sparkContext.defaultParallelism
    wanted = -(-rows // ROWS_PER_SCAN_TASK)
    if wanted > int(now):
        spark.conf.set(name, str(wanted))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in here leave no shuffle files behind, which nothing would read again.

    By default they stay until the driver happens to collect its garbage, so a job of several
    writes holds what all of them have shuffled beside its tables.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables that a job writes and reads back.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``, so that
    what is written survives a lost executor. Only a local session may fall back to a
    folder on this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="sparkmart-")
    return f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}"


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and gives real size statistics."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").options(**STORED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session settings used by the tests and the benchmark.

A cluster brings its own session; nothing in the library depends on these values.
"""

from __future__ import annotations

import os
import re
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # an execution's shuffle files go when it ends
_OPEN = threading.local()  # names of the tables written in the innermost open block of ``scratch``


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the engine expects of a cluster (UTC, AQE, skew handling)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corvane")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CORVANE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.openCostInBytes", str(128 * 1024))  # small test files still use every core
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on an input of few splits, such as one small file, before expensive per-row work.

    An input split holds at most ``spark.sql.files.maxPartitionBytes``, so fewer than two splits per core bounds what
    is moved here to that much for each. A larger input already fills the cluster and is left where it is. Rows are
    placed by key, which later groupings by that key reuse.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < 2 * cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, where every task shares one disk, may fall back to a scratch folder.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        import tempfile

        folder = tempfile.mkdtemp(prefix="corvane-checkpoint-")
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For results a plan reads several times and for the steps of iterations: the work runs once, later plans stay
    short, column pruning still applies, the size is known for join choices, and a lost executor loses nothing. What
    was shuffled for it is not needed again and goes from the executors' disks at once, not when the driver next
    collects its garbage.
    """
    spark = df.sparkSession
    name = f"corvane-{uuid.uuid4().hex}"
    path = f"{shared_folder(spark).rstrip('/')}/{name}"
    if getattr(_OPEN, "tables", None) is not None:
        _OPEN.tables.add(name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that :func:`cut_lineage` writes inside are deleted at the end, but for those that a frame given to ``keep`` reads.

    So steps whose result is written hold the shared folder for as long as they run only. ``keep`` gives its frame back;
    a kept table belongs to the block around this one, if there is one.
    """
    around = getattr(_OPEN, "tables", None)
    _OPEN.tables, kept = set(), set()

    def keep(df: DataFrame) -> DataFrame:
        kept.update(_tables_of(df))
        return df

    try:
        yield keep
    finally:
        own, _OPEN.tables = _OPEN.tables, around
        _delete(spark, own - kept)
        if around is not None:
            around.update(own & kept)


def discard(df: DataFrame) -> None:
    """Delete the tables of :func:`cut_lineage` that ``df`` reads; for steps of iterations that nothing reads any more."""
    _delete(df.sparkSession, _tables_of(df))


def _tables_of(df: DataFrame) -> set[str]:
    return set(re.findall("corvane-[0-9a-f]{32}", "\n".join(df.inputFiles())))


def _delete(spark: SparkSession, names: set[str]) -> None:
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

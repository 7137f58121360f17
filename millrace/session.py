"""Session settings the jobs rely on, and tables written to the shared folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
import warnings
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# UTC: days and wall-clock times are derived in the session zone.
# ANSI: strict casts must raise on bad values.
# Skew join is forced so that AQE may add a shuffle rather than leave one task
# with a hot partition.
# Shuffled rows take some fifteen times their compressed bytes where a task sorts or
# aggregates them, so AQE merges partitions to half of Spark's size only.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; safe to call on any session, any number of times."""
    # Listing day directories takes several of them per task instead of one.
    listing = str(max(16, 2 * spark.sparkContext.defaultParallelism))
    wanted = SETTINGS | {"spark.sql.sources.parallelPartitionDiscovery.parallelism": listing}
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Change one runtime setting for the duration of a job."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Jobs of one application that run side by side.
TOGETHER = 8


def run_together(steps: Iterable[Callable[[], object]]) -> list:
    """Run independent steps, each with Spark jobs of its own, side by side; results in their order.

    A small job leaves most of a cluster idle, a large one takes what is free: the scheduler hands
    out the tasks of all. The first failure is raised once the other steps have ended.
    """
    steps = list(steps)
    if not steps:
        return []
    with ThreadPoolExecutor(min(TOGETHER, len(steps))) as pool:
        return [found.result() for found in [pool.submit(step) for step in steps]]


# Shuffle partitions are sized for inputs of this many bytes each, up to a number
# that the driver can still track for every map task. The session setting below raises
# that number for larger inputs; reaching it is reported.
PARTITION_BYTES = 64 * 1024 * 1024
MAX_PARTITIONS = 50_000
MAX_PARTITIONS_SETTING = "spark.millrace.maxShufflePartitions"
# Stored layers are written once and read many times.
STORED_CODEC = "zstd"
# What a file of an export should hold.
EXPORT_FILE_BYTES = 512 * 1024 * 1024


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under a path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return int(fs.getContentSummary(where).getLength())


def size_shuffles(spark: SparkSession, size: int) -> int:
    """Raise the number of shuffle partitions to suit an input of ``size`` bytes.

    AQE merges partitions that turn out small, so only too few of them would hurt:
    each would then be larger than the memory of a task and spill.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = int(spark.conf.get(MAX_PARTITIONS_SETTING, str(MAX_PARTITIONS)))
    needed = -(-size // PARTITION_BYTES)
    if needed > most:
        warnings.warn(f"{size} bytes need {needed} shuffle partitions; {MAX_PARTITIONS_SETTING} allows {most}", stacklevel=2)
    wanted = max(current, min(most, needed))
    if wanted != current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may do without the setting; it gets a fresh temporary
    folder once per application.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_written: list[str] = []


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def written_so_far() -> int:
    """A mark: what is written to the shared folder later can be discarded by it."""
    return len(_written)


def is_written(path: str) -> bool:
    """Whether a path of ``new_path`` has not been discarded yet."""
    return path in _written


def discard_written(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables this application wrote to the shared folder, from a mark on, once results are saved."""
    while len(_written) > since:
        delete(spark, _written.pop())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict = {"lock": threading.Lock(), "writers": 0, "before": None}


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Let Spark delete the shuffle files of a write as soon as it ends, not when the driver collects garbage.

    Writes may overlap in several threads: the first one in sets it, the last one out sets it back.
    """
    with _cleaning["lock"]:
        if not _cleaning["writers"]:
            _cleaning["before"] = spark.conf.get(CLEANUP_SETTING, "false")
            spark.conf.set(CLEANUP_SETTING, "true")
        _cleaning["writers"] += 1
    try:
        yield
    finally:
        with _cleaning["lock"]:
            _cleaning["writers"] -= 1
            if not _cleaning["writers"]:
                spark.conf.set(CLEANUP_SETTING, _cleaning["before"])


def write_out(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used for nodes with several readers: it cuts lineage, and a lost executor
    costs a re-read of the files instead of a recomputation. The shuffles behind the table
    are of no more use and take no disk beside it. ``codec`` replaces the session's Parquet codec.
    """
    path = new_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Parquet exports of the source tables and the raw views over them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from contextlib import contextmanager
from datetime import date
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleaning import utc_day
from millrace.operators.joins import lookup_join
from millrace.session import EXPORT_FILE_BYTES, STORED_CODEC, delete, setting, shuffles_removed


#: What is done to a table as the last step before it is written, e.g. to watch its rows.
Last = Callable[[DataFrame], DataFrame]


def export_table(df: DataFrame, path: str, last: Last = lambda df: df) -> None:
    """Write a whole table as one Parquet dataset; the shuffles behind it are deleted with the end of the write."""
    with shuffles_removed(df.sparkSession):
        last(df).write.mode("overwrite").parquet(path, compression=STORED_CODEC)


def with_day(df: DataFrame, ts: str, day: str) -> DataFrame:
    """Add the UTC day of an event time as the partition column."""
    return df.withColumn(day, utc_day(ts))


def with_parent_day(
    children: DataFrame, parents: DataFrame, key: str, ts: str, day: str
) -> DataFrame:
    """Add the parent's UTC day to each child; children without a parent are left out."""
    days = parents.select(key, utc_day(ts).alias(day))
    return lookup_join(children, days, key, how="inner")


@contextmanager
def day_files(spark: SparkSession, file_bytes: int = EXPORT_FILE_BYTES):
    """Settings under which the rebalance step of day exports makes files of about ``file_bytes``.

    The cost of a small export is its number of files, not its bytes, so it is kept on all cores.
    """
    with (
        setting(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "16KB"),
        setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes)),
    ):
        yield


def write_days(df: DataFrame, path: str, day: str, last: Last = lambda df: df) -> None:
    """Write one directory per day, within ``day_files``.

    The rebalance step gathers each day into few files and lets AQE split a day
    that is much larger than the others, so that no single task writes it alone.
    """
    with shuffles_removed(df.sparkSession):
        last(df.hint("rebalance", F.col(day))).write.mode("overwrite").partitionBy(day).parquet(path, compression=STORED_CODEC)


def export_by_day(df: DataFrame, path: str, day: str, file_bytes: int = EXPORT_FILE_BYTES) -> None:
    """Write a table as one directory per day."""
    with day_files(df.sparkSession, file_bytes):
        write_days(df, path, day)


def day_digests(df: DataFrame, day: str) -> DataFrame:
    """(day, n_rows, low, high): what tells a day's rows from others, whatever their order; equal rows count each."""
    columns = sorted(c for c in df.columns if c != day)
    one, two = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    halves = [F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))) for h in (one, F.shiftrightunsigned(one, 32), two)]
    return df.groupBy(F.col(day).alias("day")).agg(
        F.count("*").alias("n_rows"), halves[0].alias("low"), halves[1].alias("high"), halves[2].alias("other")
    )


#: Where an export by day keeps what it wrote; readers of the dataset do not see it.
DAYS = "_days"


def written_days(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """(run, digests) of the last export to ``path`` that ended; 0 and None before the first."""
    try:
        runs = spark.read.option("basePath", f"{path}/{DAYS}").parquet(f"{path}/{DAYS}")
    except AnalysisException:  # nothing is there yet
        return 0, None
    last = runs.agg(F.max("run")).first()[0]
    return (last, runs.where(F.col("run") == last).drop("run")) if last else (0, None)


def export_changed_days(df: DataFrame, path: str, day: str, file_bytes: int = EXPORT_FILE_BYTES) -> list:
    """Bring the dataset at ``path`` up to date: days whose rows changed are written, vanished ones deleted, others not touched.

    Returns the days that were written. Days are compared by number and checksums of their rows with those of
    the last export. The digests are written after the data: where a run ends in between, the
    next one writes the same days again. Rows without a day are a day of their own.
    """
    spark = df.sparkSession
    run, before = written_days(spark, path)
    now = day_digests(df, day)
    if before is None:
        export_by_day(df, path, day, file_bytes)
        changed, gone = [r["day"] for r in now.select("day").collect()], []
    else:
        same = F.col("n.day").eqNullSafe(F.col("b.day"))
        values = [c for c in now.columns if c != "day"]
        equal = reduce(and_, [F.col(f"n.{c}") == F.col(f"b.{c}") for c in values])
        both = now.alias("n").join(before.alias("b"), same, "full")
        state = F.when(F.col("n.n_rows").isNull(), "gone").when(F.coalesce(equal, F.lit(False)), "same").otherwise("changed")
        # One row per day comes to the driver.
        found = both.select(F.coalesce("n.day", "b.day").alias("day"), state.alias("state")).where("state != 'same'").collect()
        changed, gone = ([r["day"] for r in found if r["state"] == s] for s in ("changed", "gone"))
        if changed:
            days = F.broadcast(spark.createDataFrame([(d,) for d in changed], "__day date"))
            rows = df.join(days, F.col(day).eqNullSafe(F.col("__day")), "left_semi")
            with day_files(spark, file_bytes), shuffles_removed(spark):
                gathered = rows.hint("rebalance", F.col(day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                gathered.partitionBy(day).parquet(path, compression=STORED_CODEC)
        for d in gone:
            delete(spark, f"{path}/{day}={'__HIVE_DEFAULT_PARTITION__' if d is None else d}")
    if before is None or changed or gone:
        now.coalesce(1).write.parquet(f"{path}/{DAYS}/run={run + 1}")
    return sorted(changed, key=str)


def register_raw(spark: SparkSession, base: str, tables: Iterable[str], prefix: str = "raw_") -> dict[str, DataFrame]:
    """Read exported tables and (re)create one temporary view for each.

    Day directories come back as a DATE column of the table, and filters on that
    column prune directories.
    """
    found = {}
    for name in tables:
        df = spark.read.parquet(f"{base}/{name}")
        df.createOrReplaceTempView(prefix + name)
        found[name] = df
    return found


def stored_days(df: DataFrame, day: str) -> DataFrame:
    """(day,) of the day directories that ``df``, a plain read of a dataset, consists of; no row is read.

    Exports write no directory without rows, so these are the days of the rows. The driver lists the files.
    """
    found = {part.split("=", 1)[1] for f in df.inputFiles() for part in f.split("/") if part.startswith(f"{day}=")}
    days = [(None if d == "__HIVE_DEFAULT_PARTITION__" else date.fromisoformat(d),) for d in sorted(found)]
    return df.sparkSession.createDataFrame(days, f"`{day}` date")


def view_counts(spark: SparkSession, tables: Iterable[str], prefix: str = "raw_") -> DataFrame:
    """Row count of every registered view."""
    out = None
    for name in tables:
        one = spark.table(prefix + name).agg(F.count("*").alias("n_rows"))
        one = one.select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def absent_rows(staged: DataFrame, target: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Staged rows whose key the target does not have yet, one per key.

    Of several staged rows with the same key the first in ``order`` is taken. The
    target is only read for the keys between the smallest and largest staged key,
    so an append beyond the existing keys skips its row groups, and only keys that
    are also staged are kept for the final comparison.
    """
    rest = [c for c in staged.columns if c != key and c not in order]
    first = staged.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("row"))
    candidates = first.select(key, "row.*").select(*staged.columns)
    low, high = staged.agg(F.min(key), F.max(key)).first()
    if low is None:
        return candidates
    existing = target.where(F.col(key).between(low, high)).select(key)
    existing = existing.join(staged.select(key), key, "left_semi")
    return candidates.join(existing, key, "left_anti")


def append_if_absent(staged: DataFrame, target: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The target with the absent staged rows added."""
    return target.unionByName(absent_rows(staged, target, key, order))


def append_to_path(staged: DataFrame, path: str, key: str, order: list[str]) -> None:
    """Append the absent staged rows to an existing Parquet dataset; nothing is rewritten."""
    target = staged.sparkSession.read.parquet(path)
    absent_rows(staged, target, key, order).write.mode("append").parquet(path)

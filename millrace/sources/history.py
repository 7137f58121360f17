"""A persisted type-2 history: one directory per snapshot run, and compacted segments of closed versions.

Each run writes the versions it closed and the complete set of current versions,
as two sub-directories of one job. Closed versions never change, so they are not
read or written again by later runs, and a run costs as much as the current rows
only. A run counts once its ``_SUCCESS`` file exists; a failed run is ignored and
the next one takes a new number.

So that many runs are read as few files, ``compact`` gathers the closed versions of the runs since
the last time into a segment, and equally old segments into larger ones: a version is written again
once per level. A manifest says which segments stand for which runs. It is written last and counts
once its own ``_SUCCESS`` exists, so a crash in between leaves the history as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.temporal import timestamp
from millrace.operators.scd2 import first_history, merge_snapshot
from millrace.session import shuffles_removed
from millrace.sources.catalog import files_query


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def _numbered(spark: SparkSession, base: str, kind: str) -> list[int]:
    """The numbers of the directories ``kind=...``, in order; one listing."""
    fs, where = _file_system(spark, base)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}="))


def _at(base: str, kind: str, number: int) -> str:
    return f"{base}/{kind}={number:08d}"


def _committed(spark: SparkSession, path: str) -> bool:
    return _exists(spark, f"{path}/_SUCCESS")


def _manifest(spark: SparkSession, base: str) -> tuple[int, list[tuple[int, str]]]:
    """(last run it covers, segments as (level, path) from old to new) of the newest committed manifest."""
    for number in reversed(_numbered(spark, base, "manifest")):
        path = _at(base, "manifest", number)
        if _committed(spark, path):
            rows = spark.read.schema(MANIFEST).parquet(path).orderBy("place").collect()
            return number, [(r["level"], f"{base}/{r['segment']}") for r in rows]
    return 0, []


def _runs(spark: SparkSession, base: str, after: int = 0) -> tuple[list[str], int]:
    """Committed run paths in order, and the highest run number in use.

    Runs up to ``after`` are only looked at if none came later.
    """
    numbers = _numbered(spark, base, "run")
    done = [n for n in numbers if n > after and _committed(spark, _at(base, "run", n))]
    if not done:
        done = [n for n in reversed(numbers) if n <= after and _committed(spark, _at(base, "run", n))][:1]
    return [_at(base, "run", n) for n in done], numbers[-1] if numbers else 0


def _parts(spark: SparkSession, base: str) -> tuple[list[str], list[str]]:
    """Paths of the closed versions and of the current ones."""
    covered, segments = _manifest(spark, base)
    runs, _ = _runs(spark, base, covered)
    later = [r for r in runs if int(r.rsplit("=", 1)[1]) > covered]
    return [path for _, path in segments] + _stored(spark, later, "closed"), _stored(spark, runs[-1:], "current")


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def _stored(spark: SparkSession, runs: list[str], state: str) -> list[str]:
    """Paths of one state in the given runs; a run without such rows has none."""
    return [p for p in (f"{run}/state={state}" for run in runs) if _exists(spark, p)]


def _read(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    return spark.read.parquet(*paths) if paths else None


def current_versions(spark: SparkSession, base: str) -> DataFrame | None:
    """Open versions as of the last committed run."""
    return _read(spark, _parts(spark, base)[1])


def read_history(spark: SparkSession, base: str) -> DataFrame | None:
    """All versions: those closed by any committed run, and the open ones."""
    closed, current = _parts(spark, base)
    return _read(spark, closed + current)


def history_query(spark: SparkSession, base: str) -> str | None:
    """The history as SQL over its files, for a lasting view; to be renewed after every run and compaction."""
    paths = [p for part in _parts(spark, base) for p in part]
    return files_query(_read(spark, paths).columns, paths) if paths else None


MANIFEST = "place int, level int, segment string"
#: Segments of one level that become one of the next.
FAN_IN = 8


def compact(spark: SparkSession, base: str) -> int:
    """Gather the closed versions of the runs since the last manifest; returns the number of segments.

    Nothing is deleted: readers of the files that were replaced go on. ``drop_replaced`` clears up.
    """
    covered, segments = _manifest(spark, base)
    runs, last = _runs(spark, base, covered)
    done = [r for r in runs if int(r.rsplit("=", 1)[1]) > covered]
    if not done:
        return len(segments)
    last = int(done[-1].rsplit("=", 1)[1])
    closed = _stored(spark, done, "closed")
    level = 0
    while closed:
        # Merge with the segments of the same level once there are enough of them.
        same = [path for at, path in segments if at == level]
        if len(same) + 1 < FAN_IN:
            break
        closed, segments, level = same + closed, [s for s in segments if s[0] != level], level + 1
    if closed:
        path = f"{base}/segment={last:08d}"
        # A segment no manifest names is left from a failed compaction and may be written over.
        _read(spark, closed).write.mode("overwrite").parquet(path)
        segments = [*segments, (level, path)]
    rows = [(k, at, path.removeprefix(f"{base}/")) for k, (at, path) in enumerate(segments)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(_at(base, "manifest", last))
    return len(segments)


def drop_replaced(spark: SparkSession, base: str) -> int:
    """Delete what the newest manifest and the last run replace; returns the number of directories.

    Only once no reader uses them any more. The last committed run stays, and so does every later one.
    """
    covered, segments = _manifest(spark, base)
    runs, _ = _runs(spark, base, covered)
    kept = {*runs, *(path for _, path in segments), _at(base, "manifest", covered)}
    kept |= {r.replace("/run=", "/taken=") for r in runs}
    fs, _ = _file_system(spark, base)
    gone = 0
    for kind in ("run", "taken", "segment", "manifest"):
        for number in _numbered(spark, base, kind):
            path = _at(base, kind, number)
            if number <= covered and path not in kept:
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)
                gone += 1
    return gone


def _last_instant(spark: SparkSession, runs: list[str]) -> datetime | None:
    """When the last committed run was taken."""
    taken = _read(spark, [p for p in (run.replace("/run=", "/taken=") for run in runs[-1:]) if _exists(spark, p)])
    return taken.first()["taken_at"] if taken is not None else None


def record_snapshot(
    source: DataFrame, base: str, key: str, check: Sequence[str], snapshot_ts: str, compact_every: int = 32
) -> DataFrame:
    """Merge a snapshot into the history under ``base`` and return the whole history.

    The source has one row per key, and snapshots come in order of time, whether or not the
    last one changed anything. Taking one again at the same time is allowed while no version
    changes. Anything else is refused and leaves the history as it is. After ``compact_every`` runs
    their closed versions are gathered into a segment.
    """
    spark = source.sparkSession
    repeated = source.groupBy(key).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"the snapshot has several rows for {key} {repeated[0][0]}")
    covered, _ = _manifest(spark, base)
    runs, last = _runs(spark, base, covered)
    at = spark.range(1).select(timestamp(snapshot_ts).alias("taken_at"))
    before, now = _last_instant(spark, runs), at.first()["taken_at"]
    if before is not None and before > now:
        raise ValueError(f"the history already holds a snapshot taken after {snapshot_ts}")
    current = _read(spark, _stored(spark, runs[-1:], "current"))
    if current is None:
        merged = first_history(source, key, snapshot_ts)
    else:
        merged = merge_snapshot(current, source, key, check, snapshot_ts)
        if before == now and not merged.where("valid_to is not null").isEmpty():
            raise ValueError(f"a different snapshot was taken at {snapshot_ts}")
    # The instant is written first: only the run's own _SUCCESS makes both count.
    at.write.mode("overwrite").parquet(f"{base}/taken={last + 1:08d}")
    state = F.when(F.col("valid_to").isNull(), F.lit("current")).otherwise(F.lit("closed"))
    with shuffles_removed(spark):
        merged.withColumn("state", state).write.partitionBy("state").parquet(f"{base}/run={last + 1:08d}")
    if len(runs) + 1 >= compact_every:
        compact(spark, base)
    stored = read_history(spark, base)
    return merged if stored is None else stored

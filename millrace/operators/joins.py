"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# A key is hot if it holds as many rows as this many mean shuffle partitions, or the
# share below where partitions are few. There can be at most 1 / LEAST_SHARE hot keys,
# which bounds the list held by the driver.
HOT_PARTITIONS = 2
HOT_SHARE = 0.005
LEAST_SHARE = 0.0001
_SALT = "__salt"
_KEY = "__key_"
_COPIES = "__copies"


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_share(partitions: int) -> float:
    return max(LEAST_SHARE, min(HOT_SHARE, HOT_PARTITIONS / partitions))


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for a relation (file sizes, pruned to used columns)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    """The session's own limit in bytes; below it Spark broadcasts by itself."""
    session = df.sparkSession
    text = session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if text.startswith("-"):
        return -1
    return session._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def fits_broadcast(df: DataFrame) -> bool:
    return planned_bytes(df) <= broadcast_limit(df)


_profiles: dict[tuple, dict[int, float]] = {}


def hot_hashes(df: DataFrame, keys: Sequence[str], share: float | None = None) -> dict[int, float]:
    """Hashes of the keys that hold ``share`` of the rows or more, each with its share.

    Two scans of the key columns alone, without a shuffle of rows: the first keeps
    a bounded counter per partition and finds every key that could be that
    frequent, the second counts these candidates exactly. The profile of a relation
    is remembered by its plan: a stale one changes the balance of a join, never its rows.
    """
    share = hot_share(shuffle_partitions(df)) if share is None else share
    hashes = df.select(F.xxhash64(*keys).alias("h"))
    known = (df.sparkSession.sparkContext.applicationId, hashes.semanticHash(), share)
    if known not in _profiles:
        if len(_profiles) >= 256:
            _profiles.clear()
        _profiles[known] = _profile(hashes, share)
    return _profiles[known]


def _profile(hashes: DataFrame, share: float) -> dict[int, float]:
    row = hashes.freqItems(["h"], share).first()
    candidates = list(row[0] or []) if row else []
    if not candidates:
        return {}
    marked = hashes.select(F.when(F.col("h").isin(candidates), F.col("h")).alias("h"))
    counts = dict(marked.groupBy("h").agg(F.count("*").alias("n")).collect())
    total = sum(counts.values())
    return {h: n / total for h, n in counts.items() if h is not None and n >= share * total}


def _copies(df: DataFrame, hot: dict[int, float]) -> DataFrame:
    """(hash, copies) of the hot keys: as many copies as a key has mean partitions, so all
    together at most one per partition and one per hot key."""
    parts = shuffle_partitions(df)
    rows = [(h, max(2, min(parts, round(parts * share)))) for h, share in hot.items()]
    return F.broadcast(df.sparkSession.createDataFrame(rows, f"__h long, {_COPIES} int"))


def _salted(left: DataFrame, hashed: Column, hot: dict[int, float]) -> DataFrame:
    # The salt depends on the row and its partition, so a recomputed task sends every
    # row to the same place as before, and equal rows of many partitions are spread.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *left.columns), F.col(_COPIES)).cast("int")
    marked = left.withColumn(_SALT + "_h", hashed).join(_copies(left, hot), F.col(_SALT + "_h") == F.col("__h"), "left")
    salt = F.when(F.col(_COPIES).isNotNull(), spread).otherwise(F.lit(0))
    return marked.withColumn(_SALT, salt).drop(_SALT + "_h", "__h", _COPIES)


def _replicated(right: DataFrame, hashed: Column, hot: dict[int, float]) -> DataFrame:
    marked = right.withColumn(_SALT + "_h", hashed).join(_copies(right, hot), F.col(_SALT + "_h") == F.col("__h"), "left")
    last = F.coalesce(F.col(_COPIES), F.lit(1)) - F.lit(1)
    return marked.withColumn(_SALT + "_r", F.explode(F.sequence(F.lit(0), last))).drop(_SALT + "_h", "__h", _COPIES)


def row_bytes(df: DataFrame) -> int:
    """Size of one row of short columns in a broadcast table: 64 bytes per column."""
    return 64 * len(df.columns)


def _common_types(left: DataFrame, rights: Sequence[DataFrame], pairs: dict[str, str]) -> dict[str, DataType]:
    """Per key the type in which all sides compare, as a union widens it."""
    found = {}
    for k, r in pairs.items():
        keys = left.select(F.col(k).alias("k"))
        for right in rights:
            keys = keys.union(right.select(r))
        found[k] = keys.schema["k"].dataType
    return found


def lookup_join(
    left: DataFrame,
    rights: DataFrame | Sequence[DataFrame],
    on: str | Sequence[str] | dict[str, str],
    how: str = "left",
    condition: Callable[[], Column] | None = None,
    keys_from: DataFrame | None = None,
    counted: int | None = None,
) -> DataFrame:
    """Join ``left`` with one or more relations on the same left key.

    ``on`` names the key columns, or maps left names to right names. The right key
    is not repeated in the result; other right columns must have names of their
    own. ``condition`` adds a residual predicate.

    A right side within the session's broadcast limit is left to Spark. When a
    right side is larger, the left rows of hot keys (including a frequent NULL)
    are spread over salted sub-keys and the matching right rows are copied to each
    sub-key. The left side is salted once, so all joins of one call share one
    partitioning of it; without hot keys the plan is the plain join.

    ``keys_from`` is a relation with the key columns and the key frequencies of
    ``left`` that is cheaper to scan, such as the base table that ``left``
    enriches. ``counted`` is the exact number of right rows where the caller knows
    it; it then tells, in place of the estimate, whether to look for hot keys. Whether
    a side is broadcast is always left to Spark, which knows its bytes.
    """
    rights = [rights] if isinstance(rights, DataFrame) else list(rights)
    pairs = dict(on) if isinstance(on, dict) else {k: k for k in ([on] if isinstance(on, str) else on)}
    keys = list(pairs)
    if counted is None:
        large = [not fits_broadcast(r) for r in rights]
    else:
        large = [counted * row_bytes(r) > broadcast_limit(left) for r in rights]
    source = (left if keys_from is None else keys_from).select(*keys)
    hot: dict[int, float] = {}
    types = {}
    # A left side of a broadcast's size has no hot key worth spreading.
    if any(large) and not fits_broadcast(source):
        # All sides hash the key in one type, so equal keys hash alike.
        types = _common_types(source, [r for r, is_large in zip(rights, large) if is_large], pairs)
        hot = hot_hashes(source.select(*[F.col(k).cast(types[k]).alias(k) for k in keys]), keys)
    out = _salted(left, F.xxhash64(*[F.col(k).cast(types[k]) for k in keys]), hot) if hot else left
    for right, is_large in zip(rights, large):
        names = [_KEY + r for r in pairs.values()]
        renamed = right.withColumnsRenamed({r: _KEY + r for r in pairs.values()})
        match = [F.col(k) == F.col(n) for k, n in zip(keys, names)]
        extra = list(names)
        if hot and is_large:
            typed = [F.col(n).cast(types[k]) for k, n in zip(keys, names)]
            renamed = _replicated(renamed, F.xxhash64(*typed), hot)
            match.append(F.col(_SALT) == F.col(_SALT + "_r"))
            extra.append(_SALT + "_r")
        if condition is not None:
            match.append(condition())
        out = out.join(renamed, reduce(and_, match), how).drop(*extra)
    return out.drop(_SALT) if hot else out


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, count: str = "n_rows") -> DataFrame:
    """Foreign-key values without a parent, with the number of child rows of each.

    The child is reduced to one row per value before it is shuffled, so a hot
    value costs no more than a rare one.
    """
    values = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias(count))
    known = parent.select(F.col(pk).alias(_KEY + pk))
    return values.join(known, F.col(fk) == F.col(_KEY + pk), "left_anti")


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """The child rows whose foreign key has no parent.

    The missing key values come from ``orphans``, one row each, so a hot key that has its parent
    costs nothing here, and a hot orphan meets a single row.
    """
    missing = orphans(child, fk, parent, pk).select(F.col(fk).alias(_KEY + fk))
    return child.join(missing, F.col(fk) == F.col(_KEY + fk), "left_semi")


_BYTES, _TEXT = "__bytes_", "__text_"


def packed(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with md5 texts as their 16 bytes, for the way through a shuffle; ``unpacked`` gives the texts back.

    Half of a hexadecimal text is redundant, which the codec of the shuffle does not find. Other texts stay
    as they are.
    """
    for c in names:
        md5 = F.col(c).rlike(r"\A[0-9a-f]{32}\z")
        df = df.select("*", F.when(md5, F.unhex(c)).alias(_BYTES + c), F.when(~md5, F.col(c)).alias(_TEXT + c)).drop(c)
    return df


def unpacked(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the texts that ``packed`` took, at its end."""
    for c in names:
        df = df.select("*", F.coalesce(F.lower(F.hex(_BYTES + c)), F.col(_TEXT + c)).alias(c)).drop(_BYTES + c, _TEXT + c)
    return df

"""Type-2 history: check-based merge, dimension views, backfill and as-of binding."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.temporal import FIRST_INSTANT, timestamp
from millrace.operators.joins import lookup_join
from millrace.session import write_out

META = ("scd_id", "updated_at", "valid_from", "valid_to")


def version_id(key: Column, updated_at: Column) -> Column:
    """Hash that names one version of one key."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (key, updated_at)]
    return F.md5(F.concat(parts[0], F.lit("|"), parts[1]))


def first_history(source: DataFrame, key: str, snapshot_ts: str) -> DataFrame:
    """History after the first snapshot: every source row opens a version."""
    at = timestamp(snapshot_ts)
    return source.select(
        "*",
        version_id(F.col(key), at).alias("scd_id"),
        at.alias("updated_at"),
        at.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def merge_snapshot(
    history: DataFrame, source: DataFrame, key: str, check: Sequence[str], snapshot_ts: str
) -> DataFrame:
    """Merge one snapshot of ``source`` (one row per key) into ``history``.

    A new key opens a version. A key whose check columns differ (NULLs compare as
    values) closes its current version at ``snapshot_ts`` and opens another.
    Everything else stays: unchanged keys, changes outside ``check``, and keys that
    are missing from the source.

    History and source are read once each. Closed versions never match; they are
    spread by their own id, so a key with a very long history is not gathered in
    one task.
    """
    at = timestamp(snapshot_ts)
    columns = source.columns
    closed = F.col("valid_to").isNotNull()
    h = history.select(
        F.struct(*columns, *META).alias("h"),
        F.when(~closed, F.col(key)).alias("open_key"),
        F.when(closed, F.xxhash64("scd_id")).otherwise(F.xxhash64(key)).alias("spread"),
    ).alias("old")
    s = source.select(
        F.struct(*columns).alias("s"),
        F.col(key).alias("open_key"),
        F.xxhash64(key).alias("spread"),
    ).alias("new")
    joined = h.join(
        s,
        (F.col("old.spread") == F.col("new.spread")) & (F.col("old.open_key") == F.col("new.open_key")),
        "full",
    )
    in_history, in_source = F.col("h").isNotNull(), F.col("s").isNotNull()
    differs = reduce(
        lambda a, b: a | b, [~F.col(f"h.{c}").eqNullSafe(F.col(f"s.{c}")) for c in check]
    )
    opens = in_source & (~in_history | differs)
    closes = in_history & in_source & differs
    kept = F.struct(
        in_history.alias("present"),
        *[F.col(f"h.{c}").alias(c) for c in (*columns, *META[:-1])],
        F.when(closes, at).otherwise(F.col("h.valid_to")).alias("valid_to"),
    )
    added = F.struct(
        opens.alias("present"),
        *[F.col(f"s.{c}").alias(c) for c in columns],
        version_id(F.col(f"s.{key}"), at).alias("scd_id"),
        at.alias("updated_at"),
        at.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
    rows = joined.select(F.inline(F.array(kept, added)))
    return rows.where("present").select(*columns, *META)


def version_dimension(history: DataFrame, surrogate: str, columns: Sequence[str]) -> DataFrame:
    """History as a dimension: surrogate key, attributes, window and current flag."""
    return history.select(
        F.col("scd_id").alias(surrogate),
        *columns,
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def backfill_first(versions: DataFrame, key: str) -> DataFrame:
    """Let the first version of each key start in 1900, so that older facts match it.

    The first start per key is a pre-combined aggregate joined back on (key,
    start), which is unique, so no task has to hold all versions of one key.
    """
    firsts = versions.groupBy(F.col(key).alias("__k")).agg(F.min("valid_from").alias("__first"))
    marked = versions.join(
        firsts, (F.col(key) == F.col("__k")) & (F.col("valid_from") == F.col("__first")), "left"
    )
    start = F.when(F.col("__k").isNotNull(), timestamp(FIRST_INSTANT)).otherwise(F.col("valid_from"))
    return marked.withColumn("valid_from", start).drop("__k", "__first")


#: Finer bins that a coarse bin holds, at the least: each level of bins is one more shuffle of the rows looked up.
FAN_OUT = 64

#: Later than any time a version ends at.
LAST_INSTANT = "9999-12-31 23:59:59"


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    attributes: Sequence[str],
    long_history: int = 64,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Bind each fact to the versions of its key with ``valid_from <= ts < valid_to``.

    Facts without a match are kept with NULL attributes; an open version never ends. Where versions
    of a key overlap, a fact in several of them comes back once for each. The versions
    are counted first. If no key has more than ``long_history``, they are looked up by key.
    Otherwise the time of each key with a long history is cut into bins of about that many
    versions, every version is dealt into the bins it covers, and facts are looked up by key and bin,
    which finds the same pairs: so neither a hot key nor a long history meets in one task. Hot keys of
    the facts are spread by ``lookup_join`` either way.
    """
    counts = versions.groupBy(key).agg(F.count("*").alias("__n"))
    longest, total = counts.agg(F.max("__n"), F.sum("__n")).first()
    v = versions.select(F.col(key), *attributes, F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"))

    def inside() -> Column:
        return (F.col(ts) >= F.col("__from")) & (F.col("__to").isNull() | (F.col(ts) < F.col("__to")))

    if (longest or 0) <= long_history:
        joined = lookup_join(facts, v, key, condition=inside, keys_from=keys_from, counted=total or 0)
        return joined.drop("__from", "__to")
    bins = history_bins(versions, counts, key, long_history)
    located = in_bin(facts, bins, key, F.col(ts), "__bin", long_history)
    joined = lookup_join(located, into_bins(v, bins, key, long_history), [key, "__bin"], condition=inside)
    return joined.drop("__from", "__to", "__bin")


def history_bins(versions: DataFrame, counts: DataFrame, key: str, size: int) -> DataFrame:
    """(key, __number, __start): the time of each key with more than ``size`` versions, in bins of about ``size`` starts.

    Bounds are starts of versions, so bursts are cut like the rest; equal starts share a bin. The
    starts are numbered by ranges, not per key: only counts of ranges are summed up.
    """
    long = counts.where(F.col("__n") > size).select(F.col(key).alias("__k"))
    starts = versions.join(long, F.col(key) == F.col("__k"), "left_semi").select(key, F.col("valid_from").alias("__start"))
    # The number holds the partition in its upper bits, and partitions ascend with the ranges.
    order = [key, "__start"]
    ranged = starts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__row", F.monotonically_increasing_id())
    ranged = write_out(ranged, "version-starts").withColumn("__part", F.shiftright("__row", 33))
    parts = ranged.groupBy(key, "__part").agg(F.min("__row").alias("__first"), F.count("*").alias("__held"))
    before = F.sum("__held").over(Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(key, "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    place = F.col("__row") + F.col("__shift")
    bounds = ranged.join(parts, [key, "__part"]).where(place % size == 0).select(key, "__start").distinct()
    number = (F.row_number().over(Window.partitionBy(key).orderBy("__start")) - 1).cast("long")
    return write_out(bounds.select(key, number.alias("__number"), "__start"), "history-bins")


def in_bin(df: DataFrame, bins: DataFrame, key: str, at: Column, name: str, size: int) -> DataFrame:
    """``df`` with the bin that ``at`` falls into; 0 for a key without bins and before its first one.

    Bins are found from coarse to fine, as in a search tree: a coarse bin holds ``size`` finer ones, or ``FAN_OUT``
    if that is more, so each step is a join by key and coarse bin with a few candidates per row, and most
    histories need one step.
    """
    size = max(size, FAN_OUT)
    most = bins.agg(F.max("__number")).first()[0] or 0
    widths = [1]
    while most // widths[-1] >= size:
        widths.append(widths[-1] * size)
    out = df.withColumn(name, F.lit(0).cast("long"))
    for width in reversed(widths):
        parent = F.expr(f"__number div {width * size}") if width < widths[-1] else F.lit(0).cast("long")
        following = F.lead("__start").over(Window.partitionBy(key).orderBy("__number"))
        level = bins.where(F.col("__number") % width == 0)
        level = level.select(key, parent.alias("__up"), "__start", following.alias("__end"), F.expr(f"__number div {width}").alias("__own"))

        def within() -> Column:
            return (at >= F.col("__start")) & (F.col("__end").isNull() | (at < F.col("__end")))

        out = lookup_join(out, level, {key: key, name: "__up"}, condition=within)
        out = out.withColumn(name, F.coalesce("__own", F.lit(0))).drop("__start", "__end", "__own")
    return out


def into_bins(v: DataFrame, bins: DataFrame, key: str, size: int) -> DataFrame:
    """Versions with their bin, once for each bin they cover."""
    v = in_bin(v, bins, key, F.col("__from"), "__low", size)
    v = in_bin(v, bins, key, F.coalesce("__to", timestamp(LAST_INSTANT)), "__high", size)
    return v.withColumn("__bin", F.explode(F.sequence(F.col("__low"), F.greatest("__low", "__high")))).drop("__low", "__high")

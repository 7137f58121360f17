"""Rollups of child rows to the grain of their parent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from millrace.functions.cleaning import cents, from_cents
from millrace.functions.temporal import minutes_between
from millrace.operators.joins import fits_broadcast, hot_hashes
from millrace.session import write_out


def line_rollup(
    lines: DataFrame,
    parent: str,
    item: str,
    quantity: str,
    amount: str,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Amount, quantity, line count and distinct items per parent.

    Lines are normally gathered and sorted by parent in one shuffle, which also serves the
    distinct count and later joins on the parent: items are counted where they differ from the
    line before, so that a task holds a sorted partition, which may spill, and no table of all (parent, item). If
    some parent holds a large part of the lines, Spark's two-step distinct plan is kept instead: it
    reduces to (parent, item) first and so spreads that parent over its items.
    ``keys_from`` is a relation with the parents of ``lines`` that is cheaper to scan.
    """
    parents = (lines if keys_from is None else keys_from).select(parent)
    items = F.count_distinct(item)
    if fits_broadcast(parents) or not hot_hashes(parents, [parent]):
        before = F.lag(item).over(Window.partitionBy(parent).orderBy(F.asc_nulls_first(item)))
        first = F.col(item).isNotNull() & ~F.col(item).eqNullSafe(before)
        lines = lines.repartition(parent).withColumn("__first", first)
        items = F.count_if("__first")
    kind = lines.schema[amount].dataType
    if isinstance(kind, DecimalType) and kind.scale == 2 and kind.precision <= 12:
        subtotal = from_cents(F.sum(cents(amount)))
    else:
        subtotal = F.round(F.sum(amount), 2).cast("decimal(22,2)")
    return lines.groupBy(parent).agg(
        subtotal.alias("items_subtotal"),
        F.sum(quantity).cast("bigint").alias("items_total_qty"),
        F.count("*").alias("item_lines"),
        items.alias("distinct_menu_items"),
    )


def milestone_rollup(
    events: DataFrame,
    parent: str,
    ts: str,
    status: str,
    event_id: str,
    milestones: dict[str, str],
    flags: dict[str, str],
    durations: dict[str, tuple[str, str]],
) -> DataFrame:
    """One row per parent from its status history.

    ``milestones`` maps output columns to the status whose first time they hold,
    ``flags`` maps output columns to the milestone whose presence they tell, and
    ``durations`` maps output columns to (start, end) milestones.

    The latest status skips NULL statuses and events without a time; events at the
    same instant are ordered by their id. Every aggregate combines before the shuffle.
    """
    known = F.col(status).isNotNull() & F.col(ts).isNotNull()
    newest = F.when(known, F.struct(ts, event_id))
    rolled = events.groupBy(parent).agg(
        *[F.min(F.when(F.col(status) == s, F.col(ts))).alias(name) for name, s in milestones.items()],
        F.max_by(F.col(status), newest).alias("latest_status"),
        F.max(ts).alias("latest_status_at"),
    )
    return rolled.select(
        "*",
        *[F.col(m).isNotNull().alias(name) for name, m in flags.items()],
        *[minutes_between(a, b).alias(name) for name, (a, b) in durations.items()],
    )


def ordered_children(
    children: DataFrame, parent: str, order: str, fields: Sequence[str], span: int = 1_000_000
) -> DataFrame:
    """Children of each parent with their 1-based position in the order of a unique column.

    The list of a parent is given as numbered rows, not as one array, because a
    single parent may own a large part of all rows. A NULL order comes last. Where there are more than
    ``span`` rows, they are dealt into ranges of (parent, order) of about that many
    rows, whatever the values; ranks are computed inside (parent, range) groups and
    shifted by the number of rows in the parent's earlier ranges.
    """
    rows = children.select(parent, order, *fields)
    total = rows.count()
    last = F.col(order).asc_nulls_last()
    if total <= span:
        place = F.row_number().over(Window.partitionBy(parent).orderBy(last))
        return rows.select(parent, place.cast("bigint").alias("position"), order, *fields)
    ranged = rows.repartitionByRange(-(-total // span), F.col(parent), last)
    # Written once: the ranges must be the same for the counts and for the rows.
    ranged = write_out(ranged.withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy(parent, "__range").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(parent).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    skips = sizes.select(
        F.col(parent).alias("__p"), F.col("__range").alias("__r"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__skip")
    )
    inside = Window.partitionBy(parent, "__range").orderBy(last)
    placed = ranged.withColumn("__rank", F.row_number().over(inside)).join(
        skips, F.col(parent).eqNullSafe(F.col("__p")) & (F.col("__range") == F.col("__r"))
    )
    return placed.select(
        parent, (F.col("__skip") + F.col("__rank")).cast("bigint").alias("position"), order, *fields
    )


def key_ranges(relations: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Smallest and largest key of each named relation, and the next free key."""
    parts = [
        df.agg(F.min(key).cast("bigint").alias("lo"), F.max(key).cast("bigint").alias("hi")).select(
            F.lit(name).alias("relation"),
            "lo",
            "hi",
            (F.coalesce("hi", F.lit(0)) + F.lit(1)).cast("bigint").alias("next_key"),
        )
        for name, (df, key) in relations.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

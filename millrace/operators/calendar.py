"""The date dimension."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.temporal import date_parts


def dates_in_use(sources: Iterable[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct non-null dates of several relations (not a gap-free calendar).

    Each partition reduces to its few distinct dates before the only shuffle.
    """
    days = [df.select(F.col(c).alias("date_utc")).where(F.col(c).isNotNull()) for df, c in sources]
    out = days[0]
    for more in days[1:]:
        out = out.union(more)
    return out.distinct()


def date_dimension(sources: Iterable[tuple[DataFrame, str]]) -> DataFrame:
    parts = date_parts("date_utc")
    return dates_in_use(sources).select("date_utc", *[c.alias(n) for n, c in parts.items()])

"""Time arithmetic with the warehouse's semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_MICROS = 60_000_000
FIRST_INSTANT = "1900-01-01 00:00:00"


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a UTC wall-clock time."""
    return F.unix_micros(ts.cast("timestamp"))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end`` (may be negative).

    00:00:59 to 00:01:00 counts 1 and 00:00:00 to 00:00:59 counts 0, unlike
    ``timestampdiff``, which counts whole elapsed minutes.
    """
    a, b = (micros(F.col(c) if isinstance(c, str) else c) for c in (start, end))
    whole = [m - F.pmod(m, F.lit(MINUTE_MICROS)) for m in (a, b)]
    # Both sides are multiples of a minute, so the division is exact.
    return ((whole[1] - whole[0]) / F.lit(MINUTE_MICROS)).cast("bigint")


def timestamp(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def date_parts(day: str) -> dict[str, Column]:
    """Calendar attributes of a date; Sunday is day 0 and weeks follow ISO 8601."""
    d = F.col(day)
    return {
        "year_utc": F.year(d),
        "month_utc": F.month(d),
        "day_utc": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d) - F.lit(1),
        "week_of_year": F.weekofyear(d),
    }

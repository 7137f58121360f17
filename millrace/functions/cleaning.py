"""Casts and text cleaning used by the staging layer."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    StringType,
    TimestampNTZType,
)

# The Unicode space separators (category Zs) that count as blank at
# the ends of a text. Tabs and line breaks are kept.
SPACES = (
    " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# Times as Spark's own cast reads them right: a full date and, after it, hour and minute
# at least. Spark alone would also take a bare year, or a bare time as one of today.
_ZONE = r"(?:Z|[+-]\d{1,2}(?::?\d{2}(?::\d{2})?)?| [A-Za-z]\S*)?"
PLAIN_TIME = r"^-?\d{4,6}-\d{1,2}-\d{1,2}(?:[ T]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d*)?)?" + _ZONE + ")?$"
# All forms of a time: sign, year, separator, month, day, hour, minute, second, fraction, zone.
ANY_TIME = (
    r"^\s*(-?)(\d{1,6})([-/ \\])(\d{1,2})\3(\d{1,2})"
    r"(?:(?: +|T)0*(\d{1,2}):(\d{1,2}):?(?:(?<=:)(\d{1,2})(\.\d*)?)?(" + _ZONE + ") *)?$"
)
EPOCH = "epoch"


def strict_cast(value: Column | str, dtype: str) -> Column:
    """Cast that raises on a malformed value (ANSI mode)."""
    return _column(value).cast(dtype)


def safe_cast(value: Column | str, dtype: str) -> Column:
    """Cast that turns a malformed value into NULL."""
    return _column(value).try_cast(dtype)


def whole_number(value: Column | str, source: DataType, dtype: str, safe: bool = False) -> Column:
    """Integer cast that rounds fractions instead of cutting them off.

    Halves go to the even neighbour for floating point and away from zero for
    decimals and texts, as the warehouse's staging rules expect.
    """
    cast = safe_cast if safe else strict_cast
    if isinstance(source, (FloatType, DoubleType)):
        return cast(F.rint(_column(value)), dtype)
    if isinstance(source, DecimalType):
        return cast(F.round(_column(value), 0), dtype)
    if isinstance(source, StringType):
        return cast(F.round(cast(value, "decimal(38,10)"), 0), dtype)
    return cast(value, dtype)


def utc_timestamp(value: Column | str, source: DataType = StringType(), safe: bool = False) -> Column:
    """UTC wall-clock time of a zoned instant, a text with or without offset, or a plain time.

    All layers above the raw one carry this single timestamp type, so interval
    comparisons never mix zoned and plain values.
    """
    column = _column(value)
    if isinstance(source, TimestampNTZType):
        return column
    if not isinstance(source, StringType):
        return column.cast("timestamp").cast("timestamp_ntz")
    plain = F.when(column.rlike(PLAIN_TIME), column.try_cast("timestamp"))
    parsed = F.coalesce(plain, _unusual_time(column))
    if not safe:
        wrong = F.raise_error(F.concat(F.lit("not a time: "), column)).cast("timestamp")
        parsed = F.when(column.isNotNull(), F.coalesce(parsed, wrong))
    return parsed.cast("timestamp_ntz")


def _unusual_time(text: Column) -> Column:
    """The time a text means that Spark's cast does not read, else NULL.

    Blanks around it, other date separators, years below 1000, hour 24 as the start of the next
    day, and ``epoch``.
    """

    def part(n: int) -> Column:
        return F.regexp_extract(text, ANY_TIME, n)

    midnight = (part(6) == "24") & part(7).rlike("^0+$") & part(8).rlike("^0*$") & part(9).rlike(r"^\.?0*$")
    hour = F.when(midnight, F.lit("0")).otherwise(part(6))
    clock = F.when(part(6) == "", F.lit("")).otherwise(
        F.concat(F.lit(" "), hour, F.lit(":"), part(7), F.lit(":"), F.when(part(8) == "", F.lit("0")).otherwise(part(8)), part(9), part(10))
    )
    year = F.greatest(F.length(part(2)), F.lit(4))
    time = F.concat(part(1), F.lpad(part(2), year, F.lit("0")), F.lit("-"), part(4), F.lit("-"), part(5), clock).try_cast("timestamp")
    time = F.when(midnight, time + F.expr("interval 24 hours")).otherwise(time)
    return F.when(text.rlike(ANY_TIME), time).when(F.lower(F.trim(text)) == EPOCH, F.timestamp_seconds(F.lit(0)))


def utc_day(value: Column | str) -> Column:
    """UTC calendar day of an instant (the session zone is UTC)."""
    return F.to_date(strict_cast(value, "timestamp"))


def clean_text(value: Column | str) -> Column:
    """As text, without surrounding blanks; nothing left means NULL."""
    return F.nullif(F.trim(_column(value).cast("string"), F.lit(SPACES)), F.lit(""))


def clean_category(value: Column | str) -> Column:
    """Cleaned text in upper case."""
    return F.upper(clean_text(value))


def money(value: Column | str, precision: int = 12) -> Column:
    """Fixed-point amount with two decimals, rounded half away from zero."""
    return _column(value).cast(f"decimal({precision},2)")


def cents(value: Column | str) -> Column:
    """An amount with two decimals and at most 12 digits as whole cents.

    Exact, since so many digits fit a double; sums of cents stay 8-byte values in
    aggregates, where a sum of decimals would carry objects.
    """
    return F.rint(_column(value).cast("double") * F.lit(100)).cast("bigint")


def from_cents(value: Column | str, dtype: str = "decimal(22,2)") -> Column:
    """Whole cents as an amount with two decimals."""
    return (_column(value).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(dtype)

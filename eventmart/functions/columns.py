"""Column expressions shared by the operators. No UDFs: everything stays in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The corrupted-integer rule of the event log.
INT_OVERFLOW = 2147483648
REPAIRED, NULLED = "bitflip_recovered", "overflow_nulled"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def repair_int(value: str | Column) -> Column:
    """Undo a bitwise complement; a value with the high bit set is beyond repair and becomes NULL."""
    v = col(value)
    return F.when(v < 0, F.bitwise_not(v)).when(v < F.lit(INT_OVERFLOW), v)


def register_sql_functions(spark: SparkSession) -> None:
    """Offer the integer repair to SQL users as `repair_int(v)`."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION repair_int(v BIGINT) RETURNS BIGINT "
              f"RETURN CASE WHEN v < 0 THEN ~v WHEN v < {INT_OVERFLOW} THEN v END")


def repair_label(values: Sequence[str | Column]) -> Column:
    """Which repair a row needed, looking at several raw integers at once."""
    raw = [col(v) for v in values]
    low = F.least(*raw) if len(raw) > 1 else raw[0]
    high = F.greatest(*raw) if len(raw) > 1 else raw[0]
    return F.when(low < 0, F.lit(REPAIRED)).when(high >= F.lit(INT_OVERFLOW), F.lit(NULLED))


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    """Elapsed seconds as DOUBLE, from whole microseconds (no float cancellation)."""
    return (F.unix_micros(col(later)) - F.unix_micros(col(earlier))) / F.lit(1e6)


def time_slice(ts: str | Column, seconds: int) -> Column:
    """Number of the fixed-width time slice an instant falls in; never decreases with time."""
    return F.floor(F.unix_seconds(col(ts)) / F.lit(seconds)).cast("bigint")


def number_slice(value: str | Column, width: float) -> Column:
    """Number of the fixed-width slice a value falls in; never decreases with the value."""
    return F.floor(col(value).cast("double") / F.lit(float(width))).cast("bigint")


def bracket_min(level: str | Column, width: int = 10) -> Column:
    """First level of the bracket a level belongs to (1, 11, 21, ... for width 10)."""
    return (F.floor((col(level) - 1) / F.lit(width)) * width + 1).cast("int")


def day(ts: str | Column) -> Column:
    return col(ts).cast("date")


def stamp(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd HH:mm:ss")


def text_of(*parts: str | Column) -> Column:
    """Concatenate text; plain strings are literals. NULL if any part is NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def ratio(numerator: Column, denominator: Column) -> Column:
    """DOUBLE quotient, NULL when the denominator is zero or NULL."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def nulls_for(value: str | Column, placeholder) -> Column:
    """The value, or NULL where it equals the placeholder."""
    return F.nullif(col(value), F.lit(placeholder))

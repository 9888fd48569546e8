"""Event-time and amount columns (PRJ-1, cents for exact sums)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def amount_cents(amount: Column | str = "amount") -> Column:
    """Integer cents; sums of cents are exact and order independent."""
    if isinstance(amount, str):
        amount = F.col(amount)
    return F.round(amount * 100).cast("bigint")


# An amount is its whole cents and a rest in thousand-millionths of a unit of money. The
# rest of a two-decimal amount is exactly 0; sums of both are exact and order independent.
RESTS_PER_CENT = 10_000_000


def amount_rest() -> Column:
    """What ``amount`` has beyond ``amount_cents``: at most half a cent either way."""
    beyond = F.col("amount") - F.col("amount_cents").cast("double") / F.lit(100.0)
    return F.floor(beyond * F.lit(1e9) + F.lit(0.5)).cast("bigint")


def exact_cents(cents: Column, rest: Column) -> Column:
    """Cents with their fraction, of an amount or of sums of both parts."""
    return cents.cast("double") + rest.cast("double") / F.lit(float(RESTS_PER_CENT))


def exact_sum(value: Column | str) -> Column:
    """The sum of 64-bit integers as a decimal of 38 digits. The high and the low 24 bits are
    summed apart, as integers, so no sum of under 2^39 values overflows."""
    value = F.col(value) if isinstance(value, str) else value
    high, low = F.sum(F.shiftright(value, 24)), F.sum(value.bitwiseAND(F.lit((1 << 24) - 1).cast("bigint")))
    return high.cast("decimal(30,0)") * F.lit(1 << 24) + low.cast("decimal(20,0)")


def whole_cents(cents: Column, rest: Column) -> Column:
    """The nearest whole cent of a total, rounded once, after summing; null where a 64-bit
    integer cannot hold it (the amount beside it does)."""
    return (cents + F.floor(rest.cast("double") / F.lit(float(RESTS_PER_CENT)) + F.lit(0.5)).cast("bigint")
            ).try_cast("bigint")


def with_event_time(df: DataFrame) -> DataFrame:
    """Add ``ts`` (event time as TIMESTAMP) and ``amount_cents``."""
    out = df.withColumn("ts", F.timestamp_millis(F.col("event_time")))
    if "amount_cents" not in df.columns:
        out = out.withColumn("amount_cents", amount_cents("amount"))
    return out


def tumbling_end_ms(event_time: Column | str, window_ms: int) -> Column:
    """End (exclusive, epoch ms) of the epoch-aligned tumbling window."""
    if isinstance(event_time, str):
        event_time = F.col(event_time)
    return event_time - F.pmod(event_time, F.lit(window_ms)) + F.lit(window_ms)


def window_end_ms(window_col: str = "window") -> Column:
    """Epoch ms of the end of a ``F.window`` struct."""
    return F.unix_millis(F.col(f"{window_col}.end"))


def epoch_micros(col: Column | str, dtype: T.DataType) -> Column:
    """Microseconds since 1970-01-01 00:00 of a timestamp column.

    A TIMESTAMP_NTZ is a wall-clock value: it is read as UTC using only
    zone-free functions (day number and time-of-day fields), so the result
    does not depend on the session time zone. A TIMESTAMP is an instant.
    """
    if isinstance(col, str):
        col = F.col(col)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    day = F.unix_date(col.cast("date")).cast("long")
    sec = F.extract(F.lit("SECOND"), col)           # seconds with micros
    return (day * F.lit(86_400_000_000)
            + F.hour(col).cast("long") * F.lit(3_600_000_000)
            + F.minute(col).cast("long") * F.lit(60_000_000)
            + (sec * F.lit(1_000_000)).cast("long"))

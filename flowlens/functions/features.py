"""Column expressions for time and traffic features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlens.functions.values import as_column

# The guards added to a denominator.
RATE_EPSILON = 0.001
SMALL_EPSILON = 0.000001

# First and last second of the years 1 to 9999, the range of a timestamp.
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799


def epoch_to_time(seconds: Column | str) -> Column:
    """Epoch seconds to a timestamp without its fraction; NULL when out of range."""
    whole = as_column(seconds).try_cast("long")
    return F.when(whole.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(whole))


def hour_of_day(time: Column | str = "timestamp") -> Column:
    return F.hour(time)


def day_of_week(time: Column | str = "timestamp") -> Column:
    """1 is Sunday."""
    return F.dayofweek(time)


def total_bytes(sent: Column | str = "orig_bytes", received: Column | str = "resp_bytes") -> Column:
    """Sum of both directions; NULL if it does not fit a long."""
    return F.try_add(as_column(sent), as_column(received))


def bytes_per_sec(
    total: Column | str = "total_bytes",
    duration: Column | str = "duration",
    epsilon: float = RATE_EPSILON,
) -> Column:
    return F.try_divide(as_column(total), as_column(duration) + F.lit(epsilon))


def orig_bytes_ratio(
    sent: Column | str = "orig_bytes",
    total: Column | str = "total_bytes",
    epsilon: float = SMALL_EPSILON,
) -> Column:
    return F.try_divide(as_column(sent), as_column(total) + F.lit(epsilon))

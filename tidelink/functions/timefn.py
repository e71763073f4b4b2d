"""Time helpers as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value that must equal the reference's: epoch numbers whose reading
# as seconds lands after year 3000 are milliseconds. 3001-01-01T00:00:00Z:
EPOCH_MS_THRESHOLD = 32535216000

# Epochs that a calendar of four-digit years has, in seconds and milliseconds:
# 0001-01-01T00:00:00Z and 10000-01-01T00:00:00Z.
FIRST_EPOCH_S = -62135596800
END_EPOCH_MS = 253402300800000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def minute_index(ts) -> Column:
    """Whole minutes since the epoch (floor), i.e. the minute boundary count."""
    return F.floor(F.unix_seconds(_c(ts)) / 60)


def minute_boundary_diff(a, b) -> Column:
    """|number of minute boundaries between a and b| (DuckDB date_diff('minute')).

    00:00:59 -> 00:01:01 counts 1, unlike an elapsed-time difference.
    """
    return F.abs(minute_index(b) - minute_index(a))


def elapsed_ms(a, b) -> Column:
    """Whole milliseconds elapsed from a to b (floor of the microsecond gap)."""
    return F.floor((F.unix_micros(_c(b)) - F.unix_micros(_c(a))) / 1000)


def offset_seconds(t, t0) -> Column:
    """Seconds since ``t0`` at millisecond resolution (whole ms, then /1000)."""
    return elapsed_ms(t0, t) / F.lit(1000.0)


def add_seconds(ts, secs) -> Column:
    """ts + fractional seconds, rounded to the microsecond."""
    return F.timestamp_micros(F.unix_micros(_c(ts)) + F.round(_c(secs).cast("double") * 1e6).cast("long"))


def epoch_auto(x) -> Column:
    """Numeric epoch, seconds or milliseconds decided per row.

    Null where the number is no time of the years 1 to 9999 (NaN and the
    infinities too), so that such a row can be put aside.
    """
    v = _c(x).cast("double")
    v = F.when((v >= F.lit(FIRST_EPOCH_S)) & (v < F.lit(END_EPOCH_MS)), v)
    return (F.when(v >= F.lit(EPOCH_MS_THRESHOLD), F.timestamp_millis(F.floor(v).cast("long")))
             .otherwise(F.timestamp_micros(F.round(v * 1e6).cast("long"))))


def local_to_utc(naive_ts, tz) -> Column:
    """Wall-clock time in zone ``tz`` (a column or literal) -> UTC instant."""
    return F.to_utc_timestamp(_c(naive_ts), tz if isinstance(tz, Column) else F.lit(tz))


def utc_to_local(ts, tz) -> Column:
    """UTC instant -> wall clock in ``tz`` (for month layout in local time)."""
    return F.from_utc_timestamp(_c(ts), tz if isinstance(tz, Column) else F.lit(tz))


def day_of(ts) -> Column:
    """Calendar day (UTC) as a timestamp at midnight, like date_trunc('day')."""
    return F.date_trunc("day", _c(ts))

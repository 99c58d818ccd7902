"""Durations and epoch conversions for TIMESTAMP and TIMESTAMP_NTZ columns.

All arithmetic on event time is done on epoch microseconds (bigint), which
keeps comparisons exact and identical to the DuckDB oracle.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

US_PER_MS = 1_000
US_PER_S = 1_000_000


def _EPOCH_NTZ() -> Column:
    """1970-01-01 as TIMESTAMP_NTZ: NTZ arithmetic against it never consults a time zone."""
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")

_UNITS_US = {
    "us": 1, "microsecond": 1, "microseconds": 1,
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "min": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
    "week": 604_800_000_000, "weeks": 604_800_000_000,
}
_DURATION = re.compile(r"^\s*(\d+(?:\.\d+)?)\s*([a-zA-Z]+)\s*$")


def duration_us(d: str | int | _dt.timedelta) -> int:
    """``'10 minutes'`` / ``timedelta`` / int microseconds -> microseconds.

    Negative durations are rejected, as the reference rejects negative
    out-of-orderness and idleness.
    """
    if isinstance(d, _dt.timedelta):
        us = (d.days * 86_400 + d.seconds) * US_PER_S + d.microseconds
    elif isinstance(d, int):
        us = d
    else:
        m = _DURATION.match(str(d))
        if not m or m.group(2).lower() not in _UNITS_US:
            raise ValueError(f"cannot parse duration {d!r}")
        us = int(round(float(m.group(1)) * _UNITS_US[m.group(2).lower()]))
    if us < 0:
        raise ValueError(f"duration must not be negative: {d!r}")
    return us


def spark_interval(d: str | int | _dt.timedelta) -> str:
    """A duration as a string Spark's window functions accept."""
    return f"{duration_us(d)} microseconds"


def time_type(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def epoch_us(df: DataFrame, col: str) -> Column:
    """Epoch microseconds of a TIMESTAMP / TIMESTAMP_NTZ / bigint-millis column.

    NTZ values are read as UTC wall time, independent of the session zone.
    """
    return epoch_us_of(time_type(df, col), F.col(col), col)


def epoch_us_of(dt: T.DataType, c: Column, name: str = "column") -> Column:
    """``epoch_us`` for an expression of a known type."""
    if isinstance(dt, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", _EPOCH_NTZ(), c)
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dt, (T.LongType, T.IntegerType)):
        return c.cast("long") * US_PER_MS  # epoch milliseconds, as the reference's tuples
    raise TypeError(f"{name} has type {dt}, expected a timestamp or epoch-ms long")


def ntz_from_us(us: Column) -> Column:
    """Epoch microseconds -> TIMESTAMP_NTZ (UTC wall time)."""
    return F.timestamp_add("MICROSECOND", us, _EPOCH_NTZ())


def as_event_time(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Cast a TIMESTAMP_NTZ or epoch-ms column to TIMESTAMP for ``withWatermark``.

    Structured Streaming refuses a watermark on TIMESTAMP_NTZ. The cast reads
    the value as UTC wall time, so the session zone must be UTC for the
    instant to be right; ``build_session`` pins it.
    """
    dt = time_type(df, col)
    c = F.col(col)
    if isinstance(dt, T.TimestampType):
        out = c
    elif isinstance(dt, T.TimestampNTZType):
        out = c.cast("timestamp")
    elif isinstance(dt, (T.LongType, T.IntegerType)):
        out = F.timestamp_millis(c.cast("long"))
    else:
        raise TypeError(f"column {col} has type {dt}")
    return df.withColumn(name or col, out)

"""Watermarks on streams: dropped rows counted, and several sources. ``sinks.writers.late_sinks`` keeps late rows.

* ``drop_system_lag_late``: a row is late when its window ended before
  ``now - lag`` (processing time).
* ``dropped_by_watermark``: rows that the stateful operators of a query
  dropped as late, by micro-batch.
* ``union_sources``: one stream from several, each with its own delay; the
  slowest source holds the watermark back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.functions.time import US_PER_MS, as_event_time, duration_us, spark_interval


def drop_system_lag_late(df: DataFrame, time: str, size, lag="50 seconds", now: Column | None = None) -> DataFrame:
    """Keep rows whose tumbling window has not ended before ``now - lag``."""
    now = F.current_timestamp() if now is None else now
    size_us, lag_us = duration_us(size), duration_us(lag)
    t = F.unix_micros(F.col(time).cast("timestamp"))
    end_us = (t - F.pmod(t, F.lit(size_us))) + F.lit(size_us)
    wm_us = F.unix_micros(now) - F.lit(lag_us)
    return df.filter(end_us - F.lit(US_PER_MS) > wm_us)


def dropped_by_watermark(query: StreamingQuery) -> dict[int, int]:
    """Rows that the stateful operators of ``query`` dropped as late, by batch, as far as its progress goes back."""
    out: dict[int, int] = {}
    for p in query.recentProgress:
        out[p["batchId"]] = sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])
    return out


def union_sources(sources: list[tuple[DataFrame, str, str]], time: str = "time") -> DataFrame:
    """The union of streams given as (stream, its time column, its delay), by column name, with one time column.

    Each stream has its own watermark, and the smallest of them holds for
    windows behind the union: a slow source keeps them open, as the reference's
    engine does with parallel sources. Asking for the smallest is a setting of
    the session (``multipleWatermarkPolicy``), which this makes.
    """
    if not sources:
        raise ValueError("at least one source is needed")
    sources[0][0].sparkSession.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    marked = [as_event_time(df.withColumnRenamed(t, time), time).withWatermark(time, spark_interval(delay)) for df, t, delay in sources]
    out = marked[0]
    for more in marked[1:]:
        out = out.unionByName(more)
    return out

"""Windowed and continuous aggregates on streams (built-in stateful operators).

* tumbling / sliding / session windows with a bounded-out-of-orderness
  watermark (``WATERMARK FOR t AS t - INTERVAL d`` = ``withWatermark(t, d)``);
  in append mode a window is emitted once the watermark passes its end and
  late rows are dropped, which is the reference's behaviour without allowed
  lateness.
* continuous word count: ``groupBy(word).count()`` in update or complete
  mode. The reference prints a retract/insert changelog; update mode gives
  the upserts and the final state is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import as_event_time, spark_interval
from tideline.operators.wordcount import words


def _flat(g: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in g.columns if c not in (*keys, "__w")]
    return g.select(*keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *rest)


def stream_window_aggregate(df: DataFrame, keys: list[str], time: str, size, aggs: list[Column],
                            slide=None, delay="5 seconds") -> DataFrame:
    """Event-time tumbling (or sliding) window aggregate with a watermark."""
    ev = as_event_time(df, time).withWatermark(time, spark_interval(delay))
    w = (F.window(time, spark_interval(size)) if slide is None
         else F.window(time, spark_interval(size), spark_interval(slide)))
    return _flat(ev.groupBy(*keys, w.alias("__w")).agg(*aggs), keys)


def stream_session_aggregate(df: DataFrame, keys: list[str], time: str, gap: str | Column,
                             aggs: list[Column], delay="5 seconds") -> DataFrame:
    """Session windows on a stream (static gap, or a string-valued gap column)."""
    ev = as_event_time(df, time).withWatermark(time, spark_interval(delay))
    g = gap if isinstance(gap, Column) else spark_interval(gap)
    return _flat(ev.groupBy(*keys, F.session_window(time, g).alias("__w")).agg(*aggs), keys)


def stream_word_counts(df: DataFrame, text: str, word: str = "word", count: str = "count") -> DataFrame:
    """Continuous COUNT(*) per word; run with outputMode 'update' or 'complete'."""
    return words(df, text, word).groupBy(word).agg(F.count(F.lit(1)).alias(count))

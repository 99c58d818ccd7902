"""Event-time ordered LAG and price signals on a stream.

Structured Streaming refuses ``lag() OVER`` on a stream. The reference's
engine orders a rowtime OVER window by buffering rows until the watermark
passes them. Here rows wait in state until then and are emitted in (time, tie)
order with the previous price of their key. Rows at or behind the watermark
when they arrive are late: they are counted and dropped, as the reference's
engine drops them, or kept in the output on request. Rows without key or time
have no place in the order; ``split_valid`` sends them elsewhere and counts
them.

Two engines share one vectorized step, which takes the rows of a group of keys
at once (``key_groups`` groups), as one sort and one shift. State is the last
row of each key and the rows not yet passed by the watermark.

* ``'state_v2'`` (``transformWithStateInPandas``) keeps the last rows in
  levelled blocks (see ``streaming.state``): a batch writes the rows of its own
  keys and those that wait, however many idle keys there are.
* ``'group_state'`` (``applyInPandasWithState``) moves a group's whole state
  with each batch that has rows for it: for few keys.

``key_groups`` bounds the parallelism and belongs to the checkpoint.

Values cross into Python as strings, which keeps nulls, NaN and every digit.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.scalar import BUY_BELOW, SELL_ABOVE, signal
from tideline.functions.time import as_event_time
from tideline.session import ship_package
from tideline.streaming.state import Levels, packed, unpacked

KEY_GROUPS = 64
_FIELDS = ["k", "t_us", "tie", "v"]
_ROWS = pa.schema([("k", pa.string()), ("t_us", pa.int64()), ("tie", pa.int64()), ("v", pa.string())])
_STATE = ", ".join(f"{part}_k array<string>, {part}_t array<long>, {part}_i array<long>, {part}_v array<string>"
                   for part in ("last", "wait"))
_OUT = "k string, t_us long, tie long, v string, prev string, late boolean"


def split_valid(df: DataFrame, key: str, time: str) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) rows: rejected ones have no key or no time.

    Their numbers in each micro-batch are the observed metric ``input`` of
    the queries that read the valid rows.
    """
    ok = F.col(key).isNotNull() & F.col(time).isNotNull()
    counted = df.observe("input", F.count(F.when(ok, 1)).alias("valid"), F.count(F.when(~ok, 1)).alias("rejected"))
    return counted.filter(ok), df.filter(~ok)


def _frame(columns: list[list]) -> pd.DataFrame:
    return pd.DataFrame({"k": pd.Series(columns[0], dtype=object), "t_us": pd.Series(columns[1], dtype="int64"),
                         "tie": pd.Series(columns[2], dtype="int64"), "v": pd.Series(columns[3], dtype=object)})


def lag_step(fresh: list[pd.DataFrame], last: pd.DataFrame, wait: pd.DataFrame, wm_ms: int):
    """One micro-batch of a group: (output rows, new last rows of the keys emitted, waiting rows).

    ``last`` holds the last emitted row of each key, ``wait`` those behind
    which the watermark still is.
    """
    rows = pd.concat([f[_FIELDS] for f in fresh], ignore_index=True) if fresh else wait.iloc[:0]
    behind = rows["t_us"] // 1000 <= wm_ms if wm_ms > 0 else pd.Series(False, index=rows.index)
    late = rows[behind].assign(prev=None, late=True)
    rows = pd.concat([wait, rows[~behind]], ignore_index=True)
    due = rows["t_us"] // 1000 <= wm_ms
    ready, wait = rows[due], rows[~due]
    ready = ready.sort_values(["k", "t_us", "tie"], kind="stable")
    before = ready["v"].shift(1)
    first = ready["k"] != ready["k"].shift(1)
    known = dict(zip(last["k"], last["v"]))
    prev = before.astype(object).where(~first, ready["k"].map(known))
    out = ready.assign(prev=prev.astype(object).where(prev.notna(), None), late=False)
    return (pd.concat([out, late], ignore_index=True) if len(late) else out), ready.drop_duplicates("k", keep="last"), wait


class EventTimeLagProcessor(StatefulProcessor):
    """The step over a group's state, woken by a timer at its earliest waiting row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = Levels(handle, "last", _ROWS)
        self.wait = handle.getValueState("wait", "rows binary")

    def _step(self, fresh: list[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        wait = unpacked(bytes(self.wait.get()[0]), _ROWS) if self.wait.exists() else _frame([[], [], [], []])
        out, last, wait = lag_step(fresh, self.last.read(), wait, timerValues.getCurrentWatermarkInMs())
        self.last.add(last)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if len(wait):
            self.wait.update((packed(wait, _ROWS),))
            self.handle.registerTimer(int(wait["t_us"].min()) // 1000)
        else:
            self.wait.clear()
        if len(out):
            yield out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        return self._step(list(rows), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._step([], timerValues)

    def close(self) -> None:
        pass


def _group_state_step(key, pdfs, state):
    parts = [list(x) for x in state.get] if state.exists else [[] for _ in range(8)]
    out, new, wait = lag_step(list(pdfs), _frame(parts[:4]), _frame(parts[4:]), state.getCurrentWatermarkMs())
    last = pd.concat([_frame(parts[:4]), new], ignore_index=True).drop_duplicates("k", keep="last")
    state.update(tuple(x[c].tolist() for x in (last, wait) for c in _FIELDS))
    if len(wait):
        state.setTimeoutTimestamp(int(wait["t_us"].min()) // 1000)
    if len(out):
        yield out


def stream_with_previous(df: DataFrame, key: str, value: str, time: str, tie: str | None = None,
                         delay: str = "5 seconds", engine: str = "state_v2", emit_late: bool = False,
                         key_groups: int = KEY_GROUPS) -> DataFrame:
    """Streaming ``LAG(value) OVER (PARTITION BY key ORDER BY time)``.

    Output ``(key, time, tie, value, prev)``; ``time`` becomes TIMESTAMP. Rows
    without key or time are left out. Late rows are left out too. Those behind
    the watermark of the batch before do not reach the operator; Spark counts
    them (``watermark.dropped_by_watermark``). The others are counted as the
    observed metric ``lag``; with ``emit_late`` they are kept, marked by a
    column ``late``.
    """
    ship_package(df.sparkSession)
    ev = as_event_time(df, time)
    types = {c: ev.schema[c].dataType for c in (key, value)}
    narrow = ev.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).cast("string").alias("k"), F.col(time), F.unix_micros(F.col(time)).alias("t_us"),
        F.coalesce(F.col(tie).cast("long") if tie else F.lit(0), F.lit(0)).cast("long").alias("tie"),
        F.col(value).cast("string").alias("v")).withWatermark(time, delay)
    grouped = narrow.withColumn("g", F.pmod(F.xxhash64("k"), F.lit(key_groups))).groupBy("g")
    if engine == "group_state":
        out = grouped.applyInPandasWithState(_group_state_step, _OUT, _STATE, "append", "EventTimeTimeout")
    elif engine == "state_v2":
        out = grouped.transformWithStateInPandas(
            statefulProcessor=EventTimeLagProcessor(), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")
    else:
        raise ValueError(f"unknown engine {engine!r}")
    out = out.observe("lag", F.count(F.when(F.col("late"), 1)).alias("late"))
    out = out if emit_late else out.filter(~F.col("late")).drop("late")
    return out.select(F.col("k").cast(types[key]).alias(key), F.timestamp_micros(F.col("t_us")).alias(time),
                      F.col("tie").alias(tie or "tie"), F.col("v").cast(types[value]).alias(value),
                      F.col("prev").cast(types[value]).alias("prev"), *(["late"] if emit_late else []))


def stream_price_signals(df: DataFrame, key: str, price: str, time: str, tie: str | None = None,
                         delay: str = "5 seconds", low: float = BUY_BELOW,
                         high: float = SELL_ABOVE, engine: str = "state_v2",
                         key_groups: int = KEY_GROUPS) -> DataFrame:
    """The BUY/SELL job on a stream: ``(key, signal, price, time)``."""
    lagged = stream_with_previous(df, key, price, time, tie, delay, engine, key_groups=key_groups)
    out = lagged.select(F.col(key), signal(F.col(price), F.col("prev"), low, high).alias("signal"),
                        F.col(price), F.col(time))
    return out.filter(F.col("signal").isNotNull())

"""Keyed deduplication on a stream.

* ``TagDuplicatesProcessor`` / ``stream_tag_duplicates``: every row with
  ``is_duplicate``; split into a main and a side sink by ``two_sinks``.
* ``stream_keep_first``: the rows that are no duplicates. State is kept
  forever (the reference's plain dedup never clears it either).
* ``ExpiringDedupProcessor`` / ``stream_dedup_expiring``: processing-time
  timers at ``arrival + ttl`` after every arrival; any timer clears the key.

Rows of one micro-batch arrive in the order of the ``order`` column, and
batches one after the other, so "first" does not depend on how files or
partitions happen to be read.

Keys are dealt to ``key_groups`` groups, and a group's exact keys are read
once and written once a batch, as blocks (see ``streaming.state``).
``key_groups`` bounds the parallelism and belongs to the checkpoint: choose it
for the cluster, at some thousands of keys a group, before the first start.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.scalar import key_text
from tideline.functions.time import duration_us
from tideline.session import ship_package
from tideline.streaming.state import Levels

KEY_GROUPS = 64
_KEYS = pa.schema([("k", pa.string())])


def _firsts(rows: Iterator[pd.DataFrame], order: str) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    """(earliest row of each key so far, rows that later or earlier ones outdo) after each chunk."""
    held = None
    for pdf in rows:
        both = pdf if held is None else pd.concat([held, pdf])
        both = both.sort_values(order, kind="stable")
        repeated = both.duplicated("tideline_key")
        held = both[~repeated]
        yield held, both[repeated]


class TagDuplicatesProcessor(StatefulProcessor):
    """Pass every row through with ``is_duplicate``.

    The rows of a group come in chunks. Of each key only the earliest row so
    far is held back; all others stream through.
    """

    def __init__(self, order: str, columns: list[str]):
        self.order, self.columns = order, list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = Levels(handle, "seen", _KEYS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = None
        for held, rest in _firsts(rows, self.order):
            if len(rest):
                yield rest[self.columns].assign(is_duplicate=True)
        if held is not None and len(held):
            known = held["tideline_key"].isin(self.seen.read()["k"])
            self.seen.add(pd.DataFrame({"k": held.loc[~known, "tideline_key"]}))
            yield held[self.columns].assign(is_duplicate=known)

    def close(self) -> None:
        pass


def _by_group(df: DataFrame, keys: list[str], key_groups: int):
    ship_package(df.sparkSession)
    keyed = df.withColumn("tideline_key", key_text(**{f"k{i}": F.col(k) for i, k in enumerate(keys)}))
    return keyed.withColumn("tideline_group", F.pmod(F.xxhash64("tideline_key"), F.lit(key_groups))).groupBy("tideline_group")


def stream_tag_duplicates(df: DataFrame, keys: list[str], order: str, key_groups: int = KEY_GROUPS) -> DataFrame:
    """All rows plus ``is_duplicate`` (false for the first row of each key by ``order``)."""
    schema = T.StructType(df.schema.fields + [T.StructField("is_duplicate", T.BooleanType())])
    return _by_group(df, keys, key_groups).transformWithStateInPandas(
        statefulProcessor=TagDuplicatesProcessor(order, df.columns), outputStructType=schema,
        outputMode="Append", timeMode="None")


def stream_keep_first(df: DataFrame, keys: list[str], order: str, key_groups: int = KEY_GROUPS) -> DataFrame:
    """First row per key in arrival order; state is never evicted (as in the reference)."""
    return stream_tag_duplicates(df, keys, order, key_groups).filter(~F.col("is_duplicate")).drop("is_duplicate")


class ExpiringDedupProcessor(StatefulProcessor):
    """Reference semantics of the dedup with state clean-up, for a group of keys.

    Every arrival registers a processing-time timer at ``now + ttl``; timers
    are never deleted by later arrivals; whichever fires first clears the
    key. Timers already due when new rows come in are applied first, so a
    timer at the same instant as an arrival counts before it.

    All rows of a batch arrive at one instant, so their timers are one entry
    of a map from instants to the keys that arrived; one timer of the group
    stands for them. Entries due are applied at once. The live keys are one
    set, which holds no key that is past its timers.
    """

    def __init__(self, order: str, ttl_ms: int, columns: list[str]):
        self.order, self.ttl_ms, self.columns = order, ttl_ms, list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.live = handle.getValueState("live", "keys binary")
        self.arrived = handle.getMapState("arrived", "at long", "keys binary")

    def _live(self) -> set[str]:
        return pickle.loads(bytes(self.live.get()[0])) if self.live.exists() else set()

    def _expire(self, live: set[str], due: list[int]) -> None:
        for at in due:
            held = self.arrived.getValue((at,))
            if held is not None:
                live -= pickle.loads(bytes(held[0]))
                self.arrived.removeKey((at,))

    def _keep(self, live: set[str]) -> None:
        if live:
            self.live.update((pickle.dumps(live, 5),))
        else:
            self.live.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        live, held = self._live(), None
        due = [t for t in self.handle.listTimers() if t <= now]
        self._expire(live, due)
        for t in due:
            self.handle.deleteTimer(t)
        for held, _ in _firsts(rows, self.order):
            pass
        if held is not None and len(held):
            keys = set(held["tideline_key"])
            before = self.arrived.getValue((now + self.ttl_ms,))
            timers = keys | pickle.loads(bytes(before[0])) if before is not None else keys
            self.arrived.updateValue((now + self.ttl_ms,), (pickle.dumps(timers, 5),))
            self.handle.registerTimer(now + self.ttl_ms)
            new = held[~held["tideline_key"].isin(live)]
            live |= keys
            if len(new):
                yield new[self.columns]
        self._keep(live)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        live = self._live()
        self._expire(live, [expiredTimerInfo.getExpiryTimeInMs()])
        self._keep(live)
        return iter([])

    def close(self) -> None:
        pass


def stream_dedup_expiring(df: DataFrame, keys: list[str], order: str, ttl="10 minutes",
                          key_groups: int = KEY_GROUPS) -> DataFrame:
    """Rows emitted by the expiring dedup; needs a processing-time trigger."""
    return _by_group(df, keys, key_groups).transformWithStateInPandas(
        statefulProcessor=ExpiringDedupProcessor(order, duration_us(ttl) // 1000, df.columns),
        outputStructType=T.StructType(df.schema.fields), outputMode="Append", timeMode="ProcessingTime")

"""Stateful operators driven by hand: levelled blocks, expiring dedup against the timer simulator."""

from __future__ import annotations

import random

import pandas as pd
import pyarrow as pa
import pytest

from test_simulators import simulate_expiring_dedup
from tideline.streaming.dedup import ExpiringDedupProcessor
from tideline.streaming.state import BASE_ROWS, Levels, packed, unpacked

SCHEMA = pa.schema([("k", pa.string()), ("n", pa.int64())])


class Map:
    def __init__(self):
        self.held, self.written = {}, 0

    def iterator(self):
        return iter([(k, v) for k, v in self.held.items()])

    def getValue(self, key):
        return self.held.get(key)

    def updateValue(self, key, value):
        self.held[key] = value
        self.written += sum(len(x) for x in value if isinstance(x, bytes))

    def removeKey(self, key):
        del self.held[key]


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Handle:
    def __init__(self):
        self.maps, self.values, self.timers = {}, {}, set()

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, Map())

    def getValueState(self, name, *_):
        return self.values.setdefault(name, Value())

    def listTimers(self):
        return iter(sorted(self.timers))

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)


def test_levels_keep_the_last_row_of_each_key():
    rng, handle, want = random.Random(4), Handle(), {}
    for _ in range(300):
        levels = Levels(handle, "x", SCHEMA)  # as after a restart
        rows = levels.read()
        assert dict(zip(rows["k"], rows["n"])) == want and len(rows) == len(want)
        new = {f"k{rng.randrange(3000)}" if rng.random() < 0.9 else None: rng.randrange(10 ** 12) for _ in range(rng.choice([0, 1, 7, 200, 900]))}
        levels.add(pd.DataFrame({"k": pd.Series(list(new), dtype=object), "n": pd.Series(list(new.values()), dtype="int64")}))
        want |= new
    sizes = [handle.maps["x"].held[k][0] for k in sorted(handle.maps["x"].held)]
    assert all(n <= BASE_ROWS << k[0] for k, (n, _) in handle.maps["x"].held.items()) and len(sizes) <= 8


def bytes_written(idle: int, batches: int = 60) -> int:
    handle = Handle()
    levels = Levels(handle, "x", SCHEMA)
    levels.read()
    levels.add(pd.DataFrame({"k": [f"idle{i:09}" for i in range(idle)], "n": range(idle)}))
    handle.maps["x"].written = 0
    for _ in range(batches):
        levels = Levels(handle, "x", SCHEMA)
        levels.read()
        levels.add(pd.DataFrame({"k": [f"busy{i:09}" for i in range(50)], "n": range(50)}))
    return handle.maps["x"].written


def test_a_batch_does_not_rewrite_idle_keys():
    small, large = bytes_written(2_000), bytes_written(200_000)
    assert large <= 1.5 * small


def test_blocks_keep_nulls_and_numbers():
    rows = pd.DataFrame({"k": pd.Series(["a", None, ""], dtype=object), "n": [1, -(2 ** 62), 0]})
    back = unpacked(packed(rows, SCHEMA), SCHEMA)
    assert back["k"].tolist() == ["a", None, ""] and back["n"].tolist() == [1, -(2 ** 62), 0]
    assert len(unpacked(packed(rows.iloc[:0], SCHEMA), SCHEMA)) == 0


class Now:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


class Expired(Now):
    def getExpiryTimeInMs(self):
        return self.now


@pytest.mark.parametrize("fire", ["in time", "late"])
def test_expiring_dedup_of_a_group_equals_the_timer_simulator(fire):
    """400 keys in one group. Timers fire as soon as due, or only when rows come in."""
    rng, ttl, arrivals, want = random.Random(7), 10, {}, set()
    for key in range(400):
        times = sorted({rng.randint(0, 60) for _ in range(rng.randint(1, 12))})  # a batch gives one row of a key at a time
        own = [(t, key * 100 + j) for j, t in enumerate(times)]
        want |= simulate_expiring_dedup(own, ttl)
        for t, i in own:
            arrivals.setdefault(t, []).append((str(key), i))
    handle, got = Handle(), []
    for now in range(0, 100):
        processor = ExpiringDedupProcessor("i", ttl, ["i"])
        processor.init(handle)
        rows = arrivals.get(now, [])
        if fire == "in time":
            for t in [t for t in sorted(handle.timers) if t <= now]:
                handle.timers.discard(t)
                list(processor.handleExpiredTimer(None, Now(now), Expired(t)))
        if rows:
            rng.shuffle(rows)
            pdf = pd.DataFrame(rows, columns=["tideline_key", "i"])
            for out in processor.handleInputRows(None, iter([pdf.iloc[:3], pdf.iloc[3:]]), Now(now)):
                got += out["i"].tolist()
    assert sorted(got) == sorted(want)
    if fire == "in time":
        assert not handle.maps["arrived"].held and not handle.values["live"].exists()

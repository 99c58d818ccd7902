"""Keyed rows of a group in levels of map state, so that a batch writes what it changes.

A stateful operator here handles a group of keys at once. Reading or writing
one state entry per key costs a call each; one entry for the whole group would
be rewritten whole by every batch. ``Levels`` keeps the group's rows in a few
blocks, newest first, of which each holds about twice as many as the one
before. A batch adds a small block; when a level is taken, its block is merged
with the new one and moves up. So a row is written again as often as there are
levels, a logarithm of the group's rows, however many idle keys there are, and
reading takes one call per level.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa

# Rows of the lowest level's block.
BASE_ROWS = 256


def packed(rows: pd.DataFrame, schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_arrays([pa.array(rows[f.name], f.type, from_pandas=False) for f in schema], schema=schema)
    with pa.ipc.new_stream(sink, schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(block: bytes | pa.Table, schema: pa.Schema) -> pd.DataFrame:
    table = pa.ipc.open_stream(block).read_all() if isinstance(block, bytes) else block
    # Texts stay objects and numbers keep their type; times of waiting rows are never null.
    return pd.DataFrame({f.name: pd.Series(table[f.name].to_pylist(), dtype=object) if pa.types.is_string(f.type)
                         else table[f.name].to_numpy() for f in schema})


class Levels:
    """The last row of each key; rows of a later ``add`` replace earlier ones of the same key."""

    def __init__(self, handle, name: str, schema: pa.Schema, key: str = "k"):
        self.blocks = handle.getMapState(name, "level int", "n long, rows binary")
        self.schema, self.key = schema, key

    def read(self) -> pd.DataFrame:
        """All rows, one for each key."""
        self.held = {level: (n, rows) for (level,), (n, rows) in self.blocks.iterator()}
        frames = [unpacked(self.held[level][1], self.schema) for level in sorted(self.held, reverse=True)]
        return self._last(frames)

    def _last(self, frames: list[pd.DataFrame]) -> pd.DataFrame:
        if not frames:
            return unpacked(pa.schema(self.schema).empty_table(), self.schema)
        rows = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
        return rows.drop_duplicates(self.key, keep="last") if len(frames) > 1 else rows

    def add(self, rows: pd.DataFrame) -> int:
        """Add rows of distinct keys after ``read``; the bytes written."""
        if not len(rows):
            return 0
        level, frames, n = 0, [rows[[f.name for f in self.schema]]], len(rows)
        while level in self.held or n > BASE_ROWS << level:
            if level in self.held:
                size, block = self.held.pop(level)
                frames.insert(0, unpacked(block, self.schema))
                n += size
                self.blocks.removeKey((level,))
            level += 1
        merged = self._last(frames)
        block = packed(merged, self.schema)
        self.held[level] = (len(merged), block)
        self.blocks.updateValue((level,), (len(merged), block))
        return len(block)

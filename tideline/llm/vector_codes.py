"""Vectors as short codes: product codebooks by Lloyd's rounds over resident members.

A vector of integers is cut into equal parts; each part's position has a
codebook, and a part's code is the index of its nearest entry. Lloyd's rounds
assign every part to its nearest entry and move each entry to the floored mean
of its parts.

Members live with their owners: parts are dealt once, to the task that owns
their (position, entry, salt), and stay there as one block of numpy arrays.
An owner adds up its members without any shuffle; only the sums, one small
table of all entries, go to the driver. In the next round each owner finds its
members' nearest entries, and only parts that change entry migrate: they are
shuffled to their new owners, and each owner takes its arrivals in beside the
members that stayed (``zip``: partition by partition, the residents do not
move). Salts deal an entry that holds a third of all parts over all tasks; a
sum does not depend on who adds it up. Blocks are checkpointed in the shared
folder, so a round does not repeat the ones before, and a lost executor's
blocks are read again.

This is RDD code, as it is about what stays in a partition. Codebooks hold
``entries`` times the vector's length numbers, whatever the table's size;
nothing else comes to the driver. Codes of vectors (``encode``) are then a map
over the table, with DataFrames.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import arrow_map, shared_folder, without

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Parts compared with their codebooks at once, and vectors dealt at once.
COMPARED, DEALT = 4096, 1 << 16


@dataclass(frozen=True)
class Codebooks:
    """``table[position, entry]`` is a part of integers; ``scale`` turns a component into one."""
    table: np.ndarray
    scale: int = SCALE

    def numbers(self) -> str:
        """All components by position, entry and place, joined by commas."""
        return ",".join(map(str, self.table.ravel().tolist()))


def whole_vectors(vector: str) -> Column:
    """True for a vector that is not null or empty and has no null, NaN or infinite component."""
    v = F.col(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & good, F.lit(False))


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors; exact, or an error if squared distances could leave 64 bits."""
    out = np.floor(values.astype(np.float64) * scale)
    if out.size and 4 * out.shape[1] * float(np.abs(out).max()) ** 2 >= 2 ** 63:
        raise ValueError("components are too large for exact distances of 64 bits")
    return out.astype(np.int64)


def nearest(parts: np.ndarray, position: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each part in its position's codebook; of equal ones the lower entry."""
    entry, distance = np.empty(len(parts), np.int32), np.empty(len(parts), np.int64)
    for at in range(0, len(parts), COMPARED):
        some = slice(at, at + COMPARED)
        d = ((parts[some, None, :] - table[position[some]]) ** 2).sum(2)
        entry[some] = best = d.argmin(1)
        distance[some] = np.take_along_axis(d, best[:, None], 1)[:, 0]
    return entry, distance


def _rows(column, length: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows of a matrix."""
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes != length).any():
        raise ValueError(f"vectors of {length} components expected")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


# A block is (position, entry, salt, part) of its members, as arrays.

def _owner(position: np.ndarray, entry: np.ndarray, salt: np.ndarray, owners: int) -> np.ndarray:
    key = (position.astype(np.uint64) << np.uint64(48)) + (entry.astype(np.uint64) << np.uint64(32)) + salt.astype(np.uint64)
    key = (key ^ key >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return ((key >> np.uint64(32)) % np.uint64(owners)).astype(np.int64)


def _dealt(block: tuple, owners: int):
    """(owner, packed block) for each owner of some members."""
    owner = _owner(*block[:3], owners)
    order = np.argsort(owner, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1) if len(order) else []:
        yield int(owner[some[0]]), pickle.dumps(tuple(x[some] for x in block), 5)


def _joined(blocks: list[tuple], width: int) -> tuple:
    none = (np.empty(0, np.int16), np.empty(0, np.int32), np.empty(0, np.int32), np.empty((0, width), np.int32))
    return tuple(np.concatenate(x) for x in zip(none, *blocks))


def _sums(block: tuple, shape: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Componentwise sums and numbers of the members of every entry."""
    position, entry, _, part = block
    total, count = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
    np.add.at(total, (position, entry), part)
    np.add.at(count, (position, entry), 1)
    return total, count


def fit(df: DataFrame, vector: str, order: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
        scale: int = SCALE) -> Codebooks:
    """Codebooks from all whole vectors of ``df``.

    They start as the parts of the first ``entries`` vectors by ``order`` (null
    last, ties by the vector), or of as many as there are. An entry without
    parts stays. Vectors that are null, empty or not finite are left out; all
    others need the same length, a multiple of ``parts``, else there is an
    error. Repeated rows count as often as they come. A table without vectors
    gives codebooks without entries. Other columns are not read.
    """
    spark = df.sparkSession
    shared_folder(spark)  # blocks are checkpointed there
    rows = df.select(F.col(order).alias("__o"), F.col(vector).alias("__v")).filter(whole_vectors("__v"))
    first = [r[0] for r in rows.orderBy(F.col("__o").asc_nulls_last(), "__v").limit(entries).select("__v").collect()]
    length = len(first[0]) if first else 0
    if length % parts or any(len(v) != length for v in first):
        raise ValueError(f"vectors of one length, a multiple of {parts}, expected")
    width = length // parts
    start = scaled(np.array(first, np.float64).reshape(len(first), length), scale)
    table = np.ascontiguousarray(start.reshape(len(first), parts, width).transpose(1, 0, 2))
    if not first or not rounds:
        return Codebooks(table, scale)
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches, table=table):
        import pyarrow as pa
        from pyspark import TaskContext

        seen, held = TaskContext.get().partitionId(), []

        def flushed():
            values = scaled(np.concatenate(held), scale)
            n = len(values)
            part = values.reshape(-1, width).astype(np.int32 if not n or np.abs(values).max() < 2 ** 31 else np.int64)
            position = np.tile(np.arange(parts, dtype=np.int16), n)
            salt = np.repeat((np.arange(n) + seen) % owners, parts).astype(np.int32)
            out = list(_dealt((position, nearest(part, position, table)[0], salt, part), owners))
            return pa.RecordBatch.from_arrays([pa.array([o for o, _ in out], pa.int32()), pa.array([b for _, b in out], pa.binary())],
                                              names=["owner", "block"])

        for batch in batches:
            held.append(_rows(batch.column(0), length))
            if sum(map(len, held)) >= DEALT:
                yield flushed()
                seen, held = seen + sum(map(len, held)), []
        if held:
            yield flushed()

    def settled(packed) -> list[tuple]:
        return [_joined([pickle.loads(b) for _, b in packed], width)]

    dealt = rows.select("__v").mapInArrow(deal, "owner int, block binary").rdd.map(lambda r: (r[0], bytes(r[1])))
    residents = dealt.partitionBy(owners, lambda o: o).mapPartitions(settled)
    for done in range(rounds):
        residents.checkpoint()
        shape = table.shape
        total, count = residents.map(lambda b: _sums(b, shape)).treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))
        table = np.where(count[:, :, None] > 0, total // np.maximum(count, 1)[:, :, None], table)
        if done + 1 < rounds:
            residents = _migrated(residents, table, owners, settled)
    return Codebooks(table, scale)


def _migrated(residents, table: np.ndarray, owners: int, settled):
    """Residents by the entries of a new table: only parts that change entry are shuffled."""
    def moving(blocks):
        for position, entry, salt, part in blocks:
            new = nearest(part, position, table)[0]
            go = new != entry
            yield from _dealt((position[go], new[go], salt[go], part[go]), owners)

    def received(pair):
        (position, entry, salt, part), arrived = pair
        stay = nearest(part, position, table)[0] == entry
        return _joined([tuple(x[stay] for x in (position, entry, salt, part)), arrived], part.shape[1])

    arrivals = residents.mapPartitions(moving).partitionBy(owners, lambda o: o).mapPartitions(settled)
    return residents.zip(arrivals).map(received)


def encode(df: DataFrame, books: Codebooks, vector: str, code: str = "code", error: str = "error") -> DataFrame:
    """The whole vectors of ``df`` with their code and squared error in place of the vector.

    ``code`` has two hex digits for each part. Rows whose vector is null,
    empty or not finite are dropped; one of another length than the codebooks'
    is an error. Repeated rows have a code each; an empty table gives an empty
    result. Columns of ``df`` called ``code`` or ``error`` are replaced.
    """
    df = without(df, [code, error], keep=(vector,))
    kept = [c for c in df.columns if c != vector]
    table, scale = books.table, books.scale
    parts, _, width = table.shape

    def coded(batches):
        import pyarrow as pa

        for batch in batches:
            values = scaled(_rows(batch.column(batch.num_columns - 1), parts * width), scale)
            entry, distance = nearest(values.reshape(-1, width), np.tile(np.arange(parts), len(values)), table)
            codes = entry.astype(np.uint8).tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([codes[i:i + 2 * parts] for i in range(0, len(codes), 2 * parts)], pa.string()),
                 pa.array(distance.reshape(-1, parts).sum(1), pa.int64())], names=[*batch.schema.names[:-1], code, error])

    if not 0 < table.shape[1] <= 256:
        if table.shape[1]:
            raise ValueError("two hex digits number 256 entries")
        return df.filter(F.lit(False)).select(*[F.col(f"`{c}`") for c in kept], F.lit("").alias(code), F.lit(0).cast("long").alias(error))
    return arrow_map(df.filter(whole_vectors(vector)), kept, F.col(vector), coded, **{code: "string", error: "long"})

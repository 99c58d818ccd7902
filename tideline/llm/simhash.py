"""SimHash near-duplicates by tiled exact comparison.

A document's fingerprint holds, for each of 64 bits, whether it is set in
over half the XXH64 values (seed 42) of its word shingles. Distinct
fingerprints, one row however many copies a text has, are laid out in tiles
by the population counts of their four 16-bit quarters (``SEGMENTS``). A bit flip changes
one of those counts by one, so fingerprints at ``radius`` bits or fewer lie
in tiles whose counts differ by ``radius`` in sum at most: only such tile
pairs meet, through an equi-join on the counts, and all others are skipped.
A pair of tiles is compared in full with exclusive-or and bit counts in
numpy. It yields the links of a spanning forest of its matches, so a dense
group of m fingerprints makes some m links, not m squared; reachability, and
with it every component, stays the same.

Tiles hold at most ``TILE`` fingerprints on average; a crowded population
count is dealt to several tiles by hash, which all meet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import few, with_fields, without, written
from tideline.llm.components import connected_components

TILE = 2048
#: Parts of a fingerprint whose population counts make a tile's key.
SEGMENTS = 4
SEED = 42
#: Shingles hashed at once within one document.
BLOCK = 1 << 16


def text_fingerprint(text: str, shingle: int) -> int:
    """The 64-bit fingerprint of one text as a signed integer."""
    import numpy as np
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and the six white-space bytes only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[len(words) - n:].tolist())
    digest, of = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        hashes = np.array([digest(joined[a:b], SEED) for (a, b), _ in zip(spans, range(min(BLOCK, n - at)))], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        of += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * of > n, bitorder="little").view("<i8")[0])


def simhash(df: DataFrame, text: str = "text", shingle: int = 3, name: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint (long) of ``text`` in place of the text.

    A null or empty text, or one of white space only, has fingerprint 0; a
    text of fewer words than a shingle counts as one shingle. A column of ``df``
    called ``name`` already is replaced.
    """
    df = without(df, [name], keep=(text,))
    kept = [c for c in df.columns if c != text]

    def hashed(batches):
        import pyarrow as pa

        for batch in batches:
            column = batch.column(batch.schema.names.index("__text"))
            found = []
            for at in range(0, len(column), 256):
                found += [text_fingerprint(t, shingle) for t in column.slice(at, 256).to_pylist()]
            columns = [c for c, f in zip(batch.columns, batch.schema.names) if f != "__text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.int64())], names=[*kept, name])

    rows = df.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return rows.mapInArrow(hashed, with_fields(df.select(*kept).schema, **{name: "long"}))


def _segment_counts(fp: str, segments: int) -> list:
    bits = 64 // segments
    segment = lambda i: F.shiftrightunsigned(F.col(fp), bits * i).bitwiseAND(F.lit((1 << bits) - 1))
    return [F.bit_count(segment(i)).alias(f"q{i}") for i in range(segments)]


def _offsets(places: int, radius: int) -> list[tuple[int, ...]]:
    """All integer vectors whose absolute values add up to ``radius`` at most."""
    if not places:
        return [()]
    return [(x, *rest) for x in range(-radius, radius + 1) for rest in _offsets(places - 1, radius - abs(x))]


def tile_forest(a, b, radius: int):
    """(representative, member) links that span the matches between two arrays of fingerprints."""
    import numpy as np

    near = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]) <= radius
    rows, columns = near.any(axis=1), near.any(axis=0)
    if not rows.any():
        return None
    a, b, near = a[rows], b[columns], near[rows][:, columns]
    most = np.iinfo(np.int64).max
    of_a, of_b = a.copy(), b.copy()
    while True:
        new_b = np.minimum(of_b, np.where(near, of_a[:, None], most).min(axis=0))
        new_a = np.minimum(of_a, np.where(near, new_b[None, :], most).min(axis=1))
        if (new_a == of_a).all() and (new_b == of_b).all():
            break
        of_a, of_b = new_a, new_b
    to, member = np.concatenate((of_a, of_b)), np.concatenate((a, b))
    return to[to != member], member[to != member]


def links_within(fingerprints: DataFrame, radius: int = 3, fp: str = "fingerprint", segments: int = SEGMENTS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints at ``radius`` bits or fewer (a spanning subset).

    With 2, 4 or 8 ``segments`` tile pairs hold 0.24, 0.04 or 0.001 of all
    pairs; more segments make more and smaller tiles, for more fingerprints.
    """
    counts = written(fingerprints.select(F.col(fp).alias("fp"), *_segment_counts(fp, segments)), "fingerprints")
    key = [f"q{i}" for i in range(segments)]
    crowd = written(counts.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TILE), "crowd")
    dealt = counts.join(few(crowd), key, "left").withColumn(
        "sub", F.pmod(F.xxhash64("fp"), F.coalesce(F.ceil(F.col("n") / TILE), F.lit(1))))
    tiles = dealt.groupBy(*key, "sub").agg(F.collect_list("fp").alias("fps"))

    # Each unordered pair of tiles meets once: the offset's first non-zero count is positive, or it is the same key.
    offsets = [o for o in _offsets(segments, radius) if o >= (0,) * segments]
    near = F.explode(F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(o)]) for o in offsets]))
    left = tiles.select(*key, F.col("sub").alias("sub_a"), F.col("fps").alias("a"), near.alias("d")).select(
        *[(F.col(k) + F.col(f"d.d{i}")).alias(k) for i, k in enumerate(key)], "sub_a", "a",
        reduce(lambda a, b: a & b, [F.col(f"d.d{i}") == 0 for i in range(segments)]).alias("same"))
    pairs = left.join(tiles.select(*key, F.col("sub").alias("sub_b"), F.col("fps").alias("b")), key).filter(
        ~F.col("same") | (F.col("sub_a") <= F.col("sub_b"))).select("a", "b")

    def compared(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            sides = []
            for column in batch.columns:
                sides.append((column.offsets.to_numpy(), column.values.to_numpy()))
            (of_a, a), (of_b, b) = sides
            found = [tile_forest(a[of_a[i]:of_a[i + 1]], b[of_b[i]:of_b[i + 1]], radius) for i in range(len(batch))]
            found = [f for f in found if f]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["a", "b"])

    return pairs.mapInArrow(compared, "a long, b long").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """One row per row of ``df``: id, fingerprint (long), component_id, keep.

    component_id is the smallest id that links of at most ``radius`` differing
    bits reach, itself included. ``keep`` is true for the row of that id with
    the smallest text hash: rows repeated in full are all kept or all not.
    A null or empty text has fingerprint zero and links like any other; a very
    long one has one fingerprint of all its shingles.
    A null id never is a component_id unless a component has no other; an
    empty table gives an empty result; further columns of ``df`` are not read.
    """
    docs = df.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"),
                     F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__th"))
    docs = written(simhash(docs, "__text", shingle, "__fp"), "simhash")
    rank = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__th").alias("th"))
    distinct = written(docs.groupBy("__fp").agg(F.min(rank).alias("first")), "distinct")
    labels = connected_components(links_within(distinct, radius, "__fp"))
    rooted = distinct.join(labels, F.col("__fp") == F.col("node"), "left").select(
        "__fp", "first", F.coalesce("label", "__fp").alias("root"))
    roots = rooted.groupBy("root").agg(F.min("first").alias("rep"))
    of = rooted.join(roots, "root").select("__fp", "rep")
    return docs.join(of, "__fp").select(
        F.col("__id").alias(id_col), F.col("__fp").alias("fingerprint"), F.col("rep.id").alias("component_id"),
        (F.col("__id").eqNullSafe(F.col("rep.id")) & (F.col("__th") == F.col("rep.th"))).alias("keep"),
        F.col("__th").alias("text_hash"))

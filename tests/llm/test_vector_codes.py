from __future__ import annotations

import hashlib
import math
import random

import pytest

from tideline.llm import vector_codes as vc


def brute(vectors, parts=16, entries=64, rounds=2):
    """(codebooks, codes, errors) for (id, vector) rows, in whole numbers."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v: [v[p * width:(p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for _, v in kept[:entries]] for p in range(parts)]

    def near(p, part):
        ds = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
        return ds.index(min(ds)), min(ds)

    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = {}
            for _, v in kept:
                members.setdefault(near(p, cut(v)[p])[0], []).append(cut(v)[p])
            new.append([[sum(x) // len(members[k]) for x in zip(*members[k])] if k in members else e for k, e in enumerate(books[p])])
        books = new
    found = [[near(p, part) for p, part in enumerate(cut(v))] for _, v in kept]
    return books, [(i, "".join(f"{k:02x}" for k, _ in f), sum(d for _, d in f)) for (i, _), f in zip(kept, found)]


def made_up(n, dim=32, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, list(rows[7][1])) for i in range(n // 2)]  # one very common vector
    rows += [(3, list(rows[3][1])), (3, list(rows[3][1])), (3, list(rows[4][1])), (None, list(rows[5][1]))]
    rows += [(90_000, None), (90_001, []), (90_002, [*rows[0][1][1:], math.nan]), (90_003, [*rows[0][1][1:], -math.inf]),
             (90_004, [None, *rows[0][1][1:]]), (90_005, [300.5, *rows[0][1][1:]])]
    rng.shuffle(rows)
    return [(i, [None if x is None else float(x) for x in v] if v is not None else None) for i, v in rows]


@pytest.mark.parametrize("rounds", [0, 1, 2, 4])
def test_codebooks_and_codes_equal_brute_force(spark, rounds):
    rows = made_up(150)
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(3)
    books, codes = brute(rows, parts=8, entries=16, rounds=rounds)
    got = vc.fit(df, "v", "vec_id", parts=8, entries=16, rounds=rounds)
    assert got.table.tolist() == books
    out = vc.encode(df, got, "v")
    assert out.columns == ["vec_id", "code", "error"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(codes, key=str)


def test_few_and_no_vectors(spark):
    rows = [(1, [0.0] * 16), (2, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, v array<float>")
    books = vc.fit(df, "v", "vec_id")
    assert books.table.shape == (16, 2, 1) and [r.error for r in vc.encode(df, books, "v").collect()] == [0, 0]
    for none in (df.limit(0), spark.createDataFrame([(1, None), (2, [math.nan] * 16)], "vec_id long, v array<float>")):
        empty = vc.fit(none, "v", "vec_id")
        assert empty.table.shape[1] == 0 and vc.encode(none, empty, "v").collect() == []


def test_extra_and_clashing_columns(spark):
    df = spark.createDataFrame([(i, [i / 7.0] * 16) for i in range(9)], "id long, v array<double>").selectExpr("id `a.b`", "v", "'x' CODE", "1 __x")
    books = vc.fit(df.withColumnRenamed("a.b", "id"), "v", "id", entries=4)
    out = vc.encode(df, books, "v")
    assert out.columns == ["a.b", "__x", "code", "error"] and out.count() == 9


def test_wrong_lengths_and_sizes_are_errors(spark):
    df = spark.createDataFrame([(1, [1.0] * 16), (2, [1.0] * 32)], "id long, v array<double>")
    with pytest.raises(ValueError, match="length"):
        vc.fit(df, "v", "id")
    with pytest.raises(ValueError, match="length"):
        vc.fit(spark.createDataFrame([(1, [1.0] * 15)], "id long, v array<double>"), "v", "id")
    with pytest.raises(ValueError, match="large"):
        vc.fit(spark.createDataFrame([(1, [1e30] * 16)], "id long, v array<double>"), "v", "id")


def test_only_parts_that_change_entry_migrate(spark):
    """What the second deal shuffles is what changed entry, and members end where their entry is owned."""
    import pickle

    import numpy as np

    rng = np.random.default_rng(4)
    part = rng.integers(-60, 60, (4000, 2)).astype(np.int32)
    position = (np.arange(4000) % 4).astype(np.int16)
    salt = (np.arange(4000) % 5).astype(np.int32)
    old = rng.integers(-60, 60, (4, 8, 2))
    new = old + rng.integers(-8, 9, old.shape)
    entry = vc.nearest(part, position, old)[0]
    changed = int((vc.nearest(part, position, new)[0] != entry).sum())
    blocks = list(vc._dealt((position, entry, salt, part), 6))
    settled = lambda packed: [vc._joined([pickle.loads(b) for _, b in packed], 2)]
    residents = spark.sparkContext.parallelize(blocks, 3).partitionBy(6, lambda o: o).mapPartitions(settled)
    sent = []
    plain = vc._dealt
    after = vc._migrated(residents, new, 6, settled)
    assert 0 < changed < 4000
    for owner, block in enumerate(after.collect()):
        assert (vc._owner(*block[:3], 6) == owner).all() and (vc.nearest(block[3], block[0], new)[0] == block[1]).all()
        sent.append(len(block[0]))
    assert sum(sent) == 4000 and plain is vc._dealt
    assert after.getNumPartitions() == 6


def test_query_against_brute_force(spark):
    from conftest import SF001

    from tideline.llm.queries import op13_vector_codes
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    books, codes = brute([(r.vec_id, r.embedding) for r in rows])
    label = {r.vec_id: r.label for r in rows}
    total = {}
    for i, _, e in codes:
        total[label[i]] = total.get(label[i], 0) + e
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    got = op13_vector_codes(spark, SF001).collect()
    assert sorted(map(tuple, got)) == sorted((i, c, e, total[label[i]], digest) for i, c, e in codes)

from __future__ import annotations

import random
import re

import pytest

from tideline.llm.mixing import BLOCK, apportion, mix


def brute_seats(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max((p for p in votes if votes[p] > 0), key=lambda p: (votes[p] / (2 * won[p] + 1), -p), default=None)
        if best is None:
            break
        won[best] += 1
    return {p: n for p, n in won.items() if votes[p] > 0}


def brute_targets(sizes, weights=(1, 2, 3), share=1.0, cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        free = sum(w[s] for s in names if s not in full)
        over = {s for s in names if s not in full and free and left * w[s] / free > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in full else left * w[s] / free if free else 0.0 for s in names}
        full |= over


def test_apportion_equals_highest_quotients(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for g in range(40):
        votes = {p: rng.choice([0, 1, 2, 3, 10, 500, 10_000]) * rng.randint(1, 3) for p in range(rng.randint(1, 30))}
        seats = rng.choice([0, 1, 5, 37, 400])
        rows += [(g, p, v, seats) for p, v in votes.items()]
        want |= {(g, p): n for p, n in brute_seats(votes, seats).items()}
    df = spark.createDataFrame(rows, "g int, p int, v long, s long")
    assert {(r.g, r.p): r.won for r in apportion(df, ["g"], ["p"], "v", "s").collect()} == want


def check(rows, got, shard_words=None):
    sizes: dict = {}
    for r in rows:
        sizes[r[1]] = sizes.get(r[1], 0) + r[2]
    targets, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    assert sorted(map(str, ((r.doc_id, r.source, r.size) for r in got))) == sorted(map(str, rows))
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    shards = 1 if shard_words is None else 64
    for s, t in targets.items():
        assert abs(taken[s] - t) <= BLOCK * shards, (s, t, taken[s])


def rows_of(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice(["a", "a", "a", "a", "b", "é", None, "z", "Z"]), rng.randint(0, 400)) for i in range(n)]


@pytest.mark.parametrize("shard_words", [4_000_000, 3000])
def test_mix_meets_targets(spark, shard_words):
    rows = rows_of(900, 1) + [(5000, "tiny", 3), (5001, "none", 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(4)
    got = mix(df, "size", shard_words=shard_words).collect()
    check(rows, got, shard_words if shard_words < 4_000_000 else None)
    again = mix(df.repartition(7), "size", shard_words=shard_words).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_edge_tables(spark):
    schema = "doc_id long, source string, size long"
    assert mix(spark.createDataFrame([], schema), "size").collect() == []
    rows = [(None, None, 40), (None, None, 40), (1, None, 0), (1, None, 0)]
    check(rows, mix(spark.createDataFrame(rows, schema), "size").collect())
    zero = mix(spark.createDataFrame([(1, "a", 0)], schema), "size").collect()[0]
    assert (zero.target, zero.taken) == (0.0, 0)
    clash = spark.createDataFrame(rows, schema).selectExpr("*", "'x' Taken", "0 target")
    check(rows, mix(clash, "size").collect())


def test_query_meets_targets(spark):
    from conftest import SF01

    from tideline.llm.queries import op9_mixing
    docs = spark.read.parquet(f"{SF01}/documents.parquet").collect()
    got = op9_mixing(spark, SF01).collect()
    source = {d.doc_id: d.source for d in docs}
    size = {d.doc_id: sum(map(bool, re.split(r"[\x20\x09-\x0D]+", d.text))) for d in docs}
    assert {r.doc_id: r["size"] for r in got} == size
    taken, target = {}, brute_targets({s: sum(n for d, n in size.items() if source[d] == s) for s in set(source.values())})
    for r in got:
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        assert r.target == pytest.approx(target[source[r.doc_id]]) and r.taken <= 3 * r["size"]
    assert all(abs(taken[s] - t) <= BLOCK for s, t in target.items())

from __future__ import annotations

import hashlib
import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from tideline.llm import merkle


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def brute_tree(text):
    cut = lambda pattern, s: regex.split(pattern, s, flags=regex.V1) if s else [""]
    return [[[md5(r) for r in cut(merkle.RUNS, p)] for p in cut(merkle.PARAGRAPHS, s)] for s in cut(merkle.SECTIONS, text)]


def brute_fingerprint(text):
    t = brute_tree(text)
    root = hashlib.sha256("".join(md5("".join(md5("".join(p)) for p in s)) for s in t).encode()).hexdigest()
    return root + ":" + "/".join(".".join("".join(r[:6] for r in p) for p in s) for s in t)


def brute_likeness(a, b):
    if a[:64] == b[:64]:
        return 1.0
    leaves = lambda s: re.findall("[0-9a-f]{6}", s)
    anywhere = [set(leaves(f[65:])) for f in (a, b)]
    placed = [{(leaf, i) for p in re.split("[./]", f[65:]) for i, leaf in enumerate(leaves(p))} for f in (a, b)]
    return max(2 * len(x & y) / (len(x) + len(y)) for x, y in (anywhere, placed))


def brute(rows):
    """Expected (n_chars, sha, fp, edited fp, near_edited, near_next) by id, for unique ids."""
    rows = sorted((i, t or "") for i, t in rows)
    out = {}
    for at, (i, t) in enumerate(rows):
        nxt = rows[(at + 1) % len(rows)][1]
        k = len(t) // 4
        e = t[:len(t) - k] + nxt[:k]
        a, b = brute_fingerprint(t), brute_fingerprint(e)
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, brute_likeness(a, b), brute_likeness(a, brute_fingerprint(nxt)))
    return out


def values(r):
    return r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, pytest.approx(r.near_edited), pytest.approx(r.near_next)


@pytest.mark.parametrize("n", [1, 2, 3, 400])
def test_equals_brute_force(spark, n):
    rng = random.Random(n)
    parts = ["one ", "trees, ", "on ", "$$$ ", "one ", "é ", "\n", "\n\n", "😀 ", "x", "end. ", "  ", "\t"]
    rows = [(i * 7 - 50, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) or None) for i in range(n)]
    rng.shuffle(rows)
    got = merkle.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = brute(rows)
    assert len(got) == n
    for r in got:
        assert want[r.doc_id] == values(r)


def test_edge_rows(spark):
    rows = [(None, "abc def "), (None, "abc def "), (3, "same"), (3, "same"), (3, None), (9, "last one " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 fingerprint", "2 text_hash")
    got = merkle.edited_fingerprints(df).collect()
    assert len(got) == len(rows)
    none = [r for r in got if r.doc_id is None]
    assert {r.edited_fingerprint for r in none} == {brute_fingerprint("abc de")}
    assert len({r.fingerprint for r in got if r.doc_id == 3}) == 2
    assert merkle.edited_fingerprints(df.limit(0)).collect() == []


def test_differing_branches_locate_edits(spark):
    a = "p one\np two\n\nq one\nq two\nq three\n\nr one"
    cases = [(a, a, None), (a, a.replace("q two", "q 2"), (1, 1)), (a, a + "\nr two", (2, 0)), (a, "x" + a, (0, 0)),
             (a, a + "\n\ns", (2, 0)), (a, a[:len(a) - 7], (1, 2))]
    df = spark.createDataFrame([(i, x, y) for i, (x, y, _) in enumerate(cases)], "i int, a string, b string")
    fp = lambda c: merkle.fingerprint(merkle.tree(F.col(c)))
    got = {r.i: r.p and tuple(r.p) for r in df.select("i", merkle.edit_place(fp("a"), fp("b")).alias("p")).collect()}
    assert got == {i: p for i, (_, _, p) in enumerate(cases)}


def test_query_against_brute_force(spark):
    from conftest import SF001

    from tideline.llm.queries import op5_merkle
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want, got = brute(rows), op5_merkle(spark, SF001).collect()
    assert len(got) == len(rows)
    for r in got:
        assert want[r.doc_id] == values(r)
    long = [r for r in got if r.n_chars > 400]
    assert sum(r.near_edited for r in long) / len(long) > 0.6 > 0.2 > sum(r.near_next for r in long) / len(long)

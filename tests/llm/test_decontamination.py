from __future__ import annotations

import random
from itertools import combinations

import pytest
import regex

from tideline.llm.decontamination import MASKS, SIMILARITY, SPAN, WINDOW, contaminated


def tokens(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def brute(doc, item):
    """Best matches of a window over all alignments, or None."""
    d, t = tokens(doc), tokens(item)
    w = min(WINDOW, len(t))
    least = w if w < WINDOW else SIMILARITY * w
    if len(t) < SPAN or len(d) < w:
        return None
    best = max(sum(a == b for a, b in zip(t[i:i + w], d[j:j + w]))
               for i in range(len(t) - w + 1) for j in range(len(d) - w + 1))
    return best if best >= least else None


def quick(doc, item):
    """``brute`` where it can find something: a window with two substitutions keeps four tokens in a row."""
    four = lambda t: {tuple(t[i:i + 4]) for i in range(len(t) - 3)}
    return brute(doc, item) if four(tokens(doc)) & four(tokens(item)) else None


def test_masks_see_two_substitutions_anywhere():
    for gone in combinations(range(WINDOW), 2):
        assert any(all(at + o not in gone for o in mask) for mask in MASKS for at in range(WINDOW - SPAN + 1))
    assert all(max(m) + 1 == SPAN for m in MASKS)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_finds_what_brute_force_finds(spark, limit):
    rng = random.Random(8)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyzäöü") + rng.choice("xyz")
    items = [(i, " ".join(word() for _ in range(rng.randint(5, 30)))) for i in range(25)]
    docs = []
    for i in range(120):
        body = [word() for _ in range(rng.randint(0, 60))]
        if i % 2:
            t = items[rng.randrange(25)][1].split()
            a = rng.randrange(len(t))
            part = t[a:] if i % 4 == 1 else t
            part = [w if rng.random() > 0.12 else word() for w in part]
            at = rng.randint(0, len(body))
            body[at:at] = part
        docs.append((i, ", ".join(body).upper()))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = contaminated(df, spark.createDataFrame(items, "item_id long, text string"), broadcast_tokens=limit).collect()
    want = {(d, i): n for d, x in docs for i, t in items if (n := brute(x, t)) is not None}
    assert len(want) > 20
    assert {(r.doc_id, r.item_id): r.matched for r in got} == want


@pytest.mark.parametrize("limit", [500_000, 0])
def test_edge_rows(spark, limit):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, None), (2, ""), (3, passage), (3, passage), (None, "x " * 4000 + passage), (5, "one two three"), (6, passage[:40])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 h", "2 item_id")
    items = spark.createDataFrame([(7, passage), (7, passage), (None, passage), (8, None), (9, "one two three")],
                                  "item_id long, text string")
    got = contaminated(df, items, broadcast_tokens=limit).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.doc_start) for r in got) == [
        ("3", "7", 0), ("3", "None", 0), ("None", "7", 4000), ("None", "None", 4000)]
    assert contaminated(df.limit(0), items, broadcast_tokens=limit).collect() == []
    assert contaminated(df, items.limit(0), broadcast_tokens=limit).collect() == []


def test_query_against_brute_force(spark):
    from conftest import SF001

    from tideline.llm.queries import op3_decontamination
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.matched for r in op3_decontamination(spark, SF001).collect()}
    want = {(d, i): n for d, x in docs.items() for i, t in items.items() if (n := quick(x, t)) is not None}
    assert got == want and want

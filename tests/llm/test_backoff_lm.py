from __future__ import annotations

import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from tideline.llm import backoff_lm as lm


def words_of(text):
    out = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        out = out.replace(c, " ")
    return [w for w in out.split(" ") if w] + ["\n"]


class Brute:
    def __init__(self, texts, order, prior):
        self.order, self.prior, self.c = order, prior, Counter()
        for t in texts:
            ws = ["\n", *words_of(t)]
            for i in range(1, len(ws)):
                self.c[(ws[i],)] += 1
                for k in range(2, order + 1):
                    if i - k + 1 >= 0:
                        self.c[tuple(ws[i - k + 1:i + 1])] += 1
        self.n = sum(v for g, v in self.c.items() if len(g) == 1)
        self.v = sum(len(g) == 1 for g in self.c)

    def p(self, history, w):
        if not history:
            return (self.c[(w,)] + 1) / (self.n + self.v + 1)
        lower, k = self.p(history[1:], w), self.prior[len(history) + 1]
        return (self.c[(*history, w)] + k * lower) / (self.c[history] + k) if self.c[history] else lower

    def score(self, text):
        ws = ["\n", *words_of(text)]
        return sum(math.log10(self.p(tuple(ws[max(0, i - self.order + 1):i]), ws[i])) for i in range(1, len(ws)))


TEXTS = ["The cat sat", "the cat sat on the mat", "", None, "a b a b a b", "unseen words here", "The\tCAT\x0bsat", "É é É"]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, order):
    rng = random.Random(order)
    texts = TEXTS + [" ".join(rng.choice("the cat sat on a mat b c d".split()) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    rows = [(i if i != 7 else None, t, i % 5 == 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, held_out boolean").repartition(3)
    got = lm.score_corpus(df, order=order, prior={2: 3.0, 3: 1.5}, block_tokens=50).collect()
    train = [t for _, t, h in rows + rows[:3] if not h]
    brute = Brute(train, order, {2: 3.0, 3: 1.5})
    assert len(got) == len(rows) + 3
    by = {i: (t, h) for i, t, h in rows}
    for r in got:
        text, held = by[r.doc_id]
        ws = words_of(text)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held, len(ws), brute.n)
        assert r.n_known == sum(brute.c[(w,)] > 0 for w in ws)
        assert r.base_score == pytest.approx(sum(math.log10(brute.p((), w)) for w in ws))
        assert r.score == pytest.approx(brute.score(text))


def test_the_model_sums_to_one():
    brute = Brute([t for t in TEXTS if t], 3, {2: 3.0, 3: 1.5})
    words = [g[0] for g in brute.c if len(g) == 1] + ["never seen"]
    for history in ((), ("the",), ("the", "cat"), ("\n", "the"), ("x", "y")):
        assert sum(brute.p(history, w) for w in words) == pytest.approx(1)


def test_packing_round_trips():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        keys = np.unique(rng.integers(0, 1 << 60, n, dtype=np.uint64))
        assert np.array_equal(lm.unpack_sorted(lm.pack_sorted(keys)), keys)
        tokens = rng.integers(0, 1 << 31, n)
        assert np.array_equal(lm.unpack_tokens(lm.pack_tokens(tokens)), tokens)
        counts = rng.integers(0, 600, n)
        assert np.array_equal(lm.unpack_counts(lm.pack_counts(counts), n), counts)


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([(1, "a b", True), (2, None, True)], "doc_id long, text string, held_out boolean")
    assert lm.score_corpus(df.limit(0)).collect() == []
    assert sorted((r.doc_id, r.n_known, r.train_tokens, r.score) for r in lm.score_corpus(df).collect()) == [
        (1, 0, 0, 0.0), (2, 0, 0, 0.0)]


def test_query_scores_held_out_texts_above_the_base(spark):
    from conftest import SF01

    from tideline.llm.queries import op2_lm_scoring
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = op2_lm_scoring(spark, SF01).collect()
    held = {d: crc32(str(d).encode()) % 7 == 2 for d in docs}
    brute = Brute([t for d, t in docs.items() if not held[d]], 2, lm.PRIOR)
    assert len(rows) == len(docs)
    for r in rows[::7]:
        assert r.held_out == held[r.doc_id] and r.train_tokens == brute.n
        assert r.score == pytest.approx(brute.score(docs[r.doc_id]), rel=1e-9)
    held_rows = [r for r in rows if r.held_out]
    assert sum(r.score for r in held_rows) > sum(r.base_score for r in held_rows)

from __future__ import annotations

from itertools import product

import numpy as np
import pytest

from tideline.llm import langid


def test_forward_backward_is_the_sum_over_all_labellings():
    rng = np.random.default_rng(1)
    k, lengths = 3, np.array([4, 1, 2])
    start, moves = rng.normal(size=k), rng.normal(size=(k, k))
    scores = rng.normal(size=(lengths.sum(), k))
    emit, mask = langid.padded(scores, lengths)
    found, pairs = langid.forward_backward(emit, mask, start, moves)
    want_pairs = np.zeros((k, k))
    for c, n in enumerate(lengths):
        total, by, two = 0.0, np.zeros((n, k)), np.zeros((k, k))
        for path in product(range(k), repeat=n):
            w = np.exp(start[path[0]] + sum(emit[c, t, y] for t, y in enumerate(path))
                       + sum(moves[a, b] for a, b in zip(path, path[1:])))
            total += w
            for t, y in enumerate(path):
                by[t, y] += w
            for a, b in zip(path, path[1:]):
                two[a, b] += w
        assert np.allclose(found[c, :n], by / total)
        want_pairs += two / total
    assert np.allclose(pairs, want_pairs)


def test_words_hold_letters_only():
    assert langid.letter_words(["The m\u00b2 \u00bd x_y 12a \u2167 \u00c9t\u00e9", "12 \u00bd"]) == [["the", "m", "x", "y", "a", "\u00e9t\u00e9"], []]


def test_features_do_not_depend_on_neighbours():
    words = ["a", "ab", "straße", "été", "internationalisation", "x" * 300]
    together, sizes = langid.word_features(words)
    for w, part in zip(words, np.split(together, np.cumsum(sizes)[:-1])):
        assert np.array_equal(part, langid.word_features([w])[0])


@pytest.fixture(scope="module")
def model():
    sample = [("the cat sat on the mat and the dog ran with them", "en"), ("der hund und die katze sitzen nicht auf dem dach", "de")] * 12
    return langid.train(sample)


def test_switched_text_is_labelled_word_by_word(model):
    words = "the dog and the cat sat der hund und die katze".split()
    lexicon = langid.Lexicon()
    numbers = lexicon.number([words])
    emit, mask = langid.padded(model.emissions(lexicon)[numbers], np.array([len(words)]))
    found, _ = langid.forward_backward(emit, mask, model.start, model.moves)
    got = [model.labels[i] for i in found[0].argmax(axis=1)]
    assert got == ["en"] * 6 + ["de"] * 5


def test_operator_edge_rows(spark, model):
    rows = [(1, None, 0), (2, "", 0), (3, "12 !! 34", 0), (4, "the dog", 0), (4, "the dog", 0), (None, "die katze " * 3000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    got = langid.identify(df, model).collect()
    assert [r.lang_pred for r in got] == ["und", "und", "und", "en", "en", "de"]
    assert [r.score for r in got[:3]] == [0.0] * 3 and all(0 < r.score <= 1 for r in got[3:])
    assert langid.identify(df.limit(0), model).collect() == []
    clash = langid.identify(df.selectExpr("doc_id", "'x' SCORE", "text", "1 lang_pred"), model)
    assert clash.columns == ["doc_id", "text", "lang_pred", "score"] and clash.collect()[3].lang_pred == "en"
    nothing = langid.fit(df.selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}


def test_sample_is_bounded_by_language(spark):
    df = spark.range(300).selectExpr("id doc_id", "concat('w', id) text", "if(id % 3 = 0, 'a', 'b') lang")
    sample = langid.sample_languages(df.union(df), "text", "lang", "doc_id", 40)
    assert sorted(x for _, x in sample) == ["a"] * 40 + ["b"] * 40


def test_held_out_accuracy(spark):
    from conftest import SF01

    from tideline.llm.queries import op4_langid
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = op4_langid(spark, SF01).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert len(held) > 250 and sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98

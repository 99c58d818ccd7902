from __future__ import annotations

import numpy as np
import pytest

from tideline.llm import toxicity


def brute_score(model, text):
    """The network word by word, window by window."""
    import re
    words = re.findall(toxicity.WORDS, text.lower())
    x = [sum(model.embed[f] for f in toxicity.feature_table([w])[0]) for w in words]
    pooled = []
    for i, width in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            best = 0.0
            for t in range(len(x) - width + 1):
                best = max(best, sum(float(x[t + o] @ model.filters[i][o][:, f]) for o in range(width)) + float(model.bias[i][f]))
            pooled.append(best)
    z = float(np.dot(pooled, model.out[:-1]) + model.out[-1]) - model.shift
    return 1 / (1 + np.exp(-(z + np.log(0.3 / 0.7))))


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(60)]
    sample = []
    for i in range(400):
        text = [str(w) for w in rng.choice(words, 20)]
        bad = i % 4 == 0
        if bad:
            text[int(rng.integers(20))] = "nasty" + str(rng.choice(["a", "bc", "xyz"]))
        sample.append((" ".join(text), int(bad), "en"))
    return toxicity.train(sample, {0: 1.0, 1: 1.0})


def test_scores_equal_a_word_by_word_network(model):
    texts = ["", "w1", "w1 w2", "w1 nastybc w3 w4", "nastyq w9 " * 7, "!!"]
    got = toxicity.score_texts(model, toxicity.Vocabulary(100), texts)
    assert np.allclose(got, [brute_score(model, t) for t in texts], atol=1e-4)


def test_learned_stem_is_found_anywhere(model):
    texts = [" ".join(f"w{(i * 7 + j) % 60}" for j in range(300)) for i in range(30)]
    scores = toxicity.score_texts(model, toxicity.Vocabulary(100), texts + [t + " nastyhmm " + t for t in texts])
    assert (scores[:30] < 0.3).all() and (scores[30:] >= 0.3).all()


def test_best_threshold_is_the_best_cut():
    rng = np.random.default_rng(2)
    for _ in range(30):
        v, y = rng.integers(0, 6, 25).astype(float), rng.integers(0, 2, 25).astype(float)
        y[0] = 1
        w = rng.random(25) + 0.1

        def f1(t):
            taken = v >= t
            return 2 * (w * y * taken).sum() / ((w * taken).sum() + (w * y).sum())
        assert f1(toxicity.best_threshold(v, y, w)) == pytest.approx(max(f1(t) for t in v))


def test_operator_edge_rows(spark, model):
    rows = [(1, None, "en"), (2, "", None), (3, "nastyxyz w1", "xx"), (3, "nastyxyz w1", "xx"), (None, "w1 " * 50_000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = toxicity.classify(df, model).collect()
    assert got[0].score == got[1].score and got[2].score == got[3].score >= 0.3 > got[4].score
    assert toxicity.classify(df.limit(0), model).collect() == []
    clash = toxicity.classify(df.selectExpr("*", "'x' Flagged", "2 score"), model)
    assert [r.score for r in clash.collect()] == [r.score for r in got]
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 0)], "doc_id long, toxic int")
    one_sided = toxicity.fit(df, labels)
    assert max(r.score for r in toxicity.classify(df, one_sided).collect()) < 0.3


def test_held_out_accuracy(spark):
    from tideline.llm.queries import op1_toxicity
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op1_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    y, s = np.array([truth[r.doc_id] for r in held]), np.array([r.score for r in held])
    auc = (s[y == 1][:, None] > s[y == 0][None]).mean()
    p = np.array([r.predicted for r in held])
    f1 = 2 * (p * y).sum() / (p.sum() + y.sum())
    assert auc > 0.95 and f1 > 0.8


def labelled(spark, n, toxic_at):
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 90}" for j in range(12)) + (f" {toxic_at(i)}" if toxic_at(i) else ""), "en") for i in range(n)]
    labels = [(i, int(toxic_at(i) is not None)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int").repartition(3)


def test_every_labelled_text_is_learned_from(spark):
    # More texts than the 3,000 toxic and 6,000 other ones that a fit once drew; each toxic word is in few of them.
    n = 16_000
    docs, labels = labelled(spark, n, lambda i: f"foul{i % 800}z" if i % 3 == 0 else None)
    rows = toxicity.labelled_texts(docs, labels)
    assert rows.count() == n and rows.select("shard").distinct().count() == 2
    have = toxicity._counts(rows)
    assert have[:, toxicity.BUCKETS].tolist() == [n - len(range(0, n, 3)), len(range(0, n, 3))]
    local = toxicity.Vocabulary(1 << 62)
    texts = [(r.text, r.y) for r in rows.collect()]
    words = toxicity.words_of([t for t, _ in texts])
    numbers, features = local.featured(words)
    brute = np.zeros_like(have)
    for w, (_, y) in zip(words, texts):
        of = {f for x in w for f in toxicity.feature_table([x])[0].tolist() if f >= 0}
        brute[y, list(of)] += 1
        brute[y, toxicity.BUCKETS] += 1
    assert (have == brute).all()
    assert (toxicity.feature_counts(numbers, np.array([len(w) for w in words]), np.array([y for _, y in texts]), features) == brute).all()


def test_calibration_counts_every_kept_back_text(spark, model):
    docs, labels = labelled(spark, 500, lambda i: "nastybc" if i % 5 == 0 else None)
    rows = toxicity.labelled_texts(docs, labels)
    here = toxicity.Model(model.embed, model.filters, model.bias, model.out)
    toxicity._calibrate(rows, here)
    texts = [(r.text, r.y) for r in rows.collect()]
    values = np.rint(toxicity.logits(here, toxicity.Vocabulary(1000), toxicity.words_of([t for t, _ in texts])) * toxicity.LOGIT_STEPS) / toxicity.LOGIT_STEPS
    assert here.shift == toxicity.best_threshold(values, np.array([y for _, y in texts]), np.ones(len(texts)))
    assert list(here.by_lang) == ["en"]


def test_reruns_and_other_partitions_give_the_same_model(spark):
    docs, labels = labelled(spark, 9_000, lambda i: f"foul{i % 40}z" if i % 4 == 0 else None)
    one, two = toxicity.fit(docs, labels), toxicity.fit(docs.repartition(7), labels.coalesce(1))
    assert (one.embed == two.embed).all() and (one.out == two.out).all() and one.shift == two.shift and one.by_lang == two.by_lang
    found = toxicity.classify(docs, one).join(labels, "doc_id")
    assert found.filter("(score >= 0.3) != (toxic = 1)").count() == 0

"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of the embeddings of its hashed features: the
word and the stems it extends (its proper prefixes). Filters of several widths slide over a text's words;
the largest response of each filter, at least zero, goes to a logistic
output. It learns from every labelled text, in Spark tasks: the texts are
dealt to shards by id and written once. One job counts the texts of either
label that have each feature. In each round a task takes its shard's texts in
small steps from the common parameters, some times over, a block of texts
after the other; the largest response has one position, so the gradients
reach few words. The changes of every parameter are averaged
over the shards that moved it, in whole numbers, so that their order does not
matter. A quarter of the texts is kept from training to calibrate, all of it
counted by logit: the logit is shifted so that the threshold of best F1 lies
at ``THRESHOLD``, and languages with enough cases get a threshold of their
own, at which their rows are flagged. The driver holds the parameters and
tables of bounded size, no texts.

Scoring reads every word of every text, batch by batch, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import few, with_fields, without, written
from tideline.llm.langid import Lexicon

BUCKETS = 1 << 17
DIMENSIONS = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (3, 4, 5, 6, 7, 8)
#: A feature is learned if so many training texts have it.
LEAST_TEXTS = 3
#: Texts of a step, and of a shard, about.
STEP_TEXTS = 64
SHARD_TEXTS = 8192
RATE, SEED = 0.05, 3
#: How often a block of texts is gone through in each round; the parameters are averaged after a round.
ROUNDS = (2, 3)
#: Characters that a task learns from at once.
LEARN_CHARS = 1 << 23
#: A toxic text weighs as much as brings all of them to a third of the gradients, at most so much.
MOST_EMPHASIS = 100.0
#: One labelled text in so many is kept from training to calibrate, and counted by logit in steps of 1 / LOGIT_STEPS.
KEPT_BACK = 4
LOGIT_STEPS = 1024
#: Changes of parameters are added up in whole multiples of 1 / UNIT.
UNIT = 1 << 30
THRESHOLD = 0.3
WORDS = r"[^\W_]+"
CACHE = 200_000
#: Characters scored at once.
BLOCK_CHARS = 1 << 21
#: Cases of either label that a language's own threshold needs.
LEAST_CASES = 20


def feature_table(words: list[str]):
    """Hashed features of words, a row of fixed length for each (-1: none)."""
    from zlib import crc32

    import numpy as np

    out = np.full((len(words), 1 + len(PREFIXES)), -1, np.int32)
    for i, w in enumerate(words):
        out[i, 0] = crc32(w.encode("utf-8", "replace")) % BUCKETS
        for j, k in enumerate(PREFIXES, 1):
            if len(w) > k:
                out[i, j] = crc32(f"{w[:k]}*".encode("utf-8", "replace")) % BUCKETS
    return out


@dataclass
class Model:
    embed: object  # BUCKETS + 1 rows; the last stands for absent features and stays zero
    filters: list  # of each width: width x DIMENSIONS x FILTERS
    bias: list     # of each width: FILTERS
    out: object    # of each filter, and a constant
    shift: float = 0.0
    by_lang: dict = field(default_factory=dict)

    def convolved(self, vectors, starts, lengths):
        """Of each width: the responses at every word; windows that leave their text are -inf."""
        import numpy as np

        for width, filters, bias in zip(WIDTHS, self.filters, self.bias):
            y = np.full((len(vectors), FILTERS), -np.inf, np.float32)
            n = len(vectors) - width + 1
            if n > 0:
                y[:n] = sum(vectors[o:o + n] @ filters[o] for o in range(width)) + bias
            for o in range(1, width):
                y[(starts + lengths)[lengths >= o] - o] = -np.inf
            yield y

    def pooled(self, vectors, starts, lengths):
        """Largest response of each filter in each text, at least zero."""
        import numpy as np

        best = np.zeros((len(lengths), len(WIDTHS) * FILTERS), np.float32)
        full = np.flatnonzero(lengths)
        if len(full):
            top = [np.maximum.reduceat(y, starts[full], axis=0) for y in self.convolved(vectors, starts, lengths)]
            best[full] = np.maximum(np.concatenate(top, axis=1), 0)
        return best

    def scores(self, pooled):
        import numpy as np

        logit = pooled @ self.out[:-1] + self.out[-1] - self.shift + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -40, 40)))


#: Parameters beside the embeddings, in the rows below theirs.
REST = {"out": (len(WIDTHS) * FILTERS + 1,)} | {f"filters{i}": (w, DIMENSIONS, FILTERS) for i, w in enumerate(WIDTHS)} | {
    f"bias{i}": (FILTERS,) for i in range(len(WIDTHS))}
ROWS = BUCKETS + 1 - sum(map(prod, REST.values())) // -DIMENSIONS


def parts(matrix) -> dict:
    """Views of all parameters in one matrix of ``ROWS`` rows."""
    out, rest, at = {"embed": matrix[:BUCKETS + 1]}, matrix[BUCKETS + 1:].reshape(-1), 0
    for name, shape in REST.items():
        out[name] = rest[at:at + prod(shape)].reshape(shape)
        at += prod(shape)
    return out


def model_of(matrix) -> Model:
    p = parts(matrix)
    return Model(p["embed"], [p[f"filters{i}"] for i in range(len(WIDTHS))], [p[f"bias{i}"] for i in range(len(WIDTHS))], p["out"])


class Vocabulary(Lexicon):
    """Numbers words and keeps the features, or the embedding, of each."""

    def featured(self, texts: list[list[str]]):
        """Number of every word, and the features of all words numbered."""
        import numpy as np

        numbers = self.number(texts)
        done = 0 if self.margins is None else len(self.margins)
        if done < len(self.of) or not done:
            new = feature_table(self.words(done))
            self.margins = np.concatenate((self.margins, new)) if done else new
        return numbers, self.margins

    def embedded(self, model: Model, texts: list[list[str]]):
        import numpy as np

        numbers = self.number(texts)
        done = 0 if self.scores is None else len(self.scores)
        if done < len(self.of):
            new = model.embed[feature_table(self.words(done))].sum(axis=1)
            self.scores = np.concatenate((self.scores, new)) if done else new
        return self.scores[numbers] if len(numbers) else np.zeros((0, DIMENSIONS), np.float32)


def score_texts(model: Model, vocabulary: Vocabulary, texts: list[str]):
    """Score of each text."""
    import numpy as np

    words = words_of(texts)
    lengths = np.array([len(w) for w in words], np.int64)
    return model.scores(model.pooled(vocabulary.embedded(model, words), np.cumsum(lengths) - lengths, lengths))


def best_threshold(values, toxic, weight) -> float:
    """The cut of ``values`` with the best weighted F1, half-way to the next value below it."""
    import numpy as np

    order = np.argsort(-values, kind="stable")
    v, y, w = values[order], toxic[order], weight[order]
    hits, taken = np.cumsum(w * y), np.cumsum(w)
    f1 = 2 * hits / (taken + (w * y).sum())
    f1[:-1][v[:-1] == v[1:]] = -1  # equal values cannot be parted
    at = int(f1.argmax())
    below = v[at + 1] if at + 1 < len(v) else v[at] - 1
    return float(v[at] + below) / 2


def words_of(texts: list[str]) -> list[list[str]]:
    import re

    find = re.compile(WORDS).findall
    return [find(t.lower()) for t in texts]


def distinct(values):
    """The distinct values, in order; sorting is faster here than numpy's hashing."""
    import numpy as np

    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[:len(values)]]


def feature_counts(numbers, lengths, toxic, features):
    """Texts of either label that have each feature; the last column: texts."""
    import numpy as np

    have = np.zeros((2, BUCKETS + 1), np.int64)
    have[:, BUCKETS] = np.bincount(toxic, minlength=2)
    if len(numbers):
        once = distinct(np.repeat(np.arange(len(lengths)), lengths) * len(features) + numbers)
        text, of = once // len(features), features[once % len(features)]
        pairs = distinct((text[:, None] * BUCKETS + of)[of >= 0])
        of_toxic = toxic[pairs // BUCKETS]
        for y in (0, 1):
            have[y, :BUCKETS] += np.bincount(pairs[of_toxic == y] % BUCKETS, minlength=BUCKETS)
    return have


def initial(rng, have):
    """Parameters to begin with, and which features are learned.

    The first dimension begins as a feature's log-odds, drawn to zero where
    few texts have it.
    """
    import numpy as np

    matrix = np.zeros((ROWS, DIMENSIONS), np.float32)
    p = parts(matrix)
    small = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    p["embed"][:] = small(BUCKETS + 1, DIMENSIONS, scale=0.1)
    for i, w in enumerate(WIDTHS):
        p[f"filters{i}"][:] = small(w, DIMENSIONS, FILTERS, scale=0.3)
    p["out"][:-1] = small(len(WIDTHS) * FILTERS, scale=0.1)
    size = np.maximum(have[:, BUCKETS], 1)
    odds = np.log((have[1] + 0.5) / (size[1] + 1)) - np.log((have[0] + 0.5) / (size[0] + 1))
    seen = have.sum(axis=0)
    p["embed"][:, 0] = np.clip(odds, -3, 3) * seen / (seen + 5)
    learned = seen >= LEAST_TEXTS
    learned[BUCKETS] = False
    p["embed"][~learned] = 0
    p["filters0"][0, :, 0], p["filters0"][0, 0, 0], p["out"][0], p["out"][-1] = 0, 1, 1, -2
    return matrix, learned


def one_sided(toxic: bool) -> Model:
    """For labels of one value, or none."""
    import numpy as np

    model = model_of(np.zeros((ROWS, DIMENSIONS), np.float32))
    model.out[-1] = 4.0 if toxic else -4.0
    return model


def descend(matrix, square, words: list, toxic, features, rate: float, emphasis: float = 1.0) -> None:
    """One step on some texts, as word numbers, in place; ``square``: sums of the squared gradients so far."""
    import numpy as np

    lengths = np.array([len(w) for w in words])
    flat = np.concatenate(words)
    if not len(flat):
        return
    model, params, squares = model_of(matrix), parts(matrix), parts(square)

    def step(name, grad, rows=slice(None)):
        squares[name][rows] += grad * grad
        params[name][rows] -= rate * grad / np.sqrt(squares[name][rows])

    starts = np.cumsum(lengths) - lengths
    distinct, place_of = np.unique(flat, return_inverse=True)
    x = model.embed[features[distinct]].sum(axis=1)[place_of]
    best, where = [], []
    for y in model.convolved(x, starts, lengths):
        top = np.array([y[s:s + n].argmax(axis=0) + s if n else np.zeros(FILTERS, int) for s, n in zip(starts, lengths)])
        where.append(top)
        best.append(np.where((lengths > 0)[:, None], np.maximum(y[top, np.arange(FILTERS)], 0), 0))
    pooled = np.concatenate(best, axis=1)
    p = 1 / (1 + np.exp(-np.clip(pooled @ model.out[:-1] + model.out[-1], -40, 40)))
    off = ((p - toxic) * np.where(toxic > 0, emphasis, 1.0) / len(words)).astype(np.float32)
    back = off[:, None] * model.out[:-1] * (pooled > 0)
    of_x: dict[str, list] = {"at": [], "grad": []}
    filter_grads = []
    for i, width in enumerate(WIDTHS):
        g = back[:, i * FILTERS:(i + 1) * FILTERS]
        grad = np.zeros_like(model.filters[i])
        active = np.nonzero(g)
        place, value = where[i][active], g[active]
        for o in range(width):
            pulled = value[:, None] * x[place + o]
            grad[o] = np.stack([np.bincount(active[1], pulled[:, d], FILTERS) for d in range(DIMENSIONS)])
            of_x["at"].append(place + o)
            of_x["grad"].append(value[:, None] * model.filters[i][o].T[active[1]])
        filter_grads.append((grad, g.sum(axis=0)))
    step("out", np.append(off @ pooled, off.sum()).astype(np.float32))
    for i, (grad, of_bias) in enumerate(filter_grads):
        step(f"filters{i}", grad)
        step(f"bias{i}", of_bias)
    touched = features[flat[np.concatenate(of_x["at"])]]
    spread = np.repeat(np.concatenate(of_x["grad"]), touched.shape[1], axis=0)
    rows, slot = np.unique(touched.ravel(), return_inverse=True)
    grad = np.stack([np.bincount(slot, spread[:, d], len(rows)) for d in range(DIMENSIONS)], axis=1)
    real = rows >= 0
    step("embed", grad[real], rows[real])


def logits(model: Model, vocabulary: Vocabulary, texts: list[list[str]]):
    """Logit of each text's words, not shifted."""
    import numpy as np

    lengths = np.array([len(w) for w in texts], np.int64)
    pooled = model.pooled(vocabulary.embedded(model, texts), np.cumsum(lengths) - lengths, lengths)
    return (pooled @ model.out[:-1] + model.out[-1]).astype(np.float64)


def shifted(values, shift: float):
    """Scores of logits whose best threshold is ``shift``."""
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(values - shift + np.log(THRESHOLD / (1 - THRESHOLD)), -40, 40)))


def train(sample: list[tuple[str, int, str | None]], weights: dict[int, float], epochs: int = sum(ROUNDS),
          rate: float = RATE, seed: int = SEED) -> Model:
    """Fit the network to a few (text, label, language) rows here; ``weights``: rows that one row of a label stands for."""
    import numpy as np

    if len({y for _, y, _ in sample}) < 2:
        return one_sided(any(y for _, y, _ in sample))
    rng = np.random.default_rng(seed)
    order = np.random.default_rng(seed + 1).permutation(len(sample))
    words = words_of([sample[i][0] for i in order])
    toxic, langs = np.array([sample[i][1] for i in order], np.int64), [sample[i][2] for i in order]
    vocabulary = Vocabulary(1 << 62)
    numbers, features = vocabulary.featured(words)
    ends = np.cumsum([len(w) for w in words])
    texts = np.split(numbers, ends[:-1])
    back = np.arange(len(texts)) % KEPT_BACK == 0
    rest = np.flatnonzero(~back)
    have = feature_counts(np.concatenate([texts[i] for i in rest]), np.array([len(texts[i]) for i in rest]), toxic[rest], features)
    matrix, learned = initial(rng, have)
    square, features = np.full_like(matrix, 1e-4), np.where(learned[features], features, -1)
    for _ in range(epochs):
        some = rng.permutation(rest)
        for at in range(0, len(some), STEP_TEXTS):
            now = some[at:at + STEP_TEXTS]
            descend(matrix, square, [texts[i] for i in now], toxic[now], features, rate)
    model = model_of(matrix)
    of = np.flatnonzero(back)
    values, y = logits(model, Vocabulary(1 << 62), [words[i] for i in of]), toxic[of]
    weight = np.array([weights[int(v)] for v in y])
    if len(set(y.tolist())) == 2:
        model.shift = best_threshold(values, y, weight)
    found = shifted(values, model.shift)
    for lang in {langs[i] for i in of} - {None}:
        own = np.array([langs[i] == lang for i in of])
        if min(y[own].sum(), (1 - y[own]).sum()) >= LEAST_CASES:
            model.by_lang[lang] = best_threshold(found[own], y[own], weight[own])
    return model


def shard_blocks(batches, most: int = BLOCK_CHARS) -> Iterator[tuple]:
    """Consecutive rows of one shard, of about ``most`` characters: the shard, and the other columns as lists."""
    held, size, of = [], 0, None
    for batch in batches:
        for shard, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (shard != of or size >= most):
                yield of, *map(list, zip(*held))
                held, size = [], 0
            of = shard
            held.append(row)
            size += len(row[0])
    if held:
        yield of, *map(list, zip(*held))


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
                   label: str = "toxic") -> DataFrame:
    """Every labelled text once for each id, with its shard and whether it is kept back, written; a shard's rows lie together."""
    known = written(labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y")).filter(F.col("y").isin(0, 1)), "known")
    shards = max(1, -(-known.count() // SHARD_TEXTS))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        F.col("text").isNotNull() & F.col("id").isNotNull())
    rows = texts.join(few(known), "id").repartition(shards, "id").groupBy("id").agg(F.min(F.struct("text", "y", "lang")).alias("r"))
    mixed = F.xxhash64("id", F.lit(5))
    rows = rows.sortWithinPartitions(mixed, "id").select(
        F.spark_partition_id().alias("shard"), "r.text", "r.y", "r.lang", (F.pmod(mixed, F.lit(KEPT_BACK)) == 0).alias("back"))
    return written(rows, "labelled", compression="zstd")


def _counts(rows: DataFrame):
    """``feature_counts`` of all rows."""
    import numpy as np

    def counted(batches):
        import pyarrow as pa

        have, vocabulary = np.zeros((2, BUCKETS + 1), np.int64), Vocabulary(CACHE)
        for _, texts, toxic in shard_blocks(batches):
            words = words_of(texts)
            numbers, features = vocabulary.featured(words)
            have += feature_counts(numbers, np.array([len(w) for w in words]), np.array(toxic), features)
        some = np.flatnonzero(have.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(have[0, some]), pa.array(have[1, some])], names=["feature", "other", "toxic"])

    found = rows.select("shard", "text", "y").mapInArrow(counted, "feature long, other long, toxic long")
    table = found.groupBy("feature").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toArrow()
    have = np.zeros((2, BUCKETS + 1), np.int64)
    have[:, table["feature"].to_numpy()] = table["other"].to_numpy(), table["toxic"].to_numpy()
    return have


def _round(rows: DataFrame, matrix, square, learned, number: int, passes: int, emphasis: float) -> None:
    """Every shard goes through its rows from the common parameters, which then move by their changes' averages."""
    import numpy as np

    given = rows.sparkSession.sparkContext.broadcast((matrix, square, learned))
    names = [f"c{i}" for i in range(2 * DIMENSIONS)]

    def changed(batches):
        import pyarrow as pa

        def moved():
            some = np.flatnonzero((mine_square != square).any(axis=1))
            change = np.concatenate((mine[some] - matrix[some], mine_square[some] - square[some]), axis=1)
            whole = np.rint(change.astype(np.float64) * UNIT).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(some), *map(pa.array, whole.T.copy())], names=["row", *names])

        matrix, square, learned = given.value
        last = None
        for shard, texts, toxic in shard_blocks(batches, LEARN_CHARS):
            if shard != last:
                if last is not None:
                    yield moved()
                last, mine, mine_square = shard, matrix.copy(), square.copy()
                rng = np.random.default_rng((SEED, number, shard))
            vocabulary, numbers = Vocabulary(1 << 62), []
            for at in range(0, len(texts), 4 * STEP_TEXTS):
                words = words_of(texts[at:at + 4 * STEP_TEXTS])
                numbers += np.split(vocabulary.number(words).astype(np.int32), np.cumsum([len(w) for w in words])[:-1])
            features, toxic = vocabulary.featured([])[1], np.array(toxic)
            features = np.where(learned[features], features, -1)
            for _ in range(passes):
                order = rng.permutation(len(numbers))
                for at in range(0, len(order), STEP_TEXTS):
                    now = order[at:at + STEP_TEXTS]
                    descend(mine, mine_square, [numbers[i] for i in now], toxic[now], features, RATE, emphasis)
        if last is not None:
            yield moved()

    found = rows.select("shard", "text", "y").mapInArrow(changed, f"row long, {', '.join(f'{c} long' for c in names)}")
    # At most ROWS rows, however many shards.
    table = found.groupBy("row").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names]).toArrow()
    given.unpersist()
    at, n = table["row"].to_numpy(), table["n"].to_numpy()
    for i, c in enumerate(names):
        (matrix if i < DIMENSIONS else square)[at, i % DIMENSIONS] += (table[c].to_numpy() / (n * UNIT)).astype(np.float32)


def _calibrate(rows: DataFrame, model: Model) -> None:
    """The shift, and the languages' thresholds, from the logits of all rows, counted."""
    import numpy as np

    def told(batches):
        import pyarrow as pa

        vocabulary = Vocabulary(CACHE)
        for _, texts, toxic, langs in shard_blocks(batches):
            step = np.rint(np.clip(logits(model, vocabulary, words_of(texts)), -40, 40) * LOGIT_STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(step), pa.array(toxic, pa.int32())], names=["lang", "step", "y"])

    found = rows.select("shard", "text", "y", F.col("lang").cast("string").alias("lang")).mapInArrow(told, "lang string, step long, y int")
    found = written(found.groupBy("lang", "step", "y").agg(F.count(F.lit(1)).alias("n")), "logits")
    table = found.groupBy("step", "y").agg(F.sum("n").alias("n")).orderBy("step", "y").toArrow()
    y = table["y"].to_numpy()
    if len(set(y.tolist())) < 2:
        return
    model.shift = shift = best_threshold(table["step"].to_numpy() / LOGIT_STEPS, y, table["n"].to_numpy())

    def of_lang(key, rows):
        import pandas as pd

        rows = rows.sort_values(["step", "y"])
        scores = shifted(rows["step"].to_numpy() / LOGIT_STEPS, shift)
        return pd.DataFrame({"lang": [key[0]], "at": [best_threshold(scores, rows["y"].to_numpy(), rows["n"].to_numpy())]})

    cases = [F.sum(F.when(F.col("y") == v, F.col("n")).otherwise(0)) >= LEAST_CASES for v in (0, 1)]
    enough = found.filter(F.col("lang").isNotNull()).groupBy("lang").agg((cases[0] & cases[1]).alias("enough")).filter("enough").select("lang")
    # At most 80 LOGIT_STEPS rows of either label in a group, one row out.
    model.by_lang = {r["lang"]: r["at"] for r in found.join(enough, "lang").groupBy("lang").applyInPandas(of_lang, "lang string, at double").collect()}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
        label: str = "toxic") -> Model:
    """A model from all labelled texts of ``docs``.

    Rows of ``labels`` without id or label are left out; of several labels of
    one id the largest holds, and of several texts the smallest. Very long
    texts are learned from whole.
    """
    import numpy as np

    rows = labelled_texts(docs, labels, id_col, text, lang, label)
    learn, back = rows.filter("not back"), rows.filter("back")
    have = _counts(learn)
    other, toxic = have[:, BUCKETS].tolist()
    if not (other and toxic):
        return one_sided(toxic > 0)
    matrix, learned = initial(np.random.default_rng(SEED), have)
    square = np.full_like(matrix, 1e-4)
    for number, passes in enumerate(ROUNDS):
        _round(learn, matrix, square, learned, number, passes, min(MOST_EMPHASIS, max(1.0, other / (2 * toxic))))
    model = model_of(matrix)
    _calibrate(back, model)
    return model


def classify(df: DataFrame, model: Model, text: str = "text", lang: str = "lang", score: str = "score") -> DataFrame:
    """``df`` and its scores: score, lang_threshold, flagged.

    A null or empty text has the score of a text without words. The language
    is no input of the score; it picks the calibrated threshold alone (null
    or not calibrated: the common one). Very long texts are scored whole, by
    the largest response anywhere. Repeated rows score alike; an empty
    table gives an empty result; columns of ``df`` with the names of the
    outputs are replaced.
    """
    new = {score: "double", "lang_threshold": "double", "flagged": "boolean"}
    df = without(df, list(new), keep=(text, lang))
    where, of_lang = df.columns.index(text), df.columns.index(lang)

    def scored(batches):
        import numpy as np
        import pyarrow as pa

        vocabulary = Vocabulary(CACHE)
        for batch in batches:
            column, at = batch.column(where), 0
            langs = batch.column(of_lang).to_pylist()
            while at < len(batch):
                texts, held, upto = [], 0, at
                while upto < len(batch) and (not texts or held < BLOCK_CHARS):
                    texts.append(column[upto].as_py() or "")
                    held += len(texts[-1])
                    upto += 1
                found = score_texts(model, vocabulary, texts)
                limit = np.array([model.by_lang.get(x, THRESHOLD) for x in langs[at:upto]])
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(at, upto - at).columns, pa.array(found), pa.array(limit), pa.array(found >= limit)],
                    names=[*batch.schema.names, *new])
                at = upto

    return df.mapInArrow(scored, with_fields(df.schema, **new))

"""Language identification by a linear-chain conditional random field over words.

Every word of a text is labelled with a language, also where writers switch
within a text. A word's emission scores are sums of learned weights of its
features: affixes, character n-grams and the word itself (the lexicon), all
hashed. Transitions between neighbouring labels are learned with them. The
forward-backward algorithm gives each word's label probabilities; a text's
scores are their means over its words, weighted by letters.

Training takes the language of a sampled document as the label of its words.
A word repeated on the spot is one position of a chain, there and in scoring.
Part of the training chains join pieces of documents in two languages, so
that the transitions of switched text are learned too. The sample is bounded
(``per_language`` documents of each language, by hash of the id); scoring
reads every word of every text, in chains of ``CHAIN`` words, batch by batch
and without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import with_fields, without

BUCKETS = 1 << 16
CHAIN = 256
#: Words whose features are kept between batches of one task.
CACHE = 200_000
#: Characters labelled at once.
BLOCK_CHARS = 1 << 21
LETTERS = r"[^\W\d_]+"


def letter_words(texts: list[str]) -> list[list[str]]:
    """Runs of letters of each text, lower-cased."""
    import re

    find = re.compile(LETTERS).findall
    out = []
    for text in texts:
        words = find(text.lower())
        if not all(map(str.isalpha, words)):  # signs like superscripts count as word characters there
            words = [w for w in ("".join(filter(str.isalpha, x)) for x in words) if w]
        out.append(words)
    return out


def word_features(words: list[str]):
    """Hashed features of all words, one word after the other, and how many each has.

    A word of n characters has itself (its lexicon entry), up to four
    prefixes and four suffixes, and n trigrams of its characters between
    spaces.
    """
    import numpy as np

    def bucket(h, salt):
        h = (h + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)) % np.uint64(BUCKETS)

    n = np.fromiter(map(len, words), np.int64, len(words))
    chars = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    start = np.cumsum(n + 1) - n  # of each word in chars
    of_char = np.repeat(np.arange(len(words)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)  # place in the word
    at = start[of_char] + inner
    ends = np.minimum(n, 4)
    sizes = 1 + 2 * ends + n
    first = np.cumsum(sizes) - sizes
    out = np.empty(sizes.sum(), np.int64)
    factor = np.cumprod(np.full(max(int(n.max(initial=0)), 4), 0x100000001B3, np.uint64))
    out[first] = bucket(np.add.reduceat(chars[at] * factor[inner], np.cumsum(n) - n), 1)
    for k in range(1, 5):
        long = np.flatnonzero(n >= k)
        head = sum(chars[start[long] + i] * factor[i] for i in range(k))
        tail = sum(chars[start[long] + n[long] - k + i] * factor[i] for i in range(k))
        out[first[long] + k] = bucket(head, 1 + k)
        out[first[long] + ends[long] + k] = bucket(tail, 11 + k)
    three = chars[at - 1] + chars[at] * factor[0] + chars[at + 1] * factor[1]
    out[first[of_char] + 1 + 2 * ends[of_char] + inner] = bucket(three, 21)
    return out, sizes


def word_trigrams(words: list[str]):
    """Trigrams of all words between spaces, as numbers, one word after the other, and how many each has."""
    import numpy as np

    n = np.fromiter(map(len, words), np.int64, len(words))
    chars = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    at = np.repeat(np.cumsum(n + 1) - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return chars[at - 1] << np.uint64(42) | chars[at] << np.uint64(21) | chars[at + 1], n


class Lexicon:
    """Numbers words as they come; starts afresh once it has grown to ``most`` words."""

    def __init__(self, most: int = CACHE):
        self.most, self.of, self.scores, self.margins = most, None, None, None

    def number(self, texts: list[list[str]]):
        import numpy as np
        from collections import defaultdict
        from itertools import chain

        if self.of is None or len(self.of) > self.most:
            self.of, self.scores, self.margins = defaultdict(), None, None
            self.of.default_factory = self.of.__len__
        return np.fromiter(map(self.of.__getitem__, chain.from_iterable(texts)), np.int64)

    def words(self, since: int = 0) -> list[str]:
        from itertools import islice

        return list(islice(self.of, since, None))


@dataclass
class Model:
    labels: list[str]
    weights: object  # BUCKETS x labels
    start: object    # labels
    moves: object    # labels x labels
    seen: object = None    # the trigrams of all training texts, sorted
    missing: float = 0.5   # share of a language's trigrams that training has not seen
    chance: float = 1.0    # the same if all trigrams of the training's letters were equally frequent

    def margins(self, lexicon: Lexicon):
        """Of all words of the lexicon: log odds of their trigrams in a learned language over letters at random."""
        import numpy as np

        done = 0 if lexicon.margins is None else len(lexicon.margins)
        if done < len(lexicon.of):
            trigrams, sizes = word_trigrams(lexicon.words(done))
            known = in_sorted(trigrams, self.seen)
            rest = max(1 - self.chance, 1e-9)
            each = np.where(known, np.log((1 - self.missing) / rest), np.log(self.missing / self.chance))
            new = np.add.reduceat(each, np.cumsum(sizes) - sizes)
            lexicon.margins = np.concatenate((lexicon.margins, new)) if done else new
        return lexicon.margins

    def emissions(self, lexicon: Lexicon):
        """Emission scores of all words of the lexicon, added to those it has kept."""
        import numpy as np

        done = 0 if lexicon.scores is None else len(lexicon.scores)
        if done < len(lexicon.of):
            features, sizes = word_features(lexicon.words(done))
            new = np.add.reduceat(self.weights[features], np.cumsum(sizes) - sizes, axis=0).astype(np.float32)
            lexicon.scores = np.concatenate((lexicon.scores, new)) if done else new
        return lexicon.scores


def padded(scores, lengths):
    """Rows of chains, each of scores for its positions and then zeros; the mask of true positions."""
    import numpy as np

    mask = np.arange(max(lengths.max(), 1))[None, :] < lengths[:, None]
    out = np.zeros((*mask.shape, scores.shape[1]), scores.dtype)
    out[mask] = scores
    return out, mask


def forward_backward(emit, mask, start, moves, expected: bool = True):
    """Label probabilities of each position and, if asked for, the expected number of each transition.

    Chains advance side by side, position by position. ``mask`` has true
    positions first in each row.
    """
    import numpy as np

    kind = emit.dtype
    emit = np.exp(emit - emit.max(axis=2, keepdims=True)).transpose(1, 0, 2).copy()
    on = mask.T
    steps, n, k = emit.shape
    step = np.exp(moves - moves.max()).astype(kind)
    forward, backward = np.empty_like(emit), np.empty_like(emit)
    a = np.exp(start - start.max()).astype(kind) * emit[0]
    one = np.ones(k, kind)
    forward[0] = a / (a @ one)[:, None]
    for t in range(1, steps):
        a = (forward[t - 1] @ step) * emit[t]
        forward[t] = a / (a @ one)[:, None]
    backward[-1] = 1.0
    pairs = np.zeros((k, k))
    for t in range(steps - 1, 0, -1):
        b = emit[t] * backward[t]
        if expected and on[t].any():
            joint = forward[t - 1][on[t]][:, :, None] * step * b[on[t]][:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = b @ step.T
        b /= (b @ one)[:, None]
        b[~on[t]] = 1.0
        backward[t - 1] = b
    forward *= backward
    return (forward / (forward @ one)[:, :, None]).transpose(1, 0, 2), pairs


def in_sorted(values, of):
    """Which values are in the sorted array."""
    import numpy as np

    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def learn_trigrams(model: Model, sample: list[tuple[str, str]]) -> None:
    """The model's trigrams from all texts, and the share that is new in each language's every fifth text, kept back for that.

    The language with most new ones counts. Without texts to keep back the
    share is one half.
    """
    from collections import Counter

    import numpy as np

    nth, parts = Counter(), ([], [])
    for text, lang in sample:
        nth[lang] += 1
        words = letter_words([text])[0]
        if words:
            parts[nth[lang] % 5 == 0].append((word_trigrams(words)[0], lang))
    learned = np.unique(np.concatenate([np.zeros(0, np.uint64), *(t for t, _ in parts[0])]))
    new, of = Counter(), Counter()
    for trigrams, lang in parts[1]:
        new[lang] += int((~in_sorted(trigrams, learned)).sum())
        of[lang] += len(trigrams)
    model.seen = np.union1d(learned, np.concatenate([np.zeros(0, np.uint64), *(t for t, _ in parts[1])]))
    letters = len(np.unique(model.seen >> np.uint64(21) & np.uint64((1 << 21) - 1)))
    # The letter in the middle and, on each side, a letter or the space.
    model.chance = max(1 - len(model.seen) / max(letters * (letters + 1) ** 2, 1), 1e-9)
    model.missing = min(max(((new[x] + 1) / (of[x] + 2) for x in of), default=0.5), model.chance)


def train(sample: list[tuple[str, str]], epochs: int = 6, rate: float = 0.3, seed: int = 7) -> Model:
    """Fit weights and transitions by adaptive gradient steps on the chains' log-likelihood."""
    import numpy as np

    rng = np.random.default_rng(seed)
    labels = sorted({lang for _, lang in sample})
    lexicon, chains = Lexicon(1 << 62), []
    for text, lang in sample:
        numbers = lexicon.number(letter_words([text]))
        numbers = numbers[np.diff(numbers, prepend=-1) != 0]
        chains += [(numbers[i:i + CHAIN], labels.index(lang)) for i in range(0, len(numbers), CHAIN)]
    if chains:
        every, many = word_features(lexicon.words())
        begin = np.cumsum(many) - many
    k = len(labels)
    model = Model(labels, np.zeros((BUCKETS, k)), np.zeros(k), np.zeros((k, k)))
    learn_trigrams(model, sample)
    if not chains:
        return model
    size = {"weights": np.full((BUCKETS, k), 1e-6), "start": np.full(k, 1e-6), "moves": np.full((k, k), 1e-6)}
    for _ in range(epochs):
        order = rng.permutation(len(chains))
        for at in range(0, len(order), 96):
            words, gold = [], []
            for i in order[at:at + 96]:
                numbers, label = chains[i]
                other, of_other = chains[rng.integers(len(chains))]
                if rng.random() < 0.25 and len(numbers) > 1 and len(other):
                    cut = int(rng.integers(1, len(numbers)))
                    piece = other[:len(numbers) - cut]
                    words.append(np.concatenate((numbers[:cut], piece)))
                    gold.append(np.repeat([label, of_other], [cut, len(piece)]))
                else:
                    words.append(numbers)
                    gold.append(np.full(len(numbers), label))
            lengths = np.array([len(w) for w in words])
            flat, want = np.concatenate(words), np.eye(k)[np.concatenate(gold)]
            distinct, inverse = np.unique(flat, return_inverse=True)
            sizes = many[distinct]
            first = np.cumsum(sizes) - sizes
            features = every[np.repeat(begin[distinct] - first, sizes) + np.arange(sizes.sum())]
            scores = np.add.reduceat(model.weights[features], first, axis=0)[inverse]
            emit, mask = padded(scores, lengths)
            found, pairs = forward_backward(emit, mask, model.start, model.moves)
            off = found[mask] - want
            by_word = np.stack([np.bincount(inverse, off[:, y], len(distinct)) for y in range(k)], axis=1)
            spread = np.repeat(by_word, sizes, axis=0)
            used, slot = np.unique(features, return_inverse=True)
            grad = np.stack([np.bincount(slot, spread[:, y], len(used)) for y in range(k)], axis=1) / len(words)
            real = np.zeros((k, k))
            for g in gold:
                np.add.at(real, (g[:-1], g[1:]), 1)
            ends = np.cumsum(lengths) - lengths
            steps = {"weights": (used, grad + 1e-5 * model.weights[used]),
                     "start": (slice(None), (found[:, 0] - want[ends]).mean(axis=0)),
                     "moves": (slice(None), (pairs - real) / len(words) + 1e-3 * model.moves)}
            for name, (rows, g) in steps.items():
                size[name][rows] += g * g
                getattr(model, name)[rows] -= rate * g / np.sqrt(size[name][rows])
    return model


def label_texts(model: Model, lexicon: Lexicon, texts: list[str], margins=None):
    """Of each text: the label probabilities, weighted by letters (zeros without letters).

    An array ``margins`` of zeros gets the sums of its words' margins.
    """
    from itertools import chain

    import numpy as np

    words = letter_words(texts)
    out = np.zeros((len(texts), len(model.labels)))
    counts = np.array([len(w) for w in words], np.int64)
    if not counts.sum() or not model.labels:
        return out
    numbers = lexicon.number(words)
    weight = np.fromiter(map(len, chain.from_iterable(words)), np.float64, len(numbers))
    # A run of one word is one position: said over and over, it is no more evidence.
    new = np.diff(numbers, prepend=-1) != 0
    new[(np.cumsum(counts) - counts)[counts > 0]] = True
    numbers, weight = numbers[new], weight[new]
    counts = np.bincount(np.repeat(np.arange(len(texts)), counts)[new], minlength=len(texts))
    lengths = np.concatenate([np.full(n // CHAIN + 1, CHAIN) for n in counts])
    last = np.cumsum(counts // CHAIN + 1) - 1
    lengths[last] = counts % CHAIN
    lengths = lengths[lengths > 0]
    emit, mask = padded(model.emissions(lexicon)[numbers], lengths)
    found, _ = forward_backward(emit, mask, model.start, model.moves, expected=False)
    by_word = found[mask] * weight[:, None]
    full = np.flatnonzero(counts)
    firsts = (np.cumsum(counts) - counts)[full]
    sums = np.add.reduceat(by_word, firsts, axis=0)
    out[full] = sums / sums.sum(axis=1, keepdims=True)
    if margins is not None:
        margins[full] = np.add.reduceat(model.margins(lexicon)[numbers], firsts)
    return out


def sample_languages(df: DataFrame, text: str, lang: str, id_col: str, per_language: int) -> list[tuple[str, str]]:
    """Up to ``per_language`` texts of each language, those whose ids have the smallest hashes."""
    known = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    langs = sorted(r[0] for r in known.select(lang).distinct().collect())
    if not langs:
        return []
    keyed = known.select(F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"),
                         F.xxhash64(F.col(text), F.lit(11)).alias("h"))
    chosen = reduce(DataFrame.unionAll, [
        keyed.filter(F.col("lang") == x).select("id", "lang", "h").distinct()
        .orderBy(F.xxhash64("id", F.lit(11)), "id", "h").limit(per_language) for x in langs])
    on = ["id", "lang", "h"]
    same_id = F.col("d.id").eqNullSafe(F.col("c.id")) & (F.col("d.lang") == F.col("c.lang")) & (F.col("d.h") == F.col("c.h"))
    # At most per_language rows of three short columns for each language.
    rows = keyed.alias("d").join(F.broadcast(chosen.alias("c")), same_id, "left_semi").dropDuplicates(on)
    return sorted((r["text"], r["lang"]) for r in rows.collect())


def fit(df: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
        per_language: int = 400) -> Model:
    """A model from the texts and non-null languages of a bounded sample of ``df``."""
    return train(sample_languages(df, text, lang, id_col, per_language))


def identify(df: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred",
             score: str = "score", margin: str | None = None) -> DataFrame:
    """``df`` and two columns: the predicted language and its probability.

    ``margin`` names a third: the log odds that the text's trigrams are of a
    learned language rather than letters at random, whatever the number of
    languages. It is 0 for ``und``.

    A null text, one without letters, and any text if nothing was learned, is
    ``und`` with score 0. Ties go to the language first in code-point order.
    Repeated rows are labelled alike; an empty table gives an empty result;
    columns of ``df`` with the names of the outputs are replaced.
    """
    more = [margin] if margin else []
    df = without(df, [pred, score, *more], keep=(text,))
    where = df.columns.index(text)

    def labelled(batches):
        import numpy as np
        import pyarrow as pa

        lexicon = Lexicon()
        for batch in batches:
            column, at = batch.column(where), 0
            while at < len(batch):
                texts, held, upto = [], 0, at
                while upto < len(batch) and (not texts or held < BLOCK_CHARS):
                    texts.append(column[upto].as_py() or "")
                    held += len(texts[-1])
                    upto += 1
                margins = np.zeros(len(texts)) if margin else None
                found = label_texts(model, lexicon, texts, margins)
                best = found.argmax(axis=1) if found.shape[1] else np.zeros(len(texts), int)
                top = found.max(axis=1, initial=0.0)
                names = [model.labels[i] if p > 0 else "und" for i, p in zip(best, top)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(at, upto - at).columns, pa.array(names, pa.string()), pa.array(top, pa.float64()),
                     *[pa.array(margins, pa.float64()) for _ in more]],
                    names=[*batch.schema.names, pred, score, *more])
                at = upto

    return df.mapInArrow(labelled, with_fields(df.schema, **{pred: "string", score: "double"}, **dict.fromkeys(more, "double")))

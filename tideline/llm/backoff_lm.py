"""Language-model scores by a weighted backoff automaton.

The model: p(w) is the add-one estimate over words and one class of unknown
ones, and a longer history h with h' its shorter one gives

    p(w | h) = (c(h w) + K p(w | h')) / (c(h) + K),

which sums to one over all words. As an automaton, every history seen in
training is a state. A seen n-gram h w is an arc that carries log10 p(w | h);
every state has a failure arc to the state of its shorter history that
carries log10 K / (c(h) + K), the weight of all words it has no arc for. A
text is scored by one traversal from left to right: take the arc of the next
word, through failure arcs where there is none, and add up what the arcs
carry. A text begins in the state of the end token, which ends each text.

The model grows with the corpus, so no task holds it. Texts form blocks of
some ``BLOCK_TOKENS`` tokens. Each block sends its distinct n-grams, as 60-bit
hashes with its training counts, to buckets of the hash; the buckets add the
counts of all blocks and return to each block the counts of what it asked
for, a byte or so each. The block builds the part of the automaton that its
texts can reach, which gives each of them the score of the whole model.
Frequent n-grams are one entry per block, so no bucket is hot. Blocks travel
once, as word numbers, and are written to the shared folder.

Two n-grams share a hash with a probability of about m^2 / 2^60 for m
distinct n-grams in the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import written

BLOCK_TOKENS = 1 << 19
#: N-grams of all blocks, repeats over blocks included, that one bucket adds up: the number of buckets grows with the input.
BUCKET_GRAMS = 4_000_000
#: Characters cut into words at once.
BLOCK_CHARS = 1 << 21
END = b"\n"  # no word holds white space
BITS = 60
#: K by order of the history's n-grams (2: one word of history).
PRIOR = {2: 400.0, 3: 150.0}


# Packed integers: what blocks and buckets exchange.

def pack_sorted(keys) -> bytes:
    """Ascending integers as differences of as many bytes as the largest needs."""
    import numpy as np

    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    first = steps[:1].tobytes()
    if len(steps) > 1:  # the first may be large
        width = max(1, (int(steps[1:].max()).bit_length() + 7) // 8)
    return bytes([width]) + first + steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_sorted(data: bytes):
    import numpy as np

    width = data[0]
    rest = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(rest) + 1, 8), np.uint8)
    steps[0] = np.frombuffer(data, np.uint8, 8, 1)
    steps[1:, :width] = rest
    return np.cumsum(steps.reshape(-1).view("<u8"))


def pack_counts(counts) -> bytes:
    """One byte for each count; those of 255 and more follow. Compressed: most are 0 or 1."""
    import numpy as np
    import zstandard

    plain = np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<u8").tobytes()
    return zstandard.compress(plain, 1)


def unpack_counts(data: bytes, n: int):
    import numpy as np
    import zstandard

    data = zstandard.decompress(data)
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", offset=n).astype(np.int64)
    return counts


def pack_tokens(tokens) -> bytes:
    """Word numbers, compressed byte by byte: frequent words come early and have small numbers."""
    import numpy as np
    import zstandard

    return zstandard.compress(tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_tokens(data: bytes):
    import numpy as np
    import zstandard

    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


class Grams:
    """The distinct n-grams of a block by order: index at every position, keys, and their parts.

    ``tokens``: the word numbers of all texts (0: end), each text closed by an
    end; ``hashes``: of the words.
    """

    def __init__(self, tokens, hashes, order: int):
        import numpy as np

        n, mask = len(tokens), np.uint64((1 << BITS) - 1)
        ended = np.flatnonzero(tokens == 0)
        begin = np.concatenate(([0], ended[:-1] + 1))
        place = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
        previous = np.where(place == 0, 0, np.concatenate(([0], tokens[:-1])))
        self.order, self.at, self.word, self.history, self.shorter = order, {1: tokens}, {}, {}, {}
        # The lowest bit tells words from longer n-grams.
        self.keys = {1: (hashes & mask) | np.uint64(1)}
        chain = hashes
        for k in range(2, order + 1):
            valid = np.flatnonzero(place >= k - 2)
            history = previous[valid] if k == 2 else self.at[k - 1][valid - 1]
            codes = history.astype(np.int64) * len(hashes) + tokens[valid]
            _, one, index = np.unique(codes, return_index=True, return_inverse=True)
            at = np.full(n, -1, np.int64)
            at[valid] = index
            one = valid[one]
            self.at[k], self.word[k] = at, tokens[one]
            self.history[k] = previous[one] if k == 2 else self.at[k - 1][one - 1]
            self.shorter[k] = self.at[k - 1][one]
            h = (chain[self.history[k]] ^ np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15) + hashes[self.word[k]]
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            chain = h ^ (h >> np.uint64(29))
            self.keys[k] = (chain & mask) & ~np.uint64(1)

    def sorted_keys(self):
        """All keys in ascending order without repeats, and each n-gram's place among them, by order."""
        import numpy as np

        every = np.concatenate([self.keys[k] for k in range(1, self.order + 1)])
        keys, places = np.unique(every, return_inverse=True)
        ends = np.cumsum([len(self.keys[k]) for k in range(1, self.order + 1)])
        return keys, dict(zip(range(1, self.order + 1), np.split(places, ends[:-1])))


def bucket_of(keys, buckets: int):
    import numpy as np

    return ((keys >> np.uint64(BITS - 32)) * np.uint64(buckets)) >> np.uint64(32)


class Block:
    """Texts as word numbers."""

    def __init__(self):
        from collections import defaultdict

        self.number = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[END]
        self.parts, self.rows, self.tokens = [], [], 0

    def add(self, rows: list[tuple], texts: list[str]) -> None:
        """Append documents: what identifies each, and its text."""
        from itertools import chain

        import numpy as np

        words = [t.encode("utf-8", "replace").lower().split() for t in texts]
        for w in words:
            w.append(END)
        self.parts.append(np.fromiter(map(self.number.__getitem__, chain.from_iterable(words)), np.uint32))
        self.rows += [(*row, len(w)) for row, w in zip(rows, words)]
        self.tokens += sum(map(len, words))

    def hashes(self):
        import numpy as np
        import xxhash

        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.number), np.uint64, len(self.number))


def automaton(grams: Grams, counts: dict, total: int, distinct: int, prior: dict):
    """Arcs, their weights and targets, and failure weights and targets of a block's part of the model.

    States: 0 without history; 1 + i for the i-th word; longer histories follow.
    An arc's key is state * words + word.
    """
    import numpy as np

    words = len(counts[1])
    p = {1: (counts[1] + 1) / (total + distinct + 1)}
    first_state = {1: 1}
    for k in range(2, grams.order):
        first_state[k] = first_state[k - 1] + len(counts[k - 1])
    states = 1 + sum(len(counts[k]) for k in range(1, grams.order))
    fail, fail_weight = np.zeros(states, np.int64), np.zeros(states)
    known = np.where(counts[1] > 0, 1 + np.arange(words), 0)
    keys, weights, targets = [np.arange(words)], [np.log10(p[1])], [known if grams.order > 1 else np.zeros(words, np.int64)]
    for k in range(2, grams.order + 1):
        of_history, seen = counts[k - 1][grams.history[k]], counts[k] > 0
        p[k] = np.where(of_history > 0, (counts[k] + prior[k] * p[k - 1][grams.shorter[k]]) / (of_history + prior[k]),
                        p[k - 1][grams.shorter[k]])
        at = first_state[k - 1] + np.arange(len(counts[k - 1]))
        fail_weight[at] = np.log10(prior[k] / (counts[k - 1] + prior[k]))
        if k > 2:
            shorter = grams.shorter[k - 1]
            fail[at] = np.where(counts[k - 2][shorter] > 0, first_state[k - 2] + shorter, 0)
        keys.append(((first_state[k - 1] + grams.history[k]) * words + grams.word[k])[seen])
        weights.append(np.log10(p[k])[seen])
        itself = first_state[k] + np.arange(len(seen)) if k < grams.order else first_state[k - 1] + grams.shorter[k]
        targets.append(np.where(grams.word[k] == 0, 1, itself)[seen])
    arcs = dict(zip(np.concatenate(keys).tolist(), range(sum(map(len, keys)))))
    return arcs, np.concatenate(weights).tolist(), np.concatenate(targets).tolist(), fail.tolist(), fail_weight.tolist()


def traverse(model, tokens: list[int], words: int) -> list[float]:
    """log10 probability of each text, from its first word to its end."""
    arcs, weights, targets, fail, fail_weight = model
    begin = min(1, len(fail) - 1)  # the end token's state, if there are histories
    find, out, score, state = arcs.get, [], 0.0, begin
    for w in tokens:
        arc = find(state * words + w)
        while arc is None:
            score += fail_weight[state]
            state = fail[state]
            arc = find(state * words + w)
        score += weights[arc]
        if w:
            state = targets[arc]
        else:
            out.append(score)
            score, state = 0.0, begin
    return out


def score_corpus(df: DataFrame, id_col: str = "doc_id", text: str = "text", held_out: str = "held_out",
                 order: int = 2, prior: dict | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per row of ``df``: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose ``held_out`` is false or null are the training texts. A null
    text is empty: its only token is the end; a very long one is counted and
    traversed whole. Repeated rows count as often as they come; without
    training texts every probability is 1. An empty table gives an empty
    result. Further columns of ``df`` are not read.
    """
    spark = df.sparkSession
    prior = {**PRIOR, **(prior or {})}
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(held_out), F.lit(False)).alias("held"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    shape = f"block string, ids array<{kind}>, held array<boolean>, lengths array<long>, tokens binary, hashes binary"
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(df.schema[id_col].dataType)  # looked up on the driver

    def blocks(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        partition, made = TaskContext.get().partitionId(), 0
        names = [f.split()[0] for f in shape.split(", ")]
        types = [pa.string(), pa.list_(id_type), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary()]

        def row_of(block: Block):
            ids, held, lengths = (list(x) for x in zip(*block.rows))
            row = (f"{partition}-{made}", ids, held, lengths, pack_tokens(np.concatenate(block.parts)), block.hashes().tobytes())
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)

        block = Block()
        for batch in batches:
            ids, held, column = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            at = 0
            while at < len(batch):
                texts, size, upto = [], 0, at
                while upto < len(batch) and (not texts or size < BLOCK_CHARS):
                    texts.append(column[upto].as_py())
                    size += len(texts[-1])
                    upto += 1
                block.add(list(zip(ids[at:upto], held[at:upto])), texts)
                at = upto
                if block.tokens >= block_tokens:
                    yield row_of(block)
                    block, made = Block(), made + 1
        if block.rows:
            yield row_of(block)

    def asked(batches):
        """The n-grams of each block by bucket, with the block's training counts."""
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(len(batch)):
                name, held, lengths, packed, hashes = (batch.column(c)[i].as_py() for c in range(5))
                tokens, hashes = unpack_tokens(packed), np.frombuffer(hashes, np.uint64)
                grams = Grams(tokens, hashes, order)
                training = np.repeat(~np.array(held), lengths)
                keys, places = grams.sorted_keys()
                counts = np.zeros(len(keys), np.int64)
                for k, at in grams.at.items():
                    here = training & (at >= 0)
                    counts += np.bincount(places[k][at[here]], minlength=len(keys))
                cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1, dtype=np.uint64))
                full = np.flatnonzero(np.diff(cuts))
                parts = [(keys[cuts[b]:cuts[b + 1]], counts[cuts[b]:cuts[b + 1]]) for b in full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(full)), pa.array(full, pa.int32()), pa.array([pack_sorted(k) for k, _ in parts]),
                     pa.array([pack_counts(c) for _, c in parts])], names=["block", "bucket", "keys", "counts"])

    def merged(table):
        import numpy as np
        import pyarrow as pa

        keys = [unpack_sorted(k) for k in table["keys"].to_pylist()]
        sizes = [len(k) for k in keys]
        counts = np.concatenate([unpack_counts(c, n) for c, n in zip(table["counts"].to_pylist(), sizes)])
        distinct, index = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(index, counts, len(distinct)).astype(np.int64)
        words = total[(distinct & np.uint64(1)) == 1]
        answers = [pack_counts(a) for a in np.split(total[index], np.cumsum(sizes)[:-1])]
        bucket = table["bucket"][0].as_py()
        return pa.table({"block": pa.array([*table["block"].to_pylist(), None], pa.string()),
                         "bucket": pa.array([bucket] * (len(sizes) + 1), pa.int32()),
                         "answer": pa.array([*answers, None], pa.binary()), "n": pa.array([*sizes, 0], pa.int64()),
                         "total": pa.array([0] * len(sizes) + [int(words.sum())], pa.int64()),
                         "distinct": pa.array([0] * len(sizes) + [int((words > 0).sum())], pa.int64())})

    made = written(rows.mapInArrow(blocks, shape), "lm-blocks")
    tokens = made.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda n, x: n + x))).first()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-order * tokens // BUCKET_GRAMS))
    wanted = made.select("block", "held", "lengths", "tokens", "hashes").mapInArrow(
        asked, "block string, bucket int, keys binary, counts binary")
    answers = written(wanted.groupBy("bucket").applyInArrow(
        merged, "block string, bucket int, answer binary, n long, total long, distinct long"), "lm-answers")
    sums = answers.filter("block is null").agg(F.sum("total").alias("t"), F.sum("distinct").alias("d")).first()
    total, distinct = int(sums["t"] or 0), int(sums["d"] or 0)

    def scored(replies, docs):
        import numpy as np
        import pyarrow as pa

        tokens = unpack_tokens(docs["tokens"][0].as_py())
        hashes = np.frombuffer(docs["hashes"][0].as_py(), np.uint64)
        lengths = np.array(docs["lengths"][0].as_py())
        grams = Grams(tokens, hashes, order)
        _, places = grams.sorted_keys()
        replies = sorted(zip(replies["bucket"].to_pylist(), replies["answer"].to_pylist(), replies["n"].to_pylist()))
        found = np.concatenate([unpack_counts(a, n) for _, a, n in replies])
        counts = {k: found[p] for k, p in places.items()}
        model = automaton(grams, counts, total, distinct, prior)
        starts = np.cumsum(lengths) - lengths
        base = np.add.reduceat(np.log10((counts[1] + 1) / (total + distinct + 1))[tokens], starts)
        known = np.add.reduceat((counts[1] > 0)[tokens].astype(np.int64), starts)
        n = len(lengths)
        return pa.table({id_col: docs["ids"].combine_chunks().flatten(), held_out: docs["held"].combine_chunks().flatten(),
                         "n_tokens": pa.array(lengths), "n_known": pa.array(known), "train_tokens": pa.array(np.full(n, total)),
                         "base_score": pa.array(base),
                         "score": pa.array(traverse(model, tokens.tolist(), len(hashes)), pa.float64())})

    replies = answers.filter("block is not null").select("block", "bucket", "answer", "n")
    return replies.groupBy("block").cogroup(made.groupBy("block")).applyInArrow(
        scored, f"`{id_col}` {kind}, `{held_out}` boolean, n_tokens long, n_known long, train_tokens long, "
                f"base_score double, score double")

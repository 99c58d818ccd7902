"""Periodic runs of words, found online on the diagonals of a text's match matrix.

A run of period q is a diagonal: every word equals the one q words before.
Words are taken from left to right. An earlier occurrence of the word, ``lag``
words back, makes the diagonal of that lag one longer, and when a diagonal
ends, it is emitted at once if it is long enough.

Diagonals are kept sparse without losing a run. One of period q and at least
``max(least, power * q)`` words matches on ``least * (power - 1) / power``
words or more, so a word counts together with as many that follow, as one
gram: most words of most texts then have no earlier occurrence. Longer lags
take longer grams, twice as long each time, up to the lag's own length. Where
a gram is at least as long as the lag, of all its earlier occurrences only the
nearest can be the smallest period: two within the gram's length overlap, so
what lies between them is itself periodic, and the farther one a multiple. So
one diagonal is active at a time for each length of grams, and a text of n
words costs n log n steps, whatever it repeats; one word a million times, too.

Grams get exact numbers, from pairs of shorter ones; a hash only tells which
texts repeat no gram at all and are done. A map over all texts: nothing is
shuffled, and a task holds the words of some texts at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import WORD_REGEX, arrow_map, without

LEAST, POWER = 24, 3
#: Characters of the texts that are looked at together, but for a longer text by itself.
BATCH_CHARS = 1 << 21
RUN = "struct<start:long,length:long,period:long>"


def _numbered(*keys: np.ndarray) -> np.ndarray:
    """A number for each row of equal-length integer columns, the same for equal rows."""
    key = keys[0]
    for more in keys[1:]:
        key = key * (int(more.max(initial=0)) + 1) + more
    return np.unique(key, return_inverse=True)[1]


def _nearest(grams: np.ndarray) -> np.ndarray:
    """How far back each gram last began; 0 if it has not."""
    order = np.argsort(grams, kind="stable")
    same = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    lag = np.zeros(len(grams), np.int64)
    lag[order[same + 1]] = order[same + 1] - order[same]
    return lag


def _emitted(lag: np.ndarray, low: int, gram: int, least: int, power: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the diagonals of lags in (low, gram]: a pass over the grams that occurred before."""
    at = np.flatnonzero((lag > low) & (lag <= gram))
    active = matched = last = 0
    for i, q in [*zip(at.tolist(), lag[at].tolist()), (-1, 0)]:
        if q == active and i == last + 1:
            matched += 1
        else:
            words = matched + gram - 1 + active
            if active and words >= max(least, power * active):
                yield last - matched + 1 - active, words, active
            active, matched = q, 1
        last = i


def runs_of(words: np.ndarray, least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of one text, given a number for each word; by start, then period."""
    n, low, gram = len(words), 0, 1
    first = max(1, least * (power - 1) // power)
    if n < max(least, power):
        return []
    grams = _numbered(words)
    while gram < first:  # a gram from two that overlap or meet
        step = min(gram, first - gram)
        grams, gram = _numbered(grams[:-step], grams[step:]), gram + step
    found: list[tuple[int, int, int]] = []
    while True:
        lag = _nearest(grams)
        found += _emitted(lag, low, gram, least, power)
        low = gram
        if power * (low + 1) > n or not lag.any():
            return sorted(found, key=lambda r: (r[0], r[2]))
        grams, gram = _numbered(grams[:-gram], grams[gram:]), 2 * gram


def _repeating(words: np.ndarray, ends: np.ndarray, gram: int) -> list[int]:
    """Which of several texts, one behind the other up to ``ends``, may repeat a gram."""
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    left = ends[text] - np.arange(len(words))
    h = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    size = 1
    while size < gram:
        step = min(size, gram - size)
        h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        h[:-step] += h[step:] * np.uint64(0x94D049BB133111EB)
        size += step
    at = np.flatnonzero(left >= gram)
    key = (h[at] ^ h[at] >> np.uint64(32)) + text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(key)
    return np.unique(text[at[order[1:][key[order[1:]] == key[order[:-1]]]]]).tolist()


def find_runs(df: DataFrame, text: str = "text", least: int = LEAST, power: int = POWER) -> DataFrame:
    """``df`` with ``n_words``, ``runs`` and ``collapsed`` in place of the text.

    ``runs`` is an array of (start, length, period): stretches of words of
    smallest period q and at least ``max(least, power * q)`` words that no
    neighbouring word extends, by start and then period. ``collapsed`` has the
    words, joined by one space, that no run holds behind its first period.

    A null or empty text has no words, no runs and an empty ``collapsed``; a
    very long text is looked at whole, by itself; repeated rows have a result
    each; an empty table gives an empty result. Columns of ``df`` with these
    names are replaced.
    """
    if power < 3 or least < 1:
        raise ValueError("power has to be 3 or more, and least 1 or more")
    added = ["n_words", "runs", "collapsed"]
    df = without(df, added, keep=(text,))
    kept = [c for c in df.columns if c != text]
    pattern = re.compile(WORD_REGEX)

    def look(texts: list[str]) -> tuple[list[int], list[list[tuple]], list[str]]:
        split = [pattern.findall(t) for t in texts]
        number: dict[str, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for ws in split for w in ws), np.int64)
        ends = np.cumsum([len(ws) for ws in split])
        runs: list[list[tuple]] = [[] for _ in texts]
        left = [" ".join(ws) for ws in split]
        for i in _repeating(ids, ends, max(1, least * (power - 1) // power)):
            runs[i] = runs_of(ids[ends[i] - len(split[i]):ends[i]], least, power)
            if runs[i]:
                keep = np.ones(len(split[i]), bool)
                for start, length, period in runs[i]:
                    keep[start + period:start + length] = False
                left[i] = " ".join(w for w, k in zip(split[i], keep.tolist()) if k)
        return [len(ws) for ws in split], runs, left

    def find(batches):
        import pyarrow as pa

        run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
        for batch in batches:
            column, begin = batch.column(batch.num_columns - 1), 0
            while begin < len(column):
                texts, size = [], 0
                while begin + len(texts) < len(column) and size < BATCH_CHARS:
                    texts.append(column[begin + len(texts)].as_py())
                    size += len(texts[-1])
                n, runs, left = look(texts)
                lists = pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs], pa.list_(run))
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(begin, len(texts)) for c in batch.columns[:-1]], pa.array(n, pa.int64()), lists, pa.array(left, pa.string())],
                    names=[*batch.schema.names[:-1], *added])
                begin += len(texts)

    body = F.coalesce(F.col(text), F.lit(""))
    return arrow_map(df, kept, body, find, n_words="long", runs=f"array<{RUN}>", collapsed="string")


def strongest(runs: Column) -> Column:
    """The run of the greatest length/period, compared exactly; of equal ones the first by start and period; null if none."""
    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def listed(runs: Column) -> Column:
    """``start,length,period`` and a line feed for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def with_planted_runs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` in which every tenth text, by crc32 of its key, repeats one stretch of its words to the end.

    With h that hash, g = h div 10 and n words, the words from a = g mod n on
    repeat the first 1 + (n - a) div (3 + g mod 8) of them. Other texts stay
    as they are, and so do those without words; a null key plants nothing.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        copies = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        new = F.concat(F.slice(words, F.lit(1), a), F.slice(copies, F.lit(1), n - a))
        return F.when(n > 0, F.array_join(new, " ")).otherwise(F.lit(""))

    # Bound to a name by a one-element array: words are found once.
    found = F.transform(F.array(F.regexp_extract_all(F.col(text), F.lit(WORD_REGEX), F.lit(0))), planted)[0]
    return df.withColumn(text, F.when(F.pmod(h, F.lit(10)) == 0, found).otherwise(F.col(text)))

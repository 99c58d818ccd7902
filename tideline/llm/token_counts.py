"""Token counts with a public tokenizer, by overlap resynchronisation for huge documents.

Documents up to ``chunk_chars`` code points are encoded whole, in batches of
bounded size. A longer one is encoded in overlapping chunks with offsets. Two
neighbouring chunks are spliced at a boundary that both have in their
overlap. Such a boundary is proven stable: the pre-tokenizer scans from left
to right and looks at no character before the place where it stands, so from
a boundary common to both chunks on, the right chunk is cut exactly as the
whole text is; and a boundary of the left chunk that is ``margin`` characters
before its end cannot depend on what follows. Pieces between boundaries are
encoded independently, so the counts add up to that of the whole text. If
the overlap holds no common boundary (one endless word, say), it is widened,
and the chunk with it, until there is one or the text ends.

Shorter texts use the same fact at boundaries known beforehand. Where a
byte-level pre-tokenizer meets a single space between two other characters,
a piece begins, whatever stands around; so the parts between such spaces are
encoded once each and their counts kept for the next texts.

Nothing is shuffled: a task holds one batch of texts, one chunk's encoding and
the counts of at most ``MEMO`` parts.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import with_fields, without

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 9
#: Characters encoded in one call, which bounds the memory of the encodings.
BATCH_CHARS = 1 << 20
MEMO = 400_000


def load_tokenizer(path: str):
    """The tokenizer of a .json file, or of a file's name that the package of public tokenizers knows."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    if not os.path.isabs(path):
        import public_tokenizers
        path = public_tokenizers.path(path)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def boundaries(encoding, at: int = 0) -> dict[int, int]:
    """Where pieces that are encoded by themselves begin (offset + ``at``), and the tokens before each."""
    words = encoding.word_ids
    return {offset[0] + at: i for i, offset in enumerate(encoding.offsets) if not i or words[i] != words[i - 1]}


def spliced_count(tokenizer, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of ``text``, encoded in overlapping chunks of ``chunk`` characters."""
    special = tokenizer.get_added_tokens_decoder().values()
    margin = 2 + max((len(t.content) for t in special), default=0)
    encode = lambda s: tokenizer.encode(s, add_special_tokens=False)
    size, lap = max(chunk, 4 * margin), max(overlap, 2 * margin)
    total, start, end = 0, 0, min(size, len(text))
    left = encode(text[:end])
    while end < len(text):
        at = max(start + 1, end - lap)
        far = min(at + max(size, 2 * lap), len(text))
        right = encode(text[at:far])
        ours, theirs = boundaries(left, start), boundaries(right, at)
        common = [p for p in ours.keys() & theirs.keys() if start < p <= end - margin]
        if common:
            cut = min(common)
            total += ours[cut]
            # What stands before the cut in the right chunk has been counted on the left.
            left, total, start, end = right, total - theirs[cut], at, far
            lap = max(overlap, 2 * margin)
        else:  # no alignment: both reach farther, from the last proven start
            lap *= 2
            if at == start + 1 or lap > end - start:
                end = min(start + 2 * (end - start), len(text))
                left = encode(text[start:end])
    return total + len(left)


def parts(text: str) -> list[str]:
    """``text`` cut before each space that has no other white space beside it."""
    first, *rest = text.split(" ")
    out = [first]
    for part in rest:
        last = out[-1]
        if part and last and not part[0].isspace() and not last[-1].isspace():
            out.append(" " + part)
        else:
            out[-1] = f"{last} {part}"
    return out


class Counter:
    """Counts tokens of texts; keeps the counts of parts where the tokenizer encodes them by themselves."""

    def __init__(self, tokenizer):
        import json

        self.tokenizer, self.memo = tokenizer, {}
        spec = json.loads(tokenizer.to_str())
        pre, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
        self.by_part = (pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
                        and not spec["normalizer"] and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in added))

    def encoded(self, texts: list[str]) -> list[int]:
        out = []
        for some in _batches(texts, BATCH_CHARS):
            out += map(len, self.tokenizer.encode_batch_fast([texts[i] for i in some], add_special_tokens=False))
        return out

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_part:
            return self.encoded(texts)
        if len(self.memo) > MEMO:
            self.memo = {}
        memo, cut = self.memo, [parts(t) for t in texts]
        new = list({p for c in cut for p in c if p not in memo})
        memo.update(zip(new, self.encoded(new)))
        return [sum(map(memo.__getitem__, c)) for c in cut]


def _batches(texts: list[str], most: int) -> Iterator[list[int]]:
    batch, held = [], 0
    for i, text in enumerate(texts):
        if batch and held + len(text) > most:
            yield batch
            batch, held = [], 0
        batch.append(i)
        held += len(text)
    if batch:
        yield batch


def count_tokens(df: DataFrame, tokenizer_path: str, text: str = "text", name: str = "n_tokens",
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """``df`` with the number of tokens of ``text`` in place of the text.

    Special strings inside texts count as the tokenizer's default has it; no
    begin, end or padding tokens are added. A null or empty text has 0 tokens;
    repeated rows are counted each; an empty table gives an empty result. A
    column of ``df`` called ``name`` already is replaced.
    """
    df = without(df, [name], keep=(text,))
    kept = [c for c in df.columns if c != text]

    def count(batches):
        import pyarrow as pa

        tokenizer = load_tokenizer(tokenizer_path)
        counter = Counter(tokenizer)
        for batch in batches:
            column = batch.column(batch.schema.names.index("__text"))
            found: list[int] = []
            for at in range(0, len(column), 256):
                texts = column.slice(at, 256).to_pylist()
                n = counter.counts([t if len(t) <= chunk_chars else "" for t in texts])
                found += [n[i] if len(t) <= chunk_chars else spliced_count(tokenizer, t, chunk_chars, overlap_chars)
                          for i, t in enumerate(texts)]
            columns = [c for c, f in zip(batch.columns, batch.schema.names) if f != "__text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.int64())], names=[*kept, name])

    rows = df.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return rows.mapInArrow(count, with_fields(df.select(*kept).schema, **{name: "long"}))

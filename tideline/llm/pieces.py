"""SentencePiece encoding with the place of every piece in the original text, and decoding.

A byte-pair model file is read here: pieces, scores, the normaliser's settings
and its compiled character map, a double-array trie over UTF-8. Normalising
takes at each place the longest prefix that the map knows and writes its
replacement; where none is known the character passes. Every byte written
records the source byte that it comes from: a character that passes byte by
byte, a replacement as a whole. Merging then works on normalised text, and a
piece's bounds are looked up in that record, so each piece is a span of
original bytes: spans join without a gap, and the blank put in front of the
text has none. A character without a piece becomes one piece for each byte.

A merge crosses the place between two characters only if some piece holds the
two side by side. Text is cut before blanks, where none does, and long parts at
all such places. The pieces of a short part are kept for the next texts, and
those of many new parts are found together, a join of each at a time. A map over all texts: nothing is shuffled, and a task holds
some texts at a time and the pieces of at most ``MEMO`` parts.
"""

from __future__ import annotations

import heapq
import os
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import arrow_map, without

BLANK = "▁"
_BLANK = BLANK.encode()
#: Parts up to ``MEMO_CHARS`` characters are kept, at most ``MEMO`` of them.
MEMO, MEMO_CHARS = 400_000, 48
#: Parts whose pieces are found together.
MERGED = 4096
#: Characters of the texts that are turned into one record batch, but for a longer text by itself.
BATCH_CHARS = 1 << 20
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
_NEVER = 1 << 30
_PARTS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a serialized protocol buffer message, in file order."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            n, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at:at + n], at + n
        yield key >> 3, value


class CharacterMap:
    """A compiled character map: a double-array trie whose leaves point into a block of NUL-ended replacements."""

    def __init__(self, compiled: bytes):
        if compiled:
            size = struct.unpack_from("<I", compiled)[0]
            self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
            self.written = compiled[4 + size:]
        else:
            self.units, self.written = [], b""
        first = [b for b in range(256) if self.units and self._step(self._base(0, 0), b) is not None]
        #: Where a key may begin.
        self.begin = re.compile(b"[" + b"".join(re.escape(bytes([b])) for b in first) + b"]") if first else None

    def _base(self, at: int, unit_at: int) -> int:
        unit = self.units[unit_at]
        return at ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _step(self, base: int, byte: int) -> int | None:
        at = base ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, text: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest key that ``text`` has at ``at`` (0: none), and its replacement."""
        length, value, base = 0, 0, self._base(0, 0)
        for i in range(at, len(text)):
            node = self._step(base, text[i])
            if node is None:
                break
            base = self._base(node, node)
            if self.units[node] >> 8 & 1:
                length, value = i + 1 - at, self.units[base] & 0x7FFFFFFF
        return length, self.written[value:self.written.index(b"\0", value)] if length else b""


class Normaliser:
    def __init__(self, spec: bytes = b""):
        fields = dict(_message(spec))
        self.map = CharacterMap(fields.get(2, b""))
        self.prefix, self.squeeze = bool(fields.get(3, 1)), bool(fields.get(4, 1))
        if not fields.get(5, 1):
            raise ValueError("models that do not escape blanks are not supported")

    def plain(self, text: str) -> str | None:
        """The normalised text if only blanks change; None where ``aligned`` is needed."""
        if self.map.begin is not None or self.squeeze or BLANK in text:
            return None
        text = text.replace(" ", BLANK)
        return BLANK + text if self.prefix and text else text

    def chunks(self, source: bytes) -> Iterator[tuple[int, int, bytes]]:
        """(start, end, written) of the text's chunks in order: those that pass as they are, and replaced ones."""
        at, n = 0, len(source)
        while at < n:
            found = self.map.begin.search(source, at) if self.map.begin is not None else None
            stop = found.start() if found else n
            if stop > at:
                yield at, stop, source[at:stop]
                at = stop
            if found:
                length, new = self.map.longest(source, at)
                if length:
                    yield at, at + length, new
                else:  # one whole character passes
                    length = 1
                    while at + length < n and source[at + length] & 0xC0 == 0x80:
                        length += 1
                    yield at, at + length, source[at:at + length]
                at += length

    def aligned(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the source byte where that begins."""
        source, out, origin = text.encode(), bytearray(), []
        # ``lead``: where the blanks in front end; ``blank``: blanks to come are dropped.
        lead, blank, began = 0, self.squeeze, False

        def put(piece: bytes, places: list[int]) -> None:
            for byte, place in zip(piece, places):
                if byte == 32:
                    out.extend(_BLANK)
                    origin.extend([place] * 3)
                else:
                    out.append(byte)
                    origin.append(place)

        for start, end, new in self.chunks(source):
            same = new == source[start:end]
            places = list(range(start, end)) if same else [start] * len(new)
            if self.squeeze:
                kept = []
                for i, byte in enumerate(new):
                    if byte == 32 and blank:
                        if not began and (same or new == b" "):
                            lead = places[i] + 1 if same else end
                        continue
                    began, blank = True, byte == 32
                    kept.append(i)
                new, places = bytes(new[i] for i in kept), [places[i] for i in kept]
            if new and not out and self.prefix:
                out += _BLANK
                origin += [lead] * 3
            put(new, places)
        stop = len(source) if out else 0
        while self.squeeze and out.endswith(_BLANK):  # none is left at the end
            stop = origin[-3]
            del out[-3:], origin[-3:]
        origin.append(stop)
        return out.decode(), np.array(origin, np.int64)


class Pieces(dict):
    """A byte-pair model; as a dict the ids of parts seen, packed as 32-bit numbers, made when first asked for."""

    def __init__(self, data: bytes):
        pieces, trainer, normaliser = [], {}, b""
        for number, value in _message(data):
            if number == 1:
                one = dict(_message(value))
                score = struct.unpack("<f", one[2])[0] if 2 in one else 0.0
                pieces.append((one.get(1, b"").decode(), score, one.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_message(value))
            elif number == 3:
                normaliser = value
        kinds = {k for *_, k in pieces}
        if trainer.get(3) != 2 or trainer.get(24, 0) or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("a byte-pair model with blanks in front and without user-defined pieces is needed")
        self.normaliser = Normaliser(normaliser)
        self.ids = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        self.rank = {p: -s for p, s, k in pieces if k == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        if len(self.bytes) < 256 or any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a model with all byte pieces and blanks only in front of pieces is needed")
        #: Pairs of neighbouring characters within pieces: no merge crosses the place between any other two.
        self.inside = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        # Symbols are the pieces and the characters that they are made of; pairs of symbols that make a piece, sorted.
        symbols = dict(self.ids)
        for c in sorted({c for p in self.ids for c in p} - symbols.keys()):
            symbols[c] = len(pieces) + len(symbols)
        self.many = len(pieces) + len(symbols)
        order = {x: i for i, x in enumerate(sorted(set(self.rank.values())))}
        pairs = sorted((symbols[p[:i]] * self.many + symbols[p[i:]], order[self.rank[p]], self.ids[p])
                       for p in self.ids for i in range(1, len(p)) if p[:i] in symbols and p[i:] in symbols)
        table = np.array(pairs or [(-1, 0, 0)], np.int64).T
        self.pair, self.pair_rank, self.pair_id = table[0].copy(), table[1].astype(np.int32), table[2].astype(np.int32)
        self.of_point = np.full(0x110000, -1, np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.of_point[ord(c)] = i
        value = {i: b for b, i in self.bytes.items()}
        unknown = trainer.get(44, " ⁇ ".encode()).decode()
        self.kinds = np.array([k for *_, k in pieces], np.int8)
        #: What a piece shows; of byte pieces those that are a character by themselves.
        self.shows = [p.replace(BLANK, " ") if k == NORMAL else unknown if k == UNKNOWN
                      else chr(value[i]) if k == BYTE and value[i] < 128 else "" for i, (p, _, k) in enumerate(pieces)]
        self.value = value
        #: Pieces that cannot be shown by themselves: bytes of longer characters and control pieces.
        self.apart = np.array([k == CONTROL or (k == BYTE and value[i] >= 128) for i, (*_, k) in enumerate(pieces)])
        #: Bytes of a piece in the normalised text, and in a source where only blanks were changed.
        self.size = np.array([1 if k == BYTE else len(p.encode()) for p, _, k in pieces], np.int64)
        self.source_size = self.size - 2 * np.array([p.count(BLANK) if k == NORMAL else 0 for p, _, k in pieces])

    def _packed(self, symbols: list[str]) -> bytes:
        out = array("i")
        for s in symbols:
            found = self.ids.get(s)
            out.extend([found] if found is not None else [self.bytes[b] for b in s.encode()])
        return out.tobytes()

    def merged(self, part: str) -> bytes:
        """Ids of a part, packed: the pair of the best score is joined first, of equal ones the leftmost."""
        symbols: list[str | None] = list(part)
        n, rank = len(symbols), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], i, p) for i in range(n - 1) if (p := symbols[i] + symbols[i + 1]) in rank]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            left, j = symbols[i], after[i]
            if left is None or j >= n or len(left) + len(symbols[j]) != len(pair):
                continue  # one of the two has been joined to something else
            symbols[i], symbols[j] = pair, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := pair + symbols[k]) in rank:
                    heapq.heappush(heap, (rank[p], i, p))
            if (h := before[i]) >= 0 and (p := symbols[h] + pair) in rank:
                heapq.heappush(heap, (rank[p], h, p))
        return self._packed([s for s in symbols if s is not None])

    def _looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, id) of the pieces that pairs of symbols make; the rank is ``_NEVER`` for those that make none."""
        key = np.where((left < 0) | (right < 0), -2, left.astype(np.int64) * self.many + right)
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        hit = self.pair[at] == key
        return np.where(hit, self.pair_rank[at], _NEVER), self.pair_id[at]

    def merged_many(self, parts: list[str]) -> list[bytes]:
        """``merged`` of short parts of similar length, one join of every part at a time."""
        sizes = np.array([len(p) for p in parts])
        width, n = int(sizes.max()) + 1, len(parts)
        column = np.arange(width, dtype=np.int32)
        table = np.full((n, width), -1, np.int32)  # symbols; -1: none, or past the end
        table[column < sizes[:, None]] = self.of_point[np.frombuffer("".join(parts).encode("utf-32-le"), np.int32)]
        begins = np.broadcast_to(column, (n, width)).copy()  # where a symbol begins in its part
        rank, made = self._looked_up(table[:, :-1], table[:, 1:])
        live = np.arange(n)
        while len(live):
            best = rank[live].argmin(1)
            go = rank[live, best] < _NEVER
            live, best = live[go], best[go]
            table[live, best] = made[live, best]
            # What stands behind the joined pair moves up by one.
            moved = column[:-1] + (column[:-1] >= best[:, None] + 1)
            for grid in (table, begins):
                grid[live, :-1] = np.take_along_axis(grid[live], moved, 1)
                grid[live, -1] = -1
            moved = np.minimum(moved, width - 2)
            rank[live], made[live] = np.take_along_axis(rank[live], moved, 1), np.take_along_axis(made[live], moved, 1)
            rank[live, -1] = _NEVER
            sizes[live] -= 1
            for at in (best - 1, best):
                some, place = live[at >= 0], at[at >= 0]
                inner = place < width - 1
                some, place = some[inner], place[inner]
                rank[some, place], made[some, place] = self._looked_up(table[some, place], table[some, place + 1])
        held = column < sizes[:, None]
        bare = (held & ((table < 0) | (table >= len(self.kinds)))).any(1)  # parts with a character that is no piece
        flat, ends = table[held].tobytes(), np.cumsum(sizes) * 4
        out = [flat[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]
        for i in np.flatnonzero(bare).tolist():
            cut = [*begins[i, :sizes[i]].tolist(), len(parts[i])]
            out[i] = self._packed([parts[i][a:b] for a, b in zip(cut, cut[1:])])
        return out

    def _cut(self, part: str) -> list[str]:
        """Sub-parts between which no merge is possible."""
        inside = self.inside
        cuts = [i for i, pair in enumerate(map(add, part, part[1:]), 1) if pair not in inside]
        return [part[a:b] for a, b in zip([0, *cuts], [*cuts, len(part)])] if cuts else [part]

    def learn(self, parts: Iterable[str]) -> None:
        """Keep the ids of short parts, found together."""
        if len(self) > MEMO:
            self.clear()
        new = sorted({p for p in parts if p not in self and len(p) <= MEMO_CHARS}, key=len)
        for at in range(0, len(new), MERGED):
            some = new[at:at + MERGED]
            self.update(zip(some, self.merged_many(some)))

    def __missing__(self, part: str) -> bytes:
        cut = self._cut(part)
        return b"".join(map(self.__getitem__, cut)) if len(cut) > 1 else self.merged(part)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text the ids, and where each piece begins and ends in the text's UTF-8 bytes."""
        plain = [self.normaliser.plain(t) for t in texts]
        origins = [None if p is not None else self.normaliser.aligned(t) for t, p in zip(texts, plain)]
        parts = [_PARTS.findall(p if o is None else o[0]) for p, o in zip(plain, origins)]
        self.learn(chain.from_iterable(parts))
        return [self._spans(np.frombuffer(b"".join(map(self.__getitem__, ps)), np.int32), o) for ps, o in zip(parts, origins)]

    def _spans(self, ids: np.ndarray, aligned: tuple[str, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if aligned is None:  # a blank is one byte of the source; the one put in front is none
            ends = np.cumsum(self.source_size[ids]) - (1 if self.normaliser.prefix else 0)
            return ids, np.concatenate([[0], ends[:-1]])[:len(ids)], ends
        ends = np.cumsum(self.size[ids])
        return ids, aligned[1][np.concatenate([[0], ends[:-1]])[:len(ids)]], aligned[1][ends]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``: blanks for their sign, without that of the front; a byte that ends no character is U+FFFD."""
        if not len(ids):
            return ""
        strip = self.normaliser.prefix or self.normaliser.squeeze
        if not self.apart[ids].any():
            text = "".join(map(self.shows.__getitem__, ids.tolist()))
            return text[1:] if strip and self.kinds[ids[0]] == NORMAL and text.startswith(" ") else text
        out, run, dropped = [], bytearray(), False
        for i in [*ids.tolist(), None]:
            if i in self.value:
                run.append(self.value[i])
                continue
            if run:
                out.append(_characters(bytes(run)))
                run = bytearray()
            if i is None:
                break
            shown = self.shows[i]
            if strip and self.kinds[i] == NORMAL and not dropped and not any(out) and shown.startswith(" "):
                shown, dropped = shown[1:], not self.normaliser.squeeze
            out.append(shown)
        return "".join(out)


def _characters(run: bytes) -> str:
    out = ""
    while run:
        try:
            return out + run.decode()
        except UnicodeDecodeError as e:
            out, run = out + run[:e.start].decode() + "�", run[e.start + 1:]
    return out


def load_model(path: str) -> Pieces:
    """The model of a file, or of a file's name that the package of public tokenizers knows."""
    if not os.path.isabs(path):
        import public_tokenizers
        path = public_tokenizers.path(path)
    with open(path, "rb") as f:
        return Pieces(f.read())


def _some(column, most: int = BATCH_CHARS) -> Iterator[list]:
    """The values of an Arrow column, as many at once as hold some ``most`` characters."""
    held, size = [], 0
    for at in range(0, len(column), 64):
        for value in column.slice(at, 64).to_pylist():
            held.append(value)
            size += len(value)
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def encode_pieces(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids``, ``begins`` and ``ends`` (arrays of int) in place of the text.

    ``begins`` and ``ends`` are byte offsets into the UTF-8 text. Begin and
    end ids are not added. A null or empty text has empty arrays; a very long
    text is encoded whole, by itself; repeated rows are encoded each; an empty
    table gives an empty result. Columns of ``df`` with these names are
    replaced.
    """
    added = ["ids", "begins", "ends"]
    df = without(df, added, keep=(text,))
    kept = [c for c in df.columns if c != text]

    def encode(batches):
        import pyarrow as pa

        model = load_model(model_path)
        for batch in batches:
            at, others = 0, batch.columns[:-1]
            for texts in _some(batch.column(batch.num_columns - 1)):
                found = model.encode(texts)
                offsets = pa.array(np.cumsum([0, *[len(f[0]) for f in found]]), pa.int32())
                arrays = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x).astype(np.int32))) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays([*[c.slice(at, len(texts)) for c in others], *arrays],
                                                 names=[*batch.schema.names[:-1], *added])
                at += len(texts)

    return arrow_map(df, kept, F.coalesce(F.col(text), F.lit("")), encode, **{c: "array<int>" for c in added})


def decode_pieces(df: DataFrame, model_path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text of the array ``ids`` in the column ``name``, in place of the ids.

    A null array is an empty one; an id that the model does not have is an
    error. Rows, empty tables and clashing names as in ``encode_pieces``.
    """
    df = without(df, [name], keep=(ids,))
    kept = [c for c in df.columns if c != ids]

    def decode(batches):
        import pyarrow as pa

        model = load_model(model_path)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            for begin in range(0, len(lists), 64):
                some = lists.slice(begin, 64)
                texts = [model.decode(x.values.to_numpy(zero_copy_only=False)) for x in some]
                yield pa.RecordBatch.from_arrays([*[c.slice(begin, 64) for c in batch.columns[:-1]], pa.array(texts, pa.string())],
                                                 names=[*batch.schema.names[:-1], name])

    none = F.array().cast("array<int>")
    return arrow_map(df, kept, F.coalesce(F.col(ids).cast("array<int>"), none), decode, **{name: "string"})


def listed(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.concat_ws(",", ids.cast("array<string>"))

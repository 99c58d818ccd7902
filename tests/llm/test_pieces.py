from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tideline.llm.pieces import Normaliser, _message, decode_pieces, encode_pieces, load_model

NAME = "piece_bpe_32k.model"
BITS = ["the", " and", "  ", "\n\n", "\t", "é", "日本語", "😀", "🧿", "12 345", "!!!", "a" * 90, " " * 70, "▁", "▁▁x", " ", "\x1c", "<s>", "</s>",
        "<0x41>", "<unk>", " ⁇ ", "\x00", "ก", "é", "ﬁ", "½", "　"]


@pytest.fixture(scope="module")
def model():
    return load_model(NAME)


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(NAME))


def made_up(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_texts_and_spans_equal_the_library(model, library):
    for text in ["", " ", *made_up(500), "ab" * 30_000, "日本" * 5_000, "á" * 3_000]:
        ids, begins, ends = model.encode([text])[0]
        assert ids.tolist() == library.encode(text)
        assert model.decode(ids) == library.decode(ids.tolist())
        if not text:
            continue
        # Spans join without a gap and cover the text.
        assert begins[0] == 0 and ends[-1] == len(text.encode()) and (begins[1:] == ends[:-1]).all()
        if len(text) < 5000:
            theirs = library.encode(text, return_type="proto").pieces
            for (a, b), piece in zip(zip(begins, ends), theirs):
                # The library gives all bytes of a character without a piece to the last of its byte pieces.
                if not (piece.piece.startswith("<0x") and (piece.begin, piece.end) != (a, b)):
                    assert (a, b) == (piece.begin, piece.end), (text, piece)


def test_spans_show_the_pieces(model):
    for text in made_up(200, 4):
        source = text.encode()
        for i, a, b in zip(*model.encode([text])[0]):
            if i not in model.value:
                assert source[a:b].decode().replace("▁", " ") == (model.shows[i] if a or source[:1] in b" \xe2" and b - a == len(model.shows[i])
                                                                 else model.shows[i][len(model.shows[i]) - len(source[a:b].decode()):])


def test_any_ids_decode_as_in_the_library(model, library):
    rng = random.Random(8)
    p = library.piece_to_id
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(200, 259), rng.randrange(259, 32000), p("▁"), p("▁▁"), p("▁a")])
               for _ in range(rng.randint(0, 7))]
        assert model.decode(np.array(ids, np.int32)) == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_character_maps_equal_the_library(rule):
    """Longest prefixes through compiled maps, with the source of every character."""
    import sentencepiece
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    ours = Normaliser(dict(_message(library.serialized_model_proto()))[3])
    rng = random.Random(5)
    bits = ["ﬁ", "½", " ", "  ", "　", "é", "É", "日", "ｶﾞ", "a", "B", " ", "①", "\t", "\n", "​", "😀", "Å", "x", "한", "한", "㍿",
            "﻿", "¨", "̀", "▁"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        norm, origin = ours.aligned(text)
        source, places, at = text.encode(), [], 0
        for c in [*norm, ""]:
            places.append(len(source[:origin[at]].decode()))
            at += len(c.encode())
        assert (norm, places) == tuple(library.normalize(text, with_offsets=True)), text


def test_edge_rows(spark, library):
    rows = [(1, None), (2, ""), (3, "a <s> b"), (3, "a <s> b"), (None, "word  " * 9000), (5, "x\ty")]
    df = spark.createDataFrame(rows, "id long, text string")
    coded = encode_pieces(df, NAME)
    assert coded.columns == ["id", "ids", "begins", "ends"]
    got = sorted(((r.id, r.ids) for r in coded.collect()), key=str)
    assert got == sorted(((i, library.encode(t or "")) for i, t in rows), key=str)
    texts = decode_pieces(coded.select("id", "ids"), NAME).collect()
    assert sorted(map(tuple, texts), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert encode_pieces(df.limit(0), NAME).collect() == [] and decode_pieces(coded.limit(0), NAME).collect() == []
    clash = encode_pieces(df.selectExpr("id `a.b`", "'x' IDS", "text", "1 __x", "2 Ends"), NAME)
    assert clash.columns == ["a.b", "__x", "ids", "begins", "ends"] and len(clash.collect()) == 6
    nulls = decode_pieces(spark.createDataFrame([(1, None)], "id int, ids array<int>").selectExpr("id", "ids", "3 Decoded"), NAME)
    assert nulls.columns == ["id", "decoded"] and nulls.collect()[0].decoded == ""


def test_query_against_library(spark, library):
    from conftest import SF001

    from tideline.llm.queries import op11_pieces
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = op11_pieces(spark, SF001).collect()
    assert len(rows) == len(texts)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.n_bytes) == (
            len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)), len(texts[r.doc_id].encode()))

from __future__ import annotations

import random

import pytest

from tideline.llm.token_counts import Counter, count_tokens, load_tokenizer, spliced_count

NAME = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def tokenizer():
    return load_tokenizer(NAME)


def whole(tokenizer, text):
    return len(tokenizer.encode(text, add_special_tokens=False))


def test_splices_equal_whole_encoding(tokenizer):
    rng = random.Random(5)
    parts = ["the", " and", "  ", "\n\n\n", "   x", "don't", "<|endoftext|>", "<|endof", "text|>", "é", "日本語", "😀", "12 345", "!!!",
             "a" * 90, " " * 70, "'re", "\t\t ", "x" * 300, " ", " ", "\u00a0", "\x1c", "\x85 "]
    for _ in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 160)))
        for chunk, overlap in ((64, 8), (100, 40), (257, 3)):
            assert spliced_count(tokenizer, text, chunk, overlap) == whole(tokenizer, text)
        assert Counter(tokenizer).counts([text, "", text + " x"]) == [whole(tokenizer, t) for t in (text, "", text + " x")]


def test_other_tokenizers_count_whole_texts():
    tokenizer = load_tokenizer("word_bpe_49k.json")
    counter = Counter(tokenizer)
    assert not counter.by_part and counter.counts(["Ab  cd", "x"]) == [whole(tokenizer, t) for t in ("Ab  cd", "x")]


def test_endless_word_widens(tokenizer):
    text = "start " + "ab" * 3000 + " end"
    assert spliced_count(tokenizer, text, 128, 16) == whole(tokenizer, text)


def test_operator_edge_rows(spark, tokenizer):
    rows = [(1, None), (2, ""), (3, "a<|endoftext|>b"), (3, "a<|endoftext|>b"), (None, "word " * 9000), (5, "x")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = sorted(count_tokens(df, NAME, chunk_chars=500).collect(), key=str)
    want = sorted([(i, whole(tokenizer, t or "")) for i, t in rows], key=str)
    assert [str(tuple(r)) for r in got] == [str(w) for w in want]
    assert count_tokens(df.limit(0), NAME).collect() == []
    clash = count_tokens(df.selectExpr("id", "'x' N_Tokens", "text", "1 __x"), NAME)
    assert clash.columns == ["id", "__x", "n_tokens"] and clash.collect()[0].n_tokens == 0


def test_query_against_library(spark, tokenizer):
    from conftest import SF001

    from tideline.llm.queries import op10_token_counts
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = op10_token_counts(spark, SF001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = whole(tokenizer, texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)

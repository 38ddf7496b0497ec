import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradeloom.llm.tokens import count, ends_piece, encoder, op4_token_counts, token_counts

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole():
    loaded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: len(loaded.encode(text, add_special_tokens=False))


def texts():
    rng = random.Random(4)
    parts = ["the ", "étion", "don't", "  ", "\n\n", "123", "4", "!!!", "<|endoftext|>", "世界", "。", " ", "x" * 40, "'s", "🙂", "\t"]
    for size in (0, 1, 5, 60, 400, 1500):
        for _ in range(4):
            yield "".join(rng.choice(parts) for _ in range(size))
    yield "a" * 3000
    yield " " * 3000
    yield "世" * 2000
    yield "<|endoftext|>" * 300


@pytest.mark.parametrize("chunk, overlap", [(64, 48), (100, 40), (700, 64)])
@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json"])
def test_spliced_chunks_equal_whole_texts(whole, chunk, overlap, vocabulary):
    encode = encoder(vocabulary)
    for text in texts():
        assert count(text, encode, chunk, overlap) == whole(text), text[:80]


def test_sure_ends_of_pieces():
    assert ends_piece("a", " ") and ends_piece("a", ".") and ends_piece("1", "a") and ends_piece(".", "\n")
    assert not ends_piece(" ", "a") and not ends_piece("'", "s") and not ends_piece("a", "b")


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json"])
def test_separators_that_are_no_white_space(whole, vocabulary):
    assert not any(ends_piece("!", c) for c in "\x1c\x1d\x1e\x1f") and ends_piece("\x1f", " ")
    encode, rng = encoder(vocabulary), random.Random(6)
    parts = ["!", "!!", "=", "==", "--", ".", "\x1c", "\x1d", "\x1e", "\x1f"]
    for size in (300, 1500):
        for _ in range(10):
            text = "a " + "".join(rng.choice(parts) for _ in range(size)) + " b"
            assert count(text, encode, 64, 48) == whole(text), text[:80]


def test_query_equals_the_library(spark, whole):
    rows = op4_token_counts(spark, SMALL).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), whole(text))
        assert r.over_limit == (r.n_tokens > 512)


def test_null_empty_and_repeated_rows(spark, whole):
    long = "word éa 12 " * 9000
    frame = spark.createDataFrame([(1, None), (1, ""), (None, long), (2, long)], "doc_id long, text string")
    got = frame.select("doc_id", token_counts(frame.text).alias("c")).select("doc_id", "c.*").collect()
    assert [(r.n_bytes, r.n_tokens) for r in got] == [(0, 0), (0, 0)] + [(len(long.encode()), whole(long))] * 2
    assert frame.limit(0).select(token_counts(frame.text)).collect() == []

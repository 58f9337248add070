import random

import llm_brute as brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from millrace.llm import bpe, queries

PATH = public_tokenizers.path(queries.RANKS)


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def own(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_against_tiktoken(ranks, own, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 300)
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    rng = random.Random(1)
    alphabets = [["a", "e", " ", "\x1c", "\n", "\t", "é", "日", "𝒳", "1", "'s", "the", "　", "\x85", "s"], list("abtheo"), list(" \n")]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 200))) for a in alphabets for _ in range(150)]
    texts += ["a" * 5000, "ab" * 3000, "thethe" * 2000, "<|endoftext|>", ""]
    for text in texts:
        packed = codec.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == own.encode_ordinary(text)
        assert codec.decode(packed) == text.encode()
    with pytest.raises(ValueError):
        codec.decode(np.array([10**6], "<u4").tobytes())


def test_a_whole_document_as_one_piece_is_not_quadratic(ranks, own):
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    text = "abcdefghij" * 10_000
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == own.encode_ordinary(text)


def test_columns(spark):
    tokenizer = bpe.Tokenizer(spark, PATH, public_tokenizers.PATTERN)
    rows = [(1, "a b", "x"), (2, None, "x"), (3, "", "x"), (1, "a b", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.round_trip(df, tokenizer).collect()
    assert sorted((r.doc_id, bytes(r.decoded)) for r in got) == [(1, b"a b"), (1, b"a b"), (2, b""), (3, b"")]
    assert df.where("doc_id = 3").select(tokenizer.ids(tokenizer.encode(df.text))).first()[0] == []
    assert bpe.round_trip(df.where("false"), tokenizer).collect() == []


def test_query_over_whole_tables(spark, own):
    rows = {r.doc_id: r for r in queries.QUERIES["op1_bpe"](spark, brute.SF).collect()}
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = own.encode_ordinary(d.text or "")
        packed = np.array(ids, "<u4").tobytes()
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(packed), brute.sha(d.text or ""))

import random

import llm_brute as brute
import pytest

from millrace.llm import contamination, queries


def texts(seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["Aa", "b", "c,", "d-e", "É", "é"]) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("block_words", [200_000, 40])
def test_against_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(contamination, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(contamination.W, "SLICE_BYTES", 500)
    docs = [*enumerate(texts(1, 60)), (60, None), (61, ""), (62, "aa b " * 3000)]
    items = [*enumerate(texts(2, 25)), (25, None), (26, "aa"), (None, "b c"), (28, "..."), (3, "d e")]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_words int").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = contamination.decontaminate(d, b, 4).collect()
    want = brute.leaks(docs, items, 4)
    assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in rows} == want
    for r in rows:
        assert sum(s.end - s.begin for s in r.stretches) == r.n_hit


def test_proximity(spark):
    docs = [(1, "x a y b z c w"), (2, "c b a"), (3, "a b"), (4, "a q q q q q b c"), (5, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    b = spark.createDataFrame([(7, "A b C"), (8, None)], "item_id long, text string")
    got = {tuple(r) for r in contamination.proximity(d, b, 5).collect()}
    assert got == {(1, 7, 1, 6), (2, 7, 0, 3)}


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert contamination.decontaminate(d.where("false"), b).collect() == []
    assert [r.n_hit for r in contamination.decontaminate(d, b.where("false")).collect()] == [0]
    assert contamination.proximity(d, b.where("false"), 3).collect() == []


def test_query_over_whole_tables(spark):
    rows = queries.QUERIES["op4_decontaminate"](spark, brute.SF).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{brute.SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{brute.SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute.leaks(docs, items, 10)
    assert len(rows) == len(docs) and any(r.contaminated for r in rows)
    for r in rows:
        n, hit, named = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            n, hit, len(named), brute.sha(",".join(named)), hit > 0
        )

import random

import llm_brute as brute
import pytest

from millrace.llm import queries, substrings


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, kept string").repartition(3)


@pytest.mark.parametrize("length", [1, 2, 3, 5, 9, 35, 70])
def test_against_brute_force(spark, monkeypatch, length):
    monkeypatch.setattr(substrings.W, "SLICE_BYTES", 2000)
    monkeypatch.setattr(substrings, "LONGEST_FIRST", 16)
    rng = random.Random(length)
    passages = [[rng.choice("abcdefghij") + str(rng.randint(0, 30)) for _ in range(length + rng.randint(0, 40))] for _ in range(4)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages)[rng.randint(0, 3) :] if rng.random() < 0.5 else [
                rng.choice("kl\xa0mé") + str(rng.randint(0, 10 ** 6)) for _ in range(rng.randint(1, 50))
            ]
        docs.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    docs += [(60, docs[3][1]), (61, docs[3][1]), (62, None), (63, ""), (64, " \t"), (65, "z " * 500), (66, "q" * 9000)]
    got = {r.doc_id: (r.n_words, r.n_removed, brute.sha(r.kept)) for r in substrings.remove_repeats(frame(spark, docs), length).collect()}
    assert got == brute.repeats(docs, length)


def test_same_rows_and_empty(spark):
    text = " ".join(map(str, range(40)))
    got = substrings.remove_repeats(frame(spark, [(1, text), (1, text), (None, "a"), (None, text + " z")])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (0, 40), (1, 40), (1, 40)]
    assert substrings.remove_repeats(frame(spark, [(1, "a")]).where("false")).collect() == []


def test_query_over_whole_tables(spark):
    rows = queries.QUERIES["op3_substrings"](spark, brute.SF).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{brute.SF}/documents.parquet").select("doc_id", "text").collect()]
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == brute.repeats(docs, 35)
    assert any(r.n_removed for r in rows)

import random
import re

import llm_brute as brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, rules


def plain(text):
    words = brute.SPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if brute.SPACE.search(x)]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    inside = {p for k, w in enumerate(windows) if windows.count(w) > 1 for p in range(k, k + 5)}
    count = lambda pattern: len(re.findall(pattern, text or ""))
    return (len(words), sum(map(len, words)), count(r"[#*$%&|<>]"), len(lines) - len(set(lines)), len(inside),
            len(lines), len(set(words)), count("[0-9]"), count("[A-Z]"))


def awkward(seed):
    rng = random.Random(seed)
    pool = ["a", "b", "é#", "Ω|", "\xa0", "x\x85y", "9%", "Zz", " ", "<b>"]
    texts = [None, "", " \n\t", "one", "a\n a\na \n\n\n", "a b c d e\n" * 3, "\x0b\x0c\n\x0b\x0c", "w " * 400]
    for _ in range(60):
        texts.append("".join(rng.choice(pool) + rng.choice([" ", "\n", "  ", "\r\n", "\t"]) for _ in range(rng.randint(1, 60))))
    return texts


@pytest.mark.parametrize("piece", [7, 40, 1 << 20])
def test_counts_against_definition(monkeypatch, piece):
    monkeypatch.setattr(rules, "PIECE", piece)
    texts = awkward(piece)
    got = rules.counts(pa.array(texts, pa.string()))
    assert [tuple(r) for r in got.tolist()] == [plain(t) for t in texts]


def test_very_long_texts():
    line = "one two three\n"
    texts = [line * 300_000, "q" * 6_000_000, ("q" * 2_000_000 + " ") * 12, "z"]
    got = rules.counts(pa.array(texts)).tolist()
    assert got[0][:7] == [900_000, 3_300_000, 0, 299_999, 900_000, 300_000, 3]
    assert got[1][:7] == [1, 6_000_000, 0, 0, 0, 1, 1] and got[3][:2] == [1, 1]
    assert got[2][:7] == [12, 24_000_000, 0, 0, 12, 1, 1]


def test_learned_list_is_an_ordered_conditional(spark):
    rng = np.random.default_rng(4)
    x = rng.random((600, 3))
    bad = (x[:, 0] > 0.8) | ((x[:, 1] < 0.2) & (x[:, 2] > 0.5))
    names = ["a", "b", "c"]
    found = rules.cover(x, bad, np.arange(600) % 3 == 0, names)
    first = np.zeros(600, int)
    for number, rule in reversed(list(enumerate(found.rules, 1))):
        first[rule.holds(x, names)] = number
    assert ((first > 0) == bad).mean() > 0.97 and 2 <= len(found.rules) <= 6
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i long, a double, b double, c double")
    got = rows.select("i", found.decided_by({n: F.col(n) for n in names}).alias("rule")).orderBy("i").collect()
    assert [r.rule for r in got] == first.tolist()
    assert str(found).startswith("CASE\nWHEN ") and str(found).endswith("ELSE keep END")


def test_noise_gives_no_rules():
    rng = np.random.default_rng(5)
    found = rules.cover(rng.random((400, 4)), rng.random(400) < 0.3, np.arange(400) % 3 == 0, list("abcd"))
    assert found.rules == []


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "y"), (None, None, "z")], "doc_id long, text string, n_words string")
    labels = spark.createDataFrame([(1, 0), (1, None), (None, 1)], "doc_id long, quality int")
    for some in (labels, labels.where("false")):
        learned = rules.fit(docs, some)
        assert learned.rules == []
        stats = docs.select(rules.statistics(F.col("text")).alias("s"), "n_words")
        got = stats.select(learned.decided_by(rules.features(F.col("s"))).alias("r"), "s.n_words").collect()
        assert sorted(map(tuple, got)) == [(0, 0), (0, 2), (0, 2)]
    assert docs.where("false").select(rules.statistics(F.col("text"))).collect() == []


def test_query_against_brute_force(spark):
    """Base columns by definition; the verdict by the learned list, recomputed; what it learnt holds on held-out rows."""
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.QUERIES["op13_rules"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == docs.count()
    for doc_id, text in docs.collect():
        if doc_id % 7 == 0 or len(text) < 400:
            r, want = rows[doc_id], plain(text)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[:5]
    for r in rows.values():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule == 0)
    good = [rows[i].kept for i, q in quality.items() if q == 1 and rows[i].held_out]
    bad = [rows[i].kept for i, q in quality.items() if q == 0 and rows[i].held_out]
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.3

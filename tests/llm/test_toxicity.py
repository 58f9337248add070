import random
from itertools import combinations

import llm_brute as brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, toxicity


def kernel(a, b):
    total = 0.0
    for i in combinations(range(len(a)), 3):
        for j in combinations(range(len(b)), 3):
            if [a[k] for k in i] == [b[k] for k in j]:
                total += toxicity.DECAY ** (i[2] - i[0] + 1 + j[2] - j[0] + 1)
    return total


def test_kernel_against_definition():
    rng = random.Random(3)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(3, 8))) for _ in range(40)]
    marks = ["abca", "ccab", "abcabc"]
    got = toxicity.Landmarks(marks).values(words)
    for w, row in zip(words, got):
        for m, value in zip(marks, row):
            want = kernel(w, m) / np.sqrt(kernel(w, w) * kernel(m, m))
            assert value == pytest.approx(want if want >= toxicity.FLOOR else 0, abs=1e-5)


def test_inserted_and_gapped_letters():
    texts = ["you idiot", "id-i-ot!", "i d i o t here", "an idxiot", "IDIOT", "lovely day", "", None, "z" * 5000]
    best = toxicity.Matcher(toxicity.Landmarks(["idiot"])).matches(pa.array(texts))[:, 0]
    assert (best[:5] > 0.55).all() and (best[5:] == 0).all()


def test_words_in_bulk_match_like_words_alone():
    """Plain words, odd spellings and long runs: learnt together they get what each form alone gets."""
    rng = random.Random(9)
    marks = toxicity.Landmarks(["abcde", "ñandú", "cab9"])
    words = ["".join(rng.choice("abcde9ñúÑ.,-'“–") for _ in range(rng.randint(1, 30))) for _ in range(400)]
    got = toxicity.Matcher(marks).matches(pa.array(words))
    for w, row in zip(words, got):
        forms = toxicity.forms(w)
        want = marks.values(forms).max(axis=0) if forms else np.zeros(3)
        assert row == pytest.approx(want, abs=1e-5), w


def sample(rng, hot):
    words = ["".join(rng.choice("bdelnorstu") for _ in range(rng.randint(3, 8))) for _ in range(rng.randint(3, 60))]
    if hot:
        words[rng.randrange(len(words))] = rng.choice(["vaxfyq", "vax-fyq", "vaxkfyq", "gwizzpo", "gwiz.zpo"])
    return " ".join(words)


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(1)
    docs = [(i, sample(rng, i % 4 == 0), "x") for i in range(800)] + [(None, "a", "x"), (900, None, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(600)] + [(None, 1), (601, None), (5, 0)], "doc_id long, toxic int"
    )
    return df, labels, toxicity.fit(df, labels)


def test_held_out_accuracy(learned):
    df, _, model = learned
    rows = df.where("doc_id >= 600 and doc_id < 800").select("doc_id", model.score(df.text).alias("p")).collect()
    right = sum((r.p >= 0.5) == (r.doc_id % 4 == 0) for r in rows)
    assert right / len(rows) > 0.95


def test_defined_cases(spark, learned):
    df, labels, model = learned
    rows = {r.doc_id: r.p for r in df.where("doc_id is null or doc_id = 900").select("doc_id", model.score(df.text).alias("p")).collect()}
    assert rows[900] == rows[None] < 0.5
    assert df.where("false").select(model.score(df.text)).collect() == []
    for some, share in ((labels.where("false"), 0.0), (labels.where("toxic = 1"), 1.0)):
        constant = toxicity.fit(df, some)
        got = [r[0] for r in df.limit(3).select(constant.score(df.text)).collect()]
        assert got == pytest.approx([share] * 3, abs=1e-6)


def test_query_over_whole_tables(spark):
    rows = queries.QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    seen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in seen) / len(seen) > 0.9
    caught = [r.predicted for r in rows if labels.get(r.doc_id) == 1]
    assert sum(caught) / len(caught) > 0.65


def test_held_out_recall_by_language(spark):
    """The registered query on the larger sample: toxic texts that were never seen are found, clean ones are left alone.

    Six of the 97 hold none of the words that mark toxic texts elsewhere, so no more than 0.94 can be found.
    """
    folder = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op5_toxicity"](spark, folder).where("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    lang = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = {(r.lang, r.toxic): (r.hits, r.n) for r in rows.join(labels, "doc_id").join(lang, "doc_id").groupBy("lang", "toxic").agg(
        F.sum("predicted").alias("hits"), F.count("*").alias("n")).collect()}
    total = {y: [sum(v[k] for (_, t), v in found.items() if t == y) for k in (0, 1)] for y in (0, 1)}
    assert total[1][0] >= 0.85 * total[1][1] and total[0][0] <= 0.01 * total[0][1]
    assert all(found[lang, 1][0] >= 0.75 * found[lang, 1][1] for lang in ("en", "de", "fr"))


def test_chance_decides_how_many_words_are_taken():
    assert toxicity._beyond_chance([80.0, 40.0, 2.0], 10_000) == 2
    assert toxicity._beyond_chance([3.0] * 50, 10_000) == 0 == toxicity._beyond_chance([], 10)


def test_rows_of_one_id_are_one_sample(spark, learned):
    df, labels, model = learned
    many = df.unionByName(df.where("doc_id = 3").crossJoin(spark.range(200)).drop("id"))
    again = toxicity.fit(many, labels)
    assert again.landmarks == model.landmarks and again.weights == pytest.approx(model.weights)

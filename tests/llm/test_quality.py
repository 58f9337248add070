import math
import random

import llm_brute as brute
import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import quality, queries
from millrace.llm import words as W


def sample(rng, grade):
    plain = ["".join(rng.choice("bdelnorstu") for _ in range(rng.randint(3, 8))) for _ in range(rng.randint(20, 80))]
    if grade == 0:
        plain = [w.upper() + "!!" for w in plain]
    if grade == 1:
        plain = [rng.choice([w, w.upper() + "!!"]) for w in plain]
    return " ".join(plain)


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(1)
    docs = [(i, sample(rng, i % 3), 0) for i in range(600)] + [(600, None, 0), (601, "", 0), (None, "x", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, grade int")
    ratings = spark.createDataFrame([(i, i % 3) for i in range(400)] + [(None, 1), (500, None), (3, 0)], "doc_id long, grade int")
    return df, ratings, quality.fit(df, ratings, 3)


def test_held_out_grades(spark, learned):
    df, _, model = learned
    assert (np.diff(model.thresholds) > 0).all()
    rows = df.where("doc_id >= 400 and doc_id < 600").select("doc_id", model.tails(df.text).alias("t"))
    rows = rows.select("doc_id", "t", quality.expected_grade("t").alias("e")).collect()
    assert sum(round(r.e) == r.doc_id % 3 for r in rows) / len(rows) > 0.9
    for r in rows:
        assert 1 >= r.t[0] >= r.t[1] >= 0 and r.e == pytest.approx(sum(r.t))


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    rows = np.repeat(np.arange(40), 5)
    feature, value, grade = rng.integers(0, 30, 200), rng.random(200), rng.integers(0, 4, 40)

    def loss(m):
        q = np.bincount(rows, m.weights[feature] * value, 40)
        t = np.hstack([np.ones((40, 1)), m.at_least(q), np.zeros((40, 1))])
        return -np.log(t[np.arange(40), grade] - t[np.arange(40), grade + 1]).mean()

    short, long = (quality.train(rows, feature, value, grade, 4, penalty=0, steps=s) for s in (1, 300))
    assert loss(long) < loss(short) - 0.1


def test_features_do_not_depend_on_the_batch():
    texts = ["a B c9 é", None, "", "x x x", "### $$"]
    whole = quality.features(pa.array(texts))
    for i, t in enumerate(texts):
        one = quality.features(pa.array([t], pa.string()))
        own = whole[0] == i
        assert sorted(zip(whole[1][own], whole[2][own])) == sorted(zip(one[1], one[2]))


def test_defined_cases(spark, learned):
    df, ratings, model = learned
    rows = {r.doc_id: r.t for r in df.where("doc_id >= 600").select("doc_id", model.tails(df.text).alias("t")).collect()}
    assert rows[600] == rows[601]
    assert df.where("false").select(model.tails(df.text)).collect() == []
    for some, want in ((ratings.where("false"), 0), (ratings.where("grade = 2"), 2)):
        constant = quality.fit(df, some, 3)
        got = df.limit(2).select(quality.expected_grade(constant.tails(df.text))).collect()
        assert [round(r[0]) for r in got] == [want, want]


def test_query_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.QUERIES["op10_quality"](spark, folder).collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert len(rows) == 1000
    assert sum(rows[r.doc_id].keep == (r.quality == 1) for r in labels) / len(labels) > 0.9


def plain_latent(text, weights):
    """The definition, word by word."""
    words = [w.encode() for w in brute.SPACE.findall(text or "")]
    of = lambda w: int(W.find(pa.array([w], pa.binary()).cast(pa.string())).hash[0])
    kind = lambda b: (
        0 if 97 <= b <= 122 else 1 if 65 <= b <= 90 else 2 if 48 <= b <= 57 else 3 if b >= 128 else 4 if b in b",." else 5
    )
    cells = {of(w) >> (64 - quality.WORD_BITS) for w in words}
    total = sum(weights[c] for c in sorted(cells)) / math.sqrt(len(cells)) if cells else 0.0
    base = 1 << quality.WORD_BITS
    for w in words:
        shape = (kind(w[0]) * quality.KINDS + kind(w[-1])) * quality.LENGTHS + min(len(w).bit_length() - 1, quality.LENGTHS - 1)
        total += weights[base + shape] / len(words)
    base += quality.KINDS**2 * quality.LENGTHS
    varied = math.ceil(len(cells) / len(words) * (quality.BINS - 1)) if words else 0
    total += 0.5 * weights[base + varied]
    return total + 0.5 * weights[base + quality.BINS + min((len(words) + 1).bit_length() - 1, quality.BINS - 1)]


def test_query_against_plain_version(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op10_quality"](spark, brute.SF).collect()}
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    labels = spark.read.parquet(f"{brute.SF}/labels.parquet").where("crc32(cast(cast(doc_id AS string) AS binary)) % 5 <> 0")
    graded = labels.selectExpr("doc_id", "CASE WHEN quality = 0 THEN 0 ELSE 2 - toxic END AS grade")
    model = quality.fit(docs, graded, grades=3)
    weights = model.weights.astype(float)
    for doc_id, text in docs.select("doc_id", "text").collect():
        tails = [1 / (1 + math.exp(-(plain_latent(text, weights) - t))) for t in model.thresholds]
        assert rows[doc_id].expected_grade == pytest.approx(sum(tails), abs=1e-4)
        assert rows[doc_id].tail_probability == pytest.approx(tails[0], abs=1e-4)


def test_rows_of_one_id_are_one_sample(spark, learned):
    df, ratings, model = learned
    again = quality.fit(df.unionByName(df.where("doc_id = 3").crossJoin(spark.range(300)).drop("id")), ratings, 3)
    assert np.allclose(again.weights, model.weights, atol=1e-4)

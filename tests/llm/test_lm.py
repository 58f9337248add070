import math
import random
from collections import Counter

import llm_brute as brute
import pytest

from millrace.llm import lm, queries


def plain(docs, wanted, size):
    """Losses by dictionaries of words; only for texts whose words all get a number."""
    words = {i: brute.SPACE.findall(t or "") for i, t in docs}
    everywhere = Counter(w for ws in words.values() for w in ws)
    slots = 1 + lm.CLASSES + len(everywhere)
    total = sum(everywhere.values()) + 0.5 * slots

    def model(ids):
        pairs, first, single = Counter(), Counter(), Counter()
        for i in ids:
            for a, b in zip(["", *words[i]], words[i]):
                pairs[a, b] += 1
                first[a] += 1
                single[b] += 1
        n = sum(single.values())
        word = {w: (single[w] + lm.WORD_PULL * (everywhere[w] + 0.5) / total) / (n + lm.WORD_PULL) for w in everywhere}
        return lambda a, b: -math.log((pairs[a, b] + lm.BIGRAM_PULL * word[b]) / (first[a] + lm.BIGRAM_PULL))

    models = model(wanted), model(words)
    return {
        i: [sum(m(a, b) for a, b in zip(["", *ws], ws)) / len(ws) if ws else None for m in models]
        for i, ws in words.items()
    }


def test_against_brute_force(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice("abcdefgh" if i % 3 else "defghijk") * 2 for _ in range(rng.randint(0, 50)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, docs[0][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_tokens int").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)] + [(3, 0), (None, 1)], "doc_id long, quality int")
    models = lm.fit(df, labels)
    want = plain(docs, [i for i in range(40) if i % 3 == 0], models.words.size)
    rows = lm.score(df, models).collect()
    assert len(rows) == len(docs)
    for r in rows:
        t, b = want[r.doc_id]
        if t is None:
            assert r.n_tokens == 0 and r.target_loss is None and r.difference is None
        else:
            assert (r.target_loss, r.background_loss) == (pytest.approx(t, rel=1e-4), pytest.approx(b, rel=1e-4))
            assert r.difference == pytest.approx(t - b, abs=1e-3)
    assert lm.score(df.where("false"), lm.fit(df.where("false"), labels)).collect() == []
    none = lm.score(df, lm.fit(df, labels.where("false"))).where("doc_id = 1").collect()
    assert none[0].target_loss > 0


def test_small_vocabulary_uses_classes(spark):
    df = spark.createDataFrame([(1, "aa aa Bb ccc 12 é")], "doc_id long, text string")
    words = lm.vocabulary(df, size=lm.CLASSES + 2)
    assert len(words.hashes) == 1
    import pyarrow as pa

    numbers = words.numbers(lm.W.find(pa.array(["aa Bb ccc 12 é"]))).tolist()
    assert numbers[0] == lm.CLASSES + 1 and len(set(numbers)) == 5


def test_query_separates_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.QUERIES["op8_lm"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert len(rows) == 1000
    good = [rows[r.doc_id].difference for r in labels if r.quality == 1 and rows[r.doc_id].difference is not None]
    bad = [rows[r.doc_id].difference for r in labels if r.quality == 0 and rows[r.doc_id].difference is not None]
    better = sum(a < b for a in good for b in bad) / (len(good) * len(bad))
    assert better > 0.7


def test_every_word_of_a_large_vocabulary_counts(spark):
    """More words than any fixed table would hold; a rare wanted word moves the score of a text."""
    docs = [(i, " ".join(f"w{i}x{k}" for k in range(100))) for i in range(60)]
    docs += [(100 + i, f"the {'rareone' if i < 4 else 'plainone'} end") for i in range(8)] + [(200, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(100 + i, 1) for i in range(3)], "doc_id long, quality int")
    models = lm.fit(df, labels)
    assert models.words.size == 1 + lm.CLASSES + 6000 + 4
    want = plain(docs, [100, 101, 102], None)
    new = spark.createDataFrame([(1, "the rareone end"), (2, "the plainone end"), (3, "unseen end")], "doc_id long, text string")
    for counted in (True, False):
        rows = {r.doc_id: r for r in lm.score(df, models, counted=counted).collect()}
        assert len(rows) == len(docs)
        for i, (t, b) in want.items():
            if t is not None:
                assert (rows[i].target_loss, rows[i].background_loss) == (pytest.approx(t, rel=1e-4), pytest.approx(b, rel=1e-4))
        assert rows[103].difference < rows[104].difference
    other = {r.doc_id: r for r in lm.score(new, models).collect()}
    assert other[1].difference == pytest.approx(rows[103].difference) and other[3].n_tokens == 2
    assert other[3].target_loss > 0 and other[3].background_loss > 0


def test_differences_are_those_of_the_stored_models(spark, monkeypatch):
    """Also with many buckets, hot words, small blocks, copies of whole rows, null ids and texts."""
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["the", "the", f"w{rng.randint(0, 99)}", "é"]) for _ in range(rng.randint(0, 80)))) for i in range(70)]
    docs += [(70, None), (71, ""), (72, docs[0][1]), (None, "the w1"), (5, docs[5][1]), (6, "the end"), (73, "w7 " * 400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)] + [(None, 1)], "doc_id long, quality int")
    want = lm.score(df, lm.fit(df, labels), counted=True).collect()

    def key(r):
        return str(r.doc_id), r.n_tokens, r.difference is None, round(r.difference or 0, 5)

    for bucket, texts in ((lm.BUCKET, lm.BLOCK_TEXTS), (40, 5)):
        monkeypatch.setattr(lm, "BUCKET", bucket)
        monkeypatch.setattr(lm, "BLOCK_TEXTS", texts)
        known = lm.totals(lm._labelled(df, labels, "quality", "doc_id", "text"))
        assert (known.buckets > 20, len(known.hot) > 3) == (bucket == 40, bucket == 40)
        rows = lm.differences(df, labels)
        assert rows.dtypes == lm.score(df, lm.fit(df, labels)).dtypes
        rows = rows.collect()
        assert len(rows) == len(docs)
        for a, b in zip(sorted(rows, key=key), sorted(want, key=key)):
            assert (a.doc_id, a.n_tokens) == (b.doc_id, b.n_tokens)
            for x, y in zip(a[2:], b[2:]):
                assert x is y is None or x == pytest.approx(y, abs=1e-6)
    twice = lm.differences(df.union(df), labels)
    assert twice.count() == 2 * len(docs)
    assert lm.differences(df.where("false"), labels).collect() == []
    assert lm.differences(df.where("doc_id = 70"), labels).first()[1:] == (0, None, None, None)


def test_query_shuffles_little_more_than_the_texts_and_their_pairs(spark):
    """The pairs pass once, packed: no join by pair or word."""
    plan = queries.QUERIES["op8_lm"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    plan = plan[plan.index("== Physical Plan") :]
    assert plan.count("Join") == 1 and "Exchange hashpartitioning(bucket" in plan

import random

import llm_brute as brute
import numpy as np
import pytest

from millrace.llm import near, queries


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def alike(a, b, threshold, size=5):
    def cut(t):
        w = brute.SPACE.findall(t or "")
        n = min(size, len(w))
        return [tuple(w[k : k + n]) for k in range(len(w) - n + 1)] if w else []

    a, b = cut(a), cut(b)
    found = lcs(a, b)
    return bool(a and b) and found / (len(a) + len(b) - found) >= threshold - 1e-12


def brute_classes(docs, threshold=0.8):
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            a, b = docs[i][1] or "", docs[j][1] or ""
            if top(i) != top(j) and (a == b or alike(a, b, threshold)):
                root[top(i)] = top(j)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(top(i), []).append(i)
    return {frozenset(g) for g in groups.values()}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([["new%d" % rng.randrange(10**6)], [], [words[k], "more"]])
    return words


@pytest.mark.parametrize("seed", range(30))
def test_banded_alignment(seed):
    rng = random.Random(seed)
    a = [rng.randrange(rng.choice([3, 40])) for _ in range(rng.randrange(1, 80))]
    b = edited(rng, a, rng.randrange(8)) if seed % 3 else [rng.randrange(3) for _ in range(rng.randrange(1, 80))]
    b = [hash(x) % 997 for x in b] or [1]
    full = lcs(a, b)
    x, y = np.array(a, np.uint64), np.array(b, np.uint64)
    assert near.banded_lcs(x, y, 200) == full
    for band in range(0, 90, 7):
        assert near.banded_lcs(x, y, band) <= full
        if len(a) + len(b) - 2 * full <= band:
            assert near.banded_lcs(x, y, band) == full
    for t in (0.3, 0.6, 0.8, 0.95):
        assert near.similar(x, y, t) == (full / (len(a) + len(b) - full) >= t - 1e-12)


def corpus():
    rng = random.Random(5)
    base = [[rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(rng.randint(40, 160))] for _ in range(12)]
    docs = []
    for words in base:
        for _ in range(rng.randint(1, 12)):
            docs.append(" ".join(edited(rng, words, rng.randint(0, 4))))
    docs += [docs[0], docs[0], None, "", "", "one", "one", "one two", "a b c d", " ", "x " * 4000, "x " * 4100]
    return [(i, t, "z") for i, t in enumerate(docs)]


def test_against_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, class_id string").repartition(3)
    rows = near.near_duplicates(df).collect()
    assert len(rows) == len(docs)
    got = {}
    for r in rows:
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert {frozenset(g) for g in got.values()} == brute_classes(docs)
    assert all(k == min(g) for k, g in got.items()) and all(r.class_rows == len(got[r.class_id]) for r in rows)
    kept = near.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(got)


def test_repeated_rows_and_nulls(spark):
    docs = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "q"), (None, "q"), (None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = near.near_duplicates(df).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0, r.class_rows, r.keep) for r in rows) == [
        (0, 0, 1, True), (0, 0, 2, True), (0, 0, 2, True), (1, 1, 2, True), (1, 1, 2, True)
    ]
    assert sorted(map(str, near.deduplicate(df).collect())) == sorted(
        ["Row(doc_id=1, text='a b c d e f')", "Row(doc_id=None, text='q')", "Row(doc_id=None, text=None)"]
    )
    assert near.near_duplicates(df.where("false")).collect() == []


def test_query_over_whole_tables(spark):
    rows = queries.QUERIES["op2_near_duplicates"](spark, brute.SF).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{brute.SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    sets = [set(zip(*[(t or "").split()[k:] for k in range(5)])) for _, t in docs]
    known = {r.doc_id: r.class_id for r in rows}
    assert len(rows) == len(docs)
    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if docs[i][1] == docs[j][1] or a and b and len(a & b) >= 0.84 * len(a | b) and alike(docs[i][1], docs[j][1], 0.8):
                assert known[docs[i][0]] == known[docs[j][0]]
            if not a & b and docs[i][1] != docs[j][1] and a and b:
                assert known[docs[i][0]] != known[docs[j][0]] or len({r.class_rows for r in rows if r.class_id == known[docs[i][0]]} & {2}) == 0

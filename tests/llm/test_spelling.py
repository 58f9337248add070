import random
import re
import zlib
from collections import Counter

import compare
import llm_brute as brute
import numpy as np
import pytest

from millrace.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = brute.lowered(run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 31 == 0:
                run = spelling.damaged(run, h)
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def beside(word, alphabet):
    found = {word[:i] + word[i + 1 :] for i in range(len(word))}
    found |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in alphabet}
    found |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}
    return found - {word}


def expected(docs):
    n = counted(docs)
    alphabet = sorted({c for w in n for c in w})
    near = {w: [v for v in beside(w, alphabet) if v in n] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def made(seed, words):
    rng = random.Random(seed)
    stems = ["colourful", "aardvarks", "naïveté", "Straßenbahn", "bookkeeper", "aaaaaaaa", "àÿ×÷àÿ×", "letters" * 12]
    docs = []
    for i in range(120):
        found = []
        for _ in range(rng.randint(0, words)):
            w = stems[min(int(rng.expovariate(0.7)), len(stems) - 1)]
            for _ in range(min(3, int(rng.expovariate(2)))):
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "e", w[at] * 2, "A"]) + w[at + 1 :]
            found.append(w)
        docs.append((i, rng.choice([" ", "-", "1", "ā"]).join(found)))
    return docs + [(None, "colourful colourfal colourfal"), (500, None), (501, ""), (502, docs[3][1]), (502, docs[3][1])]


def result(spark, docs):
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n int").repartition(3)
    return sorted((tuple(r) for r in spelling.group(spelling.vocabulary(frame)).collect()), key=repr)


def test_against_brute_force(spark, monkeypatch):
    """Filters that take many batches, split lengths, words cut into places, and small pieces of text."""
    docs = made(1, 40)
    assert result(spark, docs) == expected(docs)
    for name, value in (("FILTER_BYTES", 8 * 40), ("LONGEST", 12), ("AT_ONCE", 64), ("PIECE", 50), ("PENDING", 3)):
        monkeypatch.setattr(spelling, name, value)
    docs = made(2, 12)
    assert result(spark, docs) == expected(docs)


def test_edits_have_the_hashes_of_their_words():
    alphabet = np.array(sorted(map(ord, "abcdé")), np.uint32)
    word = "bacdéaab"
    points = np.array([[ord(c) for c in word]], np.uint32)
    (gone, _), (swapped, _) = spelling.edits(points, alphabet, 0, len(word))
    for i, c in enumerate(word):
        short = int(spelling.hashes([word[:i] + word[i + 1 :]])[0])
        assert int(gone[0, i]) == (0 if i and word[i - 1] == c else short)
        for k, d in enumerate("abcdé"):
            assert int(swapped[0, i, k]) == (0 if d <= c else int(spelling.hashes([word[:i] + d + word[i + 1 :]])[0]))


def test_filters_lose_nothing_and_pass_little():
    rng = np.random.default_rng(1)
    keys = rng.integers(1, 2**64 - 1, 4000, dtype=np.uint64)
    [[(length, blocks, low, high)]] = spelling._batches({9: 4000}, 10**6)
    filters = spelling.Filters()
    filters.add(length, blocks, low, high)
    for h in keys:
        filters.parts[9][2][int(spelling._block(h, blocks))] |= spelling._mask(h)
    assert filters.passes(keys, 9).all() and not filters.passes(keys, 10).any()
    assert filters.passes(rng.integers(1, 2**64 - 1, 100_000, dtype=np.uint64), 9).mean() < 0.02


def test_chain_of_forms_and_empty(spark):
    words = [("abcdefgh", 10_000), ("abcdefgx", 1000), ("abcdefxx", 100), ("abcdexxx", 10), ("abcdxxxx", 1), ("unrelated", 5)]
    frame = spark.createDataFrame(words, "word string, n long")
    got = {r.word: (r.form, r.root, r.n_near, r.form_n) for r in spelling.group(frame).collect()}
    assert got["abcdxxxx"] == ("abcdexxx", "abcdefgh", 1, 10) and got["abcdefgx"] == ("abcdefgh", "abcdefgh", 2, 10_000)
    assert got["unrelated"] == (None, "unrelated", 0, None)
    assert spelling.group(frame.where("false")).collect() == []
    with pytest.raises(ValueError):
        spelling.group(frame, ratio=1)


def test_very_long_text_and_word(spark):
    docs = [(1, "q" * 200_000), (2, "q" * 200_000), (3, "shorter words " * 300_000), (4, "q" * 199_999), (5, "q" * 199_999)]
    got = {len(r.word): (r.n, r.n_near) for r in spelling.group(spelling.vocabulary(spark.createDataFrame(docs, "doc_id long, text string"), noise=None)).collect()}
    assert got[7] == (300_000, 0) and got[200_000] == (2, 1)


def test_query_against_sql_and_brute_force(spark):
    df = queries.QUERIES["op11_spelling"](spark, brute.SF)
    assert compare.difference(df, compare.connect(brute.SF), queries.ORACLE["op11_spelling"]) is None
    docs = [tuple(r) for r in spark.read.parquet(f"{brute.SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == expected(docs)

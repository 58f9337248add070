import random

import llm_brute as brute
import pyarrow as pa  # noqa: F401
import pytest

from millrace.llm import lzprint, queries


def plain_phrases(text):
    known, start = [], 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in known:
            known.append(text[start:end])
            start = end
    return known


def test_parse_against_definition():
    rng = random.Random(4)
    for alphabet in ("a", "ab", "abé𝒳 ", "abcdefghijkl"):
        for n in [*range(12), 300]:
            text = "".join(rng.choice(alphabet) for _ in range(n))
            ends = lzprint.parse(text, set())
            assert [text[a:b] for a, b in zip([0, *ends[:-1]], ends)] == plain_phrases(text)
            keep, ending = rng.randint(0, n), "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            edited, signature = lzprint.Parsed(text).with_ending(keep, ending)
            assert edited == text[:keep] + ending
            assert signature.tolist() == lzprint.Parsed(edited).signature.tolist()


def test_likeness_estimates_the_jaccard_index():
    rng = random.Random(6)
    for _ in range(20):
        a = "".join(rng.choice("abcde ") for _ in range(6000))
        cut = rng.randint(0, 6000)
        b = a[:cut] + "".join(rng.choice("abcde ") for _ in range(6000 - cut))
        x, y = set(plain_phrases(a)), set(plain_phrases(b))
        got = lzprint.likeness(lzprint.Parsed(a).signature, lzprint.Parsed(b).signature)
        assert abs(got - len(x & y) / len(x | y)) < 0.2
    assert lzprint.likeness(lzprint.Parsed("abc").signature, lzprint.Parsed("abd").signature) == 0.5


def expected(docs):
    out = []
    for k, (i, text) in enumerate(docs):
        text, after = text or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        prints = [lzprint.written(lzprint.Parsed(t).signature) for t in (text, edited, after)]
        a, b, c = map(lzprint.read, prints)
        out.append((i, len(text), edited, prints[0], prints[1], lzprint.likeness(a, b), lzprint.likeness(a, c)))
    return out


@pytest.mark.parametrize("n", [1, 2, 40])
def test_against_brute_force(spark, n):
    rng = random.Random(n)
    docs = [(3 * i - 20, "".join(rng.choice("abc é") for _ in range(rng.randint(0, 200)))) for i in range(n)]
    docs += [(900, None), (901, ""), (902, "ab" * 30000)] if n > 2 else []
    df = spark.createDataFrame([(i, t, "q") for i, t in docs], "doc_id long, text string, bucket string").repartition(3)
    got = sorted(tuple(r) for r in lzprint.compare_with_next(df).collect())
    assert got == sorted(expected(docs))
    assert lzprint.compare_with_next(df.where("false")).collect() == []


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "aaab"), (1, "aaab"), (None, "x"), (None, "x")], "doc_id long, text string")
    rows = lzprint.compare_with_next(df).collect()
    assert len(rows) == 4 and {r.fingerprint for r in rows if r.doc_id == 1} == {lzprint.written(lzprint.Parsed("aaab").signature)}
    both = df.select(lzprint.fingerprint(df.text).alias("f")).select(lzprint.alike("f", "f").alias("s")).collect()
    assert [r.s for r in both] == [1.0] * 4


def test_query_over_whole_tables(spark):
    rows = queries.QUERIES["op7_lzprint"](spark, brute.SF).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{brute.SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    want = {r[0]: r for r in expected(docs)}
    assert len(rows) == len(docs)
    for r in rows:
        w = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) == (
            w[1], brute.sha(w[2]), *w[3:]
        )
    assert sum(r.near_edited > r.near_next for r in rows) > 0.9 * len(rows)


class Counted(set):
    asked = 0

    def __contains__(self, item):
        self.asked += 1
        return super().__contains__(item)


def test_phrases_of_four_letters_take_two_questions():
    known = Counted({"a", "ab", "abc", "b", "bc", "bcd"})
    assert lzprint.parse("abcdbcda" * 1, known) == [4, 8] and known.asked == 4
    assert {"abcd", "bcda"} <= known

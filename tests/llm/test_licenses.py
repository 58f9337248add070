import random

import compare
import llm_brute as brute

from millrace.llm import licenses, queries

LONG = " ".join(f"clause{i % 37} term{i}" for i in range(60))
NAMED = [*licenses.TEMPLATES, ("long", LONG), ("tiny", "too short"), ("none", None), ("MIT", "released under the mit license")]


def cut(text, size=5):
    w = brute.ALNUM.findall(brute.lowered(text or ""))
    return [tuple(w[k : k + size]) for k in range(len(w) - size + 1)]


def expected(text):
    out = {}
    for name, body in NAMED:
        parts = set(cut(body))
        if not parts:
            continue
        reach = 4
        while reach < len(parts):
            reach *= 2
        found = cut(text)
        for k in range(0, len(found), reach):
            share = len(parts & set(found[k : k + 2 * reach])) / len(parts)
            if share >= 0.8 - 1e-9:
                out[name] = max(out.get(name, 0), share)
    return out


def test_against_brute_force(spark):
    rng = random.Random(8)
    docs = []
    for i in range(150):
        words = ["w%d" % rng.randrange(50) for _ in range(rng.randint(0, 200))]
        for _ in range(rng.randint(0, 3)):
            body = rng.choice(NAMED)[1] or ""
            body = body.split()
            if rng.random() < 0.4 and len(body) > 12:
                body[rng.randrange(len(body))] = "changed"
            k = rng.randint(0, len(words))
            words[k:k] = body
        docs.append((i, " ".join(words), 1))
    docs += [(150, None, 1), (151, "", 1), (152, docs[0][1], 1), (152, docs[0][1], 1), (None, LONG.upper() + ".", 1), (154, "x " * 20000, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, matches int").repartition(3)
    rows = licenses.scan(df, spark.createDataFrame(NAMED, "template_id string, text string")).collect()
    assert len(rows) == len(docs)
    texts = {i: t for i, t, _ in docs}
    for r in rows:
        assert {m.template: m.containment for m in r.matches} == expected(texts[r.doc_id])
        for m in r.matches:
            assert 0 <= m.begin < m.end
    assert licenses.scan(df.where("false"), licenses.notices(spark)).collect() == []
    assert all(r.matches == [] for r in licenses.scan(df, licenses.notices(spark).where("false")).collect())


def test_query_is_native_and_agrees_with_sql(spark):
    df = queries.QUERIES["op9_licenses"](spark, brute.SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert compare.difference(df, compare.connect(brute.SF), queries.ORACLE["op9_licenses"]) is None
    assert df.where("n_matches > 0").count() > 0


def test_short_templates_are_one_shingle_where_asked_for(spark):
    named = [("two", "CC BY"), ("four", "under the MIT License"), ("five", "Released under the MIT License."), ("none", None), ("empty", "")]
    templates = spark.createDataFrame(named, "template_id string, text string")
    docs = [(1, "licensed under the MIT license"), (2, "Released under the MIT License"), (3, "by cc x " * 9 + "cc-by"), (4, "under the license MIT"), (5, None), (6, "cc")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = licenses.scan(df, templates, short=True).collect()
    got = {r.doc_id: [(m.template, m.containment, m.begin, m.end) for m in r.matches] for r in rows}
    assert got == {
        1: [("four", 1.0, 1, 5)], 2: [("five", 1.0, 0, 5), ("four", 1.0, 1, 5)], 3: [("two", 1.0, 27, 29)], 4: [], 5: [], 6: []
    }
    assert {r.doc_id: len(r.matches) for r in licenses.scan(df, templates).collect()} == {1: 0, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0}

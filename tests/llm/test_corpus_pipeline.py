import llm_brute as brute
import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
import test_near
import test_pii
from millrace.llm import bpe, pii

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(spark, name, rows, folder=brute.SF):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = dict(corpus_pipeline.STAGES)[name](spark, df, folder)
    if name != "byte_bpe":
        assert out.columns == COLUMNS
    return out.collect()


def rows(texts):
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{brute.SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = [tuple(r) for r in docs]

    few = sorted((r for r in kept if r[4] < 700), key=lambda r: r[0])[:40]
    few += [(1000 + r[0], r[1] + " tail", *r[2:]) for r in few[:10]]
    classes = test_near.brute_classes([(r[0], r[1]) for r in few])
    got = stage(spark, "near_duplicates", few)
    assert {r.doc_id for r in got} == {min(few[i][0] for i in c) for c in classes} and len(got) == len(classes) < len(few)

    hit = brute.leaks([(r[0], r[1]) for r in kept], items, 10)
    got = stage(spark, "decontamination", kept)
    assert sorted(map(tuple, got)) == sorted(r for r in kept if not hit[r[0]][1]) and len(got) < len(kept)

    got = {r.doc_id: r for r in stage(spark, "personal_data", kept)}
    for i, text, *_ in kept:
        assert got[i].n_chars == len(got[i].text)
        assert (got[i].text != text) == bool(pii.find(text))
        assert len(test_pii.base(text)) == sum(s["base"] for s in pii.find(text))
        assert not [s for s in test_pii.base(got[i].text) if s[0] in ("email", "card")]

    ranks = bpe.load_ranks(public_tokenizers.path(corpus_pipeline.RANKS))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in stage(spark, "byte_bpe", kept):
        text = next(x[1] for x in kept if x[0] == r.doc_id)
        assert np.frombuffer(r.ids, "<u4").tolist() == own.encode_ordinary(text)
        assert r.decoded_sha256 == brute.sha(text) and r.n_tokens == len(r.ids) // 4


def test_awkward_rows(spark):
    some = rows([None, "", "a", "a", "x y z " * 2000, "mail me@x.org", None])
    some += [(None, "w", None, None, None), (None, "w", None, None, None), some[2]]
    for name, n in (("toxicity", 10), ("near_duplicates", 5), ("decontamination", 10), ("personal_data", 10), ("byte_bpe", 10)):
        got = stage(spark, name, some)
        assert len(got) == n, name
        assert stage(spark, name, []) == []


def test_run_keeps_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    out = corpus_pipeline.run(spark, folder)
    got = {r.doc_id: r for r in out.collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    toxic = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("toxic = 1").collect()}
    assert 0.6 * len(docs) < len(got) < len(docs)
    assert len(toxic & set(got)) < 0.35 * len(toxic)
    assert set(out.columns) == {"doc_id", "lang", "source", "n_chars", "ids", "n_tokens", "ids_sha256", "decoded_sha256"}

import hashlib
import zlib

import compare
import llm_brute as brute
import pytest

from millrace.llm import merkle, queries


def digest(*parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_digest(row) -> str:
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def proof(level: list[str], place: int):
    """Siblings of a place up to the top, and the top."""
    found = []
    while len(level) > 1:
        run = level[place - place % 2 : place - place % 2 + 2]
        found.append(run[: place % 2] + run[place % 2 + 1 :] if len(run) > 1 else [])
        level = [digest(*level[i : i + 2]) for i in range(0, len(level), 2)]
        place //= 2
    return found, level[0]


def fold(start: str, place: int, found: list[list[str]]) -> str:
    for beside in found:
        start = digest(*((beside + [start]) if place % 2 else ([start] + beside)))
        place //= 2
    return start


def expected(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, row_digest(r)))
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {v: [r for r in rows if r[2] == v] for v in langs}
    tops = [proof([row_digest(r) for r in trees[v]], 0)[1] for v in langs]
    out = []
    for k, v in enumerate(langs):
        level = [row_digest(r) for r in trees[v]]
        over, root = proof(tops, k)
        for place, r in enumerate(trees[v]):
            beside, sub = proof(level, place)
            marked = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            shown = row_digest(r[:3] + (r[3] + 1,) + r[4:]) if marked else row_digest(r)
            got = fold(fold(shown, place, beside), k, over)
            told = digest(*(x for b in beside + over for x in b))
            out.append((r[0], row_digest(r), sub, root, told, got, got == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, item string, root string"


def write(spark, tmp_path, rows):
    folder = tmp_path / "documents.parquet"
    spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5).write.parquet(str(folder))
    return str(tmp_path)


def result(spark, folder):
    return sorted((tuple(r) for r in queries.QUERIES["op12_merkle"](spark, folder).collect()), key=repr)


@pytest.mark.parametrize("sizes", [(1,), (3, 33, 32), (200, 1030, 1, 64, 65)])
def test_against_brute_force(spark, tmp_path, sizes):
    rows = [(i * 3 % 1999, f"s{i % 4}", ("é", "z", None, "", "a")[g], i % 50, f"tëxt {i}") for g, n in enumerate(sizes) for i in range(n)]
    assert result(spark, write(spark, tmp_path, rows)) == expected(rows)


def test_nulls_ties_and_copies(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, "", "", 0, ""), (7, None, "a", 3, "-"), (7, None, "a", 3, "1:x"), (7, "", "a", 3, None)]
    rows += [(5, "s", "a", 2, "same")] * 70 + [(8, "s", "a", None, "x" * 100_000)]
    assert result(spark, write(spark, tmp_path, rows)) == expected(rows)


def test_no_rows_and_stored_levels(spark, tmp_path):
    folder = write(spark, tmp_path, [(i, "s", "a", 1, "t") for i in range(100)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert merkle.build(docs.where("false"), queries.LEAF).proofs().collect() == []
    tree = merkle.build(docs, queries.LEAF)
    assert [level.count() for level in tree.groups.levels] == [100, 4, 1]  # not the levels between
    assert tree.root().collect()[0].root == result(spark, folder)[0][3]


def test_query_against_sql(spark):
    df = queries.QUERIES["op12_merkle"](spark, brute.SF)
    assert compare.difference(df, compare.connect(brute.SF), queries.ORACLE["op12_merkle"]) is None
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet").select(*queries.LEAF)
    assert result(spark, brute.SF) == expected([tuple(r) for r in docs.collect()])

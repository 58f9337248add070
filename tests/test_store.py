"""Folding of batches: bounded folders, equal rows, ranges, safe readers."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.sources import files
from millrace.sources.store import Store

SCHEMA = "n long, kind string"


def rows(df):
    return sorted(tuple(r) for r in df.select("n", "kind").collect())


def folders(store, table="t"):
    return sorted(p.name for p in Path(store.folder(table)).iterdir())


@pytest.fixture
def filled(spark, tmp_path):
    """200 batches of two rows: copies of a few written ones."""
    store = Store(spark, str(tmp_path))
    for k in range(5):
        df = spark.createDataFrame([(2 * k, "a"), (2 * k + 1, "b")], SCHEMA).coalesce(1)
        store.add_batch("t", df, k + 1, ["kind"])
    for k in range(5, 200):
        shutil.copytree(tmp_path / f"t/batch={k % 5 + 1:08d}", tmp_path / f"t/batch={k + 1:08d}")
    return store


def test_folders_stay_few_and_rows_stay(filled):
    store = filled
    before = rows(store.batches("t", schema=SCHEMA))
    part = rows(store.batches("t", after=37, upto=171, schema=SCHEMA))
    planned = store.batches("t", schema=SCHEMA)  # a reader from before
    assert len(before) == 400 and len(part) == 2 * (171 - 37)
    assert store.fold("t", ["kind"], SCHEMA, fan=32) == 6
    assert len(store._parts("t")) == 6 + 200 % 32
    assert rows(store.batches("t", schema=SCHEMA)) == before == rows(planned)
    assert rows(store.batches("t", after=37, upto=171, schema=SCHEMA)) == part
    assert store.fold("t", ["kind"], SCHEMA, fan=32) == 0 and store.last_batch("t") == 200
    assert store.expire("t", grace_seconds=3600) == 0 and rows(planned) == before
    assert store.expire("t", grace_seconds=0) == 6 * 32
    assert len(folders(store)) == 6 + 200 % 32
    assert rows(store.batches("t", schema=SCHEMA)) == before
    # Once as many folded ones have gathered, they are folded again; no row is lost.
    assert store.fold("t", ["kind"], SCHEMA, fan=3) > 0
    assert rows(store.batches("t", schema=SCHEMA)) == before
    assert rows(store.batches("t", after=37, upto=171, schema=SCHEMA)) == part
    assert len(store._parts("t")) < 8


def test_the_number_of_folders_is_bounded():
    """1,000 batches, by the rule alone: at most fan - 1 folders of each size."""
    parts, most = [], 0
    for batch in range(1, 1001):
        parts.append((batch, batch))
        while due := Store._due(parts, 10):
            at = parts.index(due[0])
            parts[at : at + len(due)] = [(due[0][0], due[-1][1])]
        most = max(most, len(parts))
    assert parts == [(1, 1000)] and most <= 3 * 9


def test_an_unfinished_fold_is_not_seen_and_is_made_again(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for k in range(4):
        store.add_batch("t", spark.createDataFrame([(k, "a")], SCHEMA), k + 1)
    store.fold("t", fan=4)
    (tmp_path / "t/batch=00000001-00000004/_SUCCESS").unlink()
    assert len(store._parts("t")) == 4 and rows(store.batches("t")) == [(k, "a") for k in range(4)]
    assert store.fold("t", fan=4) == 1 and rows(store.rows("t")) == [(k, "a") for k in range(4)]
    store.add_batch("t", spark.createDataFrame([(9, "z")], SCHEMA), 5)
    assert rows(store.batches("t", after=2)) == [(2, "a"), (3, "a"), (9, "z")]


def test_raw_events_and_ledger_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("millrace.sources.store.Store.fold.__defaults__", ((), None, None, 3))
    store, folder = Store(spark, str(tmp_path / "store")), tmp_path / "data/erp/2026-01-06"
    folder.mkdir(parents=True)
    for k in range(7):
        (folder / "payments.json").write_text(f'[{{"event_id": "E{k}"}}, {{"n": {k}}}]' + " " * k)
        (folder / f"f{k}.json").write_text("[[]]" if k % 2 else "x")
        files.ingest(store, str(tmp_path / "data"))
    look = lambda: (
        sorted(tuple(r) for r in files.raw_events(store).collect()),
        sorted(tuple(r) for r in files.raw_events(store, after=4).collect()),
        sorted(tuple(r) for r in files.quarantine(store).collect()),
        sorted(tuple(r) for r in files.ledger(store).select("file_path", "file_hash", "row_count", "ingest_batch").collect()),
    )
    before = look()
    assert files.compact(store) == 4 and look() == before
    assert files.compact(store, grace_seconds=0) == 0 and look() == before
    assert len(folders(store, files.RAW)) == 3 == len(folders(store, files.LEDGER))
    kept = spark.read.parquet(f"{store.folder(files.LEDGER)}/batch=00000001-00000003")
    assert kept.where(F.col("file_path").endswith("payments.json")).count() == 1
    files.ingest(store, str(tmp_path / "data"))
    assert files.raw_events(store, after=7).count() == 0

import random

from pyspark.sql import functions as F

from millrace.operators import insert_if_absent, latest_value, upsert_guarded, upsert_latest, upsert_partial, upserted_keys

SCHEMA = "k string, seq int, guard string, v int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def random_rows(n, seed, null_share=0.0):
    rng = random.Random(seed)
    # A third of all rows share one key.
    key = lambda: None if rng.random() < null_share else ("hot" if rng.random() < 0.33 else f"k{rng.randrange(20)}")
    return [(key(), i, rng.choice(["08", "14", "20"]), rng.randrange(100)) for i in range(n)]


def test_latest_equals_replay_and_does_not_depend_on_batches(spark):
    data = random_rows(300, 1)
    state = {}
    for row in data:
        state[row[0]] = row
    expected = sorted(state.values(), key=repr)
    df = spark.createDataFrame(data, SCHEMA)
    seq = [F.col("seq")]
    assert rows_of(upsert_latest(None, df, ["k"], seq)) == expected
    first = upsert_latest(None, df.where("seq < 120"), ["k"], seq)
    assert rows_of(upsert_latest(first, df.where("seq >= 120"), ["k"], seq)) == expected
    # Late batches first, and the same batch twice.
    late = upsert_latest(None, df.where("seq >= 120"), ["k"], seq)
    again = upsert_latest(late, df, ["k"], seq)
    assert rows_of(upsert_latest(again, df, ["k"], seq)) == expected


def test_guarded_equals_replay(spark):
    data = random_rows(300, 2)
    state = {}
    for row in data:
        if row[0] not in state or row[2] > state[row[0]][2]:
            state[row[0]] = row
    expected = sorted(state.values(), key=repr)
    df = spark.createDataFrame(data, SCHEMA)
    guard, seq = [F.col("guard")], [F.col("seq")]
    assert rows_of(upsert_guarded(None, df, ["k"], guard, seq)) == expected
    part = upsert_guarded(None, df.where("seq < 77"), ["k"], guard, seq)
    assert rows_of(upsert_guarded(part, df.where("seq >= 77"), ["k"], guard, seq)) == expected


def test_null_keys_stay_apart_unless_delivered_twice(spark):
    data = random_rows(200, 3, null_share=0.3)
    df = spark.createDataFrame(data, SCHEMA)
    keyed = {}
    for row in data:
        if row[0] is not None:
            keyed[row[0]] = row
    expected = sorted([*keyed.values(), *[r for r in data if r[0] is None]], key=repr)
    seq = [F.col("seq")]
    once = upsert_latest(None, df, ["k"], seq, [F.col("seq").cast("string")])
    assert rows_of(once) == expected
    assert rows_of(upsert_latest(once, df, ["k"], seq, [F.col("seq").cast("string")])) == expected


def test_partial_refreshes_only_the_named_columns(spark):
    old = spark.createDataFrame([("a", 1, "x", 1), ("b", 2, "y", None)], SCHEMA)
    new = spark.createDataFrame([("b", 9, "z", None), ("b2", 8, "q", 5), ("a", 7, None, 3)], SCHEMA)
    merged = upsert_partial(old, new, ["k"], ["guard", "v"])
    assert rows_of(merged) == [("a", 1, None, 3), ("b", 2, "z", None), ("b2", 8, "q", 5)]
    assert rows_of(upsert_partial(None, new, ["k"], ["v"])) == rows_of(new)


def test_insert_if_absent_keeps_the_first(spark):
    old = spark.createDataFrame([("a", 1, "x", 1)], SCHEMA)
    new = spark.createDataFrame([("a", 2, "y", 2), ("c", 4, "y", 2), ("c", 3, "z", 7)], SCHEMA)
    merged = insert_if_absent(old, new, ["k"], [F.col("seq")])
    assert rows_of(merged) == [("a", 1, "x", 1), ("c", 3, "z", 7)]


def test_latest_value_may_be_null(spark):
    df = spark.createDataFrame([("a", 1, None, 5), ("a", 2, None, None), ("b", 1, None, 3)], SCHEMA)
    out = df.groupBy("k").agg(latest_value(F.col("v"), F.col("seq")).alias("v"))
    assert rows_of(out) == [("a", None), ("b", 3)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100_000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS seq")
    plan = upsert_latest(None, df, ["k"], [F.col("seq")])._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "row_number(), 1, Partial" in plan[shuffle:]


def test_keys_of_an_upsert_are_those_of_its_rows(spark):
    rows = [("a", None, 1, "x"), ("a", None, 2, "x"), ("a", None, 3, "y"), (None, None, 4, "x"), ("a", 1, 5, "x"), ("a", 1, 6, "y"), ("b", 2, 7, "x")]
    df = spark.createDataFrame(rows, "k string, l int, s int, payload string")
    for identity in (None, [F.col("payload")]):
        whole = upsert_latest(None, df, ["k", "l"], [F.col("s")], identity).select("k", "l")
        assert rows_of(upserted_keys(df, ["k", "l"], identity)) == rows_of(whole)

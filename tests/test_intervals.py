import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import Buckets, interval_join, with_validity

BASE = date(2026, 1, 1)


def history(rng, key):
    """Disjoint intervals with gaps, some long, the last one open."""
    out, day = [], BASE + timedelta(days=rng.randrange(-400, 200))
    for i in range(rng.randrange(1, 12)):
        end = day + timedelta(days=rng.choice([0, 1, 5, 40, 500]))
        out.append((key, day, end, f"{key}-{i}"))
        day = end + timedelta(days=rng.choice([1, 1, 30]))
    out.append((key, day, None, f"{key}-open"))
    return out


@pytest.mark.parametrize("days,low,high", [(1, -30, 30), (31, 0, 730), (366, 0, 730), (7, 200, 210)])
def test_equals_brute_force_whatever_the_buckets(spark, days, low, high):
    rng = random.Random(days)
    versions = [v for key in ["hot", *[f"k{i}" for i in range(8)]] for v in history(rng, key)]
    keys = ["hot"] * 100 + [f"k{i}" for i in range(10) for _ in range(20)] + [None] * 5
    facts = [(i, key, BASE + timedelta(days=rng.randrange(-900, 3000))) for i, key in enumerate(keys)]

    def match(key, day):
        found = [v for k, f, t, v in versions if k == key and f <= day and (t is None or t >= day)]
        assert len(found) <= 1
        return found[0] if found else None

    f = spark.createDataFrame(facts, "id int, k string, d date")
    v = spark.createDataFrame(versions, "k string, effective_from date, effective_to date, name string")
    buckets = Buckets(BASE + timedelta(days=low), BASE + timedelta(days=high), days)
    expected = {i: match(k, d) for i, k, d in facts}
    inner = interval_join(f, v, [("k", "k")], "d", {"name": "name"}, buckets)
    assert {r.id: r.name for r in inner.collect()} == {i: n for i, n in expected.items() if n is not None}
    left = interval_join(f, v, [("k", "k")], "d", {"name": "name"}, buckets, how="left").collect()
    assert len(left) == len(facts)
    assert {r.id: r.name for r in left} == expected


def test_inverted_interval_never_matches(spark):
    v = spark.createDataFrame([("a", date(2026, 5, 1), date(2026, 4, 1))], "k string, effective_from date, effective_to date")
    f = spark.createDataFrame([("a", date(2026, 4, 15))], "k string, d date")
    out = interval_join(f, v, [("k", "k")], "d", {"x": "effective_from"}, Buckets(BASE, date(2027, 12, 31)))
    assert out.count() == 0


def test_rates_hold_until_the_next_one_even_if_null(spark):
    rates = spark.createDataFrame(
        [("EUR/PLN", date(2026, 1, 2), 4.1), ("EUR/PLN", date(2026, 1, 5), None), ("EUR/PLN", date(2026, 1, 9), 4.3)],
        "pair string, d date, rate double",
    )
    days = spark.createDataFrame([(date(2026, 1, n), "EUR/PLN") for n in (1, 2, 4, 5, 8, 9, 30)], "day date, p string")
    valid = with_validity(rates, ["pair"], "d")
    out = interval_join(
        days, valid, [("p", "pair")], "day", {"rate": "rate", "since": "d"}, Buckets(BASE, date(2026, 2, 1), 3),
        how="left", start="valid_from", end="valid_to",
    )
    found = {r.day.day: (r.rate, r.since.day if r.since else None) for r in out.collect()}
    assert found == {1: (None, None), 2: (4.1, 2), 4: (4.1, 2), 5: (None, 5), 8: (None, 5), 9: (4.3, 9), 30: (4.3, 9)}


def test_join_is_a_hash_equality(spark):
    v = spark.createDataFrame([("a", BASE, None)], "k string, effective_from date, effective_to date")
    f = spark.createDataFrame([("a", BASE), ("b", BASE)], "k string, d date")
    out = interval_join(f, v, [("k", "k")], "d", {"x": "effective_from"}, Buckets(BASE, date(2027, 1, 1)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_key_is_split_where_the_side_is_too_big_to_broadcast(spark):
    """A third of all facts on one key and bucket, no broadcast: the hot partition is divided."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        facts = spark.range(0, 300_000, 1, 8).selectExpr(
            "id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 1000) END AS k", "date'2026-03-01' AS d"
        )
        sides = spark.range(1000).selectExpr(
            "CASE WHEN id = 0 THEN 'hot' ELSE concat('k', id) END AS k", "date'2026-01-01' AS effective_from", "cast(NULL AS date) AS effective_to"
        )
        out = interval_join(facts, sides, [("k", "k")], "d", {"since": "effective_from"}, Buckets(BASE, date(2027, 12, 31)))
        # A grouping by the join key follows, as in the scorecards.
        out = out.groupBy("k").agg(F.count("since").alias("n"))
        found = {r.k: r.n for r in out.collect()}
        assert found["hot"] == 100_000 and sum(found.values()) == 300_000 - facts.where("k = 'k0'").count()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_hot_key_is_split_among_many_parts(spark):
    """Shuffles start with 480 parts, which leaves the hot key alone in its part; rows that do not compress away are divided there too."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "480",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        facts = spark.range(0, 60_000, 1, 8).selectExpr(
            "md5(string(id)) AS v", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 1000) END AS k", "date'2026-03-01' AS d"
        )
        sides = spark.range(1000).selectExpr(
            "CASE WHEN id = 0 THEN 'hot' ELSE concat('k', id) END AS k", "date'2026-01-01' AS effective_from", "cast(NULL AS date) AS effective_to"
        )
        out = interval_join(facts, sides, [("k", "k")], "d", {"since": "effective_from"}, Buckets(BASE, date(2027, 12, 31)))
        out = out.groupBy("k").agg(F.count("since").alias("n"), F.max("v").alias("v"))
        assert {r.k: r.n for r in out.collect()}["hot"] == 20_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)

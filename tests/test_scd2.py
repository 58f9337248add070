import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from millrace.operators import scd2_build
from millrace.plans import dims

BASE = date(2026, 1, 1)
SEED = "k string, name string, segment string, terms int, since date"
CHANGES = "k string, d date, seq int, segment struct<value:string>, terms struct<value:int>"


def build(spark, seed, changes):
    out = scd2_build(
        spark.createDataFrame(seed, SEED), spark.createDataFrame(changes, CHANGES), "k", "since", "d", ["segment", "terms"], [F.col("seq")]
    )
    rows = out.select("k", "name", "segment", "terms", "since", "effective_from", "effective_to", "is_current").collect()
    return sorted([tuple(r) for r in rows], key=lambda r: (r[0], r[5]))


def replay(seed, changes):
    """Day by day: the history the rules describe."""
    out = []
    for key, name, segment, terms, since in seed:
        mine = sorted([c for c in changes if c[0] == key], key=lambda c: (c[1], c[2]))
        start = min([since, *[c[1] for c in mine]])
        versions = [[start, segment, terms]]
        for _, day, _, seg, trm in mine:
            if versions[-1][0] != day:
                versions.append([day, versions[-1][1], versions[-1][2]])
            if seg is not None:
                versions[-1][1] = seg[0]
            if trm is not None:
                versions[-1][2] = trm[0]
        for i, (day, seg, trm) in enumerate(versions):
            last = i + 1 == len(versions)
            until = None if last else versions[i + 1][0] - timedelta(days=1)
            out.append((key, name, seg, trm, since, day, until, last))
    return sorted(out, key=lambda r: (r[0], r[5]))


def test_equals_replay_on_random_histories(spark):
    rng = random.Random(7)
    seed = [(f"k{i}", f"n{i}", "S", 30, BASE + timedelta(days=rng.randrange(60))) for i in range(25)]
    changes = []
    for seq in range(400):
        key = "k0" if rng.random() < 0.33 else f"k{rng.randrange(30)}"  # some keys have no seed
        day = BASE + timedelta(days=rng.randrange(-20, 120))
        seg = (rng.choice(["A", "B", None]),) if rng.random() < 0.5 else None
        changes.append((key, day, seq, seg, None if seg is not None else (rng.randrange(9),)))
    got = build(spark, seed, changes)
    assert got == replay(seed, changes)
    for key in {r[0] for r in got}:
        mine = [r for r in got if r[0] == key]
        assert [r[7] for r in mine] == [False] * (len(mine) - 1) + [True]
        assert all(a[6] + timedelta(days=1) == b[5] for a, b in zip(mine, mine[1:]))


def test_change_on_or_before_the_seed_date(spark):
    seed = [("a", "n", "S", 30, date(2026, 3, 1)), ("b", "n", "S", 30, date(2026, 3, 1)), ("c", "n", "S", 30, date(2026, 3, 1))]
    changes = [("a", date(2026, 3, 1), 1, ("X",), None), ("b", date(2026, 2, 1), 1, ("Y",), None)]
    got = build(spark, seed, changes)
    assert [(r[0], r[2], r[5], r[6]) for r in got] == [
        ("a", "X", date(2026, 3, 1), None),
        ("b", "Y", date(2026, 2, 1), None),
        ("c", "S", date(2026, 3, 1), None),
    ]


def mdc(spark, rows):
    return spark.createDataFrame(
        rows, "change_id string, change_date date, change_type string, entity_type string, entity_id string, new_value string"
    )


def test_change_documents(spark):
    d = date(2026, 2, 1)
    rows = mdc(
        spark,
        [
            ("1", d, "segment", "customer", "scalar", '{"value":"G"}'),
            ("2", d, "segment", "customer", "named", '{"segment":"H"}'),
            ("3", d, "segment", "customer", "null", '{"segment":null}'),
            ("4", d, "segment", "customer", "other", '{"comment":"x"}'),
            ("5", d, "payment_terms_days", "customer", "terms", '{"value":"45"}'),
            ("6", d, "credit_limit", "customer", "ignored", '{"value":1}'),
        ],
    )
    got = {r.customer_id: (r.segment, r.payment_terms_days) for r in dims.customer_changes(rows).collect()}
    assert {k: (tuple(s) if s else s, tuple(t) if t else t) for k, (s, t) in got.items()} == {
        "scalar": (("G",), None), "named": (("H",), None), "null": ((None,), None), "other": (None, None), "terms": (None, (45,)),
    }


def test_sku_status_always_deactivates(spark):
    catalog = spark.createDataFrame(
        [("s1", True), ("s2", True)], "sku string, is_active boolean"
    ).selectExpr("*", "'v' AS valve_type", "1 AS dn", "'m' AS material", "'p' AS pressure_class", "'c' AS connection",
                 "'a' AS actuation", "1.0 AS weight_kg", "2.0 AS base_price_pln", "3.0 AS base_price_eur")
    changes = dims.sku_changes(mdc(spark, [("1", date(2026, 5, 1), "sku_status", "product", "s1", '{"value":"active"}')]))
    got = sorted(dims.dim_sku(catalog, changes).select("sku", "effective_from", "effective_to", "is_active", "is_current").collect())
    assert [tuple(r) for r in got] == [
        ("s1", date(2026, 1, 1), date(2026, 4, 30), True, False),
        ("s1", date(2026, 5, 1), None, False, True),
        ("s2", date(2026, 1, 1), None, True, True),
    ]


def test_latest_reliability_override(spark):
    rows = mdc(
        spark,
        [
            ("1", date(2026, 2, 1), "carrier_base_rate", "carrier", "A", '{"base_reliability":0.9}'),
            ("2", date(2026, 3, 1), "carrier_base_rate", "carrier", "A", '{"base_reliability":0.7}'),
            ("3", date(2026, 4, 1), "carrier_base_rate", "carrier", "A", '{"rate":5}'),
            ("4", date(2026, 4, 1), "segment", "carrier", "B", '{"base_reliability":0.1}'),
        ],
    )
    assert [(r.carrier_code, float(r.reliability)) for r in dims.reliability_overrides(rows).collect()] == [("A", 0.7)]

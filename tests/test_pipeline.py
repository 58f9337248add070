"""The whole way from JSON files to gold tables, on a small hand-written tree."""

import json
import os
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.plans import exports
from millrace.plans.refresh import Refresh
from millrace.sources import files
from millrace.sources.store import Store
from millrace.streaming.ingest import stream_files


def put(root: Path, name: str, content) -> None:
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content))


def line(line_id, sku="V-1", price=10.0, **quantities):
    return {"line_id": line_id, "sku": sku, "unit_price": price, "line_status": "open",
            **{f"quantity_{k}": v for k, v in quantities.items()}}


def order(order_id, day="2026-01-06", **fields):
    base = {"order_id": order_id, "customer_id": "C1", "status": "confirmed", "currency": "PLN", "priority": "std",
            "timestamp": f"{day}T08:00:00Z", "requested_delivery_date": "2026-02-01",
            "lines": [line("1", ordered=10, allocated=4, shipped=2, backordered=0)]}
    return {**base, **fields}


def data_tree(root: Path) -> None:
    put(root, "erp/2026-01-06/customer_orders.json", [
        order("O1", lines=[line("1", ordered=10, allocated=0, shipped=2, backordered=3), line("2", ordered=5, allocated=2, shipped=0)]),
        order("O2", currency="EUR", priority=None, lines=[line("1", price=1.23455, ordered=10, allocated=4, shipped=3, backordered=0)]),
        order(""),
        order("O3", customer_id=None),
        order("O4", currency="USD", lines=[line("1", ordered=1, shipped=1), line(None), line("9", sku="unknown", ordered=1)]),
        order("O5", customer_id="nobody"),
    ])
    put(root, "erp/2026-01-07/customer_orders.json", [
        order("O1", status="open", lines=[line("2", price=20.0, ordered=6, allocated=2, shipped=1)]),
    ])
    put(root, "erp/2026-01-06/exchange_rates.json", [
        {"currency_pair": "EUR/PLN", "rate": 4.30, "simulation_date": "2026-01-05", "change_pct": 0.1},
        {"rate": 1.0}, {"currency_pair": "GBP/PLN"},
    ])
    pay = {"event_id": "P1", "simulation_date": "2026-01-08", "customer_id": "C1", "payment_amount_pln": 100,
           "payment_behaviour": "on_time", "balance_after_pln": 50}
    put(root, "erp/2026-01-06/payments.json", [
        pay, dict(reversed(list(pay.items()))), {**pay, "event_id": None}, {**pay, "event_id": None, "payment_behaviour": "odd"},
    ])
    put(root, "erp/2026-01-06/inventory_snapshots.json", [
        {"snapshot_id": "SNAP-20260106-W02", "positions": [{"sku": "V-1", "quantity_on_hand": 5, "quantity_available": 0}]},
        {"warehouse": "W01", "snapshot_id": "x", "positions": []},
        {"warehouse": "W01", "positions": [{"sku": "V-1", "quantity_on_hand": 9, "quantity_available": 9}]},
    ])
    put(root, "adm/2026-01/inventory_targets.json", [
        {"sku": "V-1", "warehouse": "W01", "safety_stock": 10, "reorder_point": 12, "target_stock": 20},
    ])
    put(root, "erp/2026-01-06/backorder_events.json", [
        {"event_id": "B1", "order_id": "O1", "order_line_id": "1", "quantity_backordered": 2000000, "escalated_to_express": True, "backorder_date": "2026-01-06"},
        {"order_id": "O1", "order_line_id": "2", "quantity_backordered": 3, "escalated_to_express": False},
    ])
    put(root, "erp/2026-01-06/production_completions.json", [
        {"event_id": "X1", "simulation_date": "2026-01-06", "sku": "V-1", "quantity": 7, "grade": "C", "production_line": 3, "warehouse": "W01", "batch_id": "LOT"},
        {"event_id": "X2", "simulation_date": "2026-01-06", "sku": "V-1", "quantity": 3, "grade": "A", "warehouse": "W01"},
    ])
    put(root, "erp/2026-01-06/production_reclassifications.json", [{"event_id": "R1", "simulation_date": "2026-01-07", "sku": "V-1", "quantity": 1}])
    put(root, "erp/2026-01-06/credit_events.json", [
        {"simulation_date": "2026-01-06", "customer_id": "C1", "event_type": "credit_hold", "exposure_pln": 25, "credit_limit_pln": 100},
    ])
    put(root, "erp/2026-01-06/master_data_changes.json", [
        {"change_id": "M1", "effective_date": "2026-01-07", "entity_type": "customer", "entity_id": "C1", "field_changed": "segment", "new_value": "gold", "old_value": None},
        {"change_id": "M2", "effective_date": "2026-01-07", "entity_type": "customer", "entity_id": "C1", "field_changed": "payment_terms_days", "new_value": {"payment_terms_days": 60}},
        {"change_id": "M3", "effective_date": "2026-01-07", "entity_type": "carrier", "entity_id": "DHL", "field_changed": "carrier_base_rate", "new_value": {"base_reliability": 0.5}},
        {"change_id": "M4", "effective_date": "2026-03-01", "entity_type": "product", "entity_id": "V-1", "field_changed": "sku_status", "new_value": "discontinued"},
    ])
    load = {"load_id": "L1", "carrier_code": "DHL", "source_warehouse_id": "W01", "status": "planned", "weight_unit": "kg", "total_weight_reported": 10, "order_ids": None}
    put(root, "tms/2026-01-08/loads_08.json", [load, {**load, "load_id": None}])
    put(root, "tms/2026-01-08/loads_14.json", [{**load, "status": "moving"}])
    put(root, "tms/2026-01-08/loads_20.json", [{**load, "status": "delivered", "weight_unit": "lbs", "total_weight_reported": 10, "order_ids": ["O1", "O9"]}])
    put(root, "tms/2026-01-09/loads_08.json", [{**load, "status": "late news"}])
    back = {"rma_id": "A1", "event_subtype": "return_requested", "order_id": "O1", "customer_id": "C1", "carrier_code": "DHL", "rma_status": "new",
            "lines": [{"line_id": "1", "sku": "V-1", "quantity_returned": 2, "quantity_accepted": 1}]}
    put(root, "tms/2026-01-10/returns.json", [{**back, "event_id": "T2"}, {**back, "event_id": "T0", "rma_id": None}])
    put(root, "tms/2026-01-09/returns.json", [{**back, "event_id": "T1"}])
    put(root, "tms/2026-01-11/returns.json", [{**back, "event_id": "T3", "event_subtype": "return_received", "lines": [{"line_id": "1", "sku": "V-1", "quantity_returned": 2, "quantity_accepted": 2}]}])
    put(root, "tms/2026-01-09/carrier_events.json", [{"event_id": "K1", "carrier_code": "DHL", "duration_days": "3", "end_date": ""}])
    put(root, "adm/2026-02/demand_plans.json", {"plan_lines": [{"product_group": "G", "customer_segment": "S", "periods": [
        {"month": "2026-03", "planned_quantity": 5}, {"month": "2026-4", "planned_quantity": 6}, {"month": None, "planned_quantity": 7}]}]})
    put(root, "forecast/2026-02/demand_forecasts.json", {"model_version": "v1", "lines": [{"sku_group": "G", "periods": [{"month": "2026-03", "forecast_quantity": 4}]}]})
    put(root, "adm/demand_signals/SIG-20260210-0001.json", {"signal_id": "S1", "confidence": 0.5})
    put(root, "adm/demand_signals/BADNAME.json", {"signal_id": "S2"})
    put(root, "erp/notes/x.json", [{"event_id": "never"}])
    put(root, "erp/2026-01-06/deep/er/payments.json", [pay])
    put(root, "other/2026-01-06/payments.json", [pay])
    put(root, "erp/2026-01-06/broken.json", '[{"event_id": "E1"}, {"event_id"')
    put(root, "erp/2026-01-06/trailing.json", '[{"event_id": "E1"}] x')
    put(root, "erp/2026-01-06/scalar.json", "5")
    put(root, "erp/2026-13-45/payments.json", [pay])
    put(root, "erp/2026-01-06/empty.json", "[]")


def master_tree(root: Path) -> None:
    put(root, "carriers.json", [{"code": "DHL", "name": "D", "base_reliability": 0.9, "transit_days_min": 1, "transit_days_max": 3}])
    put(root, "catalog.json", [{"sku": "V-1", "valve_type": "gate", "dn": 50, "base_price_pln": 10.5, "is_active": False},
                               {"sku": "V-1", "valve_type": "ball", "dn": 50, "base_price_pln": 10.5, "is_active": True}])
    put(root, "customers.json", [{"customer_id": "C1", "company_name": "ACME", "segment": "silver", "region": "N", "credit_limit": 100,
                                  "payment_terms_days": 30, "onboarding_date": "2026-01-01", "primary_address": {"city": "X"}, "shutdown_months": [7], "seasonal_profile": None}])
    put(root, "warehouses.json", [{"code": "W01", "name": "main"}, {"code": "W02", "name": "second"}])


@pytest.fixture(scope="module", autouse=True)
def tiny(spark):
    """Compiling code for a handful of rows costs more than running it."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("world")
    data_tree(base / "data")
    master_tree(base / "master")
    store = Store(spark, str(base / "store"))
    refresh = Refresh(store)
    tables = refresh.run(str(base / "data"), str(base / "master"))
    return base, store, refresh, tables


def pick(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)


def test_bronze(world):
    base, store, refresh, _ = world
    bad = {(Path(r.file_path).name, Path(r.file_path).parent.name): r.reason for r in files.quarantine(store).collect()}
    assert bad == {
        ("BADNAME.json", "demand_signals"): "no event date",
        ("broken.json", "2026-01-06"): "unreadable JSON",
        ("trailing.json", "2026-01-06"): "unreadable JSON",
        ("scalar.json", "2026-01-06"): "unreadable JSON",
        ("payments.json", "2026-13-45"): "no event date",
    }
    raw = files.raw_events(store)
    counts = {r.event_type: r["count"] for r in raw.groupBy("event_type").count().collect()}
    assert counts["payments"] == 3 and counts["customer_orders"] == 7 and counts["demand_signals"] == 1
    assert "x" not in counts and "broken" not in counts and "empty" not in counts
    dates = dict(pick(raw.where("event_type in ('demand_plans', 'demand_signals')"), "event_type", "raw_event_date"))
    assert dates == {"demand_plans": date(2026, 2, 1), "demand_signals": date(2026, 2, 10)}
    assert raw.select("raw_event_key").distinct().count() == raw.count()
    ledgered = {Path(r.file_path).name for r in files.ledger(store).collect()}
    assert "payments.json" in ledgered and not {"broken.json", "empty.json", "BADNAME.json"} & ledgered


def test_silver(world):
    _, _, refresh, _ = world
    s = refresh.staged
    assert pick(s("orders"), "order_id", "status", "_dq_flags") == [
        ("O1", "open", []), ("O2", "confirmed", ["null_priority"]), ("O4", "confirmed", []), ("O5", "confirmed", [])]
    assert [(r[0], r[1], float(r[2])) for r in pick(s("order_lines").where("order_id = 'O1'"), "line_id", "quantity_ordered", "unit_price")] == [("1", 10, 10.0), ("2", 6, 20.0)]
    assert pick(refresh.rejects(), "event_type", "reason") == [
        ("customer_orders", "null customer_id"), ("customer_orders", "null line_id"), ("customer_orders", "null order_id"),
        ("demand_plans", "null period_month")]
    assert pick(s("exchange_rates"), "currency_pair", "rate_date", "_dq_flags") == [
        ("EUR/PLN", date(2026, 1, 5), []), ("GBP/PLN", date(2026, 1, 6), ["missing_rate"]), ("UNKNOWN", date(2026, 1, 6), ["missing_currency_pair"])]
    assert pick(s("payments"), "event_id", "_dq_flags") == [("P1", []), (None, ["unexpected_payment_behaviour"]), (None, [])]
    assert pick(s("inventory_snapshots"), "warehouse_id", "_dq_flags") == [("W01", []), ("W02", ["warehouse_derived_from_snapshot_id"])]
    assert pick(s("backorder_events").where("event_id = 'B1'"), "quantity", "_dq_flags") == [(None, ["qty_overflow"])]
    assert s("backorder_events").where("event_id like 'raw:%'").count() == 1
    assert pick(s("production_completions"), "event_id", "production_line", "batch_id", "_dq_flags") == [
        ("X1", "3", "LOT", ["unexpected_grade:C"]), ("X2", None, None, [])]
    assert pick(s("loads"), "load_id", "sync_window", "status", "order_ids", "_dq_flags") == [
        ("L1", "20", "delivered", ["O1", "O9"], ["weight_converted_lbs_to_kg"])]
    assert float(s("loads").first().total_weight_kg) == 4.5359
    assert pick(s("carrier_events"), "duration_days", "end_date") == [(3, None)]
    assert pick(s("returns"), "event_id") == [("T1",), ("T2",), ("T3",)]
    assert pick(s("return_lines"), "rma_id", "line_id", "quantity_accepted") == [("A1", "1", 2)]
    assert [(r[0], float(r[1])) for r in pick(s("demand_plans"), "period_month", "planned_qty")] == [(date(2026, 3, 1), 5.0), (date(2026, 4, 1), 6.0)]
    assert pick(s("demand_signals"), "signal_id", "signal_date") == [("S1", date(2026, 2, 10))]
    assert pick(s("master_data_changes"), "change_id", "old_value", "new_value")[0] == ("M1", '{"value":null}', '{"value":"gold"}')


def test_gold(world):
    base, _, refresh, t = world
    assert pick(t["dim_customer"], "segment", "payment_terms_days", "effective_from", "effective_to", "is_current") == [
        ("gold", 60, date(2026, 1, 7), None, True), ("silver", 30, date(2026, 1, 1), date(2026, 1, 6), False)]
    assert pick(t["dim_sku"], "valve_type", "is_active", "effective_from") == [("ball", False, date(2026, 3, 1)), ("ball", True, date(2026, 1, 1))]
    assert float(t["dim_carrier"].first().base_reliability) == 0.5
    lines = {(r.order_id, r.line_id): r for r in t["fact_order_lines"].collect()}
    assert sorted(lines) == [("O1", "1"), ("O1", "2"), ("O2", "1"), ("O4", "1")]
    # Delivered: line 1 has nothing allocated, so all of it ships; line 2 ships its partial allocation.
    one, two, eur, usd = (lines[k] for k in sorted(lines))
    assert (one.order_status, one.qty_shipped, one.qty_backordered, one.is_backordered, one.is_express_escalated) == ("shipped", 10, 0, True, True)
    assert (two.qty_shipped, float(two.line_revenue_pln)) == (2, 40.0)
    # The stored price is rounded, ordinary revenue uses the exact product: 3 x (1.2346 x 4.30).
    assert (float(eur.unit_price_original), float(eur.unit_price_pln), float(eur.line_revenue_pln)) == (1.2346, 5.3088, 15.9263)
    assert (usd.fx_defaulted, float(usd.unit_price_pln)) == (True, 10.0)
    stock = {r.warehouse_id: r for r in t["fact_inventory_daily"].collect()}
    assert stock["W02"].stockout_flag and not stock["W02"].below_safety_stock
    assert stock["W01"].below_safety_stock and stock["W01"].reorder_point == 12
    assert t["fact_payments"].where("event_id like 'SYNTH-PAY-%'").count() == 2
    assert float(t["fact_credit_events"].first().utilisation_pct) == 0.25
    assert pick(t["fact_returns"], "rma_id", "event_date", "qty_accepted") == [("A1", date(2026, 1, 9), 2)]
    assert pick(t["agg_production_quality"], "production_line", "total_qty", "qty_grade_a", "reclassification_count") == [
        ("3", 7, 0, 1), ("UNKNOWN", 3, 3, 1)]
    card = t["agg_customer_scorecard"].first()
    assert (card.orders_count, card.payments_count, card.credit_hold_count) == (3, 3, 1)
    assert pick(t["agg_demand_accuracy"], "period_month", "plan_vs_forecast_variance")[0][0] == date(2026, 3, 1)
    unmatched = {name: n for name, n, _ in refresh.metrics if name.endswith(":unmatched")}
    assert unmatched["fact_order_lines:unmatched"] == 2
    source = {"fact_order_lines": "order_lines", "fact_inventory_daily": "inventory_snapshots", "fact_production": "production_completions",
              "fact_payments": "payments", "fact_credit_events": "credit_events", "fact_returns": "return_lines", "fact_shipments": "loads"}
    assert unmatched == {f"{f}:unmatched": refresh.staged(s).count() - t[f].count() for f, s in source.items()}
    counts = {name: n for name, n, _ in refresh.metrics}
    assert (counts["bronze:quarantine"], counts["bronze:empty"]) == (5, 1) and counts["bronze:event"] == files.raw_events(refresh.store).count()
    assert (counts["staging_loads:skipped"], counts["staging_returns:skipped"]) == (1, 1)
    assert (counts["master_carriers"], counts["master_catalog"], counts["master_warehouses"]) == (1, 1, 2)
    refresh.spark.sparkContext.setJobGroup("dropped", "")
    refresh.dropped()
    assert refresh.spark.sparkContext.statusTracker().getJobIdsForGroup("dropped") == []
    refresh.spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert refresh.spark.table("export_orders_with_customer_and_sku").count() == 4
    assert refresh.spark.table("export_customer_ar_flat").count() == 3
    exports.write_views(t, str(base / "views"), "csv")
    rows = refresh.spark.read.option("header", "true").csv(str(base / "views" / "carrier_performance_flat"))
    assert [(r.carrier_name, r.order_ids) for r in rows.collect()] == [("D", "O1,O9")]


def test_listings_are_ordered(world):
    """In the order asked for, over all partitions; the files of a stored table hold ranges of it."""
    _, store, refresh, tables = world
    for name, by in (("dim_date", "date_id"), ("dim_warehouse", "warehouse_code")):
        got = [r[by] for r in refresh.listed(name).collect()]
        assert got == sorted(got) and len(got) == tables[name].count()
    months = [(r.year, r.month) for r in refresh.listed("agg_cash_flow_monthly").collect()]
    assert months == sorted(months)
    spans = tables["dim_date"].groupBy(F.input_file_name()).agg(F.min("date_id"), F.max("date_id")).collect()
    spans = sorted((r[1], r[2]) for r in spans)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    report = [(r.section, r.item) for r in refresh.listed("order_fact_report").collect()]
    assert report == sorted(report) and ("fact_order_lines", "total_rows") in report


def test_second_run_adds_nothing_and_changed_files_are_absorbed(world):
    base, store, refresh, tables = world
    before = {name: df.count() for name, df in tables.items()}
    raw = files.raw_events(store).count()
    again = Refresh(store)
    tables = again.run(str(base / "data"), str(base / "master"))
    assert files.raw_events(store).count() == raw
    assert {name: df.count() for name, df in tables.items()} == before

    path = base / "data/erp/2026-01-06/payments.json"
    records = json.loads(path.read_text())
    records[0]["payment_amount_pln"] = 777
    records[1]["payment_amount_pln"] = 777
    path.write_text(json.dumps(records))
    load = base / "data/tms/2026-01-09/loads_20.json"
    put(base / "data", "tms/2026-01-09/loads_20.json", [{"load_id": "L1", "sync_window": "21", "carrier_code": "DHL",
        "source_warehouse_id": "W02", "status": "pod_received", "weight_unit": "kg", "total_weight_reported": 9, "order_ids": []}])
    third = Refresh(store)
    tables = third.run(str(base / "data"), str(base / "master"))
    assert files.raw_events(store).count() == raw + 3 + 1
    pays = pick(third.staged("payments"), "event_id", "amount")
    assert [(e, float(a)) for e, a in pays] == [("P1", 777.0), (None, 100.0), (None, 100.0)]
    # A known shipment refreshes status and weight only.
    assert [(r[0], r[1], float(r[2])) for r in pick(tables["fact_shipments"], "source_warehouse_id", "status", "total_weight_kg")] == [("W01", "pod_received", 9.0)]
    third.compact()
    assert pick(Refresh(store).staged("payments"), "event_id", "amount") == pays
    assert third.reaggregate()["agg_customer_scorecard"].count() == 1


def test_a_run_becomes_visible_as_a_whole(world, spark, monkeypatch):
    """A failure between two writes leaves readers on the old run; the next run is visible with all its tables."""
    base, store, _, _ = world
    look = lambda: {name: sorted(map(repr, df.collect())) for name, df in Refresh(store).tables().items()}
    before = look()
    put(base / "data", "erp/2026-01-12/customer_orders.json", [order("O9", day="2026-01-12")])
    broken = Refresh(store)
    monkeypatch.setattr(broken, "aggregates", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        broken.run(str(base / "data"), str(base / "master"))
    assert store.snapshot("fact_order_lines").count() == len(before["fact_order_lines"]) + 1
    assert look() == before
    done = Refresh(store)
    tables = done.run(str(base / "data"), str(base / "master"))
    after = look()
    assert len(after["fact_order_lines"]) == len(before["fact_order_lines"]) + 1 == tables["fact_order_lines"].count()
    assert after["agg_order_metrics_daily"] != before["agg_order_metrics_daily"]
    assert len(list(Path(store.folder("_published")).glob("gold=*"))) == 1
    assert done.reaggregate()["dim_date"].count() == len(before["dim_date"])
    assert look() == after


def test_one_batch_equals_many(world, spark, tmp_path):
    """Delivering the files one folder at a time ends in the same staging tables."""
    data_tree(tmp_path / "all")
    whole, parts = Refresh(Store(spark, str(tmp_path / "s1"))), Refresh(Store(spark, str(tmp_path / "s2")))
    tables = ("loads", "inventory_targets", "return_lines", "exchange_rates")
    whole.bronze(str(tmp_path / "all"))
    whole.silver(tables)
    grown = tmp_path / "grown"
    folders = sorted({p.parent for p in (tmp_path / "all").rglob("*.json")})
    for group in (folders[::2], folders[1::2]):
        for folder in group:
            for source in folder.glob("*.json"):
                put(grown, str(source.relative_to(tmp_path / "all")), source.read_text())
        parts.bronze(str(grown))
        parts.silver(tables)
    for table in tables:
        columns = [c for c in whole.staged(table).columns if c not in {"raw_event_key", "ingest_batch", "file_path", "ingested_at", "payload", "_reason", "pos", "raw_event_date"}]
        if table in ("return_lines",):  # several files write the same key: the later batch wins
            columns = ["rma_id", "line_id", "sku"]
        assert pick(whole.staged(table), *columns) == pick(parts.staged(table), *columns)


def test_streamed_files_equal_ingested_files(spark, tmp_path):
    data_tree(tmp_path / "data")
    batch, stream = Store(spark, str(tmp_path / "s1")), Store(spark, str(tmp_path / "s2"))
    files.ingest(batch, str(tmp_path / "data"))
    seen = []
    for _ in range(2):  # the second start finds nothing new
        stream_files(stream, str(tmp_path / "data"), str(tmp_path / "checkpoint"), seen.append).awaitTermination()
    columns = ["file_path", "event_type", "raw_event_date", "pos", "payload", "raw_event_key"]
    assert pick(files.raw_events(stream), *columns) == pick(files.raw_events(batch), *columns)
    assert len(seen) == 1


def test_records_do_not_depend_on_the_size_of_the_file(spark, tmp_path):
    """The same awkward records alone and in a file beyond the limit of one variant."""
    odd = ['"x"', '{"a":1}', "1e3", "12345678901234567890123456789.123", "null", "[1]", '{"b":1,"a":2}']
    filler = json.dumps({"note": "y" * (9 << 20)})
    texts = {
        "small": f"[{','.join(odd)}]",
        "large": f"[{','.join([*odd, filler])}]",
        "quotes": "[{'a':1}]",
        "largequotes": "[{'a':1}," + filler + "]",
        "trailing": '[{"a":1}] x',
        "largetrailing": f"[{filler}] x",
        "two": "[1],[2]",
    }
    folder = tmp_path / "data/erp/2026-01-06"
    folder.mkdir(parents=True)
    for name, text in texts.items():
        (folder / f"{name}.json").write_text(text)
    found = files.parse(files.discover(spark, str(tmp_path / "data"))).where("payload is null or length(payload) < 1000")
    rows = found.select("event_type", "pos", "payload", "reason").collect()
    by_name = {n: sorted((r.pos, r.payload) for r in rows if r.event_type == n) for n in texts}
    assert by_name["small"] == by_name["large"] and len(by_name["small"]) == len(odd)
    reasons = {n: {r.reason for r in rows if r.event_type == n} for n in texts}
    assert reasons["quotes"] == reasons["largequotes"] and reasons["trailing"] == reasons["largetrailing"]
    assert reasons["two"] == {"unreadable JSON"} == reasons["trailing"]


def test_roots_may_be_written_in_any_way(spark, tmp_path, monkeypatch):
    put(tmp_path / "data", "erp/2026-01-06/payments.json", [{"event_id": "E1"}])
    monkeypatch.chdir(tmp_path)
    plain = str(tmp_path / "data")
    for root in (plain, f"file://{plain}", f"file:{plain}", f"{plain}/", f"{tmp_path}//data", f"{tmp_path}/./data"):
        assert files.discover(spark, root).count() == 1, root
    with pytest.raises(FileNotFoundError):
        files.discover(spark, str(tmp_path / "nowhere"))


def test_no_length_decides_what_is_loaded(spark, tmp_path, monkeypatch):
    """Files as rows and files that are split give the same events; a second run takes in nothing."""
    data_tree(tmp_path / "data")
    columns = ["file_path", "event_type", "raw_event_date", "pos", "payload", "source_system"]
    found = []
    for longest in (1 << 26, 200):
        monkeypatch.setattr(files, "LONGEST_ROW", longest)
        store = Store(spark, str(tmp_path / f"store{longest}"))
        for _ in range(2):
            files.ingest(store, str(tmp_path / "data"))
        rows = files.raw_events(store)
        assert rows.where("ingest_batch = 2").count() == 0
        assert rows.select("raw_event_key").distinct().count() == rows.count()
        bad = files.quarantine(store).where("ingest_batch = 1")
        ledger = pick(files.ledger(store), "file_path", "row_count")
        found.append((pick(rows, *columns), pick(bad, "file_path", "reason"), ledger))
    assert found[0] == found[1]


def test_unchanged_files_are_not_read_again(spark, tmp_path):
    """The listing decides: bytes changed behind an unchanged time and length are seen on request only."""
    folder = tmp_path / "data/erp/2026-01-06"
    for name in ("payments", "orders", "loads"):
        put(tmp_path / "data", f"erp/2026-01-06/{name}.json", [{"event_id": "E1"}])
    store, root = Store(spark, str(tmp_path / "store")), str(tmp_path / "data")
    files.ingest(store, root)
    assert "content" not in files.listing(files.discover(spark, root))._jdf.queryExecution().executedPlan().toString()

    stat = (folder / "payments.json").stat()
    put(tmp_path / "data", "erp/2026-01-06/payments.json", [{"event_id": "E2"}])
    os.utime(folder / "payments.json", ns=(stat.st_atime_ns, stat.st_mtime_ns))
    os.utime(folder / "orders.json", (1, 1))  # touched: another time, the same content
    put(tmp_path / "data", "erp/2026-01-06/loads.json", [{"event_id": "E3"}])
    listed = files.listing(files.discover(spark, root))
    assert sorted(Path(r.path).name for r in files.candidates(store, listed).collect()) == ["loads.json", "orders.json"]
    files.ingest(store, root)
    assert files.raw_events(store, after=1).count() == 1
    assert files.candidates(store, listed).count() == 0  # the touched file is known under its new time
    files.ingest(store, root, verify=True)
    assert [r.payload for r in files.raw_events(store, after=2).collect()] == ['{"event_id":"E2"}']
    files.ingest(store, root, verify=True)
    assert files.raw_events(store, after=3).count() == 0


def test_stream_takes_in_rewritten_files(spark, tmp_path):
    store, root = Store(spark, str(tmp_path / "store")), str(tmp_path / "data")
    put(tmp_path / "data", "erp/2026-01-06/payments.json", [{"event_id": "E1"}])
    run = lambda: stream_files(store, root, str(tmp_path / "checkpoint")).awaitTermination()
    run()
    put(tmp_path / "data", "erp/2026-01-06/payments.json", [{"event_id": "E1 again"}])
    put(tmp_path / "data", "erp/2026-01-06/loads.json", [{"event_id": "E2"}])
    run()
    assert pick(files.raw_events(store), "ingest_batch", "payload") == [
        (1, '{"event_id":"E1"}'), (2, '{"event_id":"E1 again"}'), (2, '{"event_id":"E2"}')]


def test_master_files(spark, tmp_path):
    from millrace.sources.master import read_master

    master_tree(tmp_path)
    row = read_master(spark, str(tmp_path), "customers").first()
    assert (row.primary_address, row.shutdown_months, row.seasonal_profile) == ('{"city":"X"}', "[7]", None)
    assert read_master(spark, str(tmp_path), "catalog").first().valve_type == "ball"


def test_masters_keep_what_a_later_file_lacks_and_reject_a_broken_one(spark, tmp_path):
    from millrace.sources import master

    store = Store(spark, str(tmp_path / "store"))
    master_tree(tmp_path / "m")
    master.store_all(store, str(tmp_path / "m"), 1)
    before = {r.code for r in master.stored(store, "carriers").collect()}
    carriers = next((tmp_path / "m").rglob("carriers.json"))
    rows = json.loads(carriers.read_text())
    folder = str(carriers.parent)
    carriers.write_text(json.dumps([{**rows[0], "code": "NEW"}]))
    master.store_all(store, folder, 2)
    assert {r.code for r in master.stored(store, "carriers").collect()} == before | {"NEW"}
    carriers.write_text(json.dumps(rows)[:-9])
    with pytest.raises(Exception):
        master.store_all(store, folder, 3)
    assert {r.code for r in master.stored(store, "carriers").collect()} == before | {"NEW"}

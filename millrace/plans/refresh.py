"""The whole refresh: files to raw events, staging, dimensions, facts, aggregates and views."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, functions as F

from ..session import tune
from ..sources import files, master
from ..sources.store import Store
from . import aggregates, dims, exports, facts, reports, silver
from .facts import Horizon

METRICS = "run_metrics"
RUN = "gold"  # name under which finished runs are published
DIMENSIONS = ("dim_date", "dim_customer", "dim_sku", "dim_carrier", "dim_warehouse")
FACTS = (
    "fact_order_lines", "fact_inventory_daily", "fact_production", "fact_payments", "fact_credit_events", "fact_shipments",
    "fact_returns",
)
AGGREGATES = (
    "agg_order_metrics_daily", "agg_customer_scorecard", "agg_sku_performance", "agg_inventory_health",
    "agg_carrier_scorecard", "agg_demand_accuracy", "agg_cash_flow_monthly", "agg_production_quality",
)
GOLD = DIMENSIONS + FACTS + AGGREGATES
# Tables that are stored and listed in an order of their own.
ORDER = {
    "dim_date": ["date_id"],
    "dim_carrier": ["carrier_code"],
    "dim_warehouse": ["warehouse_code"],
    "agg_order_metrics_daily": ["agg_date"],
    "agg_cash_flow_monthly": ["year", "month"],
}


def _name(table: str) -> str:
    return f"staging_{table}"


def _found(seen: Observation, wait: float = 2.0) -> dict | None:
    """What was observed inside a job that has ended; None if the plan left that part out.

    `Observation.get` waits for good for a part that was left out, so this looks first. The listener that fills in
    the figures may be a moment behind the job.
    """
    until = time.monotonic() + wait
    while not seen._jo.getRowOrEmpty().isDefined():
        if time.monotonic() > until:
            return None
        time.sleep(0.01)
    return seen.get


class Refresh:
    """One run over a store. Every written table is observed: rows and newest date, no extra scan."""

    def __init__(self, store: Store, horizon: Horizon = Horizon(), parallel_jobs: int = 4) -> None:
        self.store = store
        self.parallel_jobs = parallel_jobs
        self.spark = tune(store.spark)
        self.horizon = horizon
        self.metrics: list[tuple[str, int, str | None]] = []
        self._sources: dict[str, tuple[str, Observation]] = {}  # staging table under each fact, and its rows

    def _observed(self, table: str, df: DataFrame) -> tuple[DataFrame, Observation]:
        seen = Observation(table)
        days = [F.col(name) for name, type_ in df.dtypes if type_ == "date"]
        newest = F.max(days[0] if days else F.lit(None).cast("date")).cast("string")
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), newest.alias("newest")), seen

    def _note(self, table: str, seen: Observation) -> None:
        found = seen.get
        self.metrics.append((table, int(found["rows"]), found.get("newest")))

    def _counted(self, name: str, count: int) -> None:
        self.metrics.append((name, int(count), None))

    def _source(self, fact: str, table: str) -> DataFrame:
        """The staging table whose rows a fact is made of; its rows are counted in the fact's own job."""
        seen = Observation(f"{fact}:staged")
        self._sources[fact] = (table, seen)
        return self.staged(table).observe(seen, F.count(F.lit(1)).alias("rows"))

    def _snapshot(self, table: str, df: DataFrame, batch: int) -> DataFrame:
        watched, seen = self._observed(table, df)
        self.store.add_snapshot(table, watched, batch, ORDER.get(table, ()))
        self._note(table, seen)
        return self.store.snapshot(table, upto=batch)

    def _together(self, work: Callable[[str], object], names: Iterable[str]) -> dict[str, object]:
        """Submit independent jobs side by side, so short ones fill what long ones leave idle."""
        names = list(names)
        with ThreadPoolExecutor(self.parallel_jobs) as pool:
            results = list(pool.map(inheritable_thread_target(self.spark)(work), names))
        return dict(zip(names, results))

    def _snapshots(self, plans: Mapping[str, DataFrame], batch: int) -> dict[str, DataFrame]:
        return self._together(lambda name: self._snapshot(name, plans[name], batch), plans)

    # --- bronze and silver ---------------------------------------------------------------------

    def bronze(self, data_dir: str) -> int:
        return files.ingest(self.store, data_dir, note=lambda status, n: self._counted(f"bronze:{status}", n))

    def silver(self, tables: Iterable[str] = tuple(silver.SPECS)) -> None:
        """Stage the raw events each table has not seen; only they are read."""
        upto = self.store.last_batch(files.LEDGER)

        def stage(table: str) -> None:
            after = self.store.last_batch(_name(table))
            raw = files.raw_events(self.store, after) if after < upto else None
            if raw is None:
                return
            # Good rows and rejects leave one pass, unshuffled; keys are merged when they are read.
            skipped = Observation(f"{_name(table)}:skipped") if silver.SPECS[table].skip else None
            rows = silver.stage(raw, table, skipped).withColumn("ingested_at", F.current_timestamp())
            watched, seen = self._observed(_name(table), rows)
            self.store.add_batch(_name(table), watched, upto)
            self._note(_name(table), seen)
            if skipped is not None:
                self._counted(f"{_name(table)}:skipped", (_found(skipped) or {}).get("skipped") or 0)

        self._together(stage, tables)

    def rejects(self) -> DataFrame:
        """All rejects, once per event and reason, with the time they were found."""
        found = []
        for table in silver.SPECS:
            rows = self.store.batches(_name(table))
            if rows is not None:
                found.append(silver.rejected(rows.withColumnRenamed("ingested_at", "rejected_at"), "rejected_at"))
        return silver.distinct_rejects(found)

    def staged(self, table: str) -> DataFrame:
        """A staging table as it stands: its batches merged by the table's rule."""
        rows = self.store.rows(_name(table))
        if rows is None:
            rows = silver.stage(self.spark.createDataFrame([], files.RAW_SCHEMA), table)
        return silver.merge(None, silver.accepted(rows, table), table)

    def compact(self) -> None:
        """Fold the batches of every staging table into a snapshot, and those of raw events, ledger and masters."""
        for table in silver.SPECS:
            last = self.store.last_batch(_name(table))
            if last:
                self.store.add_snapshot(_name(table), self.staged(table), last)
        files.compact(self.store)
        for name in master.SCHEMAS:
            master.compact(self.store, name)

    # --- gold ----------------------------------------------------------------------------------

    def dimensions(self, master_dir: str, batch: int) -> dict[str, DataFrame]:
        master.store_all(self.store, master_dir, batch, note=lambda name, n: self._counted(f"master_{name}", n))
        m = {name: master.stored(self.store, name) for name in master.SCHEMAS}
        changes = self.staged("master_data_changes")
        h = self.horizon
        plans = {
            "dim_date": dims.dim_date(self.spark, h.low, h.high),
            "dim_customer": dims.dim_customer(m["customers"], dims.customer_changes(changes)),
            "dim_sku": dims.dim_sku(m["catalog"], dims.sku_changes(changes)),
            "dim_carrier": dims.dim_carrier(m["carriers"], dims.reliability_overrides(changes)),
            "dim_warehouse": dims.dim_warehouse(m["warehouses"]),
        }
        return self._snapshots(plans, batch)

    def facts(self, t: Mapping[str, DataFrame], batch: int) -> dict[str, DataFrame]:
        s, h = self.staged, self.horizon
        own = self._source
        previous = self.store.snapshot("fact_shipments", before=batch, upto=self._visible())
        fresh = facts.shipments(own("fact_shipments", "loads"), t["dim_carrier"], t["dim_warehouse"], h)
        plans = {
            "fact_order_lines": facts.fact_order_lines(
                s("orders"), own("fact_order_lines", "order_lines"), s("exchange_rates"), t["dim_customer"], t["dim_sku"],
                s("backorder_events"), s("loads"), h,
            ),
            "fact_inventory_daily": facts.fact_inventory_daily(
                own("fact_inventory_daily", "inventory_snapshots"), s("inventory_targets"), t["dim_sku"], t["dim_warehouse"], h
            ),
            "fact_production": facts.fact_production(
                own("fact_production", "production_completions"), t["dim_sku"], t["dim_warehouse"], h
            ),
            "fact_payments": facts.fact_payments(own("fact_payments", "payments"), t["dim_customer"], h),
            "fact_credit_events": facts.fact_credit_events(own("fact_credit_events", "credit_events"), t["dim_customer"], h),
            "fact_shipments": facts.fact_shipments(previous, fresh),
            "fact_returns": facts.fact_returns(
                own("fact_returns", "return_lines"), s("returns"), t["dim_customer"], t["dim_sku"], t["dim_carrier"], h
            ),
        }
        return self._snapshots(plans, batch)

    def aggregates(self, t: Mapping[str, DataFrame], batch: int) -> dict[str, DataFrame]:
        s = self.staged
        lines, stock, back = t["fact_order_lines"], t["fact_inventory_daily"], t["fact_returns"]
        paid, credit = t["fact_payments"], t["fact_credit_events"]
        plans = {
            "agg_order_metrics_daily": aggregates.order_metrics_daily(lines),
            "agg_customer_scorecard": aggregates.customer_scorecard(t["dim_customer"], lines, back, paid, credit),
            "agg_sku_performance": aggregates.sku_performance(t["dim_sku"], lines, stock, back),
            "agg_inventory_health": aggregates.inventory_health(stock, t["dim_warehouse"]),
            "agg_carrier_scorecard": aggregates.carrier_scorecard(t["dim_carrier"], t["fact_shipments"], s("returns")),
            "agg_demand_accuracy": aggregates.demand_accuracy(s("demand_plans"), s("demand_forecasts")),
            "agg_cash_flow_monthly": aggregates.cash_flow_monthly(lines, paid, credit),
            "agg_production_quality": aggregates.production_quality(
                t["fact_production"], t["dim_date"], s("production_reclassifications")
            ),
        }
        return self._snapshots(plans, batch)

    def dropped(self) -> list[tuple[str, int, str | None]]:
        """Staging rows that found no dimension version, per fact: both counts come from the job that wrote the fact.

        Where Spark could leave the staging side out of that job (another side was empty), its rows are counted now.
        """
        written = {name: n for name, n, _ in self.metrics}
        out = []
        for fact, (table, seen) in self._sources.items():
            found = _found(seen)
            rows = found["rows"] if found else self.staged(table).count()
            out.append((f"{fact}:unmatched", rows - written[fact], None))
        return out

    def gold(self, master_dir: str, batch: int) -> dict[str, DataFrame]:
        tables = self.dimensions(master_dir, batch)
        tables |= self.facts(tables, batch)
        tables |= self.aggregates(tables, batch)
        return tables

    # --- what readers see ------------------------------------------------------------------------

    def _visible(self) -> int | None:
        """The published run; None for a store that has none (its tables count as they stand)."""
        return self.store.published(RUN) or None

    def _next(self) -> int:
        """A run number above all that any table has, so a run never writes into a folder somebody reads."""
        return 1 + max([self.store.published(RUN), *(self.store.last_batch(name) for name in GOLD)])

    def tables(self) -> dict[str, DataFrame]:
        """The gold tables of the newest finished run. A run that failed half-way leaves them as they were."""
        found = {name: self.store.snapshot(name, upto=self._visible()) for name in GOLD}
        return {name: df for name, df in found.items() if df is not None}

    def listed(self, table: str) -> DataFrame:
        """A gold table in its order, or a report as a listing by section and item."""
        tables = self.tables()
        if table in ORDER:
            return tables[table].orderBy(*ORDER[table])
        build = {
            "dimension_report": reports.dimension_report,
            "aggregate_report": reports.aggregate_report,
            "order_fact_report": lambda t: reports.order_fact_report(t["fact_order_lines"]),
        }
        return build[table](tables).orderBy("section", "item")

    def _publish(self, run: int) -> dict[str, DataFrame]:
        self.store.publish(RUN, run)
        tables = self.tables()
        exports.register_views(tables)
        return tables

    def reaggregate(self) -> dict[str, DataFrame]:
        """Rebuild only the aggregates and views from the facts as they are."""
        run = self._next()
        self.aggregates(self.tables(), run)
        return self._publish(run)

    def run(self, data_dir: str, master_dir: str) -> dict[str, DataFrame]:
        """Everything, in order. Returns the gold tables."""
        batch = self.bronze(data_dir)
        self.silver()
        run = self._next()
        self.gold(master_dir, run)
        tables = self._publish(run)
        self.metrics += self.dropped()
        rows = self.spark.createDataFrame(self.metrics, "table_name string, row_count bigint, newest string")
        self.store.add_batch(METRICS, rows.withColumns({"run": F.lit(run), "batch": F.lit(batch)}), run)
        return tables

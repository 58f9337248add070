"""The benchmark tables seen as the supply-chain model.

Pure input mapping: orders and lineitem become orders, lines, loads, returns, stock and
production; events become payments and credit events; customer, part, nation and region become
master data. Everything below stays lazy and reads only the columns it maps.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.calendar import calendar, days_between
from ..operators import upsert_guarded, upsert_latest
from ..sources.arrays import stored
from ..plans import aggregates, dims, facts
from ..session import tune

# The calendar the benchmark tables run on. Some orders lie after it on purpose.
HORIZON = facts.Horizon(date(1995, 1, 1), date(2000, 12, 31))
SKU_SEED = date(1995, 6, 1)

LINE_VERSION = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]

# What the order, SKU and customer aggregates read of facts that more than one of them needs.
MEASURES = {
    "fact_order_lines": [
        "order_id",
        "sku",
        "customer_id",
        "order_date",
        "line_revenue_pln",
        "qty_shipped",
        "qty_ordered",
        "qty_backordered",
        "is_express_escalated",
    ],
    "fact_returns": ["customer_id", "sku", "qty_returned"],
}


class Model:
    """All canonical tables over one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")
        self._kept: set[str] = set()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- master data -------------------------------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        rows = self.table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        return rows.selectExpr(
            "concat('CUST-', c_custkey) AS customer_id",
            "c_name AS company_name",
            "c_mktsegment AS segment",
            "n_name AS country_code",
            "r_name AS region",
            "cast(c_acctbal AS decimal(15,4)) AS credit_limit",
            "30 AS payment_terms_days",
            "'PLN' AS currency",
            "concat('CARR-', c_custkey % 7) AS preferred_carrier",
            "cast((c_custkey % 20) * 0.01 AS decimal(6,4)) AS contract_discount_pct",
            "true AS active",
            "CASE WHEN c_custkey % 10 = 0 THEN date'1998-01-01' ELSE date'1994-01-01' END AS onboarding_date",
        )

    @cached_property
    def customer_changes(self) -> DataFrame:
        return self.table("orders").where("o_orderstatus = 'P'").selectExpr(
            "concat('CUST-', o_custkey) AS customer_id",
            "cast(o_orderdate AS date) AS change_date",
            "CASE WHEN o_orderkey % 2 = 0 THEN named_struct('value', o_orderpriority) END AS segment",
            "CASE WHEN o_orderkey % 2 <> 0 THEN named_struct('value', cast(30 + o_orderkey % 60 AS int)) END"
            " AS payment_terms_days",
            "o_orderkey AS seq",
        )

    @cached_property
    def catalog(self) -> DataFrame:
        return self.table("part").selectExpr(
            "concat('SKU-', p_partkey) AS sku",
            "p_type AS valve_type",
            "p_size AS dn",
            "p_brand AS material",
            "concat('PN', p_size % 4) AS pressure_class",
            "p_name AS connection",
            "CASE WHEN p_size % 2 = 0 THEN 'manual' ELSE 'electric' END AS actuation",
            "p_size * 0.25 AS weight_kg",
            "p_retailprice AS base_price_pln",
            "cast(NULL AS double) AS base_price_eur",
            "true AS is_active",
        )

    @cached_property
    def sku_changes(self) -> DataFrame:
        rows = self.table("lineitem").where("l_returnflag = 'R' AND l_quantity >= 49")
        return rows.selectExpr(
            "concat('SKU-', l_partkey) AS sku",
            "cast(l_shipdate AS date) AS change_date",
            "named_struct('value', false) AS is_active",
            "l_orderkey AS seq",
        )

    @cached_property
    def carriers(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "concat('CARR-', n_nationkey) AS code",
            "n_name AS name",
            "0.9 AS base_reliability",
            "1 AS transit_days_min",
            "n_regionkey + 3 AS transit_days_max",
            "CASE WHEN n_nationkey % 2 = 0 THEN 'low' ELSE 'high' END AS cost_tier",
            "'road' AS primary_use",
            "CASE WHEN n_nationkey % 2 = 0 THEN 'kg' ELSE 'lbs' END AS weight_unit",
        )

    @cached_property
    def carrier_overrides(self) -> DataFrame:
        """Suppliers report a new reliability for the carrier of their nation; the last one counts."""
        doc = F.expr("to_json(named_struct('base_reliability', cast(s_suppkey % 100 * 0.01 AS decimal(4,3))))")
        empty = F.lit('{"note":"no figure"}')
        reports = self.table("supplier").select(
            F.expr("concat('CARR-', s_nationkey)").alias("entity_id"),
            F.lit("carrier").alias("entity_type"),
            F.lit("carrier_base_rate").alias("change_type"),
            F.when(F.col("s_acctbal") < 0, empty).otherwise(doc).alias("new_value"),
            F.expr("date_add(date'1996-01-01', cast(s_suppkey % 365 AS int))").alias("change_date"),
            F.col("s_suppkey").alias("pos"),
        )
        return dims.reliability_overrides(reports)

    @cached_property
    def warehouses(self) -> DataFrame:
        return self.table("region").selectExpr(
            "concat('W', r_regionkey) AS code",
            "r_name AS name",
            "lower(r_name) AS city",
            "'PL' AS country_code",
            "CASE WHEN r_regionkey = 0 THEN 'central' ELSE 'regional' END AS role",
            "0.2 AS inventory_share",
        )

    # --- staging tables ----------------------------------------------------------------------

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "concat('ORD-', o_orderkey) AS order_id",
            "concat('CUST-', o_custkey) AS customer_id",
            "CASE o_orderstatus WHEN 'F' THEN 'open' WHEN 'P' THEN 'cancelled' ELSE 'confirmed' END AS status",
            "CASE o_custkey % 3 WHEN 0 THEN 'PLN' WHEN 1 THEN 'EUR' ELSE 'USD' END AS currency",
            "o_orderpriority AS priority",
            "o_orderdate AS order_timestamp",
            "cast(NULL AS date) AS simulation_date",
            "date_add(cast(o_orderdate AS date), 14) AS requested_delivery_date",
            "CASE WHEN o_orderkey % 2 = 0 THEN 'web' ELSE 'phone' END AS sales_channel",
            "'DAP' AS incoterms",
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        """Lines of an order; the benchmark repeats line numbers, the newest version stays."""
        rows = self.table("lineitem").selectExpr(
            "concat('ORD-', l_orderkey) AS order_id", "cast(l_linenumber AS string) AS line_id", *LINE_VERSION
        )
        rows = upsert_latest(None, rows, ["order_id", "line_id"], [F.col(c) for c in LINE_VERSION])
        return rows.selectExpr(
            "order_id",
            "line_id",
            "concat('SKU-', l_partkey) AS sku",
            "cast(cast(l_extendedprice AS decimal(15,2)) AS decimal(15,4)) AS unit_price",
            "cast(l_quantity AS int) AS quantity_ordered",
            "CASE WHEN l_returnflag = 'N' THEN cast(floor(l_quantity / 2) AS int) ELSE 0 END AS quantity_allocated",
            "CASE WHEN l_returnflag = 'R' THEN cast(l_quantity AS int) ELSE 0 END AS quantity_shipped",
            "CASE WHEN l_returnflag = 'A' THEN cast(floor(l_quantity / 4) AS int) ELSE 0 END AS quantity_backordered",
        )

    @cached_property
    def rates(self) -> DataFrame:
        days = self.table("orders").select(F.col("o_orderdate").cast("date").alias("rate_date")).distinct()
        fixing = days.where(F.dayofmonth("rate_date").isin(1, 8, 15, 22))
        currencies = F.explode(F.expr("array(named_struct('c', 'EUR', 'k', 0), named_struct('c', 'USD', 'k', 13))"))
        rows = fixing.select("rate_date", currencies.alias("m")).where("m.c = 'EUR' OR year(rate_date) >= 1996")
        return rows.selectExpr(
            "rate_date",
            "concat(m.c, '/PLN') AS currency_pair",
            "CASE WHEN day(rate_date) = 22 AND month(rate_date) = 6 THEN NULL ELSE cast(4 + ((year(rate_date) * 372"
            " + month(rate_date) * 31 + day(rate_date) + m.k) % 97) * 0.01 AS decimal(15,6)) END AS rate",
        )

    @cached_property
    def backorders(self) -> DataFrame:
        return self.table("lineitem").where("l_returnflag = 'A'").selectExpr(
            "concat('ORD-', l_orderkey) AS order_id",
            "cast(l_linenumber AS string) AS order_line_id",
            "l_quantity >= 40 AS escalated_to_express",
        )

    def _raw_reports(self) -> DataFrame:
        """Status reports of loads; a load is what one supplier ships for one order."""
        return self.table("lineitem").selectExpr(
            "cast(l_shipdate AS date) AS load_date",
            *("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", "l_quantity", "l_linestatus"),
        )

    @staticmethod
    def _report(raw: DataFrame) -> DataFrame:
        return raw.selectExpr(
            "concat('LOAD-', l_orderkey, '-', l_suppkey) AS load_id",
            "CASE l_linenumber % 3 WHEN 0 THEN '08' WHEN 1 THEN '14' ELSE '20' END AS sync_window",
            "load_date",
            "concat('CARR-', l_suppkey % 7) AS carrier_code",
            "concat('W', l_suppkey % 3) AS source_warehouse_id",
            "concat('REGION-', l_suppkey % 5) AS destination_region",
            "CASE WHEN l_linestatus = 'F' THEN 'delivered' ELSE 'in_transit' END AS status",
            "cast(l_quantity AS decimal(12,4)) AS total_weight_kg",
            "cast(NULL AS array<string>) AS shipment_ids",
            "CASE WHEN l_linenumber = 1 THEN array(concat('ORD-', l_orderkey), concat('ORD-', l_orderkey + 1))"
            " ELSE array(concat('ORD-', l_orderkey)) END AS order_ids",
            "cast(NULL AS array<string>) AS customer_ids",
            "l_linenumber",
            "l_partkey",
            "l_quantity",
            "l_linestatus",
        )

    @cached_property
    def load_reports(self) -> DataFrame:
        return self._report(self._raw_reports())

    LOAD_ORDER = ["load_date", "l_linenumber", "l_partkey", "l_quantity", "l_linestatus"]

    @cached_property
    def loads(self) -> DataFrame:
        """The report that counts is found on the bare columns; ids, arrays and texts are made of it afterwards."""
        window = F.expr("CASE l_linenumber % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END")  # in the order of the windows' names
        order = [F.col(c) for c in self.LOAD_ORDER]
        newest = upsert_guarded(None, self._raw_reports(), ["l_suppkey", "l_orderkey"], [window], order)
        return self._report(newest).drop("l_linenumber", "l_partkey", "l_quantity", "l_linestatus")

    def _raw_returns(self) -> DataFrame:
        lines = self.table("lineitem").where("l_returnflag = 'R'").selectExpr(
            "cast(l_shipdate AS date) AS event_date",
            *("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus"),
        )
        buyers = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        return lines.join(buyers, "l_orderkey")

    @cached_property
    def returns(self) -> DataFrame:
        """The newest report of an event is found on the bare columns that its id consists of; the texts are made afterwards."""
        keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        order = [F.col("event_date"), F.col("l_quantity").cast("int")]
        newest = upsert_latest(None, self._raw_returns().drop("l_linestatus"), keys, order)
        return newest.selectExpr(
            "concat('RET-', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS event_id",
            "event_date",
            "concat('RMA-', l_orderkey) AS rma_id",
            "CASE WHEN l_linenumber % 2 = 1 THEN 'return_requested' ELSE 'return_received' END AS event_subtype",
            "concat('ORD-', l_orderkey) AS order_id",
            "concat('CUST-', o_custkey) AS customer_id",
            "CASE WHEN l_suppkey % 11 <> 0 THEN concat('CARR-', l_suppkey % 7) END AS carrier_code",
        )

    @cached_property
    def return_lines(self) -> DataFrame:
        order = ["event_date", "cast(l_partkey AS string)", "cast(l_quantity AS int)", "l_linestatus"]
        newest = upsert_latest(None, self._raw_returns().drop("l_suppkey", "o_custkey"), ["l_orderkey", "l_linenumber"], [F.expr(c) for c in order])
        return newest.selectExpr(
            "concat('RMA-', l_orderkey) AS rma_id",
            "cast(l_linenumber AS string) AS line_id",
            "concat('SKU-', l_partkey) AS sku",
            "cast(l_quantity AS int) AS quantity_returned",
            "cast(floor(l_quantity / 2) AS int) AS quantity_accepted",
            "l_linestatus AS return_reason",
            "cast(NULL AS string) AS resolution",
        )

    @cached_property
    def snapshots(self) -> DataFrame:
        keyed = self.table("lineitem").selectExpr(
            "cast(l_shipdate AS date) AS snapshot_date",
            "concat('W', l_suppkey % 3) AS warehouse_id",
            "concat('SKU-', l_partkey) AS sku",
            "cast(l_quantity AS bigint) AS q",
            "l_linestatus",
        )
        return keyed.groupBy("snapshot_date", "warehouse_id", "sku").agg(
            F.sum("q").cast("int").alias("qty_on_hand"),
            F.coalesce(F.sum(F.when(F.col("l_linestatus") == "F", F.col("q"))), F.lit(0)).cast("int").alias("qty_allocated"),
            F.coalesce(F.sum(F.when(F.col("l_linestatus") == "O", F.col("q"))), F.lit(0)).cast("int").alias("qty_available"),
        )

    @cached_property
    def targets(self) -> DataFrame:
        rows = self.table("lineitem").where("l_partkey % 4 <> 0").selectExpr(
            "concat('SKU-', l_partkey) AS sku",
            "concat('W', l_suppkey % 3) AS warehouse_id",
            "trunc(cast(l_shipdate AS date), 'MM') AS target_month",
            "l_partkey",
        )
        # A SKU is one part. Grouped by the columns that facts join on, the rows are dealt out for that join already.
        return rows.groupBy("sku", "warehouse_id", "target_month").agg(F.max("l_partkey").alias("l_partkey")).selectExpr(
            "target_month",
            "sku",
            "warehouse_id",
            "cast(l_partkey % 20 + 5 AS int) AS safety_stock",
            "cast(l_partkey % 30 + 10 AS int) AS reorder_point",
            "cast(l_partkey % 50 + 40 AS int) AS target_stock",
        )

    @cached_property
    def completions(self) -> DataFrame:
        rows = self.table("lineitem").selectExpr(
            "concat('PRD-', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS event_id",
            "cast(l_shipdate AS date) AS completion_date",
            "cast(l_quantity AS int) AS quantity",
            "CASE WHEN l_returnflag = 'R' THEN 'B' ELSE 'A' END AS grade",
            *("l_orderkey", "l_partkey", "l_suppkey"),
        )
        order = [F.col(c) for c in ("completion_date", "quantity", "grade")]
        return upsert_latest(None, rows, ["event_id"], order).selectExpr(
            "event_id",
            "completion_date",
            "concat('B-', l_orderkey) AS batch_id",
            "concat('SKU-', l_partkey) AS sku",
            "quantity",
            "grade",
            "CASE WHEN l_suppkey % 5 <> 0 THEN concat('L', l_suppkey % 5) END AS production_line",
            "concat('W', l_suppkey % 3) AS warehouse_id",
        )

    @cached_property
    def reclassifications(self) -> DataFrame:
        """Half of the return events make their SKU's lot change grade."""
        return self.returns_raw_dates.where("event_subtype = 'return_received'").select(
            "sku", F.col("event_date").alias("reclassification_date")
        )

    @cached_property
    def returns_raw_dates(self) -> DataFrame:
        return self.table("lineitem").where("l_returnflag = 'R'").selectExpr(
            "concat('SKU-', l_partkey) AS sku",
            "cast(l_shipdate AS date) AS event_date",
            "CASE WHEN l_linenumber % 2 = 1 THEN 'return_requested' ELSE 'return_received' END AS event_subtype",
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self.table("events").where("event_type = 'purchase'").selectExpr(
            "concat('EV-', event_id) AS event_id",
            "cast(ts AS date) AS payment_date",
            "concat('CUST-', user_id) AS customer_id",
            "cast(value AS decimal(15,4)) AS amount",
            "CASE event_id % 4 WHEN 0 THEN 'on_time' WHEN 1 THEN 'late' WHEN 2 THEN 'very_late' ELSE 'other' END"
            " AS payment_behaviour",
            "cast(value * 3 AS decimal(15,4)) AS balance_before",
            "cast(value * 2 AS decimal(15,4)) AS balance_after",
        )

    @cached_property
    def credit_events(self) -> DataFrame:
        return self.table("events").where("event_type = 'error'").selectExpr(
            "concat('EV-', event_id) AS event_id",
            "cast(ts AS date) AS event_date",
            "concat('CUST-', user_id) AS customer_id",
            "CASE WHEN event_id % 3 = 0 THEN 'credit_hold' ELSE 'credit_ok' END AS event_subtype",
            "cast(value * 2 AS decimal(15,4)) AS customer_balance",
            "cast(value * 4 AS decimal(15,4)) AS open_order_value",
            "cast(CASE WHEN event_id % 11 = 0 THEN 0 ELSE 1000 END AS decimal(15,4)) AS credit_limit",
            "cast(value AS decimal(15,4)) AS exposure",
        )

    def _monthly_quantity(self, day: str, name: str) -> DataFrame:
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
        if day == "o_orderdate":
            heads = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
            lines = lines.join(heads, "l_orderkey")
        month = F.trunc(F.col(day).cast("date"), "MM").alias("period_month")
        quantity = F.col("l_quantity").cast("decimal(15,4)")
        per_part = lines.groupBy("l_partkey", month).agg(F.sum(quantity).alias("q"))
        brands = self.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("product_group"))
        return per_part.join(brands, "l_partkey").groupBy("product_group", "period_month").agg(
            F.sum("q").cast("decimal(15,4)").alias(name)
        )

    @cached_property
    def plans(self) -> DataFrame:
        rows = self._monthly_quantity("o_orderdate", "planned_qty")
        return rows.withColumns(
            {
                "confidence_low": (F.col("planned_qty") - 5).cast("decimal(15,4)"),
                "confidence_high": (F.col("planned_qty") + 5).cast("decimal(15,4)"),
            }
        )

    @cached_property
    def forecasts(self) -> DataFrame:
        rows = self._monthly_quantity("l_shipdate", "forecast_qty")
        return rows.withColumns(
            {
                "lower_bound": (F.col("forecast_qty") - 3).cast("decimal(15,4)"),
                "upper_bound": (F.col("forecast_qty") + 3).cast("decimal(15,4)"),
            }
        )

    def _keep(self, *histories: str) -> None:
        """Write dimensions down once, as a run does: several facts look them up, and what is small is known to be small."""
        for name in histories:
            if name not in self._kept:
                self._kept.add(name)
                self.__dict__[name] = stored(getattr(self, name), name)

    def keep_measures(self) -> None:
        """Write down once what the aggregates read of the facts, for queries that build several of them."""
        self._keep("dim_customer", "dim_sku", "rates")
        for name, columns in MEASURES.items():
            if name not in self._kept:
                self._kept.add(name)
                self.__dict__[name] = stored(getattr(self, name).select(*columns), name)

    # --- gold --------------------------------------------------------------------------------

    @cached_property
    def dim_date(self) -> DataFrame:
        """Calendar over the whole years the orders span."""
        span = self.table("orders").agg(
            F.trunc(F.min("o_orderdate").cast("date"), "YEAR").alias("low"),
            F.date_sub(F.add_months(F.trunc(F.max("o_orderdate").cast("date"), "YEAR"), 12), 1).alias("high"),
        )
        return calendar(days_between(span))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.dim_customer(self.customers, self.customer_changes)

    @cached_property
    def dim_sku(self) -> DataFrame:
        return dims.dim_sku(self.catalog, self.sku_changes, SKU_SEED)

    @cached_property
    def dim_carrier(self) -> DataFrame:
        return dims.dim_carrier(self.carriers, self.carrier_overrides)

    @cached_property
    def dim_warehouse(self) -> DataFrame:
        return dims.dim_warehouse(self.warehouses)

    @cached_property
    def fact_order_lines(self) -> DataFrame:
        return facts.fact_order_lines(
            self.orders, self.order_lines, self.rates, self.dim_customer, self.dim_sku,
            self.backorders, self.loads, HORIZON,
        )

    @cached_property
    def fact_inventory_daily(self) -> DataFrame:
        return facts.fact_inventory_daily(
            self.snapshots, self.targets, self.dim_sku, self.dim_warehouse, HORIZON
        )

    @cached_property
    def fact_production(self) -> DataFrame:
        return facts.fact_production(self.completions, self.dim_sku, self.dim_warehouse, HORIZON)

    @cached_property
    def fact_payments(self) -> DataFrame:
        return facts.fact_payments(self.payments, self.dim_customer, HORIZON)

    @cached_property
    def fact_credit_events(self) -> DataFrame:
        return facts.fact_credit_events(self.credit_events, self.dim_customer, HORIZON)

    @cached_property
    def fact_shipments(self) -> DataFrame:
        self._keep("dim_carrier")
        fresh = facts.shipments(self.loads, self.dim_carrier, self.dim_warehouse, HORIZON)
        return facts.fact_shipments(None, fresh)

    @cached_property
    def fact_returns(self) -> DataFrame:
        self._keep("dim_carrier")
        return facts.fact_returns(
            self.return_lines, self.returns, self.dim_customer, self.dim_sku, self.dim_carrier, HORIZON
        )

    @cached_property
    def agg_order_metrics_daily(self) -> DataFrame:
        return aggregates.order_metrics_daily(self.fact_order_lines)

    @cached_property
    def agg_customer_scorecard(self) -> DataFrame:
        self._keep("dim_customer", "dim_sku", "rates")
        return aggregates.customer_scorecard(
            self.dim_customer, self.fact_order_lines, self.fact_returns, self.fact_payments, self.fact_credit_events
        )

    @cached_property
    def agg_sku_performance(self) -> DataFrame:
        return aggregates.sku_performance(
            self.dim_sku, self.fact_order_lines, self.fact_inventory_daily, self.fact_returns
        )

    @cached_property
    def agg_inventory_health(self) -> DataFrame:
        return aggregates.inventory_health(self.fact_inventory_daily, self.dim_warehouse)

    @cached_property
    def agg_carrier_scorecard(self) -> DataFrame:
        self._keep("dim_carrier")
        return aggregates.carrier_scorecard(self.dim_carrier, self.fact_shipments, self.returns)

    @cached_property
    def agg_demand_accuracy(self) -> DataFrame:
        return aggregates.demand_accuracy(self.plans, self.forecasts)

    @cached_property
    def agg_cash_flow_monthly(self) -> DataFrame:
        return aggregates.cash_flow_monthly(self.fact_order_lines, self.fact_payments, self.fact_credit_events)

    @cached_property
    def agg_production_quality(self) -> DataFrame:
        return aggregates.production_quality(self.fact_production, self.dim_date, self.reclassifications)

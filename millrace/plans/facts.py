"""Fact tables.

Each fact is one logical plan over staging tables and dimensions. Dimension versions are found
with `interval_join`; what does not depend on the lines (customer version, exchange rate, shipped
flag) is attached to the orders first, which are far fewer rows than their lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import MONEY, in_calendar, month_floor, packed, ratio, surrogate_key, unpacked
from ..operators import Buckets, first_per_key, interval_join, upsert_partial, with_validity
from .dims import CALENDAR

DELIVERED = ["delivered", "pod_received"]


@dataclass(frozen=True)
class Horizon:
    """Calendar bounds, and how finely as-of joins cut the time axis."""

    low: date = CALENDAR[0]
    high: date = CALENDAR[1]
    version_days: int = 366
    rate_days: int = 31
    buckets: Buckets = field(init=False)
    rate_buckets: Buckets = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "buckets", Buckets(self.low, self.high, self.version_days))
        object.__setattr__(self, "rate_buckets", Buckets(self.low, self.high, self.rate_days))

    def date_id(self, day: Column) -> Column:
        return in_calendar(day, F.lit(self.low), F.lit(self.high))


# A surrogate key is a digest, which no shuffle compresses. The version's first day goes along instead, and the key is
# made of it where the fact is put together.
def _customer(facts: DataFrame, dim: DataFrame, day: str, h: Horizon, also: Sequence[str] = ()) -> DataFrame:
    """Version of the row's customer on the day; rows without one are dropped."""
    values = {"__customer_from": "effective_from"} | {name: name for name in also}
    return interval_join(facts, dim, [("customer_id", "customer_id")], day, values, h.buckets)


def _customer_key() -> Column:
    return surrogate_key(F.col("customer_id"), F.col("__customer_from")).alias("dim_customer_id")


def _sku(facts: DataFrame, dim: DataFrame, day: str, h: Horizon, also: Sequence[str] = ()) -> DataFrame:
    values = {"__sku_from": "effective_from"} | {name: name for name in also}
    return interval_join(facts, dim, [("sku", "sku")], day, values, h.buckets)


def _sku_key() -> Column:
    return surrogate_key(F.col("sku"), F.col("__sku_from")).alias("dim_sku_id")


def _warehouse(facts: DataFrame, dim: DataFrame, column: str = "warehouse_id") -> DataFrame:
    side = dim.select(F.col("warehouse_code").alias(column), "dim_warehouse_id")
    return facts.join(side, column)


def _carrier(facts: DataFrame, dim: DataFrame) -> DataFrame:
    return facts.join(dim.select("carrier_code", "dim_carrier_id"), "carrier_code")


def _with_lineage(df: DataFrame, columns: list[Column | str]) -> DataFrame:
    """Keep the raw event reference where the input has one (adapted tables have none)."""
    lineage = [c for c in ("raw_order_event", "raw_line_event", "raw_event_key") if c in df.columns]
    return df.select(*lineage, *columns)


def _rename_lineage(df: DataFrame, name: str) -> DataFrame:
    return df.withColumnRenamed("raw_event_key", name)


def delivered_orders(loads: DataFrame) -> DataFrame:
    """Ids of the orders that some delivered load carries."""
    ids = loads.where(F.col("status").isin(DELIVERED)).select(F.explode("order_ids").alias("order_id"))
    return ids.distinct().withColumn("__delivered", F.lit(True))


def escalated_lines(backorders: DataFrame) -> DataFrame:
    lines = backorders.where("escalated_to_express").select(
        "order_id", F.col("order_line_id").alias("line_id")
    )
    return lines.distinct().withColumn("__escalated", F.lit(True))


def with_rate(orders: DataFrame, rates: DataFrame, day: str, h: Horizon) -> DataFrame:
    """`fx_rate` to PLN: the newest rate on or before the day.

    PLN needs none (NULL). A currency without a rate, or whose newest rate is NULL, counts 1.0
    and sets `fx_defaulted`.
    """
    pair = F.concat(F.col("currency"), F.lit("/PLN"))
    foreign = ~F.col("currency").eqNullSafe(F.lit("PLN"))
    valid = with_validity(rates.select("currency_pair", "rate_date", "rate"), ["currency_pair"], "rate_date")
    joined = interval_join(
        orders.withColumn("__pair", F.when(foreign, pair)),
        valid,
        [("__pair", "currency_pair")],
        day,
        {"__rate": "rate"},
        h.rate_buckets,
        how="left",
        start="valid_from",
        end="valid_to",
    )
    one = F.lit(1).cast("decimal(15,6)")
    return (
        joined.withColumn("fx_rate", F.when(foreign, F.coalesce("__rate", one)))
        .withColumn("fx_defaulted", foreign & F.col("__rate").isNull())
        .drop("__pair", "__rate")
    )


def priced_orders(
    orders: DataFrame,
    rates: DataFrame,
    dim_customer: DataFrame,
    loads: DataFrame | None,
    h: Horizon,
    also: Sequence[str] = (),
    texts: Sequence[str] = (),
) -> DataFrame:
    """Order headers with everything that all their lines share; the columns `texts` are put into one, `__texts`."""
    heads = orders.withColumn(
        "__day", F.coalesce("simulation_date", F.to_date("order_timestamp"))
    )
    heads = with_rate(_customer(heads, dim_customer, "__day", h, also), rates, "__day", h)
    if texts:
        heads = heads.withColumn("__texts", packed(texts)).drop(*texts)
    if loads is None:
        return heads.withColumn("__delivered", F.lit(None).cast("boolean"))
    return heads.join(delivered_orders(loads), "order_id", "left")


def fact_order_lines(
    orders: DataFrame,
    order_lines: DataFrame,
    rates: DataFrame,
    dim_customer: DataFrame,
    dim_sku: DataFrame,
    backorders: DataFrame | None,
    loads: DataFrame | None,
    h: Horizon = Horizon(),
    customer_also: Sequence[str] = (),
    sku_also: Sequence[str] = (),
) -> DataFrame:
    """Order lines priced in PLN, with the lines of delivered orders marked as shipped.

    `customer_also` (texts) and `sku_also` name further columns of the two histories that come along with the versions.
    """
    # What nothing here looks at goes from the orders through both shuffles of the lines as one text.
    texts = [*customer_also, "priority", "sales_channel", "incoterms"]
    heads = priced_orders(_rename_lineage(orders, "raw_order_event"), rates, dim_customer, loads, h, customer_also, texts)
    heads = heads.drop("ingest_batch", "raw_event_date", "file_path", "pos", "_dq_flags", "_bad_values", "ingested_at")
    lines = _rename_lineage(order_lines, "raw_line_event")
    lines = lines.drop("ingest_batch", "raw_event_date", "file_path", "pos", "_dq_flags", "_bad_values", "ingested_at")
    if backorders is None:
        lines = lines.withColumn("__escalated", F.lit(None).cast("boolean"))
    else:
        lines = lines.join(escalated_lines(backorders), ["order_id", "line_id"], "left")
    rows = lines.join(heads, "order_id")

    price = F.when(F.col("currency") == "PLN", F.col("unit_price").cast("decimal(30,10)")).otherwise(
        F.col("unit_price") * F.col("fx_rate")
    )
    ordered, allocated = F.col("quantity_ordered"), F.col("quantity_allocated")
    ship = (
        F.coalesce("__delivered", F.lit(False))
        & ~F.col("status").eqNullSafe(F.lit("shipped"))
        & ~F.col("status").eqNullSafe(F.lit("cancelled"))
    )
    shipped = F.when((allocated > 0) & (allocated < ordered), F.least(ordered, allocated)).otherwise(
        ordered
    )
    rows = rows.withColumns({"__price": price, "__ship": ship, "__shipped": shipped}).withColumn(
        "unit_price_pln", F.col("__price").cast(MONEY)
    )
    # Ordinary lines multiply the exact price, shipped ones the stored (rounded) price.
    revenue = F.when(
        F.col("__ship"), F.col("__shipped").cast("decimal(10,0)") * F.col("unit_price_pln")
    ).otherwise((F.col("quantity_shipped").cast("decimal(8,0)") * F.col("__price")))
    is_ship = F.col("__ship")
    # Measures are made before the lines are dealt out by SKU: what they are made of (rate, currency, status, quantities) stays
    # behind where the reader does not ask for it.
    rows = _with_lineage(
        rows,
        [
            "__day",
            "__customer_from",
            "order_id",
            "line_id",
            "sku",
            "customer_id",
            F.to_date("order_timestamp").alias("order_date"),
            "requested_delivery_date",
            F.when(is_ship, "shipped").otherwise(F.col("status")).alias("order_status"),
            "currency",
            ordered.alias("qty_ordered"),
            F.when(is_ship, 0).otherwise(allocated).alias("qty_allocated"),
            F.when(is_ship, F.col("__shipped")).otherwise(F.col("quantity_shipped")).alias("qty_shipped"),
            F.when(is_ship, 0).otherwise(F.col("quantity_backordered")).alias("qty_backordered"),
            F.col("unit_price").alias("unit_price_original"),
            "unit_price_pln",
            revenue.cast(MONEY).alias("line_revenue_pln"),
            (F.col("quantity_backordered") > 0).alias("is_backordered"),
            F.coalesce("__escalated", F.lit(False)).alias("is_express_escalated"),
            "fx_defaulted",
            "__texts",
        ],
    )
    part = unpacked(F.col("__texts"), texts)
    shown = {
        "order_status": ["order_status", part["priority"].alias("order_priority")],
        "currency": ["currency", part["sales_channel"].alias("sales_channel"), part["incoterms"].alias("incoterms")],
        "__texts": [part[name].alias(name) for name in customer_also],
    }
    rest = [c for name in rows.columns[rows.columns.index("order_id") :] for c in shown.get(name, [name])]
    return _with_lineage(
        _sku(rows, dim_sku, "__day", h, sku_also),
        [h.date_id(F.col("__day")).alias("dim_date_id"), _customer_key(), _sku_key(), *rest, *sku_also],
    )


def fact_inventory_daily(
    snapshots: DataFrame,
    targets: DataFrame,
    dim_sku: DataFrame,
    dim_warehouse: DataFrame,
    h: Horizon = Horizon(),
    sku_also: Sequence[str] = (),
) -> DataFrame:
    """Stock per day with its targets; `sku_also` names further columns of the SKU history that come along."""
    rows = _warehouse(_sku(snapshots, dim_sku, "snapshot_date", h, sku_also), dim_warehouse)
    goals = targets.select(
        F.col("target_month").alias("__month"),
        "sku",
        "warehouse_id",
        "safety_stock",
        "reorder_point",
        "target_stock",
    )
    rows = rows.withColumn("__month", month_floor(F.col("snapshot_date")))
    rows = rows.join(goals, ["sku", "warehouse_id", "__month"], "left")
    below = F.coalesce(F.col("qty_available") < F.col("safety_stock"), F.lit(False))
    return _with_lineage(
        rows,
        [
            h.date_id(F.col("snapshot_date")).alias("dim_date_id"),
            _sku_key(),
            "dim_warehouse_id",
            "snapshot_date",
            "sku",
            "warehouse_id",
            "qty_on_hand",
            "qty_allocated",
            "qty_available",
            "safety_stock",
            "reorder_point",
            "target_stock",
            (F.col("qty_available") == 0).alias("stockout_flag"),
            below.alias("below_safety_stock"),
            *sku_also,
        ],
    )


def fact_production(
    completions: DataFrame, dim_sku: DataFrame, dim_warehouse: DataFrame, h: Horizon = Horizon()
) -> DataFrame:
    rows = _warehouse(_sku(completions, dim_sku, "completion_date", h), dim_warehouse)
    return _with_lineage(
        rows,
        [
            h.date_id(F.col("completion_date")).alias("dim_date_id"),
            _sku_key(),
            "dim_warehouse_id",
            "event_id",
            "completion_date",
            "batch_id",
            "sku",
            F.col("quantity").alias("qty_completed"),
            "grade",
            "production_line",
            "warehouse_id",
        ],
    )


def fact_payments(payments: DataFrame, dim_customer: DataFrame, h: Horizon = Horizon()) -> DataFrame:
    """Payments; one without an event id gets a synthetic one from its raw event."""
    rows = _customer(payments, dim_customer, "payment_date", h)
    event_id = F.col("event_id")
    if "raw_event_key" in rows.columns:
        event_id = F.coalesce(event_id, F.concat(F.lit("SYNTH-PAY-"), F.col("raw_event_key")))
    return _with_lineage(
        rows,
        [
            h.date_id(F.col("payment_date")).alias("dim_date_id"),
            _customer_key(),
            event_id.alias("event_id"),
            "payment_date",
            "customer_id",
            F.col("amount").alias("amount_pln"),
            "payment_behaviour",
            "balance_before",
            "balance_after",
        ],
    )


def fact_credit_events(events: DataFrame, dim_customer: DataFrame, h: Horizon = Horizon()) -> DataFrame:
    rows = _customer(events, dim_customer, "event_date", h)
    used = F.when(F.col("credit_limit") > 0, ratio(F.col("exposure"), F.col("credit_limit")))
    return _with_lineage(
        rows,
        [
            h.date_id(F.col("event_date")).alias("dim_date_id"),
            _customer_key(),
            "event_id",
            "event_date",
            "customer_id",
            "event_subtype",
            "customer_balance",
            "open_order_value",
            "credit_limit",
            "exposure",
            used.alias("utilisation_pct"),
        ],
    )


def shipments(
    loads: DataFrame, dim_carrier: DataFrame, dim_warehouse: DataFrame, h: Horizon = Horizon()
) -> DataFrame:
    rows = _warehouse(_carrier(loads, dim_carrier), dim_warehouse, "source_warehouse_id")
    return _with_lineage(
        rows,
        [
            h.date_id(F.col("load_date")).alias("dim_date_id"),
            "dim_carrier_id",
            "dim_warehouse_id",
            "load_id",
            "load_date",
            "carrier_code",
            "source_warehouse_id",
            "destination_region",
            "status",
            "total_weight_kg",
            "shipment_ids",
            "order_ids",
            "customer_ids",
        ],
    )


def fact_shipments(existing: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """Known loads refresh only status and weight; everything else keeps its first-loaded value."""
    return upsert_partial(existing, fresh, ["load_id"], ["status", "total_weight_kg"])


def first_requests(returns: DataFrame) -> DataFrame:
    """Earliest return request per RMA."""
    order = [F.col("event_date").asc_nulls_last()]
    arrival = [c for c in ("ingest_batch", "raw_event_date", "file_path", "pos") if c in returns.columns]
    order += [F.col(c).asc() for c in (arrival or ["event_id"])]
    asked = returns.where(F.col("event_subtype") == "return_requested")
    return first_per_key(asked, ["rma_id"], order)


def fact_returns(
    return_lines: DataFrame,
    returns: DataFrame,
    dim_customer: DataFrame,
    dim_sku: DataFrame,
    dim_carrier: DataFrame,
    h: Horizon = Horizon(),
) -> DataFrame:
    """Return lines under the first request of their RMA; rows without a carrier are dropped."""
    heads = first_requests(returns)
    lineage = ["raw_event_key"] if "raw_event_key" in heads.columns else []
    heads = heads.select(
        *lineage, "rma_id", "event_date", "event_subtype", "order_id", "customer_id", "carrier_code"
    )
    heads = _carrier(_customer(heads, dim_customer, "event_date", h), dim_carrier)
    lines = return_lines.select(
        "rma_id", "line_id", "sku", "quantity_returned", "quantity_accepted", "return_reason", "resolution"
    )
    rows = _sku(lines.join(heads, "rma_id"), dim_sku, "event_date", h)
    return _with_lineage(
        rows,
        [
            h.date_id(F.col("event_date")).alias("dim_date_id"),
            _customer_key(),
            _sku_key(),
            "dim_carrier_id",
            "rma_id",
            "line_id",
            "order_id",
            "customer_id",
            "sku",
            "event_date",
            "event_subtype",
            F.col("quantity_returned").alias("qty_returned"),
            F.col("quantity_accepted").alias("qty_accepted"),
            "return_reason",
            "resolution",
        ],
    )

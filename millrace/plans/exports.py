"""Flat reporting views: facts with today's dimension attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .facts import Horizon, fact_inventory_daily, fact_order_lines


CUSTOMER = ("company_name", "segment", "country_code", "region")
ORDERED_SKU = ("valve_type", "dn", "material", "pressure_class")
STOCKED_SKU = ("valve_type", "dn", "material")


def with_current(dim: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """A history whose versions all show today's `names` of their key; a fact that looks its version up has both at once.

    A key has at most one version per calendar day, and the history is already dealt out by key: no further shuffle.
    """
    now = F.max(F.when(F.col("is_current"), F.struct(*names))).over(Window.partitionBy(key))
    rows = dim.select(key, "effective_from", "effective_to", now.alias("__now")).where(F.col("__now").isNotNull())
    return rows.select(key, "effective_from", "effective_to", "__now.*")


def orders_with_customer_and_sku(order_lines: DataFrame, dim_customer: DataFrame, dim_sku: DataFrame) -> DataFrame:
    customers = dim_customer.where("is_current").select("customer_id", *CUSTOMER)
    skus = dim_sku.where("is_current").select("sku", *ORDERED_SKU)
    return order_lines.join(customers, "customer_id").join(skus, "sku")


def fresh_orders_with_customer_and_sku(
    orders: DataFrame,
    order_lines: DataFrame,
    rates: DataFrame,
    dim_customer: DataFrame,
    dim_sku: DataFrame,
    backorders: DataFrame | None,
    loads: DataFrame | None,
    h: Horizon = Horizon(),
) -> DataFrame:
    """`orders_with_customer_and_sku` over a fact that is not stored: the attributes come with the versions, so the wide
    rows are not shuffled once more by customer and once more by SKU."""
    return fact_order_lines(
        orders, order_lines, rates, with_current(dim_customer, "customer_id", CUSTOMER),
        with_current(dim_sku, "sku", ORDERED_SKU), backorders, loads, h, CUSTOMER, ORDERED_SKU,
    )


def _with_warehouse_name(inventory: DataFrame, dim_warehouse: DataFrame) -> DataFrame:
    names = dim_warehouse.select(
        F.col("warehouse_code").alias("warehouse_id"), F.col("name").alias("warehouse_name")
    )
    return inventory.join(names, "warehouse_id")


def inventory_daily_flat(inventory: DataFrame, dim_sku: DataFrame, dim_warehouse: DataFrame) -> DataFrame:
    skus = dim_sku.where("is_current").select("sku", *STOCKED_SKU)
    return _with_warehouse_name(inventory.join(skus, "sku"), dim_warehouse)


def fresh_inventory_daily_flat(
    snapshots: DataFrame, targets: DataFrame, dim_sku: DataFrame, dim_warehouse: DataFrame, h: Horizon = Horizon()
) -> DataFrame:
    """`inventory_daily_flat` over a fact that is not stored, likewise."""
    skus = with_current(dim_sku, "sku", STOCKED_SKU)
    return _with_warehouse_name(
        fact_inventory_daily(snapshots, targets, skus, dim_warehouse, h, STOCKED_SKU), dim_warehouse
    )


def carrier_performance_flat(shipments: DataFrame, dim_carrier: DataFrame) -> DataFrame:
    carriers = dim_carrier.select(
        "carrier_code",
        F.col("name").alias("carrier_name"),
        "base_reliability",
        "transit_days_min",
        "transit_days_max",
        "cost_tier",
    )
    return shipments.join(carriers, "carrier_code")


def demand_accuracy_flat(demand_accuracy: DataFrame) -> DataFrame:
    return demand_accuracy.select("*")


def customer_ar_flat(payments: DataFrame, dim_customer: DataFrame) -> DataFrame:
    customers = dim_customer.where("is_current").select(
        "customer_id", "company_name", "segment", "region", "credit_limit", "payment_terms_days"
    )
    return payments.join(customers, "customer_id")


def build_views(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All views over the gold tables."""
    return {
        "orders_with_customer_and_sku": orders_with_customer_and_sku(
            t["fact_order_lines"], t["dim_customer"], t["dim_sku"]
        ),
        "inventory_daily_flat": inventory_daily_flat(
            t["fact_inventory_daily"], t["dim_sku"], t["dim_warehouse"]
        ),
        "carrier_performance_flat": carrier_performance_flat(t["fact_shipments"], t["dim_carrier"]),
        "demand_accuracy_flat": demand_accuracy_flat(t["agg_demand_accuracy"]),
        "customer_ar_flat": customer_ar_flat(t["fact_payments"], t["dim_customer"]),
    }


def register_views(t: Mapping[str, DataFrame], prefix: str = "export_") -> list[str]:
    """Create or replace the views in the session."""
    names = []
    for name, frame in build_views(t).items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names


def write_views(t: Mapping[str, DataFrame], folder: str, file_format: str = "parquet") -> None:
    """Write every view as files; `file_format="csv"` is for spreadsheets (arrays become text)."""
    for name, frame in build_views(t).items():
        if file_format == "csv":
            arrays = {c: F.array_join(c, ",") for c, type_ in frame.dtypes if type_.startswith("array")}
            frame = frame.withColumns(arrays) if arrays else frame
        writer = frame.write.mode("overwrite").format(file_format)
        writer.option("header", "true").save(f"{folder.rstrip('/')}/{name}")

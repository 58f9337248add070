"""Dimensions: calendar, customers and SKUs with history, carriers and warehouses."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import payload as p
from ..functions.calendar import calendar, days_between
from ..functions.scalars import MONEY, surrogate_key
from ..operators import first_per_key, scd2_build

CALENDAR = (date(2026, 1, 1), date(2027, 12, 31))
SKU_SEED_DATE = date(2026, 1, 1)


def dim_date(spark: SparkSession, low: date = CALENDAR[0], high: date = CALENDAR[1]) -> DataFrame:
    bounds = spark.range(1).select(F.lit(low).alias("low"), F.lit(high).alias("high"))
    return calendar(days_between(bounds))


def customer_changes(changes: DataFrame) -> DataFrame:
    """Master-data changes as customer version points."""
    doc = p.parsed(F.col("new_value"))
    segment, terms = F.col("change_type") == "segment", F.col("change_type") == "payment_terms_days"
    return changes.where((F.col("entity_type") == "customer") & (segment | terms)).select(
        F.col("entity_id").alias("customer_id"),
        "change_date",
        F.when(segment, p.override(doc, "segment", "string")).alias("segment"),
        F.when(terms, p.override(doc, "payment_terms_days", "int")).alias("payment_terms_days"),
        *_order(changes),
    )


def _order(df: DataFrame) -> list[Column]:
    names = [c for c in ("ingest_batch", "raw_event_date", "file_path", "pos") if c in df.columns]
    return [F.col(c) for c in names] or [F.col("change_id")]


def dim_customer(customers: DataFrame, changes: DataFrame) -> DataFrame:
    """Customer history by segment and payment terms; `changes` as from `customer_changes`."""
    seed = customers.select(
        "customer_id",
        "company_name",
        "segment",
        "country_code",
        "region",
        F.col("credit_limit").cast(MONEY).alias("credit_limit"),
        F.col("payment_terms_days").cast("int").alias("payment_terms_days"),
        "currency",
        "preferred_carrier",
        F.col("contract_discount_pct").cast("decimal(6,4)").alias("contract_discount_pct"),
        "active",
        F.col("onboarding_date").cast("date").alias("onboarding_date"),
    )
    seq = _seq_columns(changes, {"customer_id", "change_date", "segment", "payment_terms_days"})
    history = scd2_build(
        seed,
        changes,
        "customer_id",
        "onboarding_date",
        "change_date",
        ["segment", "payment_terms_days"],
        seq,
    )
    return history.withColumn(
        "dim_customer_id", surrogate_key(F.col("customer_id"), F.col("effective_from"))
    )


def _seq_columns(changes: DataFrame, known: set[str]) -> list[Column]:
    return [F.col(c) for c in changes.columns if c not in known]


def sku_changes(changes: DataFrame) -> DataFrame:
    """Every SKU status change opens an inactive version, whatever its new value."""
    wanted = (F.col("entity_type") == "product") & (F.col("change_type") == "sku_status")
    return changes.where(wanted).select(
        F.col("entity_id").alias("sku"),
        "change_date",
        F.struct(F.lit(False).alias("value")).alias("is_active"),
        *_order(changes),
    )


def dim_sku(catalog: DataFrame, changes: DataFrame, seed_date: date = SKU_SEED_DATE) -> DataFrame:
    """SKU history by status; `changes` as from `sku_changes`."""
    seed = catalog.select(
        "sku",
        "valve_type",
        F.col("dn").cast("int").alias("dn"),
        "material",
        "pressure_class",
        "connection",
        "actuation",
        F.col("weight_kg").cast("decimal(10,3)").alias("weight_kg"),
        F.col("base_price_pln").cast(MONEY).alias("base_price_pln"),
        F.col("base_price_eur").cast(MONEY).alias("base_price_eur"),
        "is_active",
        F.lit(seed_date).alias("seed_date"),
    )
    seq = _seq_columns(changes, {"sku", "change_date", "is_active"})
    history = scd2_build(seed, changes, "sku", "seed_date", "change_date", ["is_active"], seq)
    return history.drop("seed_date").withColumn(
        "dim_sku_id", surrogate_key(F.col("sku"), F.col("effective_from"))
    )


def reliability_overrides(changes: DataFrame) -> DataFrame:
    """Latest reliability per carrier out of the base-rate changes that carry one."""
    doc = p.parsed(F.col("new_value"))
    wanted = (F.col("entity_type") == "carrier") & (F.col("change_type") == "carrier_base_rate")
    found = changes.where(wanted).select(
        F.col("entity_id").alias("carrier_code"),
        F.coalesce(
            p.number(doc, "base_reliability", "decimal(4,3)"),
            p.number(doc, "value", "decimal(4,3)"),
        ).alias("reliability"),
        "change_date",
        *_order(changes),
    )
    found = found.where(F.col("reliability").isNotNull())
    order = [F.col("change_date").desc_nulls_last(), *[c.desc() for c in _order(changes)]]
    return first_per_key(found, ["carrier_code"], order).select("carrier_code", "reliability")


def dim_carrier(carriers: DataFrame, overrides: DataFrame) -> DataFrame:
    """Carriers as they are now; an override replaces the master's reliability."""
    base = carriers.select(
        F.col("code").alias("carrier_code"),
        "name",
        F.col("base_reliability").cast("decimal(4,3)").alias("base_reliability"),
        F.col("transit_days_min").cast("int").alias("transit_days_min"),
        F.col("transit_days_max").cast("int").alias("transit_days_max"),
        "cost_tier",
        "primary_use",
        "weight_unit",
        F.lit(True).alias("is_current"),
    )
    joined = base.join(overrides, "carrier_code", "left")
    return (
        joined.withColumn("base_reliability", F.coalesce("reliability", "base_reliability"))
        .drop("reliability")
        .withColumn("dim_carrier_id", surrogate_key(F.col("carrier_code")))
    )


def dim_warehouse(warehouses: DataFrame) -> DataFrame:
    return warehouses.select(
        surrogate_key(F.col("code")).alias("dim_warehouse_id"),
        F.col("code").alias("warehouse_code"),
        "name",
        "city",
        "country_code",
        "role",
        F.col("inventory_share").cast("decimal(4,3)").alias("inventory_share"),
    )

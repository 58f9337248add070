"""Master data files: carriers, catalog, customers, warehouses (arrays of objects)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators import upsert_latest
from .store import Store

# The fields of the four input files, their keys, and which fields are nested.
SCHEMAS = {
    "carriers": """code string, name string, base_reliability decimal(10,6), transit_days_min int,
        transit_days_max int, cost_tier string, primary_use string, weight_unit string""",
    "catalog": """sku string, valve_type string, dn int, material string, pressure_class string,
        connection string, actuation string, weight_kg decimal(18,6), base_price_pln decimal(18,6),
        base_price_eur decimal(18,6), is_active boolean""",
    "customers": """customer_id string, company_name string, segment string, country_code string,
        region string, primary_address variant, secondary_address variant, credit_limit decimal(18,6),
        payment_terms_days int, currency string, preferred_carrier string,
        contract_discount_pct decimal(12,6), ordering_profile variant, seasonal_profile variant,
        shutdown_months variant, accepts_deliveries_december boolean, active boolean,
        onboarding_date date""",
    "warehouses": """code string, name string, city string, country_code string, role string,
        inventory_share decimal(10,6)""",
}
KEYS = {"carriers": "code", "catalog": "sku", "customers": "customer_id", "warehouses": "code"}
NESTED = ["primary_address", "secondary_address", "ordering_profile", "seasonal_profile", "shutdown_months"]


def read_master(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One master file; nested customer fields become JSON text, a repeated key keeps one row.

    A file that is cut short or has a value of the wrong type raises an error.
    """
    reader = spark.read.schema(SCHEMAS[name]).option("multiLine", "true").option("mode", "FAILFAST")
    rows = reader.json(f"{folder.rstrip('/')}/{name}.json")
    if name == "customers":
        texts = {c: F.when(~F.is_variant_null(c), F.to_json(F.col(c))) for c in NESTED}
        rows = rows.withColumns(texts)
    key = KEYS[name]
    rows = rows.where(F.col(key).isNotNull())
    # Repeated keys: the last one in the file. A file is one partition, so its rows are numbered in order.
    packed = F.struct(*[F.col(c) for c in rows.columns])
    latest = rows.select(key, packed.alias("row"), F.monotonically_increasing_id().alias("n"))
    return latest.groupBy(key).agg(F.max_by("row", "n").alias("row")).select("row.*")


def read_all(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_master(spark, folder, name) for name in SCHEMAS}


def store_all(store: Store, folder: str, batch: int, note: Callable[[str, int], None] | None = None) -> None:
    """Take in one delivery of the four files. Nothing is stored unless all four can be read.

    `note` is told the rows of each file, counted while it is read.
    """
    number = F.lit(batch).cast("bigint")
    delivery = {name: rows.withColumn("delivery", number) for name, rows in read_all(store.spark, folder).items()}
    for name, rows in delivery.items():
        seen = Observation(name)
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
        if note is not None:
            note(name, seen.get["rows"])
    for name, rows in delivery.items():
        store.add_batch(f"master_{name}", rows, batch)


def stored(store: Store, name: str) -> DataFrame:
    """A master table over all deliveries: the newest row of each key. A key that a later file lacks stays."""
    return newest(store.rows(f"master_{name}"), name)


def compact(store: Store, name: str) -> int:
    """Fold the deliveries of a master table; a folder keeps the newest row of each key."""
    keys = [KEYS[name]]
    return store.fold(f"master_{name}", merge=lambda rows: upsert_latest(None, rows, keys, [F.col("delivery")]))


def newest(rows: DataFrame, name: str) -> DataFrame:
    return upsert_latest(None, rows, [KEYS[name]], [F.col("delivery")]).drop("delivery")

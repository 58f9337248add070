"""Data-quality reports: one row per check, computed in one pass over each table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

# The calendar days spot-checked after a load.
SPOT_DAYS = [date(2026, 1, 1), date(2026, 4, 6), date(2026, 5, 1), date(2026, 12, 25)]


def _melt(df: DataFrame, section: str, measures: dict[str, Column]) -> DataFrame:
    """Aggregate measures to rows (section, item, value)."""
    row = df.agg(*[m.cast("decimal(30,4)").alias(name) for name, m in measures.items()])
    pairs = [F.struct(F.lit(name).alias("item"), F.col(name).alias("value")) for name in measures]
    return row.select(F.lit(section).alias("section"), F.inline(F.array(*pairs)))


def order_fact_report(order_lines: DataFrame) -> DataFrame:
    """Totals, missing keys and prices, shipped figures, and average price per currency.

    Totals and the per-currency figures come out of one grouping: counts and sums per currency
    are a handful of rows, and the totals are their sum.
    """
    per = order_lines.groupBy("currency").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("dim_customer_id").isNull()).alias("no_customer"),
        F.count_if(F.col("unit_price_pln").isNull()).alias("no_price"),
        F.count("unit_price_pln").alias("priced"),
        F.sum("unit_price_pln").alias("price_sum"),
        F.count_if("is_express_escalated").alias("escalated"),
        F.sum("line_revenue_pln").alias("revenue"),
        F.sum("qty_shipped").alias("shipped"),
        F.count_if(F.col("order_status") == "shipped").alias("shipped_lines"),
    )
    wide = "decimal(30,4)"
    average = (F.col("price_sum").cast("decimal(28,4)") / F.nullif(F.col("priced"), F.lit(0))).cast(wide)

    def entry(item: Column, value: Column) -> Column:
        return F.struct(item.alias("item"), value.cast(wide).alias("value"))

    name = F.coalesce("currency", F.lit("none"))
    totals = {
        "total_rows": "n",
        "null_dim_customer_id": "no_customer",
        "null_unit_price_pln": "no_price",
        "express_escalated": "escalated",
        "total_revenue_pln": "revenue",
        "total_shipped": "shipped",
        "shipped_lines": "shipped_lines",
    }
    items = [entry(F.lit(item), F.col(column)) for item, column in totals.items()]
    items += [
        entry(F.concat(F.lit("rows:"), name), F.col("n")),
        entry(F.concat(F.lit("avg_unit_price_pln:"), name), average),
    ]
    rows = per.select(F.inline(F.array(*items)))
    return rows.groupBy("item").agg(F.sum("value").cast(wide).alias("value")).select(
        F.lit("fact_order_lines").alias("section"), "item", "value"
    )


def dimension_report(t: Mapping[str, DataFrame], spot_days: list[date] = SPOT_DAYS) -> DataFrame:
    """Calendar spot checks and the row counts of every dimension."""
    days = t["dim_date"]
    calendar = _melt(days, "dim_date", {"rows": F.count(F.lit(1))})
    flag = {
        "holiday": F.col("is_polish_public_holiday").cast("int"),
        "business": F.col("is_business_day").cast("int"),
    }
    items = [
        F.struct(
            F.concat(F.date_format("date_id", "yyyy-MM-dd"), F.lit(f" {name}")).alias("item"),
            value.cast("decimal(30,4)").alias("value"),
        )
        for name, value in flag.items()
    ]
    spots = days.where(F.col("date_id").isin(spot_days)).select(
        F.lit("dim_date").alias("section"), F.inline(F.array(*items))
    )
    customers = _melt(
        t["dim_customer"],
        "dim_customer",
        {"total": F.count(F.lit(1)), "current": F.count_if("is_current")},
    )
    skus = _melt(
        t["dim_sku"],
        "dim_sku",
        {"discontinued": F.count_if(F.col("is_current") & ~F.col("is_active"))},
    )
    carriers = t["dim_carrier"].select(
        F.lit("dim_carrier").alias("section"),
        F.col("carrier_code").alias("item"),
        F.col("base_reliability").cast("decimal(30,4)").alias("value"),
    )
    warehouses = t["dim_warehouse"].select(
        F.lit("dim_warehouse").alias("section"),
        F.concat_ws(": ", "warehouse_code", "name").alias("item"),
        F.lit(None).cast("decimal(30,4)").alias("value"),
    )
    out = calendar
    for part in (spots, customers, skus, carriers, warehouses):
        out = out.unionByName(part)
    return out


def aggregate_report(t: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of the aggregates and the sanity figures of the customer scorecard."""
    n = F.count(F.lit(1))
    rate = F.col("fill_rate")
    rows = [
        _melt(t["agg_order_metrics_daily"], "agg_order_metrics_daily", {"rows": n}),
        _melt(t["agg_sku_performance"], "agg_sku_performance", {"rows": n}),
        _melt(
            t["agg_customer_scorecard"],
            "agg_customer_scorecard",
            {
                "rows": n,
                "total_revenue_pln": F.sum("revenue_pln_total"),
                "avg_fill_rate": F.sum(rate).cast("decimal(20,4)") / F.nullif(F.count(rate), F.lit(0)),
                "customers_with_revenue": F.count_if(rate > 0),
            },
        ),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def table_counts(t: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in sorted(t.items())
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out

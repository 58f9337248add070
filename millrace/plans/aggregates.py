"""Scorecards and daily/monthly aggregates.

Every source is reduced to the target's grain before anything is joined: joins then meet one row
per key on both sides and cannot multiply rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import ratio
from ..operators import first_per_key, latest_value


def _count(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)


def _zero_money(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("decimal(25,4)")).alias(name)


def order_metrics_daily(order_lines: DataFrame) -> DataFrame:
    # Each line counts twice: once for its sums, which each task adds up per day, and once for its order id alone. So the
    # orders of a day, which must be gathered to be told apart, are not gathered with sums.
    dated = order_lines.where(F.col("order_date").isNotNull()).select(
        F.col("order_date").alias("agg_date"),
        "order_id",
        F.lit(1).alias("line"),
        *("line_revenue_pln", "qty_shipped", "qty_ordered", "qty_backordered"),
        F.when(F.col("is_express_escalated"), 1).alias("escalated"),
        F.explode(F.array(F.lit(True), F.lit(False))).alias("__sums"),
    )
    parts = dated.select(
        "agg_date",
        F.when(~F.col("__sums"), F.col("order_id")).alias("order_id"),
        *[F.when(F.col("__sums"), F.col(name)).alias(name) for name in dated.columns[2:-1]],
    )
    orders = parts.groupBy("agg_date", "order_id").agg(
        F.count("line").alias("line"),
        F.sum("line_revenue_pln").alias("line_revenue_pln"),
        F.sum("qty_shipped").alias("qty_shipped"),
        F.sum("qty_ordered").alias("qty_ordered"),
        F.sum("qty_backordered").alias("qty_backordered"),
        F.count("escalated").alias("escalated"),
    )
    money = "decimal(25,4)"
    sums = orders.groupBy("agg_date").agg(
        F.count("order_id").alias("orders_placed"),
        F.sum("line").alias("lines_placed"),
        F.sum("line_revenue_pln").cast(money).alias("revenue_pln"),
        F.sum("qty_shipped").alias("qty_shipped_total"),
        F.sum("qty_ordered").alias("qty_ordered_total"),
        F.sum("qty_backordered").alias("qty_backordered_total"),
        F.sum("escalated").alias("is_express_escalated_count"),
    )
    return sums.withColumns(
        {
            "fill_rate": ratio(F.col("qty_shipped_total"), F.col("qty_ordered_total")),
            "backorder_rate": ratio(F.col("qty_backordered_total"), F.col("qty_ordered_total")),
        }
    )


def _tagged(*sides: DataFrame) -> DataFrame:
    """Rows of several facts in one table, each with NULLs in the columns of the others.

    One grouping over it replaces a grouping and a join for every fact, so each fact is shuffled once, as
    partial sums, and all of them in the same exchange.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)


def customer_scorecard(
    dim_customer: DataFrame,
    order_lines: DataFrame,
    returns: DataFrame,
    payments: DataFrame,
    credit_events: DataFrame,
) -> DataFrame:
    """One row per current customer. `return_rate` is return lines per shipped unit."""
    # Orders are told apart first, among lines only; what follows is sums.
    lines = order_lines.groupBy("customer_id", "order_id").agg(
        F.sum("line_revenue_pln").alias("line_revenue_pln"),
        _count("lines"),
        F.sum("qty_shipped").alias("qty_shipped"),
        F.sum("qty_ordered").alias("qty_ordered"),
        F.sum("qty_backordered").alias("qty_backordered"),
    )
    returned = returns.select("customer_id", F.lit(1).alias("return_line"))
    paid = payments.select(
        "customer_id",
        F.lit(1).alias("payment"),
        (F.col("payment_behaviour") == "on_time").alias("on_time"),
        F.struct("payment_date", "event_id").alias("paid_at"),
        "balance_after",
    )
    credit = credit_events.select(
        "customer_id",
        (F.col("event_subtype") == "credit_hold").alias("hold"),
        F.struct("event_date", "event_id").alias("credit_at"),
        "utilisation_pct",
    )
    sums = _tagged(lines, returned, paid, credit).groupBy("customer_id").agg(
        F.sum("line_revenue_pln").cast("decimal(25,4)").alias("revenue_pln_total"),
        F.count("order_id").alias("orders_count"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines_count"),
        F.sum("qty_shipped").alias("__shipped"),
        F.sum("qty_ordered").alias("__ordered"),
        F.sum("qty_backordered").alias("__backordered"),
        F.nullif(F.count("return_line"), F.lit(0)).alias("__return_lines"),
        F.count("payment").alias("payments_count"),
        F.count_if("on_time").alias("__on_time"),
        # Rows of other facts have no time here, and `max_by` passes over them.
        F.max_by("balance_after", "paid_at").alias("latest_balance"),
        F.max_by("utilisation_pct", "credit_at").alias("credit_utilisation_pct"),
        F.count_if("hold").alias("credit_hold_count"),
    )
    current = dim_customer.where("is_current").select("customer_id", "company_name", "segment", "region")
    return current.join(sums, "customer_id", "left").select(
        "customer_id",
        "company_name",
        "segment",
        "region",
        _zero_money("revenue_pln_total"),
        _zero("orders_count"),
        _zero("lines_count"),
        ratio(F.col("__shipped"), F.col("__ordered")).alias("fill_rate"),
        ratio(F.col("__backordered"), F.col("__ordered")).alias("backorder_rate"),
        ratio(F.col("__return_lines"), F.col("__shipped")).alias("return_rate"),
        _zero("payments_count"),
        ratio(F.col("__on_time"), F.nullif("payments_count", F.lit(0))).alias("on_time_payment_rate"),
        "latest_balance",
        "credit_utilisation_pct",
        _zero("credit_hold_count"),
    )


def sku_performance(
    dim_sku: DataFrame, order_lines: DataFrame, inventory: DataFrame, returns: DataFrame
) -> DataFrame:
    """One row per current SKU. Stock-out days count each warehouse and day."""
    lines = order_lines.select("sku", "line_revenue_pln", "qty_shipped", "qty_ordered", "qty_backordered")
    stock = inventory.select("sku", "stockout_flag", "below_safety_stock")
    returned = returns.select("sku", "qty_returned")
    sums = _tagged(lines, stock, returned).groupBy("sku").agg(
        F.sum("line_revenue_pln").alias("revenue_pln_total"),
        F.sum("qty_shipped").alias("units_sold"),
        F.sum("qty_ordered").alias("units_ordered"),
        F.sum("qty_backordered").alias("units_backordered"),
        F.sum("qty_returned").alias("units_returned"),
        F.count_if("stockout_flag").alias("stockout_days"),
        F.count_if("below_safety_stock").alias("days_below_safety_stock"),
    )
    current = dim_sku.where("is_current").select("sku", "valve_type", "dn", "material", "is_active")
    return current.join(sums, "sku", "left").select(
        "sku",
        "valve_type",
        "dn",
        "material",
        _zero_money("revenue_pln_total"),
        _zero("units_sold"),
        _zero("units_ordered"),
        _zero("units_backordered"),
        _zero("units_returned"),
        _zero("stockout_days"),
        _zero("days_below_safety_stock"),
        "is_active",
    )


def inventory_health(inventory: DataFrame, dim_warehouse: DataFrame) -> DataFrame:
    """Stock levels per SKU and warehouse; the warehouse name joins after the reduction."""
    grouped = inventory.groupBy("sku", "dim_warehouse_id").agg(
        F.sum("qty_on_hand").alias("__sum"),
        F.count("qty_on_hand").alias("__n"),
        F.min("qty_on_hand").alias("min_on_hand"),
        F.max("qty_on_hand").alias("max_on_hand"),
        F.count_if("stockout_flag").alias("stockout_days"),
        F.count_if("below_safety_stock").alias("days_below_safety_stock"),
        F.count_if(F.col("qty_available") < F.col("reorder_point")).alias("days_below_reorder_point"),
        _count("total_snapshot_days"),
    )
    names = dim_warehouse.select("dim_warehouse_id", "warehouse_code")
    return grouped.join(names, "dim_warehouse_id").select(
        "sku",
        "warehouse_code",
        ratio(F.col("__sum"), F.col("__n"), "decimal(12,2)").alias("avg_on_hand"),
        "min_on_hand",
        "max_on_hand",
        "stockout_days",
        "days_below_safety_stock",
        "days_below_reorder_point",
        "total_snapshot_days",
    )


def carrier_scorecard(dim_carrier: DataFrame, shipments: DataFrame, returns: DataFrame) -> DataFrame:
    """One row per carrier. `return_rate` is return events per load."""
    moved = shipments.groupBy("carrier_code").agg(
        _count("__loads"),
        F.count("total_weight_kg").alias("__weighed"),
        F.sum("total_weight_kg").alias("total_weight_kg"),
    )
    returned = (
        returns.where(F.col("carrier_code").isNotNull())
        .groupBy("carrier_code")
        .agg(_count("__returns"))
    )
    joined = dim_carrier.join(moved, "carrier_code", "left").join(returned, "carrier_code", "left")
    return joined.select(
        "carrier_code",
        F.col("name").alias("carrier_name"),
        F.coalesce("__loads", F.lit(0).cast("bigint")).alias("loads_count"),
        ratio(F.col("total_weight_kg"), F.col("__weighed"), "decimal(12,4)").alias("avg_weight_kg"),
        F.coalesce("total_weight_kg", F.lit(0).cast("decimal(22,4)")).alias("total_weight_kg"),
        "base_reliability",
        "transit_days_min",
        "transit_days_max",
        ratio(F.col("__returns"), F.col("__loads")).alias("return_rate"),
    )


def demand_accuracy(plans: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Plan against forecast per product group and month, over all vintages."""
    keys = ["product_group", "period_month"]
    planned = plans.groupBy(*keys).agg(
        F.sum("planned_qty").alias("plan_qty"),
        F.sum("confidence_low").alias("plan_confidence_low"),
        F.sum("confidence_high").alias("plan_confidence_high"),
    )
    expected = forecasts.groupBy(*keys).agg(
        F.sum("forecast_qty").alias("forecast_qty"),
        F.sum("lower_bound").alias("forecast_lower"),
        F.sum("upper_bound").alias("forecast_upper"),
    )
    return planned.join(expected, keys, "full").select(
        *keys,
        "plan_qty",
        "forecast_qty",
        "plan_confidence_low",
        "plan_confidence_high",
        "forecast_lower",
        "forecast_upper",
        (F.col("plan_qty") - F.col("forecast_qty")).cast("decimal(25,4)").alias("plan_vs_forecast_variance"),
    )


def _month(day: str) -> list[Column]:
    return [F.year(day).alias("year"), F.month(day).alias("month")]


def month_end_exposure(credit_events: DataFrame) -> DataFrame:
    """Newest exposure per customer and month."""
    dated = credit_events.select("customer_id", *_month("event_date"), "event_date", "event_id", "exposure")
    order = [F.col("event_date").desc_nulls_first(), F.col("event_id").desc()]
    return first_per_key(dated, ["customer_id", "year", "month"], order)


def cash_flow_monthly(order_lines: DataFrame, payments: DataFrame, credit_events: DataFrame) -> DataFrame:
    """Revenue, payments and month-end exposure on the union of their months."""
    revenue = (
        order_lines.where(F.col("order_date").isNotNull())
        .groupBy(*_month("order_date"))
        .agg(F.sum("line_revenue_pln").alias("revenue_pln"))
    )
    paid = payments.groupBy(*_month("payment_date")).agg(F.sum("amount_pln").alias("payments_received_pln"))
    credit = (
        month_end_exposure(credit_events)
        .groupBy("year", "month")
        .agg(F.sum("exposure").alias("credit_exposure_pln"))
    )
    # A union with one measure per source and a second sum is the spine and the three left joins
    # in one shuffle of already reduced rows.
    parts = [revenue, paid, credit]
    measures = ["revenue_pln", "payments_received_pln", "credit_exposure_pln"]
    rows = parts[0].unionByName(parts[1], allowMissingColumns=True)
    rows = rows.unionByName(parts[2], allowMissingColumns=True)
    return rows.groupBy("year", "month").agg(
        *[F.sum(name).cast("decimal(25,4)").alias(name) for name in measures]
    )


def production_quality(production: DataFrame, dim_date: DataFrame, reclassifications: DataFrame) -> DataFrame:
    """Grades per SKU, line and week. The reclassification count is per SKU and week: it repeats
    on every line of the SKU and must not be added up over lines."""
    days = dim_date.select(F.col("date_id").alias("completion_date"), "year", "week_iso")
    line = F.coalesce("production_line", F.lit("UNKNOWN")).alias("production_line")
    made = production.join(days, "completion_date").groupBy("sku", "year", "week_iso", line).agg(
        F.sum(F.when(F.col("grade") == "A", F.col("qty_completed"))).alias("a"),
        F.sum(F.when(F.col("grade") == "B", F.col("qty_completed"))).alias("b"),
        F.sum("qty_completed").alias("total_qty"),
    )
    moved = reclassifications.groupBy(
        "sku",
        F.year("reclassification_date").alias("year"),
        F.weekofyear("reclassification_date").alias("week_iso"),
    ).agg(_count("reclassification_count"))
    zero = F.lit(0).cast("bigint")
    joined = made.join(moved, ["sku", "year", "week_iso"], "left")
    return joined.select(
        "sku",
        "production_line",
        "year",
        "week_iso",
        F.coalesce("a", zero).alias("qty_grade_a"),
        F.coalesce("b", zero).alias("qty_grade_b"),
        "total_qty",
        ratio(F.coalesce("a", zero), F.col("total_qty")).alias("grade_a_pct"),
        ratio(F.coalesce("b", zero), F.col("total_qty")).alias("grade_b_pct"),
        _zero("reclassification_count"),
    )

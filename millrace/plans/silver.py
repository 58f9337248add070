"""Staging tables: typed, flagged, unnested and keyed rows out of raw JSON events.

Every table is a declaration (`SPECS`); `stage` turns raw events into its rows and rejects, and
`merge` folds them into what is stored. Both are plain projections, explodes and one keyed
reduction, so a load is a single pass over the new events of its event types.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions import payload as p
from ..functions.scalars import (
    after_last,
    blank,
    date_prefix,
    first_filled,
    lbs_to_kg,
    month_floor,
    month_from_text,
    within_limit,
)
from ..operators import flags, reject_reason, upsert_guarded, upsert_latest, upserted_keys

# Order of arrival: batch, event date, file, position in the file.
ARRIVAL = ["ingest_batch", "raw_event_date", "file_path", "pos"]
BAD = "_bad_values"
LINEAGE = ["raw_event_key", *ARRIVAL]

DOC, LINE, PERIOD = "doc", "line", "period"
Expr = Callable[[], Column]


def arrival() -> list[Column]:
    return [F.col(name) for name in ARRIVAL]


@dataclass(frozen=True)
class Spec:
    event_types: Sequence[str]
    keys: Sequence[str]
    columns: dict[str, Expr]
    flags: Sequence[tuple[Expr, Expr | str]] = ()
    unnest: Sequence[tuple[str, str, str]] = ()  # (source, field, name of each element)
    rejects: Sequence[tuple[Expr, str]] = ()  # on the document, before unnesting
    skip: Expr | None = None  # documents dropped without a reject
    nullable_key: bool = False
    guard: Sequence[str] = ()
    required: Sequence[str] = field(default_factory=tuple)


def text(source: str, name: str) -> Expr:
    return lambda: p.text(F.col(source), name)


@dataclass(frozen=True)
class Typed:
    """A field of a type. A value that is there but is not of that type becomes NULL, and `bad` tells it."""

    source: str
    name: str
    read: Callable[[Column, str], Column]
    probe: Callable[[Column, str], Column] | None = None  # what must succeed, if that is not the reading itself

    def __call__(self) -> Column:
        return self.read(F.col(self.source), self.name)

    def bad(self, column: str) -> Column:
        """The text of the field is looked at only where the typed value, which `column` holds, is NULL."""
        value = self.probe(F.col(self.source), self.name) if self.probe else F.col(column)
        return F.when(value.isNull(), p.given(F.col(self.source), self.name))


def integer(source: str, name: str) -> Typed:
    return Typed(source, name, p.integer)


def number(source: str, name: str, type_: str = "decimal(15,4)") -> Typed:
    return Typed(source, name, lambda column, field_: p.number(column, field_, type_))


def day(source: str, name: str) -> Typed:
    return Typed(source, name, p.day)


def boolean(source: str, name: str) -> Typed:
    return Typed(source, name, p.boolean)


def event_date() -> Column:
    return F.col("raw_event_date")


def missing(source: str, name: str) -> Expr:
    return lambda: p.text(F.col(source), name).isNull()


def empty(source: str, name: str) -> Expr:
    return lambda: blank(p.text(F.col(source), name))


def event_id_or_raw() -> Column:
    return F.coalesce(
        p.text(F.col(DOC), "event_id"), F.concat(F.lit("raw:"), F.col("raw_event_key"))
    )


def quantity_in_range(name: str) -> Typed:
    """An integer up to the limit; one beyond it is a number, hence not bad."""
    return Typed(
        DOC, name, lambda column, field_: within_limit(p.integer(column, field_)), lambda column, field_: p.number(column, field_, "double")
    )


def quantity_overflow(name: str) -> Expr:
    return lambda: p.number(F.col(DOC), name, "double") > 1_000_000


def month_of_event() -> Column:
    return month_floor(F.col("raw_event_date"))


SYNTHETIC_KEY = (missing(DOC, "event_id"), "event_id_missing_synthetic_key")

SPECS: dict[str, Spec] = {
    "orders": Spec(
        event_types=["customer_orders"],
        keys=["order_id"],
        columns={
            "order_id": text(DOC, "order_id"),
            "customer_id": text(DOC, "customer_id"),
            "status": text(DOC, "status"),
            "currency": text(DOC, "currency"),
            "priority": text(DOC, "priority"),
            "order_timestamp": Typed(DOC, "timestamp", p.instant),
            "simulation_date": day(DOC, "simulation_date"),
            "requested_delivery_date": day(DOC, "requested_delivery_date"),
            "sales_channel": text(DOC, "sales_channel"),
            "incoterms": text(DOC, "incoterms"),
        },
        flags=[
            (missing(DOC, "currency"), "null_currency"),
            (missing(DOC, "status"), "null_status"),
            (missing(DOC, "priority"), "null_priority"),
        ],
        rejects=[
            (empty(DOC, "order_id"), "null order_id"),
            (empty(DOC, "customer_id"), "null customer_id"),
        ],
    ),
    "order_lines": Spec(
        event_types=["customer_orders"],
        keys=["order_id", "line_id"],
        columns={
            "order_id": text(DOC, "order_id"),
            "line_id": text(LINE, "line_id"),
            "sku": text(LINE, "sku"),
            "unit_price": number(LINE, "unit_price"),
            "line_status": text(LINE, "line_status"),
            "quantity_ordered": integer(LINE, "quantity_ordered"),
            "quantity_allocated": integer(LINE, "quantity_allocated"),
            "quantity_shipped": integer(LINE, "quantity_shipped"),
            "quantity_backordered": integer(LINE, "quantity_backordered"),
        },
        unnest=[(DOC, "lines", LINE)],
        skip=lambda: blank(p.text(F.col(DOC), "order_id"))
        | blank(p.text(F.col(DOC), "customer_id")),
        required=["line_id"],
    ),
    "exchange_rates": Spec(
        event_types=["exchange_rates"],
        keys=["rate_date", "currency_pair"],
        columns={
            "rate_date": lambda: F.coalesce(p.day(F.col(DOC), "simulation_date"), event_date()),
            "currency_pair": lambda: F.coalesce(
                p.text(F.col(DOC), "currency_pair"), F.lit("UNKNOWN")
            ),
            "rate": number(DOC, "rate", "decimal(15,6)"),
            "change_pct": number(DOC, "change_pct", "decimal(8,4)"),
        },
        flags=[
            (missing(DOC, "currency_pair"), "missing_currency_pair"),
            (missing(DOC, "rate"), "missing_rate"),
        ],
    ),
    "inventory_snapshots": Spec(
        event_types=["inventory_snapshots"],
        keys=["snapshot_date", "warehouse_id", "sku"],
        columns={
            "snapshot_date": event_date,
            "warehouse_id": lambda: F.coalesce(
                p.text(F.col(DOC), "warehouse"),
                F.nullif(after_last(p.text(F.col(DOC), "snapshot_id"), "-"), F.lit("")),
            ),
            "sku": text(LINE, "sku"),
            "qty_on_hand": integer(LINE, "quantity_on_hand"),
            "qty_allocated": integer(LINE, "quantity_allocated"),
            "qty_available": integer(LINE, "quantity_available"),
            "snapshot_id": text(DOC, "snapshot_id"),
        },
        flags=[
            (
                lambda: p.text(F.col(DOC), "warehouse").isNull()
                & ~blank(p.text(F.col(DOC), "snapshot_id")),
                "warehouse_derived_from_snapshot_id",
            )
        ],
        unnest=[(DOC, "positions", LINE)],
        required=["warehouse_id", "sku"],
    ),
    "inventory_movements": Spec(
        event_types=["inventory_movements"],
        keys=["event_id"],
        columns={
            "event_id": lambda: F.coalesce(
                p.text(F.col(DOC), "event_id"), p.text(F.col(DOC), "movement_id")
            ),
            "movement_date": day(DOC, "movement_date"),
            "movement_type": text(DOC, "movement_type"),
            "direction": text(DOC, "quantity_direction"),
            "warehouse_id": text(DOC, "warehouse_id"),
            "sku": text(DOC, "sku"),
            "quantity": integer(DOC, "quantity"),
            "order_reference": text(DOC, "order_id"),
            "reason_code": text(DOC, "reason_code"),
        },
        flags=[(missing(DOC, "event_id"), "event_id_missing_used_movement_id")],
        required=["event_id"],
    ),
    "credit_events": Spec(
        event_types=["credit_events"],
        keys=["event_id"],
        columns={
            "event_id": event_id_or_raw,
            "event_date": day(DOC, "simulation_date"),
            "customer_id": text(DOC, "customer_id"),
            "event_subtype": text(DOC, "event_type"),
            "customer_balance": number(DOC, "customer_balance_pln"),
            "open_order_value": number(DOC, "open_orders_value_pln"),
            "credit_limit": number(DOC, "credit_limit_pln"),
            "exposure": number(DOC, "exposure_pln"),
        },
        flags=[SYNTHETIC_KEY],
    ),
    "production_completions": Spec(
        event_types=["production_completions"],
        keys=["event_id"],
        columns={
            "event_id": event_id_or_raw,
            "completion_date": day(DOC, "simulation_date"),
            "batch_id": text(DOC, "batch_id"),
            "sku": text(DOC, "sku"),
            "quantity": integer(DOC, "quantity"),
            "grade": text(DOC, "grade"),
            "production_line": text(DOC, "production_line"),
            "warehouse_id": text(DOC, "warehouse"),
        },
        flags=[
            SYNTHETIC_KEY,
            (
                lambda: ~p.text(F.col(DOC), "grade").isin("A", "B"),
                lambda: F.concat(F.lit("unexpected_grade:"), p.text(F.col(DOC), "grade")),
            ),
        ],
    ),
    "backorder_events": Spec(
        event_types=["backorder_events"],
        keys=["event_id"],
        columns={
            "event_id": event_id_or_raw,
            "event_date": day(DOC, "backorder_date"),
            "order_id": text(DOC, "order_id"),
            "order_line_id": text(DOC, "order_line_id"),
            "sku": text(DOC, "sku"),
            "quantity": quantity_in_range("quantity_backordered"),
            "reason": text(DOC, "backorder_reason"),
            "escalated_to_express": boolean(DOC, "escalated_to_express"),
        },
        flags=[SYNTHETIC_KEY, (quantity_overflow("quantity_backordered"), "qty_overflow")],
    ),
    "payments": Spec(
        event_types=["payments"],
        keys=["event_id"],
        nullable_key=True,
        columns={
            "event_id": text(DOC, "event_id"),
            "payment_date": day(DOC, "simulation_date"),
            "customer_id": text(DOC, "customer_id"),
            "amount": number(DOC, "payment_amount_pln"),
            "payment_behaviour": text(DOC, "payment_behaviour"),
            "balance_before": number(DOC, "balance_before_pln"),
            "balance_after": number(DOC, "balance_after_pln"),
        },
        flags=[
            (
                lambda: ~F.coalesce(p.text(F.col(DOC), "payment_behaviour"), F.lit("")).isin(
                    "on_time", "late", "very_late"
                ),
                "unexpected_payment_behaviour",
            )
        ],
    ),
    "master_data_changes": Spec(
        event_types=["master_data_changes"],
        keys=["change_id"],
        nullable_key=True,
        columns={
            "change_id": text(DOC, "change_id"),
            "change_date": day(DOC, "effective_date"),
            "change_type": text(DOC, "field_changed"),
            "entity_type": text(DOC, "entity_type"),
            "entity_id": text(DOC, "entity_id"),
            "old_value": lambda: p.as_object(F.col(DOC), "old_value"),
            "new_value": lambda: p.as_object(F.col(DOC), "new_value"),
        },
    ),
    "production_reclassifications": Spec(
        event_types=["production_reclassifications"],
        keys=["event_id"],
        nullable_key=True,
        columns={
            "event_id": text(DOC, "event_id"),
            "reclassification_date": day(DOC, "simulation_date"),
            "batch_id": text(DOC, "batch_id"),
            "sku": text(DOC, "sku"),
            "quantity": integer(DOC, "quantity"),
            "original_grade": text(DOC, "original_grade"),
            "new_grade": text(DOC, "new_grade"),
            "reclassification_reason": text(DOC, "reclassification_reason"),
        },
    ),
    "order_cancellations": Spec(
        event_types=["order_cancellations"],
        keys=["event_id"],
        nullable_key=True,
        columns={
            "event_id": text(DOC, "event_id"),
            "cancellation_date": day(DOC, "cancellation_date"),
            "order_id": text(DOC, "order_id"),
            "order_line_id": text(DOC, "order_line_id"),
            "sku": text(DOC, "sku"),
            "quantity_cancelled": quantity_in_range("quantity_cancelled"),
            "reason": text(DOC, "reason"),
            "days_backordered": integer(DOC, "days_backordered"),
            "cancellation_type": text(DOC, "cancellation_type"),
        },
        flags=[(quantity_overflow("quantity_cancelled"), "qty_overflow")],
    ),
    "order_modifications": Spec(
        event_types=["order_modifications"],
        keys=["event_id"],
        nullable_key=True,
        columns={
            "event_id": text(DOC, "event_id"),
            "modification_date": day(DOC, "modification_date"),
            "order_id": text(DOC, "order_id"),
            "line_id": text(DOC, "line_id"),
            "modification_type": text(DOC, "modification_type"),
            "old_value": text(DOC, "old_value"),
            "new_value": text(DOC, "new_value"),
            "reason": text(DOC, "reason"),
        },
    ),
    "schema_evolution_events": Spec(
        event_types=["schema_evolution_events"],
        keys=["evolution_id"],
        nullable_key=True,
        columns={
            "evolution_id": text(DOC, "evolution_id"),
            "event_date": event_date,
            "field_name": text(DOC, "field_name"),
            "sim_day": integer(DOC, "effective_from_day"),
            "activation_date": lambda: date_prefix(p.text(F.col(DOC), "timestamp")),
            "description": text(DOC, "description"),
        },
    ),
    "supply_disruptions": Spec(
        event_types=["supply_disruptions"],
        keys=["event_id"],
        columns={
            "event_id": text(DOC, "event_id"),
            "disruption_date": event_date,
            "disruption_category": text(DOC, "disruption_category"),
            "disruption_subtype": text(DOC, "disruption_subtype"),
            "severity": text(DOC, "severity"),
            "duration_days": integer(DOC, "duration_days"),
            "start_date": day(DOC, "start_date"),
            "end_date": day(DOC, "end_date"),
            "affected_scope": text(DOC, "affected_scope"),
            "message": text(DOC, "message"),
        },
        required=["event_id"],
    ),
    "loads": Spec(
        event_types=["loads_08", "loads_14", "loads_20"],
        keys=["load_id"],
        guard=["sync_window"],
        skip=empty(DOC, "load_id"),
        columns={
            "load_id": text(DOC, "load_id"),
            "sync_window": lambda: first_filled(
                p.text(F.col(DOC), "sync_window"), after_last(F.col("event_type"), "_")
            ),
            "load_date": event_date,
            "carrier_code": text(DOC, "carrier_code"),
            "source_warehouse_id": text(DOC, "source_warehouse_id"),
            "destination_region": text(DOC, "destination_region"),
            "status": text(DOC, "status"),
            "priority": text(DOC, "priority"),
            "total_weight_kg": lambda: F.when(
                p.text(F.col(DOC), "weight_unit") == "lbs",
                lbs_to_kg(p.number(F.col(DOC), "total_weight_reported", "decimal(18,6)")),
            )
            .otherwise(p.number(F.col(DOC), "total_weight_reported", "decimal(18,6)"))
            .try_cast("decimal(12,4)"),
            "weight_unit_original": text(DOC, "weight_unit"),
            "shipment_ids": lambda: p.strings(F.col(DOC), "shipment_ids"),
            "order_ids": lambda: p.strings(F.col(DOC), "order_ids"),
            "customer_ids": lambda: p.strings(F.col(DOC), "customer_ids"),
        },
        flags=[
            (lambda: p.text(F.col(DOC), "weight_unit") == "lbs", "weight_converted_lbs_to_kg")
        ],
    ),
    "carrier_events": Spec(
        event_types=["carrier_events"],
        keys=["event_id"],
        columns={
            "event_id": text(DOC, "event_id"),
            "event_date": event_date,
            "carrier_code": text(DOC, "carrier_code"),
            "event_subtype": text(DOC, "event_subtype"),
            "region": text(DOC, "affected_region"),
            "severity": text(DOC, "impact_severity"),
            "duration_days": lambda: p.number(F.col(DOC), "duration_days", "double").try_cast("int"),
            "end_date": day(DOC, "end_date"),
            "rate_delta_pct": number(DOC, "rate_delta_pct", "decimal(8,4)"),
        },
        required=["event_id"],
    ),
    "returns": Spec(
        event_types=["returns"],
        keys=["event_id"],
        skip=lambda: blank(p.text(F.col(DOC), "rma_id")) | blank(p.text(F.col(DOC), "event_id")),
        columns={
            "event_id": text(DOC, "event_id"),
            "event_date": event_date,
            "rma_id": text(DOC, "rma_id"),
            "event_subtype": text(DOC, "event_subtype"),
            "order_id": text(DOC, "order_id"),
            "customer_id": text(DOC, "customer_id"),
            "carrier_code": text(DOC, "carrier_code"),
            "status": text(DOC, "rma_status"),
        },
    ),
    "return_lines": Spec(
        event_types=["returns"],
        keys=["rma_id", "line_id"],
        skip=lambda: blank(p.text(F.col(DOC), "rma_id")) | blank(p.text(F.col(DOC), "event_id")),
        columns={
            "rma_id": text(DOC, "rma_id"),
            "line_id": text(LINE, "line_id"),
            "sku": text(LINE, "sku"),
            "quantity_returned": integer(LINE, "quantity_returned"),
            "quantity_accepted": integer(LINE, "quantity_accepted"),
            "return_reason": text(LINE, "return_reason"),
            "resolution": text(LINE, "resolution"),
        },
        unnest=[(DOC, "lines", LINE)],
        required=["line_id"],
    ),
    "demand_plans": Spec(
        event_types=["demand_plans"],
        keys=["plan_month", "product_group", "customer_segment", "period_month"],
        columns={
            "plan_month": month_of_event,
            "product_group": text(LINE, "product_group"),
            "customer_segment": text(LINE, "customer_segment"),
            "period_month": lambda: month_from_text(p.text(F.col(PERIOD), "month")),
            "planned_qty": number(PERIOD, "planned_quantity"),
            "confidence_low": number(PERIOD, "confidence_low"),
            "confidence_high": number(PERIOD, "confidence_high"),
        },
        unnest=[(DOC, "plan_lines", LINE), (LINE, "periods", PERIOD)],
        required=["product_group", "customer_segment", "period_month"],
    ),
    "inventory_targets": Spec(
        event_types=["inventory_targets"],
        keys=["target_month", "sku", "warehouse_id"],
        columns={
            "target_month": month_of_event,
            "sku": text(DOC, "sku"),
            "warehouse_id": text(DOC, "warehouse"),
            "safety_stock": integer(DOC, "safety_stock"),
            "reorder_point": integer(DOC, "reorder_point"),
            "target_stock": integer(DOC, "target_stock"),
            "review_trigger": text(DOC, "review_trigger"),
        },
        required=["sku", "warehouse_id"],
    ),
    "demand_signals": Spec(
        event_types=["demand_signals"],
        keys=["signal_id"],
        columns={
            "signal_id": text(DOC, "signal_id"),
            "signal_date": event_date,
            "signal_source": text(DOC, "signal_source"),
            "customer_id": text(DOC, "customer_id"),
            "product_group": text(DOC, "product_group"),
            "signal_type": text(DOC, "signal_type"),
            "magnitude": text(DOC, "magnitude"),
            "horizon_weeks": integer(DOC, "horizon_weeks"),
            "confidence": number(DOC, "confidence", "decimal(6,4)"),
        },
        required=["signal_id"],
    ),
    "demand_forecasts": Spec(
        event_types=["demand_forecasts"],
        keys=["forecast_month", "product_group", "period_month"],
        columns={
            "forecast_month": month_of_event,
            "product_group": text(LINE, "sku_group"),
            "period_month": lambda: month_from_text(p.text(F.col(PERIOD), "month")),
            "forecast_qty": number(PERIOD, "forecast_quantity"),
            "lower_bound": number(PERIOD, "lower_bound"),
            "upper_bound": number(PERIOD, "upper_bound"),
            "model_version": text(DOC, "model_version"),
        },
        unnest=[(DOC, "lines", LINE), (LINE, "periods", PERIOD)],
        required=["product_group", "period_month"],
    ),
}


def stage(raw: DataFrame, table: str, watch: Observation | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """Typed rows of one staging table, good and bad, in one pass over its events.

    `only` names the columns to be read beside those of the keys, where not all of them are wanted.

    `watch` counts the documents that are dropped without a reject, as `skipped`, in that same pass.

    A value of the wrong type becomes NULL and is named in `_bad_values` as `bad_<column>`; in a key it rejects the row.
    `_reason` is NULL for a good row. `payload` stays where it is still needed: on rejects, and on
    rows whose natural key may be NULL.

    The parse sits inside a generator on purpose: filters on parsed fields would otherwise be
    pushed below the projection, each with a parse of its own. So do the columns: reasons and flags look at what was read
    instead of reading it again.
    """
    spec = SPECS[table]
    wanted = [name for name in spec.columns if only is None or name in (*only, *spec.keys, *spec.required)]
    events = raw.where(F.col("event_type").isin(list(spec.event_types))).select(
        *LINEAGE, "event_type", "payload", F.explode(F.array(p.parsed(F.col("payload")))).alias(DOC)
    )
    if spec.skip is not None:
        if watch is not None:
            events = events.observe(watch, F.count_if(F.coalesce(spec.skip(), F.lit(True))).alias("skipped"))
        events = events.where(~spec.skip())
    for source, name, alias in spec.unnest:
        events = events.withColumn(alias, F.explode(p.elements(F.col(source), name)))
    raised = [(rule(), flag if isinstance(flag, str) else flag()) for rule, flag in spec.flags]
    built = F.struct(*[spec.columns[name]().alias(name) for name in wanted])
    sources = [DOC, *[alias for _, _, alias in spec.unnest]]
    events = events.select(*LINEAGE, "event_type", "payload", *sources, F.explode(F.array(built)).alias("__read"))
    events = events.select(*LINEAGE, "event_type", "payload", *sources, "__read.*")
    typed = {name: spec.columns[name] for name in wanted if isinstance(spec.columns[name], Typed)}
    bad = [(build.bad(name), f"bad_{name}") for name, build in typed.items()]
    rules = [(rule(), why) for rule, why in spec.rejects]
    # A key that cannot be read is no NULL key.
    rules += [(typed[name].bad(name), f"bad {name}") for name in spec.keys if name in typed]
    rules += [(F.col(name).isNull(), f"null {name}") for name in spec.required]
    reason = reject_reason(*rules)
    payload = F.col("payload")
    if not spec.nullable_key:
        payload = F.when(reason.isNotNull(), payload)
    return events.select(
        *LINEAGE,
        "event_type",
        payload.alias("payload"),
        reason.alias("_reason"),
        flags(*raised).alias("_dq_flags"),
        flags(*bad).alias(BAD),
        *wanted,
    )


def accepted(staged: DataFrame, table: str) -> DataFrame:
    drop = ["event_type", "_reason"] + ([] if SPECS[table].nullable_key else ["payload"])
    if "_reason" not in staged.columns:  # a compacted table holds good rows only
        return staged.drop(*drop)
    return staged.where(F.col("_reason").isNull()).drop(*drop)


def rejected(staged: DataFrame, *more: str) -> DataFrame:
    reason = F.col("_reason").alias("reason")
    return staged.where(F.col("_reason").isNotNull()).select(*LINEAGE, "event_type", reason, "payload", *more)


def merge(existing: DataFrame | None, rows: DataFrame, table: str) -> DataFrame:
    """Fold rows into a table by its natural key.

    The rule is associative: merging batch by batch, or all increments at once, is the same.
    """
    spec = SPECS[table]
    if spec.guard:
        guard = [F.col(name) for name in spec.guard]
        return upsert_guarded(existing, rows, spec.keys, guard, arrival())
    return upsert_latest(existing, rows, spec.keys, arrival(), _identity(spec))


def _identity(spec: Spec) -> list[Column] | None:
    return [F.col("file_path"), F.col("payload")] if spec.nullable_key else None


def load(raw: DataFrame, table: str) -> DataFrame:
    """The staging table that results from all given events."""
    return merge(None, accepted(stage(raw, table), table), table)


def loaded_keys(raw: DataFrame, table: str) -> DataFrame:
    """The keys of the staging table that results from all given events, one row for each of its rows."""
    spec = SPECS[table]
    return upserted_keys(accepted(stage(raw, table, only=()), table), spec.keys, _identity(spec))


def distinct_rejects(found: Sequence[DataFrame]) -> DataFrame:
    """All rejects, once per event and reason."""
    return reduce(DataFrame.unionByName, found).dropDuplicates(["raw_event_key", "reason"])

"""Raw JSON events made from the benchmark tables, for the staging loaders.

Each feed turns the rows of one table (or of lineitem with its order) into event documents, one
document per row, so nothing is ever grouped to build them. The expected staging rows are stated
beside it as plain SQL over the same table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from .adapters import Model

# Identity of a lineitem row, as text; it doubles as file name, so it decides ties of arrival.
_LINE_ID = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity AS int),"
    " cast(round(l_extendedprice * 100) AS bigint), l_returnflag, l_linestatus)"
)


@dataclass(frozen=True)
class Feed:
    base: str  # lineitem | orders | events | lineorder
    event_type: str  # SQL text expression
    payload: str  # Spark SQL struct expression
    expected: str  # SELECT list of the staging columns, over the same base
    keys: str  # comma-separated key columns among `expected`
    where: str = "true"
    unnest: str = ""  # extra FROM item in the expected SQL
    keep: str = "true"  # filter on the expected rows
    guard: str = ""  # leading descending order, arrival ascending
    null_key: str = ""  # column whose NULLs never collide


_DATE = {"lineitem": "l_shipdate", "lineorder": "l_shipdate", "orders": "o_orderdate", "events": "ts"}
_ID = {
    "lineitem": _LINE_ID,
    "lineorder": _LINE_ID,
    "orders": "cast(o_orderkey AS string)",
    "events": "cast(event_id AS string)",
}


def raw_events(model: Model, feed: Feed) -> DataFrame:
    """The feed's documents in the raw event layout."""
    if feed.base == "lineorder":
        lines = model.table("lineitem")
        base = lines.join(model.table("orders"), F.expr("l_orderkey = o_orderkey"))
    else:
        base = model.table(feed.base)
    row_id = _ID[feed.base]
    return base.where(feed.where).selectExpr(
        f"concat({feed.event_type}, ':', {row_id}) AS raw_event_key",
        "cast(0 AS bigint) AS ingest_batch",
        f"cast({_DATE[feed.base]} AS date) AS raw_event_date",
        f"{row_id} AS file_path",
        "0 AS pos",
        f"{feed.event_type} AS event_type",
        f"to_json({feed.payload}) AS payload",
    )


def expected_sql(feed: Feed, columns: str) -> str:
    row_id = _ID[feed.base].replace("AS string", "AS varchar")
    source = "lineitem JOIN orders ON l_orderkey = o_orderkey" if feed.base == "lineorder" else feed.base
    arrival = f"cast({_DATE[feed.base]} AS date)"
    if feed.guard:
        order = f"{feed.guard} DESC, __d, __f"
    else:
        order = "__d DESC, __f DESC"
    part = feed.keys
    if feed.null_key:
        part += f", CASE WHEN {feed.null_key} IS NULL THEN __f END"
    return f"""SELECT {columns} FROM (
SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS __n FROM (
SELECT {arrival} AS __d, {row_id} AS __f, {feed.expected} FROM {source}{feed.unnest} WHERE {feed.where}) e WHERE {feed.keep}) x WHERE __n = 1"""


_ORDERS_DOC = """named_struct(
 'order_id', CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE concat('ORD-', o_orderkey) END,
 'customer_id', CASE WHEN o_orderkey % 50 <> 1 THEN concat('CUST-', o_custkey) END,
 'status', CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END,
 'currency', CASE WHEN o_orderkey % 13 <> 0 THEN 'EUR' END,
 'priority', CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END,
 'timestamp', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
 'simulation_date', CASE WHEN o_orderkey % 5 = 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') END,
 'requested_delivery_date', date_format(l_shipdate, 'yyyy-MM-dd'),
 'sales_channel', 'web', 'incoterms', 'DAP',
 'lines', array(
  named_struct('line_id', cast(l_linenumber AS string), 'sku', concat('SKU-', l_partkey), 'unit_price', cast(l_extendedprice AS decimal(15,2)),
   'line_status', l_linestatus, 'quantity_ordered', cast(l_quantity AS int), 'quantity_allocated', cast(l_quantity / 2 AS int),
   'quantity_shipped', 0, 'quantity_backordered', cast(NULL AS int)),
  named_struct('line_id', CASE WHEN l_linenumber <> 7 THEN concat(l_linenumber, 'b') END, 'sku', concat('SKU-', l_suppkey), 'unit_price', cast(l_tax AS decimal(15,2)),
   'line_status', l_returnflag, 'quantity_ordered', 1, 'quantity_allocated', 0, 'quantity_shipped', 1, 'quantity_backordered', 2)))"""

_ORDER_FLAGS = (
    "concat_ws(',', CASE WHEN o_orderkey % 13 = 0 THEN 'null_currency' END,"
    " CASE WHEN o_orderkey % 11 = 0 THEN 'null_status' END, CASE WHEN o_orderkey % 7 = 0 THEN 'null_priority' END)"
)
_DAY = "date_format({0}, 'yyyy-MM-dd')"
_NEXT = "cast(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS date)"

FEEDS: dict[str, Feed] = {
    "orders": Feed(
        "lineorder",
        "'customer_orders'",
        _ORDERS_DOC,
        "concat('ORD-', o_orderkey) AS order_id, concat('CUST-', o_custkey) AS customer_id,"
        " CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 13 <> 0 THEN 'EUR' END AS currency,"
        " CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS priority, cast(o_orderdate AS date) AS order_timestamp,"
        " CASE WHEN o_orderkey % 5 = 0 THEN cast(o_orderdate AS date) END AS simulation_date, cast(l_shipdate AS date) AS requested_delivery_date,"
        f" 'web' AS sales_channel, 'DAP' AS incoterms, {_ORDER_FLAGS} AS _dq_flags, o_orderkey % 50 AS __bad",
        "order_id",
        keep="__bad > 1",
    ),
    "order_lines": Feed(
        "lineorder",
        "'customer_orders'",
        _ORDERS_DOC,
        "concat('ORD-', o_orderkey) AS order_id, CASE WHEN i = 0 THEN cast(l_linenumber AS varchar) WHEN l_linenumber <> 7 THEN concat(l_linenumber, 'b') END AS line_id,"
        " CASE WHEN i = 0 THEN concat('SKU-', l_partkey) ELSE concat('SKU-', l_suppkey) END AS sku,"
        " cast(CASE WHEN i = 0 THEN l_extendedprice ELSE l_tax END AS decimal(15,2)) AS unit_price,"
        " CASE WHEN i = 0 THEN l_linestatus ELSE l_returnflag END AS line_status, CASE WHEN i = 0 THEN cast(l_quantity AS int) ELSE 1 END AS quantity_ordered,"
        " CASE WHEN i = 0 THEN cast(floor(l_quantity / 2) AS int) ELSE 0 END AS quantity_allocated, i AS quantity_shipped,"
        " CASE WHEN i = 1 THEN 2 END AS quantity_backordered, '' AS _dq_flags, o_orderkey % 50 AS __bad",
        "order_id, line_id",
        unnest=" CROSS JOIN (VALUES (0), (1)) v(i)",
        keep="__bad > 1 AND line_id IS NOT NULL",
    ),
    "exchange_rates": Feed(
        "orders",
        "'exchange_rates'",
        f"""named_struct('simulation_date', CASE WHEN o_orderkey % 3 = 0 THEN {_DAY.format('date_add(cast(o_orderdate AS date), 1)')} WHEN o_orderkey % 3 = 1 THEN '' END,
 'currency_pair', CASE WHEN o_orderkey % 17 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'EUR/PLN' ELSE 'USD/PLN' END END,
 'rate', CASE WHEN o_orderkey % 19 <> 0 THEN cast((o_orderkey % 500) * 0.01 AS decimal(10,2)) END, 'change_pct', cast((o_orderkey % 7) * 0.1 AS decimal(10,1)))""",
        "cast(o_orderdate AS date) + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS rate_date,"
        " CASE WHEN o_orderkey % 17 = 0 THEN 'UNKNOWN' WHEN o_orderkey % 2 = 0 THEN 'EUR/PLN' ELSE 'USD/PLN' END AS currency_pair,"
        " CASE WHEN o_orderkey % 19 <> 0 THEN (o_orderkey % 500) / 100.0 END AS rate, (o_orderkey % 7) / 10.0 AS change_pct,"
        " concat_ws(',', CASE WHEN o_orderkey % 17 = 0 THEN 'missing_currency_pair' END, CASE WHEN o_orderkey % 19 = 0 THEN 'missing_rate' END) AS _dq_flags",
        "rate_date, currency_pair",
    ),
    "inventory_snapshots": Feed(
        "lineitem",
        "'inventory_snapshots'",
        """named_struct('warehouse', CASE WHEN l_suppkey % 3 <> 0 THEN concat('W', l_suppkey % 3) END,
 'snapshot_id', concat('SNAP-', date_format(l_shipdate, 'yyyyMMdd'), '-W', l_suppkey % 3),
 'positions', array(named_struct('sku', concat('SKU-', l_partkey), 'quantity_on_hand', cast(l_quantity AS int), 'quantity_allocated', l_linenumber, 'quantity_available', cast(l_quantity AS int) - l_linenumber),
  named_struct('sku', concat('KIT-', l_partkey % 100), 'quantity_on_hand', l_linenumber, 'quantity_allocated', 0, 'quantity_available', cast(NULL AS int))))""",
        "cast(l_shipdate AS date) AS snapshot_date, concat('W', l_suppkey % 3) AS warehouse_id, CASE WHEN i = 0 THEN concat('SKU-', l_partkey) ELSE concat('KIT-', l_partkey % 100) END AS sku,"
        " CASE WHEN i = 0 THEN cast(l_quantity AS int) ELSE l_linenumber END AS qty_on_hand, CASE WHEN i = 0 THEN l_linenumber ELSE 0 END AS qty_allocated,"
        " CASE WHEN i = 0 THEN cast(l_quantity AS int) - l_linenumber END AS qty_available, concat('SNAP-', strftime(l_shipdate, '%Y%m%d'), '-W', l_suppkey % 3) AS snapshot_id,"
        " CASE WHEN l_suppkey % 3 = 0 THEN 'warehouse_derived_from_snapshot_id' ELSE '' END AS _dq_flags",
        "snapshot_date, warehouse_id, sku",
        unnest=" CROSS JOIN (VALUES (0), (1)) v(i)",
    ),
    "inventory_movements": Feed(
        "lineitem",
        "'inventory_movements'",
        f"""named_struct('event_id', CASE WHEN l_linenumber % 4 <> 0 THEN concat('MV-', l_orderkey, '-', l_linenumber) END, 'movement_id', concat('M-', l_orderkey, '-', l_linenumber),
 'movement_date', {_DAY.format('l_shipdate')}, 'movement_type', l_returnflag, 'quantity_direction', l_linestatus, 'warehouse_id', concat('W', l_suppkey % 3),
 'sku', concat('SKU-', l_partkey), 'quantity', l_quantity, 'order_id', concat('ORD-', l_orderkey), 'reason_code', 'R')""",
        "CASE WHEN l_linenumber % 4 <> 0 THEN concat('MV-', l_orderkey, '-', l_linenumber) ELSE concat('M-', l_orderkey, '-', l_linenumber) END AS event_id,"
        " cast(l_shipdate AS date) AS movement_date, l_returnflag AS movement_type, l_linestatus AS direction, concat('W', l_suppkey % 3) AS warehouse_id,"
        " concat('SKU-', l_partkey) AS sku, cast(l_quantity AS int) AS quantity, concat('ORD-', l_orderkey) AS order_reference, 'R' AS reason_code,"
        " CASE WHEN l_linenumber % 4 = 0 THEN 'event_id_missing_used_movement_id' ELSE '' END AS _dq_flags",
        "event_id",
    ),
    "credit_events": Feed(
        "events",
        "'credit_events'",
        f"""named_struct('event_id', CASE WHEN event_id % 10 <> 0 THEN concat('EV-', event_id % 5000) END, 'simulation_date', {_DAY.format('ts')}, 'customer_id', concat('CUST-', user_id),
 'event_type', event_type, 'customer_balance_pln', cast(value AS decimal(15,2)), 'open_orders_value_pln', user_id, 'credit_limit_pln', 1000, 'exposure_pln', 'n/a')""",
        "CASE WHEN event_id % 10 <> 0 THEN concat('EV-', event_id % 5000) ELSE concat('raw:credit_events:', event_id) END AS event_id, cast(ts AS date) AS event_date,"
        " concat('CUST-', user_id) AS customer_id, event_type AS event_subtype, cast(value AS decimal(15,2)) AS customer_balance, user_id AS open_order_value, 1000 AS credit_limit,"
        " cast(NULL AS double) AS exposure, CASE WHEN event_id % 10 = 0 THEN 'event_id_missing_synthetic_key' ELSE '' END AS _dq_flags",
        "event_id",
    ),
    "production_completions": Feed(
        "lineitem",
        "'production_completions'",
        f"""named_struct('event_id', CASE WHEN l_linenumber <> 6 THEN concat('PRD-', l_orderkey, '-', l_linenumber) END, 'simulation_date', {_DAY.format('l_shipdate')}, 'batch_id', concat('B-', l_orderkey),
 'sku', concat('SKU-', l_partkey), 'quantity', cast(l_quantity AS int), 'grade', CASE WHEN l_linenumber <> 5 THEN CASE l_returnflag WHEN 'R' THEN 'C' WHEN 'N' THEN 'B' ELSE 'A' END END,
 'production_line', l_suppkey % 5, 'warehouse', concat('W', l_suppkey % 3))""",
        f"CASE WHEN l_linenumber <> 6 THEN concat('PRD-', l_orderkey, '-', l_linenumber) ELSE concat('raw:production_completions:', {_LINE_ID}) END AS event_id, cast(l_shipdate AS date) AS completion_date,"
        " concat('B-', l_orderkey) AS batch_id, concat('SKU-', l_partkey) AS sku, cast(l_quantity AS int) AS quantity,"
        " CASE WHEN l_linenumber <> 5 THEN CASE l_returnflag WHEN 'R' THEN 'C' WHEN 'N' THEN 'B' ELSE 'A' END END AS grade, cast(l_suppkey % 5 AS varchar) AS production_line, concat('W', l_suppkey % 3) AS warehouse_id,"
        " concat_ws(',', CASE WHEN l_linenumber = 6 THEN 'event_id_missing_synthetic_key' END, CASE WHEN l_linenumber <> 5 AND l_returnflag = 'R' THEN 'unexpected_grade:C' END) AS _dq_flags",
        "event_id",
    ),
    "backorder_events": Feed(
        "lineitem",
        "'backorder_events'",
        f"""named_struct('event_id', CASE WHEN l_linenumber <> 6 THEN concat('BO-', l_orderkey, '-', l_linenumber) END, 'backorder_date', {_DAY.format('l_shipdate')}, 'order_id', concat('ORD-', l_orderkey),
 'order_line_id', cast(l_linenumber AS string), 'sku', concat('SKU-', l_partkey), 'quantity_backordered', CASE WHEN l_quantity >= 45 THEN 2000000 ELSE cast(l_quantity AS int) END,
 'backorder_reason', 'short', 'escalated_to_express', CASE WHEN l_linestatus = 'F' THEN l_quantity > 20 END)""",
        f"CASE WHEN l_linenumber <> 6 THEN concat('BO-', l_orderkey, '-', l_linenumber) ELSE concat('raw:backorder_events:', {_LINE_ID}) END AS event_id, cast(l_shipdate AS date) AS event_date,"
        " concat('ORD-', l_orderkey) AS order_id, cast(l_linenumber AS varchar) AS order_line_id, concat('SKU-', l_partkey) AS sku, CASE WHEN l_quantity < 45 THEN cast(l_quantity AS int) END AS quantity,"
        " 'short' AS reason, CASE WHEN l_linestatus = 'F' THEN l_quantity > 20 END AS escalated_to_express,"
        " concat_ws(',', CASE WHEN l_linenumber = 6 THEN 'event_id_missing_synthetic_key' END, CASE WHEN l_quantity >= 45 THEN 'qty_overflow' END) AS _dq_flags",
        "event_id",
    ),
    "payments": Feed(
        "events",
        "'payments'",
        f"""named_struct('event_id', CASE WHEN event_id % 10 <> 0 THEN concat('EV-', event_id % 5000) END, 'simulation_date', {_DAY.format('ts')}, 'customer_id', concat('CUST-', user_id),
 'payment_amount_pln', cast(value AS decimal(15,2)), 'payment_behaviour', CASE event_id % 5 WHEN 0 THEN 'on_time' WHEN 1 THEN 'late' WHEN 2 THEN 'very_late' WHEN 3 THEN 'odd' END,
 'balance_before_pln', 100, 'balance_after_pln', user_id)""",
        "CASE WHEN event_id % 10 <> 0 THEN concat('EV-', event_id % 5000) END AS event_id, cast(ts AS date) AS payment_date, concat('CUST-', user_id) AS customer_id,"
        " cast(value AS decimal(15,2)) AS amount, CASE event_id % 5 WHEN 0 THEN 'on_time' WHEN 1 THEN 'late' WHEN 2 THEN 'very_late' WHEN 3 THEN 'odd' END AS payment_behaviour,"
        " 100 AS balance_before, user_id AS balance_after, CASE WHEN event_id % 5 > 2 THEN 'unexpected_payment_behaviour' ELSE '' END AS _dq_flags",
        "event_id",
        null_key="event_id",
    ),
    "master_data_changes": Feed(
        "orders",
        "'master_data_changes'",
        f"""named_struct('change_id', CASE WHEN o_orderkey % 9 <> 0 THEN concat('CH-', o_orderkey % 6000) END, 'effective_date', {_DAY.format('o_orderdate')}, 'field_changed', 'segment', 'entity_type', 'customer',
 'entity_id', concat('CUST-', o_custkey), 'old_value', named_struct('segment', o_orderstatus), 'new_value', o_orderpriority)""",
        "CASE WHEN o_orderkey % 9 <> 0 THEN concat('CH-', o_orderkey % 6000) END AS change_id, cast(o_orderdate AS date) AS change_date, 'segment' AS change_type, 'customer' AS entity_type,"
        " concat('CUST-', o_custkey) AS entity_id, concat('{\"segment\":\"', o_orderstatus, '\"}') AS old_value, concat('{\"value\":\"', o_orderpriority, '\"}') AS new_value, '' AS _dq_flags",
        "change_id",
        null_key="change_id",
    ),
    "production_reclassifications": Feed(
        "lineitem",
        "'production_reclassifications'",
        f"""named_struct('event_id', CASE WHEN l_linenumber <> 6 THEN concat('RC-', l_orderkey, '-', l_linenumber) END, 'simulation_date', {_DAY.format('l_shipdate')}, 'batch_id', concat('B-', l_orderkey),
 'sku', concat('SKU-', l_partkey), 'quantity', cast(l_quantity AS int), 'original_grade', 'A', 'new_grade', 'B', 'reclassification_reason', l_returnflag)""",
        "CASE WHEN l_linenumber <> 6 THEN concat('RC-', l_orderkey, '-', l_linenumber) END AS event_id, cast(l_shipdate AS date) AS reclassification_date, concat('B-', l_orderkey) AS batch_id,"
        " concat('SKU-', l_partkey) AS sku, cast(l_quantity AS int) AS quantity, 'A' AS original_grade, 'B' AS new_grade, l_returnflag AS reclassification_reason, '' AS _dq_flags",
        "event_id",
        where="l_returnflag <> 'N'",
        null_key="event_id",
    ),
    "order_cancellations": Feed(
        "lineitem",
        "'order_cancellations'",
        f"""named_struct('event_id', concat('CX-', l_orderkey, '-', l_linenumber), 'cancellation_date', {_DAY.format('l_shipdate')}, 'order_id', concat('ORD-', l_orderkey), 'order_line_id', cast(l_linenumber AS string),
 'sku', concat('SKU-', l_partkey), 'quantity_cancelled', CASE WHEN l_quantity >= 45 THEN 1000001 WHEN l_quantity >= 40 THEN 1000000 ELSE cast(l_quantity AS int) END, 'reason', 'late', 'days_backordered', l_linenumber, 'cancellation_type', l_linestatus)""",
        "concat('CX-', l_orderkey, '-', l_linenumber) AS event_id, cast(l_shipdate AS date) AS cancellation_date, concat('ORD-', l_orderkey) AS order_id, cast(l_linenumber AS varchar) AS order_line_id,"
        " concat('SKU-', l_partkey) AS sku, CASE WHEN l_quantity < 40 THEN cast(l_quantity AS int) WHEN l_quantity < 45 THEN 1000000 END AS quantity_cancelled, 'late' AS reason, l_linenumber AS days_backordered,"
        " l_linestatus AS cancellation_type, CASE WHEN l_quantity >= 45 THEN 'qty_overflow' ELSE '' END AS _dq_flags",
        "event_id",
    ),
    "order_modifications": Feed(
        "lineitem",
        "'order_modifications'",
        f"""named_struct('event_id', concat('MO-', l_orderkey, '-', l_linenumber), 'modification_date', {_DAY.format('l_shipdate')}, 'order_id', concat('ORD-', l_orderkey), 'line_id', cast(l_linenumber AS string),
 'modification_type', 'quantity', 'old_value', cast(l_quantity AS int), 'new_value', named_struct('q', l_linenumber), 'reason', CASE WHEN l_linestatus = 'F' THEN 'r' END)""",
        "concat('MO-', l_orderkey, '-', l_linenumber) AS event_id, cast(l_shipdate AS date) AS modification_date, concat('ORD-', l_orderkey) AS order_id, cast(l_linenumber AS varchar) AS line_id,"
        " 'quantity' AS modification_type, cast(cast(l_quantity AS int) AS varchar) AS old_value, concat('{\"q\":', l_linenumber, '}') AS new_value, CASE WHEN l_linestatus = 'F' THEN 'r' END AS reason, '' AS _dq_flags",
        "event_id",
    ),
    "schema_evolution_events": Feed(
        "events",
        "'schema_evolution_events'",
        """named_struct('evolution_id', concat('SE-', event_id % 4000), 'timestamp', CASE WHEN event_id % 3 <> 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'") END, 'field_name', event_type,
 'effective_from_day', user_id, 'description', 'd')""",
        "concat('SE-', event_id % 4000) AS evolution_id, cast(ts AS date) AS event_date, event_type AS field_name, user_id AS sim_day, CASE WHEN event_id % 3 <> 0 THEN cast(ts AS date) END AS activation_date,"
        " 'd' AS description, '' AS _dq_flags",
        "evolution_id",
    ),
    "supply_disruptions": Feed(
        "events",
        "'supply_disruptions'",
        f"""named_struct('event_id', CASE WHEN event_id % 20 <> 0 THEN concat('SD-', event_id % 4000) END, 'disruption_category', event_type, 'disruption_subtype', 's', 'severity', 'high', 'duration_days', cast(value AS int),
 'start_date', {_DAY.format('ts')}, 'end_date', {_DAY.format('date_add(cast(ts AS date), 3)')}, 'affected_scope', concat('U', user_id), 'message', 'm')""",
        "CASE WHEN event_id % 20 <> 0 THEN concat('SD-', event_id % 4000) END AS event_id, cast(ts AS date) AS disruption_date, event_type AS disruption_category, 's' AS disruption_subtype, 'high' AS severity,"
        " cast(trunc(value) AS int) AS duration_days, cast(ts AS date) AS start_date, cast(ts AS date) + 3 AS end_date, concat('U', user_id) AS affected_scope, 'm' AS message, '' AS _dq_flags",
        "event_id",
        keep="event_id IS NOT NULL",
    ),
    "loads": Feed(
        "lineitem",
        "CASE l_linenumber % 3 WHEN 0 THEN 'loads_08' WHEN 1 THEN 'loads_14' ELSE 'loads_20' END",
        """named_struct('load_id', CASE WHEN l_linenumber <> 7 THEN concat('LOAD-', l_orderkey, '-', l_suppkey % 4) ELSE '' END, 'sync_window', CASE WHEN l_linenumber = 2 THEN '20' WHEN l_linenumber = 4 THEN '' END,
 'carrier_code', concat('CARR-', l_suppkey % 7), 'source_warehouse_id', concat('W', l_suppkey % 3), 'destination_region', 'N', 'status', l_linestatus, 'priority', 'std', 'weight_unit', CASE WHEN l_suppkey % 2 = 0 THEN 'lbs' ELSE 'kg' END,
 'total_weight_reported', CASE WHEN l_linenumber <> 3 THEN cast(l_quantity AS int) END, 'order_ids', CASE WHEN l_linenumber <> 5 THEN array(concat('ORD-', l_orderkey)) END)""",
        "CASE WHEN l_linenumber <> 7 THEN concat('LOAD-', l_orderkey, '-', l_suppkey % 4) ELSE '' END AS load_id, CASE l_linenumber % 3 WHEN 0 THEN '08' WHEN 1 THEN '14' ELSE '20' END AS sync_window,"
        " cast(l_shipdate AS date) AS load_date, concat('CARR-', l_suppkey % 7) AS carrier_code, concat('W', l_suppkey % 3) AS source_warehouse_id, 'N' AS destination_region, l_linestatus AS status, 'std' AS priority,"
        " CASE WHEN l_linenumber <> 3 THEN CASE WHEN l_suppkey % 2 = 0 THEN ((2 * cast(l_quantity AS hugeint) * 1000000000 + 220462) // (2 * 220462)) / 10000.0 ELSE l_quantity END END AS total_weight_kg,"
        " CASE WHEN l_suppkey % 2 = 0 THEN 'lbs' ELSE 'kg' END AS weight_unit_original, cast(NULL AS varchar) AS shipment_ids, CASE WHEN l_linenumber <> 5 THEN concat('ORD-', l_orderkey) END AS order_ids,"
        " cast(NULL AS varchar) AS customer_ids, CASE WHEN l_suppkey % 2 = 0 THEN 'weight_converted_lbs_to_kg' ELSE '' END AS _dq_flags",
        "load_id",
        keep="load_id <> ''",
        guard="sync_window",
    ),
    "carrier_events": Feed(
        "events",
        "'carrier_events'",
        f"""named_struct('event_id', concat('CE-', event_id % 4000), 'carrier_code', concat('CARR-', user_id % 7), 'event_subtype', event_type, 'affected_region', 'N', 'impact_severity', 'low', 'duration_days', cast(value AS string),
 'end_date', CASE WHEN event_id % 2 = 0 THEN {_DAY.format('ts')} ELSE '' END, 'rate_delta_pct', cast((event_id % 100) * 0.01 AS decimal(8,2)))""",
        "concat('CE-', event_id % 4000) AS event_id, cast(ts AS date) AS event_date, concat('CARR-', user_id % 7) AS carrier_code, event_type AS event_subtype, 'N' AS region, 'low' AS severity,"
        " cast(trunc(value) AS int) AS duration_days, CASE WHEN event_id % 2 = 0 THEN cast(ts AS date) END AS end_date, (event_id % 100) / 100.0 AS rate_delta_pct, '' AS _dq_flags",
        "event_id",
    ),
    "returns": Feed(
        "lineitem",
        "'returns'",
        """named_struct('event_id', CASE WHEN l_linenumber <> 7 THEN concat('RET-', l_orderkey, '-', l_linenumber) END, 'rma_id', CASE WHEN l_linenumber <> 6 THEN concat('RMA-', l_orderkey) ELSE '' END, 'event_subtype', 'return_requested',
 'order_id', concat('ORD-', l_orderkey), 'customer_id', concat('CUST-', l_suppkey), 'carrier_code', 'CARR-1', 'rma_status', l_linestatus,
 'lines', array(named_struct('line_id', cast(l_linenumber AS string), 'sku', concat('SKU-', l_partkey), 'quantity_returned', cast(l_quantity AS int), 'quantity_accepted', l_linenumber, 'return_reason', l_returnflag, 'resolution', cast(NULL AS string))))""",
        "CASE WHEN l_linenumber <> 7 THEN concat('RET-', l_orderkey, '-', l_linenumber) END AS event_id, cast(l_shipdate AS date) AS event_date, CASE WHEN l_linenumber <> 6 THEN concat('RMA-', l_orderkey) ELSE '' END AS rma_id,"
        " 'return_requested' AS event_subtype, concat('ORD-', l_orderkey) AS order_id, concat('CUST-', l_suppkey) AS customer_id, 'CARR-1' AS carrier_code, l_linestatus AS status, '' AS _dq_flags",
        "event_id",
        where="l_returnflag = 'R'",
        keep="event_id IS NOT NULL AND rma_id <> ''",
    ),
    "demand_plans": Feed(
        "orders",
        "'demand_plans'",
        """named_struct('plan_lines', array(named_struct('product_group', o_orderpriority, 'customer_segment', o_orderstatus, 'periods', array(
  named_struct('month', date_format(o_orderdate, 'yyyy-MM'), 'planned_quantity', cast(o_totalprice AS decimal(15,2)), 'confidence_low', 1, 'confidence_high', 2),
  named_struct('month', date_format(add_months(cast(o_orderdate AS date), 1), 'yyyy-MM'), 'planned_quantity', o_custkey, 'confidence_low', cast(NULL AS int), 'confidence_high', 3)))))""",
        "cast(date_trunc('month', o_orderdate) AS date) AS plan_month, o_orderpriority AS product_group, o_orderstatus AS customer_segment,"
        f" CASE WHEN i = 0 THEN cast(date_trunc('month', o_orderdate) AS date) ELSE {_NEXT} END AS period_month,"
        " CASE WHEN i = 0 THEN cast(o_totalprice AS decimal(15,2)) ELSE o_custkey END AS planned_qty, CASE WHEN i = 0 THEN 1 END AS confidence_low, 2 + i AS confidence_high, '' AS _dq_flags",
        "plan_month, product_group, customer_segment, period_month",
        unnest=" CROSS JOIN (VALUES (0), (1)) v(i)",
    ),
    "inventory_targets": Feed(
        "lineitem",
        "'inventory_targets'",
        """named_struct('sku', CASE WHEN l_linenumber <> 7 THEN concat('SKU-', l_partkey) END, 'warehouse', concat('W', l_suppkey % 3), 'safety_stock', l_linenumber, 'reorder_point', cast(l_quantity AS int), 'target_stock', 50, 'review_trigger', l_returnflag)""",
        "cast(date_trunc('month', l_shipdate) AS date) AS target_month, CASE WHEN l_linenumber <> 7 THEN concat('SKU-', l_partkey) END AS sku, concat('W', l_suppkey % 3) AS warehouse_id, l_linenumber AS safety_stock,"
        " cast(l_quantity AS int) AS reorder_point, 50 AS target_stock, l_returnflag AS review_trigger, '' AS _dq_flags",
        "target_month, sku, warehouse_id",
        keep="sku IS NOT NULL",
    ),
    "demand_signals": Feed(
        "events",
        "'demand_signals'",
        """named_struct('signal_id', concat('SIG-', event_id % 4000), 'signal_source', 'crm', 'customer_id', concat('CUST-', user_id), 'product_group', event_type, 'signal_type', 'up', 'magnitude', cast(user_id AS string),
 'horizon_weeks', event_id % 12, 'confidence', cast((event_id % 100) * 0.01 AS decimal(6,2)))""",
        "concat('SIG-', event_id % 4000) AS signal_id, cast(ts AS date) AS signal_date, 'crm' AS signal_source, concat('CUST-', user_id) AS customer_id, event_type AS product_group, 'up' AS signal_type,"
        " cast(user_id AS varchar) AS magnitude, event_id % 12 AS horizon_weeks, (event_id % 100) / 100.0 AS confidence, '' AS _dq_flags",
        "signal_id",
    ),
    "demand_forecasts": Feed(
        "orders",
        "'demand_forecasts'",
        """named_struct('model_version', concat('v', o_orderkey % 3), 'lines', array(named_struct('sku_group', o_orderpriority, 'periods', array(
  named_struct('month', date_format(o_orderdate, 'yyyy-MM'), 'forecast_quantity', cast(o_totalprice AS decimal(15,2)), 'lower_bound', 1, 'upper_bound', 2),
  named_struct('month', date_format(add_months(cast(o_orderdate AS date), 1), 'yyyy-MM'), 'forecast_quantity', o_custkey, 'lower_bound', cast(NULL AS int), 'upper_bound', 3)))))""",
        f"cast(date_trunc('month', o_orderdate) AS date) AS forecast_month, o_orderpriority AS product_group, CASE WHEN i = 0 THEN cast(date_trunc('month', o_orderdate) AS date) ELSE {_NEXT} END AS period_month,"
        " CASE WHEN i = 0 THEN cast(o_totalprice AS decimal(15,2)) ELSE o_custkey END AS forecast_qty, CASE WHEN i = 0 THEN 1 END AS lower_bound, 2 + i AS upper_bound, concat('v', o_orderkey % 3) AS model_version, '' AS _dq_flags",
        "forecast_month, product_group, period_month",
        unnest=" CROSS JOIN (VALUES (0), (1)) v(i)",
    ),
}
FEEDS["return_lines"] = Feed(
    "lineitem",
    FEEDS["returns"].event_type,
    FEEDS["returns"].payload,
    "CASE WHEN l_linenumber <> 6 THEN concat('RMA-', l_orderkey) ELSE '' END AS rma_id, cast(l_linenumber AS varchar) AS line_id, concat('SKU-', l_partkey) AS sku, cast(l_quantity AS int) AS quantity_returned,"
    " l_linenumber AS quantity_accepted, l_returnflag AS return_reason, cast(NULL AS varchar) AS resolution, '' AS _dq_flags, l_linenumber AS __l",
    "rma_id, line_id",
    where="l_returnflag = 'R'",
    keep="__l <> 7 AND rma_id <> ''",
)

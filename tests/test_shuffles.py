"""What the wide plans send through shuffles."""

import re
from pathlib import Path

import pytest

from millrace.catalogue.adapters import Model
from millrace.catalogue.queries import QUERIES
from millrace.functions.scalars import packed, unpacked
from millrace.operators import upsert_guarded
from millrace.plans import exports
from millrace.session import tune
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="benchmark tables are not here")


def plan_of(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on tables too large to broadcast
    try:
        return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name, column", [("export_orders_flat", "sku"), ("export_inventory_flat", "sku")])
def test_exports_do_not_shuffle_the_fact_again(spark, name, column):
    """One exchange by (bucket, key) for the fact; none by the key alone above it."""
    joins = re.findall(r"SortMergeJoin \[([^\]]*)\]", plan_of(spark, name))
    assert not any(re.fullmatch(rf"{column}#\d+", keys) for keys in joins)


@pytest.mark.parametrize("name", ["fact_order_lines", "export_orders_flat"])
def test_keys_are_made_after_the_last_shuffle(spark, name):
    lines = plan_of(spark, name).splitlines()
    keys = [i for i, line in enumerate(lines) if "md5(" in line]
    shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert keys and max(keys) < min(shuffles)


def test_lines_are_dealt_out_once_for_versions_and_backorders(spark):
    assert "hashpartitioning(l_orderkey" not in plan_of(spark, "fact_order_lines")


def test_production_is_grouped_once(spark):
    """Weeks are known before rows are grouped, so no grouping by day is shuffled first."""
    assert not re.search(r"hashpartitioning\(sku#\d+, \w+#\d+, completion_date", plan_of(spark, "agg_production_quality"))


def test_loads_equal_those_of_whole_reports(spark):
    m = Model(spark, FOLDER)
    whole = upsert_guarded(None, m.load_reports, ["load_id"], [F.col("sync_window")], [F.col(c) for c in m.LOAD_ORDER])
    whole = whole.select(*m.loads.columns)
    assert whole.exceptAll(m.loads).isEmpty() and m.loads.exceptAll(whole).isEmpty()


def test_versions_show_todays_attributes(spark):
    rows = [("a", "2020-01-01", "2020-06-30", False, "old"), ("a", "2020-07-01", None, True, None), ("b", "2020-01-01", None, True, "x")]
    dim = spark.createDataFrame(rows, "k string, f string, t string, is_current boolean, v string").selectExpr(
        "k", "cast(f AS date) AS effective_from", "cast(t AS date) AS effective_to", "is_current", "v", "upper(k) AS w"
    )
    got = sorted((r.k, str(r.effective_from), r.v, r.w) for r in exports.with_current(dim, "k", ["v", "w"]).collect())
    assert got == [("a", "2020-01-01", None, "A"), ("a", "2020-07-01", None, "A"), ("b", "2020-01-01", "x", "B")]


def test_shuffles_are_cut_finely_and_a_larger_number_is_kept(spark):
    name, before = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", spark.conf.get("spark.sql.shuffle.partitions")
    try:
        tune(spark)
        assert int(spark.conf.get(name)) == 480
        spark.conf.set("spark.sql.shuffle.partitions", "900")
        tune(spark)
        assert int(spark.conf.get(name)) == 900
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        tune(spark)


def test_staging_is_counted_without_ordering_rows(spark):
    """A window per staging table would sort all its rows; the sorts that are left belong to the two joins of lines and orders."""
    plan = plan_of(spark, "staging_counts")
    assert "Window" not in plan and plan.count("Sort [") <= 4


def test_lines_are_dealt_out_by_sku_with_measures_only(spark):
    """What prices and shipped quantities are made of stays behind when lines go to their SKU's versions."""
    lines = plan_of(spark, "agg_sku_performance").splitlines()
    shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(__bucket" in line]
    dealt = [lines[i + 1] for i in shuffles if "quantity_ordered" in lines[i + 1]]
    assert dealt and all("AS line_revenue_pln" in line and "currency#" not in line for line in dealt)


@pytest.mark.parametrize("name", ["fact_order_lines", "fact_returns"])
def test_ids_are_made_after_the_newest_report_is_found(spark, name):
    assert not re.search(r"hashpartitioning\((load_id|event_id)#", plan_of(spark, name))


def test_orders_of_a_day_are_told_apart_without_their_sums(spark):
    plan = plan_of(spark, "agg_order_metrics_daily")
    assert "hashpartitioning(agg_date" in plan and "count(distinct" not in plan


def test_orders_of_a_customer_are_told_apart_among_lines_only(spark):
    assert "count(distinct" not in plan_of(spark, "agg_customer_scorecard")


def test_aggregates_are_reported_from_facts_that_are_built_once(spark):
    """The report reads written measures: no table of lines is scanned for orders again."""
    plan = plan_of(spark, "dq_aggregate_report")
    assert "o_orderstatus" not in plan and "l_returnflag" not in plan


def test_staging_reads_a_field_once(spark):
    """Reasons and flags look at the columns that were read: the id of a line is not read again to be found missing."""
    spark.conf.set("spark.sql.maxPlanStringLength", "1000000")
    plan = plan_of(spark, "silver_order_lines")
    assert plan.count("$.line_id,") == 1


@pytest.mark.parametrize("name, most", [("spark.sql.files.maxPartitionBytes", 8 << 20), ("spark.sql.adaptive.advisoryPartitionSizeInBytes", 32 << 20)])
def test_rows_are_sorted_in_small_pieces_and_a_smaller_size_is_kept(spark, name, most):
    """Rows of a piece are sorted before they are shuffled, and after: a large piece spills more than it sends."""
    before = spark.conf.get(name)
    try:
        for asked, got in (("128m", most), ("134217728b", most), ("4m", 4 << 20), ("1048576", 1 << 20)):
            spark.conf.set(name, asked)
            tune(spark)
            kept = spark.conf.get(name)
            assert spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(kept) == got
    finally:
        spark.conf.set(name, before)
        tune(spark)


def test_lines_carry_texts_that_pass_through_as_one(spark):
    """Between the orders and the SKU's versions the texts that nothing looks at are one column."""
    spark.conf.set("spark.sql.maxToStringFields", "1000")
    try:
        lines = plan_of(spark, "export_orders_flat").splitlines()
    finally:
        spark.conf.unset("spark.sql.maxToStringFields")
    shuffles = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\((__bucket#\d+, sku|order_id)#", line)]
    dealt = [lines[i + 1] for i in shuffles if "__texts" in lines[i + 1]]
    assert len(dealt) == 2  # orders by id, lines by SKU
    names = ("company_name", "segment", "country_code", "region", "sales_channel", "incoterms")
    assert not any(re.search(rf"[\[ ]{name}#\d+[,\]]", line) for line in dealt for name in names)


def test_packed_texts_come_back_as_they_were(spark):
    values = [None, "", "a", "\u0001", "\u0002", "\u0002n", "\u0002s", "\u0002es\u0001\u0001", "\u00e9\u0001\u65e5", " ", "x\ny"]
    rows = [(i, a, b, c) for i, (a, b, c) in enumerate((a, b, c) for a in values for b in values for c in values)]
    df = spark.createDataFrame(rows, "i int, a string, b string, c string").select("i", packed(["a", "b", "c"]).alias("p"))
    got = df.select("i", *[part.alias(name) for name, part in unpacked(F.col("p"), ["a", "b", "c"]).items()])
    assert sorted(tuple(r) for r in got.collect()) == rows

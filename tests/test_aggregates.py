"""Plans of the scorecards: one grouping over all facts, histories and rates written once."""

import pytest

from millrace.catalogue.adapters import Model

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("table,scans,exchanges", [("agg_customer_scorecard", 21, 24)])
def test_scorecards_read_the_tables_about_half_as_often(spark, table, scans, exchanges):
    """Against a grouping and a join for each fact, and a history made again for each look-up."""
    df = getattr(Model(spark, FOLDER), table)
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    assert sum("FileScan" in line and FOLDER in line for line in lines) <= scans * 0.55
    assert sum(" Exchange " in line for line in lines) <= exchanges * 3 / 4

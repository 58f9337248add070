"""Every catalogue query against its SQL, and what its plan must not contain."""

import re
from pathlib import Path

import compare
import pytest

import __spark_entry__ as contract
from millrace.catalogue.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("NestedLoop", "CartesianProduct", "PythonUDF", "InPandas", "ArrowEval"):
        assert forbidden not in plan
    assert compare.difference(df, duck, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_contract_registers_the_catalogue():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_library_stays_on_the_cluster():
    banned = re.compile(
        r"\budf\(|\bbroadcast\(|\.collect\(|toPandas|localCheckpoint|crossJoin|\.toLocalIterator|\.limit\(|\.sample\("
        r"|\.rdd\b|tempfile|TEXT_LIMIT|MAX_FILE"
    )
    for source in (ROOT / "millrace").rglob("*.py"):
        if source.parent.name != "llm":
            assert not banned.search(source.read_text()), source

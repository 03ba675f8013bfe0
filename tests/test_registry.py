"""Registered queries against their oracle SQL, and the plan shapes they rely on."""

import re

import pytest

import __spark_entry__ as registered
from check import compare, connect
from tallyweave.operators.durable import stored
from tallyweave.operators.metrics import dimension_totals
from tallyweave.operators.queue import aging_metrics, scored_cases, top_cases
from tallyweave.plans.catalogue import PLANS, Inputs
from tallyweave.sources.order_feeds import read_orders

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


# The training-data queries have tests of their own in tests/llm.
@pytest.mark.parametrize("name", list(PLANS))
def test_query_equals_oracle(spark, oracle, name):
    outcome = compare(spark, oracle, SF, name, registered.oracle_sql().get(name))
    assert outcome.startswith(("equal", "rows only")), outcome


def test_every_statement_belongs_to_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())
    assert set(PLANS) <= set(registered.oracle_sql())


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def plan_of(spark, name):
    df = PLANS[name](Inputs(spark, read_orders(spark, SF)))
    return df._jdf.queryExecution().executedPlan().toString()


def test_quantiles_sort_nothing_as_a_whole(spark):
    """The one stored table is the counts; every scan behind it reads that table."""
    plan = plan_of(spark, "settlement_delay_metrics")
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan and "FileScan" not in plan


@pytest.mark.parametrize(
    "name,exchanges",
    [
        ("payment_facts", 1),
        ("exception_signals", 1),
        ("reconciliation_facts", 1),
        ("signals_amount_mismatch", 1),
        ("legacy_detections", 1),
        ("expected_fees", 0),
        ("truth_labels", 0),
    ],
)
def test_number_of_exchanges(spark, name, exchanges):
    plan = plan_of(spark, name)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == exchanges
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SinglePartition" not in plan


JIT_LIMIT = 8000  # bytes of code above which the JVM, by default, does not compile a method


@pytest.mark.parametrize("name", ["payment_facts", "detected_exceptions", "dimension_metrics", "summary"])
def test_generated_code_stays_compilable(spark, name):
    assert largest_method(spark, PLANS[name](Inputs(spark, read_orders(spark, SF)))) < JIT_LIMIT


def test_generated_code_of_stored_runs_stays_compilable(spark):
    inputs = Inputs(spark, read_orders(spark, SF))
    assert largest_method(spark, inputs.cases) < JIT_LIMIT
    cases = stored(inputs.cases, "case_facts")
    for table in (scored_cases(cases), aging_metrics(cases), top_cases(cases, 25), dimension_totals(cases)):
        assert largest_method(spark, table) < JIT_LIMIT


def largest_method(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return max((int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)), default=0)


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "feed_internal")
    assert "LessThanOrEqual(o_orderdate,2001-07-30T00:00)" in plan
    narrow = plan_of(spark, "source_counts")
    assert "o_totalprice" not in narrow and "o_orderpriority" not in narrow


@pytest.mark.parametrize("name", sorted(set(PLANS) - {"operational_run", "csv_round_trip"}))
def test_no_python_rows_in_plans(spark, name):
    assert "Python" not in plan_of(spark, name)

"""One key may own a third of all rows: results stay whole and rows collapse early."""

import re

import pytest

from tallyweave.operators.evaluation import comparison, evaluation_summary, outcome_counts
from tallyweave.operators.facts import payment_facts
from tallyweave.operators.matching import single_records
from tallyweave.operators.metrics import dimension_totals, settlement_delay_metrics
from tallyweave.operators.rules import case_facts

ROWS = 60_000
HOT = ROWS // 3


@pytest.fixture(scope="module")
def feeds(spark):
    """Gateway and bank each give a third of their rows to one id; all providers unknown."""
    ids = spark.range(0, ROWS, 1, 6).selectExpr("id", f"IF(id % 3 = 0, 'hot', concat('t', id)) AS transaction_id")
    at = "TIMESTAMP_NTZ'2026-01-01 00:00:00'"
    money = "CAST(100.00 AS DECIMAL(18,2))"
    return {
        "internal": ids.selectExpr("transaction_id").distinct().selectExpr(
            "transaction_id",
            "concat('O', transaction_id) AS order_id",
            "'M1' AS merchant_id",
            "'card' AS payment_method",
            "'INR' AS currency",
            "'success' AS internal_status",
            f"{at} AS created_at",
            f"{money} AS gross_amount",
        ),
        "gateway": ids.selectExpr(
            "transaction_id",
            "concat('G', id) AS gateway_record_id",
            "'success' AS gateway_status",
            f"{at} AS gateway_event_at",
            f"{money} AS gateway_amount",
            "CAST(2.00 AS DECIMAL(18,2)) AS gateway_fee",
            "CAST(0.36 AS DECIMAL(18,2)) AS gateway_tax",
            "CAST(97.64 AS DECIMAL(18,2)) AS gateway_net",
            "'unknown' AS gateway_id",
        ),
        "settlement": ids.selectExpr(
            "transaction_id",
            "concat('S', id) AS settlement_line_id",
            f"{at} + make_dt_interval(0, 0, 0, id) AS settled_at",
            f"{money} AS gross_amount",
            "CAST(2.00 AS DECIMAL(18,2)) AS fee_amount",
            "CAST(0.36 AS DECIMAL(18,2)) AS tax_amount",
            "CAST(97.64 AS DECIMAL(18,2)) AS net_amount",
        ),
    }


def test_hot_id_keeps_every_record(spark, feeds):
    facts = payment_facts(feeds, "2026-02-10")
    (hot,) = facts.filter("transaction_id = 'hot'").collect()
    assert (hot.gateway_rows, hot.settlement_rows) == (HOT, HOT)
    assert hot.gateway_gross_total == 100 * HOT
    assert hot.gateway_duplicate_excess == 100 * (HOT - 1)
    (whole,) = dimension_totals(case_facts(facts), ("merchant",), include_all=False).collect()
    assert whole.observed_transactions == ROWS - HOT + 1
    assert whole.gateway_gross_inr == 100 * ROWS
    assert single_records(feeds["gateway"].select("transaction_id", "gateway_amount")).count() == ROWS - HOT


def test_records_collapse_before_the_exchange(spark, feeds):
    plan = payment_facts(feeds, "2026-02-10")._jdf.queryExecution().executedPlan().toString()
    above, below = re.split(r"Exchange hashpartitioning", plan, maxsplit=1)
    assert "partial_sum" in below and "partial_sum" not in above


def test_quantiles_of_one_hot_provider(spark, feeds):
    (row,) = settlement_delay_metrics(case_facts(payment_facts(feeds, "2026-02-10"))).collect()
    delays = sorted(i / 86400 for i in range(ROWS) if i % 3)
    assert row.observed_unique_settlements == len(delays)
    middle = len(delays) // 2
    assert row.median_delay_days == pytest.approx((delays[middle - 1] + delays[middle]) / 2)
    place = 0.95 * (len(delays) - 1)
    low = int(place)
    assert row.p95_delay_days == pytest.approx(delays[low] + (delays[low + 1] - delays[low]) * (place - low))
    assert row.mean_delay_days == pytest.approx(sum(delays) / len(delays))


def test_hot_truth_key_keeps_every_label(spark):
    truth = spark.range(ROWS).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('t', id)) AS transaction_id", "'x' AS exception_type", "1.0 AS reference_amount"
    )
    found = spark.createDataFrame([("hot", "x", 1.0), ("t1", "x", 1.0), ("new", "x", 1.0)],
                                  "transaction_id string, exception_type string, amount_at_risk double")
    outcomes = {r.outcome: r["count"] for r in comparison(truth, found).groupBy("outcome").count().collect()}
    assert outcomes == {"tp": HOT + 1, "fn": ROWS - HOT - 1, "fp": 1}
    (row,) = evaluation_summary(outcome_counts(truth, found)).collect()
    assert (row.tp, row.fp, row.fn, row.detected_exceptions) == (HOT + 1, 1, ROWS - HOT - 1, 3)

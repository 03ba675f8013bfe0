"""The ten-rule detector, its difference from the operational rules, and evaluation."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from payments import Payments, by_id
from tallyweave.operators.evaluation import evaluate_detections
from tallyweave.operators.legacy import detections, detector_differences, reconcile
from tallyweave.operators.rules import CORE_RULES, detected_exceptions
from tallyweave.plans.operations import cases_at
from tallyweave.sources.contracts import LEGACY_CONTRACTS, typed
from tallyweave.sources.order_feeds import order_feeds, read_orders, truth_labels

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def matured(spark):
    """Orders without the unequal or threefold duplicates on which detectors differ."""
    return read_orders(spark, SF).filter(
        "NOT (o_orderkey % 100 = 5 OR (o_orderkey % 100 = 4 AND (o_orderkey div 100) % 3 = 0))"
    )


def test_detectors_agree_on_a_matured_snapshot(spark, matured):
    feeds = order_feeds(matured)
    legacy = detections({c.name: typed(feeds[c.name], c, lower_status=False) for c in LEGACY_CONTRACTS})
    assert detector_differences(legacy, cases_at(feeds, "2010-01-01")).collect() == []
    assert legacy.select("exception_type").distinct().count() == 9


def test_every_label_is_found_on_a_matured_snapshot(spark):
    orders = read_orders(spark, SF)
    detected = detected_exceptions(cases_at(order_feeds(orders), "2010-01-01"))
    core = detected.filter(F.col("exception_type").isin(*CORE_RULES))
    result = evaluate_detections(truth_labels(orders), core)
    (row,) = result.summary.collect()
    assert (row.precision, row.recall, row.f1, row.amount_capture_rate) == (1, 1, 1, 1)
    assert row.truth_exceptions == row.tp == result.comparison.filter("outcome = 'tp'").count()


def test_dynamic_reasons_and_largest_duplicate(spark):
    p = Payments()
    p.add("copies", gateway=[{}, {"gateway_amount": "1500.00"}, {}])
    p.add("amount", gateway=[{"gateway_amount": "1000.06"}], bank=[])
    p.add("status", gateway=[{"gateway_status": "Failed"}])
    p.add("same_status", ledger=[{"internal_status": "SUCCESS"}])
    p.add("late", bank=[{"settled_at": "2026-01-08T07:00:00"}])
    p.add("boundary", gateway=[{"gateway_amount": "1000.05"}], bank=[{"gross_amount": "1000.05"}])
    feeds = p.feeds(spark)
    ledger = feeds["internal"].drop("merchant_id", "payment_method", "currency")
    got = by_id(reconcile(ledger, feeds["gateway"], feeds["settlement"]), "transaction_id", "exception_type")
    assert {k: (r.amount_at_risk, r.reason) for k, r in got.items()} == {
        ("copies", "duplicate_gateway"): (
            Decimal("1500.00"),
            "3 gateway records share the same transaction_id.",
        ),
        ("amount", "amount_mismatch"): (
            Decimal("0.06"),
            "Internal gross 1000.00 differs from gateway amount 1000.06.",
        ),
        ("amount", "missing_settlement"): (
            Decimal("976.40"),
            "Successful payment has no bank settlement line.",
        ),
        ("status", "status_mismatch"): (
            Decimal("1000.00"),
            "Internal status success differs from gateway status Failed.",
        ),
        ("late", "settlement_delay"): (
            Decimal("976.40"),
            "Settlement occurred after 7.25 days; maximum allowed is 3.00.",
        ),
    }


def test_unvalidated_amounts_never_count_below_zero(spark):
    feeds = Payments().add("refund", ledger=[], gateway=[{"gateway_amount": "-5.00"}], bank=[]).feeds(spark)
    (row,) = reconcile(**feeds).collect()
    assert (row.exception_type, row.amount_at_risk) == ("orphan_gateway", 0)


def test_records_without_event_times_still_count(spark):
    feeds = Payments().add("timeless", ledger=[{"created_at": None}], gateway=[{}, {}]).feeds(spark)
    assert [r.exception_type for r in reconcile(**feeds).collect()] == ["duplicate_gateway"]


def test_legacy_contract(spark):
    feeds = Payments().add("001").feeds(spark)
    with pytest.raises(ValueError, match="repeated transaction_id"):
        reconcile(feeds["internal"].union(feeds["internal"]), feeds["gateway"], feeds["settlement"])
    with pytest.raises(ValueError, match="null values"):
        nulls = feeds["gateway"].withColumn("transaction_id", F.lit(None).cast("string"))
        reconcile(feeds["internal"], nulls, feeds["settlement"])
    with pytest.raises(ValueError, match="missing columns"):
        reconcile(feeds["internal"].drop("order_id"), feeds["gateway"], feeds["settlement"])


def test_evaluation_by_hand(spark):
    truth = spark.createDataFrame(
        [("a", "x", 10.0), ("b", "x", 30.0), ("c", "y", 60.0), ("c", "y", 60.0)],
        "transaction_id string, exception_type string, reference_amount double",
    )
    found = spark.createDataFrame(
        [("a", "x", 9.0), ("a", "x", 9.0), ("z", "x", 1.0), ("q", "w", 1.0)],
        "transaction_id string, exception_type string, amount_at_risk double",
    )
    result = evaluate_detections(truth, found)
    types = by_id(result.by_type, "exception_type")
    assert {t: (r.tp, r.fp, r.fn) for t, r in types.items()} == {"x": (1, 1, 1), "y": (0, 0, 2), "w": (0, 1, 0)}
    assert types["x"].precision == types["x"].recall == types["x"].f1 == 0.5
    assert types["y"].precision == types["y"].f1 == 0
    (row,) = result.summary.collect()
    assert (row.truth_exceptions, row.detected_exceptions, row.tp, row.fp, row.fn) == (4, 3, 1, 2, 3)
    assert (row.injected_reference_amount, row.captured_reference_amount) == (160, 10)
    assert row.amount_capture_rate == 0.0625
    outcomes = sorted((r.transaction_id, r.outcome) for r in result.comparison.collect())
    assert outcomes == [("a", "tp"), ("b", "fn"), ("c", "fn"), ("c", "fn"), ("q", "fp"), ("z", "fp")]


def test_evaluation_of_nothing(spark):
    truth = spark.createDataFrame([], "transaction_id string, exception_type string, reference_amount double")
    found = spark.createDataFrame([], "transaction_id string, exception_type string, amount_at_risk double")
    (row,) = evaluate_detections(truth, found).summary.collect()
    assert (row.tp, row.precision, row.recall, row.f1, row.amount_capture_rate) == (0, 0, 0, 0, 0)
    with pytest.raises(ValueError, match="truth is missing"):
        evaluate_detections(truth.drop("reference_amount"), found)

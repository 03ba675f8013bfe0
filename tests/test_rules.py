"""Hand-calculated scenarios of the operational rules."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from payments import Payments, by_id
from tallyweave.config import ReconciliationConfig
from tallyweave.operators.metrics import dimension_totals, settlement_delay_metrics, summary
from tallyweave.operators.queue import scored_cases, top_cases
from tallyweave.operators.rules import detected_exceptions, exception_rollup, flagged_cases
from tallyweave.plans.operations import cases_at

AS_OF = "2026-02-10"
AGES = {0: "0 days", 3: "0-3 days", 3.5: "3-7 days", 7: "3-7 days", 14: "7-14 days", 30: "14-30 days", 31: "30+ days"}


def scenarios() -> Payments:
    p = Payments()
    p.add("clean")
    p.add("within", gateway=[{"gateway_amount": "1000.05"}])
    p.add("beyond", gateway=[{"gateway_amount": "1000.06"}])
    p.add("fee", bank=[{"fee_amount": "25", "net_amount": "971.40"}])
    p.add("gross_net", bank=[{"gross_amount": "990", "net_amount": "900"}])
    p.add("copies", gateway=[{}, {}, {}], bank=[{}, {}])
    p.add("unequal", bank=[{}, {"net_amount": "100"}, {"net_amount": "200"}])
    p.add("orphan_g", ledger=[], bank=[])
    p.add("orphan_s", ledger=[], gateway=[])
    p.add("orphan_both", ledger=[])
    p.add("orphan_copies", ledger=[], gateway=[{}, {}], bank=[])
    p.add("no_gateway_paid", gateway=[])
    p.add("no_gateway", gateway=[], bank=[])
    p.add("failed", gateway=[{"gateway_status": "FAILED"}])
    p.add("both_failed", ledger=[{"internal_status": "Failed"}], gateway=[{"gateway_status": "failed"}], bank=[])
    p.add("late", bank=[{"settled_at": "2026-01-08T01:00:00Z"}])
    p.add("provider", gateway=[{"gateway_id": "p1"}])
    p.add("providers", gateway=[{"gateway_id": "p1"}, {"gateway_id": "p2"}])
    p.add("blank_provider", gateway=[{"gateway_id": "  "}])
    p.add("future", ledger=[{"created_at": "2026-03-01"}], gateway=[], bank=[])
    for days in AGES:
        at = datetime(2026, 2, 10) - timedelta(days=days)
        p.add(f"age_{days}", ledger=[{"created_at": at.isoformat()}], gateway=[], bank=[])
    return p


@pytest.fixture(scope="module")
def cases(spark):
    return cases_at(scenarios().feeds(spark), AS_OF)


@pytest.fixture(scope="module")
def facts(cases):
    return by_id(cases)


@pytest.fixture(scope="module")
def flagged(cases):
    return by_id(flagged_cases(cases))


@pytest.fixture(scope="module")
def signals(cases):
    return by_id(detected_exceptions(cases), "transaction_id", "exception_type")


def types_of(signals, tx):
    return {rule for owner, rule in signals if owner == tx}


@pytest.mark.parametrize(
    "tx,expected",
    [
        ("clean", set()),
        ("within", set()),
        ("beyond", {"amount_mismatch", "settlement_gross_mismatch"}),
        ("fee", {"fee_mismatch", "settlement_net_mismatch"}),
        ("gross_net", {"settlement_gross_mismatch", "settlement_net_mismatch"}),
        ("copies", {"duplicate_gateway", "duplicate_settlement"}),
        ("unequal", {"duplicate_settlement"}),
        ("orphan_g", {"orphan_gateway"}),
        ("orphan_s", {"orphan_settlement"}),
        ("orphan_both", {"orphan_gateway", "orphan_settlement"}),
        ("orphan_copies", {"duplicate_gateway"}),
        ("no_gateway_paid", {"missing_gateway"}),
        ("no_gateway", {"missing_gateway"}),
        ("failed", {"status_mismatch"}),
        ("both_failed", set()),
        ("late", {"settlement_delay"}),
    ],
)
def test_rules_that_fire(signals, facts, tx, expected):
    assert types_of(signals, tx) == expected
    assert facts[tx].exception_types == ", ".join(sorted(expected))
    assert facts[tx].exception_count == len(expected)


@pytest.mark.parametrize(
    "tx,exposure",
    [
        ("fee", "5.00"),
        ("gross_net", "76.40"),
        ("copies", "2000.00"),
        ("unequal", "300.00"),
        ("orphan_g", "1000.00"),
        ("orphan_s", "976.40"),
        ("no_gateway_paid", "0.00"),
        ("no_gateway", "1000.00"),
        ("failed", "0.00"),
        ("late", "0.00"),
    ],
)
def test_current_exposure_counts_once(facts, tx, exposure):
    assert facts[tx].financial_exposure_inr + facts[tx].overdue_cash_inr == Decimal(exposure)


def test_amounts_and_deltas(facts, flagged, signals):
    assert signals["no_gateway_paid", "missing_gateway"].amount_at_risk == 1000
    assert facts["gross_net"].gateway_bank_gross_delta == -10
    assert facts["gross_net"].gateway_bank_net_delta == Decimal("-76.40")
    assert facts["copies"].gateway_bank_net_delta is None
    assert facts["copies"].ledger_gateway_gross_delta is None
    assert facts["copies"].gateway_gross_total == 3000
    assert facts["copies"].bank_net_total == Decimal("1952.80")
    assert facts["late"].historical_late_cash_inr == Decimal("976.40")
    assert flagged["late"].exception_age_days == 4


def test_states(facts):
    states = {tx: (f.settlement_state, f.reconciliation_state) for tx, f in facts.items()}
    assert states["clean"] == ("settled", "matched")
    assert states["copies"] == ("ambiguous_duplicate", "exception")
    assert states["both_failed"] == ("not_eligible_or_unmatched", "no_exception_not_three_way")
    assert "future" not in states


def test_providers(facts):
    assert facts["provider"].gateway_id == "p1"
    assert facts["providers"].gateway_id == "multiple"
    assert {facts[t].gateway_id for t in ("blank_provider", "clean", "no_gateway")} == {"unknown"}


def test_queue_cases(cases):
    queue = by_id(scored_cases(cases))
    for days, bucket in AGES.items():
        assert queue[f"age_{days}"].aging_bucket == bucket
    assert queue["late"].case_status == "settled_late_review"
    assert queue["fee"].case_status == "open_review"
    assert queue["fee"].recommended_actions == (
        "Finance operations: verify fee schedule and tax deductions; "
        "Payment operations: compare source records and investigate discrepancy"
    )
    assert queue["orphan_both"].severity == "critical"


def test_rollup_by_grouping_equals_rollup_on_the_row(cases, flagged):
    grouped = by_id(exception_rollup(detected_exceptions(cases)))
    assert grouped.keys() == flagged.keys()
    for tx, row in grouped.items():
        fact = flagged[tx]
        assert row.exception_types == fact.exception_types
        assert row.severity_rank == fact.severity_rank
        assert row.age_days == fact.exception_age_days
        assert row.recommended_actions == fact.recommended_actions
        assert row.historical_only == fact.historical_only
        for name in ("financial_exposure_inr", "overdue_cash_inr", "historical_late_cash_inr"):
            assert row[name] == fact[name]


def test_dimension_totals_tie_out(cases, facts):
    rows = dimension_totals(cases).collect()
    whole = next(r for r in rows if r.dimension == "all")
    assert whole.observed_transactions == len(facts)
    for dimension in ("merchant", "day", "payment_method", "gateway"):
        part = [r for r in rows if r.dimension == dimension]
        for measure in ("observed_transactions", "exception_count", "internal_gross_inr", "current_exposure_inr"):
            assert sum(r[measure] for r in part) == whole[measure]
    unknown = next(r for r in rows if r.dimension == "merchant" and r.dimension_value == "unknown")
    assert unknown.internal_payments == 0
    assert unknown.internal_exception_rate is None


def single(spark, as_of, **changes):
    return cases_at(Payments().add("001", **changes).feeds(spark), as_of)


@pytest.mark.parametrize(
    "as_of,state,overdue",
    [
        ("2026-01-04T00:59:59Z", "pending", 0),
        ("2026-01-04T01:00:00Z", "pending", 0),
        ("2026-01-04T01:00:01Z", "overdue", Decimal("976.40")),
    ],
)
def test_due_second(spark, as_of, state, overdue):
    (row,) = single(spark, as_of, bank=[]).collect()
    assert (row.settlement_state, row.overdue_cash_inr) == (state, overdue)
    assert row.exception_count == (state == "overdue")


def test_fractional_window_and_tolerances(spark):
    p = Payments()
    p.add("on_time", bank=[{"settled_at": "2026-01-03T13:00:00"}])
    p.add("late", bank=[{"settled_at": "2026-01-03T13:00:01"}])
    p.add("gross", gateway=[{"gateway_amount": "1000.50"}], bank=[{"gross_amount": "1000.50"}])
    p.add("fee", bank=[{"fee_amount": "20.02"}])
    config = ReconciliationConfig(amount_tolerance=0.5, fee_tolerance=0.015, max_settlement_days=2.5)
    rows = by_id(cases_at(p.feeds(spark), AS_OF, config))
    assert {tx: row.exception_types for tx, row in rows.items()} == {
        "on_time": "",
        "late": "settlement_delay",
        "gross": "",
        "fee": "fee_mismatch",
    }
    assert rows["late"].settlement_due_at == datetime(2026, 1, 3, 13)


def test_late_cash_is_unknown_before_it_arrives_and_stops_ageing_after(spark):
    late = [{"settled_at": "2026-01-08T01:00:00Z"}]
    (before,) = flagged_cases(single(spark, "2026-01-05T01:00:00Z", bank=late)).collect()
    assert (before.overdue_cash_inr, before.exception_age_days, before.bank_net_total) == (Decimal("976.40"), 1, None)
    for as_of in ("2026-01-08T01:00:00Z", "2026-03-01"):
        (after,) = flagged_cases(single(spark, as_of, bank=late)).collect()
        assert after.overdue_cash_inr == 0
        assert after.historical_late_cash_inr == Decimal("976.40")
        assert (after.exception_age_days, after.historical_only) == (4, True)


def test_offset_cutoff_equals_utc_cutoff(spark):
    utc = single(spark, "2026-01-02T01:00:00Z").collect()
    assert utc == single(spark, "2026-01-02T06:30:00+05:30").collect()
    assert utc[0].reconciliation_state == "matched"


def test_clean_summary_and_delay(spark):
    cases = single(spark, AS_OF)
    (row,) = summary(cases).collect()
    assert (row.matched_payments, row.exception_count, row.current_exposure_inr) == (1, 0, 0)
    assert row.exception_transaction_rate == 0
    (delay,) = settlement_delay_metrics(cases).collect()
    assert (delay.mean_delay_days, delay.median_delay_days, delay.p95_delay_days) == (1, 1, 1)


def test_no_input_gives_one_zero_summary(spark):
    cases = single(spark, "2025-12-31T23:00:00Z")
    (row,) = summary(cases).collect()
    assert row.observed_transactions == 0
    assert row.exception_transaction_rate is None
    assert top_cases(cases, 5).collect() == []


def test_priority_combines_severity_amount_age_and_stable_ties(spark):
    p = Payments()
    for tx, amount, at in (
        ("low", "100", "2026-01-01"),
        ("high", "10000", "2026-01-01"),
        ("older", "10000", "2025-12-31"),
        ("tie", "10000", "2026-01-01"),
    ):
        p.add(tx, ledger=[{"gross_amount": amount, "created_at": at}], gateway=[], bank=[])
    rows = sorted(top_cases(cases_at(p.feeds(spark), "2026-01-05"), 10).collect(), key=lambda r: r.priority_rank)
    assert [r.transaction_id for r in rows] == ["older", "high", "tie", "low"]
    assert rows[1].priority_score == 305

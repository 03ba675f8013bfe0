"""The twelve reconciliation rules and what each one means for a transaction.

Every rule reads a single fact row, so rules, the per-transaction rollup and both
states are column expressions on that row. No rule scan, self-join or regrouping is
needed, and the work stays inside generated code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyweave.functions import aggregates, named, text_literal
from tallyweave.functions.clock import days_between
from tallyweave.functions.money import TOTAL
from tallyweave.functions.text import joined_labels
from tallyweave.operators.facts import IN_LEDGER, SUCCESS

# Review states, exposure kinds and severity ranks.
OPEN_REVIEW = "open_review"
SETTLED_LATE_REVIEW = "settled_late_review"
POTENTIAL_LOSS = "potential_loss"
DATA_INTEGRITY = "data_integrity"
CASH_TIMING = "cash_timing"
SEVERITY_RANKS = {"critical": 4, "high": 3, "medium": 2, "low": 1}

# Next step for the owning team.
REQUEST_TRACE = "Settlement operations: request bank/gateway settlement trace"
REVIEW_BREACH = "Settlement operations: review SLA breach and root cause"
VERIFY_FEES = "Finance operations: verify fee schedule and tax deductions"
FIND_OWNER = "Finance operations: identify owner of unmatched bank credit"
COMPARE_RECORDS = "Payment operations: compare source records and investigate discrepancy"

# How a rule's amount counts: as a discrepancy, as cash still due, as cash that came
# late, or not at all.
FINANCIAL = "financial"
OVERDUE = "overdue"
HISTORICAL = "historical"
NO_EXPOSURE = "none"


@dataclass(frozen=True)
class Rule:
    """``fires`` and ``amount`` are SQL expressions over one fact row."""

    name: str
    severity: str
    exposure_kind: str
    reason: str
    fires: str
    amount: str
    exposure: str = FINANCIAL
    action: str = COMPARE_RECORDS

    @property
    def bit(self) -> int:
        return 1 << RULE_NAMES.index(self.name)


# Rule names; the position is the rule's bit in a row's signal mask.
RULE_NAMES = (
    "duplicate_gateway",
    "duplicate_settlement",
    "missing_gateway",
    "orphan_gateway",
    "orphan_settlement",
    "amount_mismatch",
    "status_mismatch",
    "missing_settlement",
    "fee_mismatch",
    "settlement_delay",
    "settlement_gross_mismatch",
    "settlement_net_mismatch",
)

UNSETTLED = "(settlement_eligible AND settlement_rows = 0)"

# Severities, exposure kinds and reasons.
RULES = (
    Rule(
        "duplicate_gateway",
        "critical",
        POTENTIAL_LOSS,
        "Multiple gateway records; verify duplicate capture versus repeated feed delivery.",
        fires="gateway_rows > 1",
        amount="gateway_duplicate_excess",
    ),
    Rule(
        "duplicate_settlement",
        "critical",
        POTENTIAL_LOSS,
        "Multiple settlement lines; verify duplicate cash movement versus repeated feed delivery.",
        fires="settlement_rows > 1",
        amount="settlement_duplicate_excess",
    ),
    Rule(
        "missing_gateway",
        "high",
        POTENTIAL_LOSS,
        "Internal payment has no gateway record at the reporting cutoff.",
        fires="has_internal AND gateway_rows = 0",
        amount="internal_gross",
    ),
    Rule(
        "orphan_gateway",
        "high",
        POTENTIAL_LOSS,
        "Gateway record has no matching internal payment.",
        fires="gateway_rows = 1 AND NOT has_internal",
        amount="gateway_amount",
    ),
    Rule(
        "orphan_settlement",
        "critical",
        POTENTIAL_LOSS,
        "Bank settlement has no matching internal payment.",
        fires="settlement_rows = 1 AND NOT has_internal",
        amount="bank_net",
        action=FIND_OWNER,
    ),
    Rule(
        "amount_mismatch",
        "high",
        POTENTIAL_LOSS,
        "Internal gross and gateway gross differ beyond tolerance.",
        fires="abs(ledger_gateway_gross_delta) > amount_tolerance",
        amount="abs(ledger_gateway_gross_delta)",
    ),
    Rule(
        "status_mismatch",
        "high",
        DATA_INTEGRITY,
        "Internal and gateway statuses disagree.",
        fires=f"{IN_LEDGER} AND internal_status != gateway_status",
        amount="internal_gross",
        exposure=NO_EXPOSURE,
    ),
    Rule(
        "missing_settlement",
        "critical",
        POTENTIAL_LOSS,
        "Successful matched payment is overdue and has no bank settlement.",
        fires=f"{UNSETTLED} AND as_of > settlement_due_at",
        amount="gateway_net",
        exposure=OVERDUE,
        action=REQUEST_TRACE,
    ),
    Rule(
        "fee_mismatch",
        "medium",
        POTENTIAL_LOSS,
        "Bank fee/tax differs from gateway fee/tax.",
        fires=f"gateway_status = '{SUCCESS}' AND fee_tax_abs_delta > fee_tolerance",
        amount="fee_tax_abs_delta",
        action=VERIFY_FEES,
    ),
    Rule(
        "settlement_delay",
        "medium",
        CASH_TIMING,
        "Cash arrived after the settlement window; historical delay, not current outstanding cash.",
        fires="settlement_delay_days > max_settlement_days",
        amount="gateway_net",
        exposure=HISTORICAL,
        action=REVIEW_BREACH,
    ),
    Rule(
        "settlement_gross_mismatch",
        "high",
        POTENTIAL_LOSS,
        "Bank gross and gateway gross differ beyond tolerance.",
        fires="abs(gateway_bank_gross_delta) > amount_tolerance",
        amount="abs(gateway_bank_gross_delta)",
    ),
    Rule(
        "settlement_net_mismatch",
        "high",
        POTENTIAL_LOSS,
        "Bank net and gateway net differ beyond tolerance; may overlap fee/gross signals.",
        fires="abs(gateway_bank_net_delta) > amount_tolerance",
        amount="abs(gateway_bank_net_delta)",
    ),
)
RULES_BY_NAME = {rule.name: rule for rule in RULES}

# The ten rules that labelled truth covers.
CORE_RULES = tuple(r.name for r in RULES if r.name not in ("settlement_gross_mismatch", "settlement_net_mismatch"))


NOTHING = f"CAST(0 AS {TOTAL})"


def _any(rules) -> str:
    """True if any of these rules fired on the row."""
    return f"(signal_mask & {sum(rule.bit for rule in rules)}) != 0"


def _age_of(rule: Rule) -> str:
    """Days a signal has been open, never negative.

    Late cash stops ageing when it arrives; missing cash ages from its due time; any
    other signal ages from the source event.
    """
    days = {
        HISTORICAL: "settlement_delay_days - max_settlement_days",
        OVERDUE: "elapsed_days - max_settlement_days",
    }.get(rule.exposure, days_between("activity_at", "as_of"))
    return f"greatest({days}, 0D)"


def _amount_as(rule: Rule, exposure: str) -> str:
    """The part of a rule's amount that counts under an exposure heading."""
    if rule.exposure != exposure:
        return NOTHING
    amount = f"CAST({rule.amount} AS {TOTAL})"
    if rule.name == "missing_gateway":
        # Cash that reached the bank is a data problem, not a loss.
        return f"IF(settlement_rows > 0, {NOTHING}, {amount})"
    return amount


def with_mask(facts: DataFrame) -> DataFrame:
    """Add one integer that holds a bit per fired rule; a null condition does not fire."""
    bits = " | ".join(f"IF({rule.fires}, {rule.bit}, 0)" for rule in RULES)
    return facts.selectExpr("*", f"{bits} AS signal_mask")


def case_facts(facts: DataFrame) -> DataFrame:
    """Facts with their signal mask, the rollup of their signals and both states.

    Overlapping rules describe the same money, so the discrepancy of a transaction is
    the largest of its rules' amounts and never their sum.
    """
    rolled = {
        "exception_count": "CAST(bit_count(signal_mask) AS BIGINT)",
        "exception_types": joined_labels([(rule.name, _any([rule])) for rule in RULES], ", "),
        "financial_exposure_inr": _largest(FINANCIAL),
        "overdue_cash_inr": _largest(OVERDUE),
        "historical_late_cash_inr": _largest(HISTORICAL),
        "settlement_state": SETTLEMENT_STATE,
        "reconciliation_state": RECONCILIATION_STATE,
    }
    return with_mask(facts).selectExpr("*", *named(rolled))


def flagged_cases(cases: DataFrame) -> DataFrame:
    """Rows with signals, with what only the queue needs.

    Computed here and not in ``case_facts``, because few rows have signals and because
    the generated code of a stage must stay small enough for the JVM to compile.
    """
    severities = " ".join(
        f"WHEN {_any(rules)} THEN {rank}"
        for severity, rank in SEVERITY_RANKS.items()
        if (rules := [r for r in RULES if r.severity == severity])
    )
    same_age: dict[str, list[Rule]] = {}
    same_action: dict[str, list[Rule]] = {}
    for rule in RULES:
        same_age.setdefault(_age_of(rule), []).append(rule)
        same_action.setdefault(rule.action, []).append(rule)
    ages = [f"IF({_any(rules)}, {age}, NULL)" for age, rules in same_age.items()]
    details = {
        "severity_rank": f"CASE {severities} END",
        "exception_age_days": f"greatest({', '.join(ages)})",
        "recommended_actions": joined_labels([(action, _any(rules)) for action, rules in same_action.items()], "; "),
        "historical_only": f"signal_mask = {RULES_BY_NAME['settlement_delay'].bit}",
    }
    return cases.filter("signal_mask != 0").selectExpr("*", *named(details))


def _largest(exposure: str) -> str:
    amounts = [f"IF({_any([r])}, {_amount_as(r, exposure)}, NULL)" for r in RULES if r.exposure == exposure]
    return f"greatest({NOTHING}, {', '.join(amounts)})"


SETTLEMENT_STATE = f"""CASE
    WHEN gateway_rows > 1 OR settlement_rows > 1 THEN 'ambiguous_duplicate'
    WHEN {UNSETTLED} THEN IF(as_of > settlement_due_at, 'overdue', 'pending')
    WHEN settlement_eligible THEN 'settled'
    ELSE 'not_eligible_or_unmatched' END"""

RECONCILIATION_STATE = f"""CASE
    WHEN signal_mask != 0 THEN 'exception'
    WHEN {UNSETTLED} THEN 'pending'
    WHEN {IN_LEDGER} AND settlement_rows = 1 THEN 'matched'
    ELSE 'no_exception_not_three_way' END"""

def reconciliation_facts(cases: DataFrame) -> DataFrame:
    return cases.drop("signal_mask")


def _per_rule(value) -> str:
    """A fixed text of each rule, looked up by the exploded rule number."""
    return f"elt(rule_no + 1, {', '.join(text_literal(value(rule)) for rule in RULES)})"


def _numbers(rules) -> str:
    return ", ".join(str(RULE_NAMES.index(rule.name)) for rule in rules)


SIGNAL_COLUMNS = ("transaction_id", "exception_type", "severity", "amount_at_risk", "exposure_kind", "reason")
DIMENSION_COLUMNS = ("merchant_id", "payment_method", "gateway_id", "activity_date")


def detected_exceptions(cases: DataFrame) -> DataFrame:
    """One row per (transaction, rule), read off the flagged fact rows."""
    amounts = ", ".join(f"CAST({rule.amount} AS {TOTAL})" for rule in RULES)
    by_exposure = {kind: [r for r in RULES if r.exposure == kind] for kind in (FINANCIAL, OVERDUE, HISTORICAL)}
    missing_gateway = RULES_BY_NAME["missing_gateway"]
    # Cash that reached the bank is a data problem, not a loss.
    counts = f"rule_no IN ({_numbers(by_exposure[FINANCIAL])}) AND NOT (rule_no = {_numbers([missing_gateway])} "
    amount_as = {
        FINANCIAL: f"{counts} AND settlement_rows > 0)",
        OVERDUE: f"rule_no IN ({_numbers(by_exposure[OVERDUE])})",
        HISTORICAL: f"rule_no IN ({_numbers(by_exposure[HISTORICAL])})",
    }
    late, overdue = by_exposure[HISTORICAL], by_exposure[OVERDUE]
    source_age = _age_of(by_exposure[FINANCIAL][0])
    return (
        cases.filter("signal_mask != 0")
        .selectExpr("*", f"posexplode(array({amounts})) AS (rule_no, amount_at_risk)")
        .filter("(signal_mask & shiftleft(1, rule_no)) != 0")
        .selectExpr(
            "transaction_id",
            *DIMENSION_COLUMNS,
            f"{_per_rule(lambda r: r.name)} AS exception_type",
            f"{_per_rule(lambda r: r.severity)} AS severity",
            "amount_at_risk",
            f"{_per_rule(lambda r: r.exposure_kind)} AS exposure_kind",
            f"{_per_rule(lambda r: r.reason)} AS reason",
            f"IF(rule_no IN ({_numbers(late)}), '{SETTLED_LATE_REVIEW}', '{OPEN_REVIEW}') AS case_status",
            f"CASE WHEN rule_no IN ({_numbers(late)}) THEN {_age_of(late[0])} "
            f"WHEN rule_no IN ({_numbers(overdue)}) THEN {_age_of(overdue[0])} ELSE {source_age} END AS age_days",
            f"IF({amount_as[FINANCIAL]}, amount_at_risk, {NOTHING}) AS financial_exposure_inr",
            f"IF({amount_as[OVERDUE]}, amount_at_risk, {NOTHING}) AS overdue_cash_inr",
            f"IF({amount_as[HISTORICAL]}, amount_at_risk, {NOTHING}) AS historical_late_cash_inr",
            f"{_per_rule(lambda r: r.action)} AS recommended_action",
        )
    )


def exception_signals(cases: DataFrame) -> DataFrame:
    return detected_exceptions(cases).select(*SIGNAL_COLUMNS)


def rule_signals(facts: DataFrame, name: str) -> DataFrame:
    """Signals of one rule only: a filter and a projection."""
    rule = RULES_BY_NAME[name]
    return facts.filter(rule.fires).selectExpr(
        "transaction_id",
        f"{text_literal(rule.name)} AS exception_type",
        f"{text_literal(rule.severity)} AS severity",
        f"CAST({rule.amount} AS {TOTAL}) AS amount_at_risk",
        f"{text_literal(rule.exposure_kind)} AS exposure_kind",
        f"{text_literal(rule.reason)} AS reason",
    )


def exception_rollup(detected: DataFrame) -> DataFrame:
    """Per-transaction rollup of a stored signal table.

    ``case_facts`` and ``flagged_cases`` find the same values without grouping; use this one when only
    the signals are at hand. A transaction has at most one signal per rule, so the
    collected lists are bounded by the number of rules.
    """
    ranks = " ".join(f"WHEN '{severity}' THEN {rank}" for severity, rank in SEVERITY_RANKS.items())
    rolled = {
        "exception_count": "count(*)",
        "exception_types": "array_join(array_sort(collect_list(exception_type)), ', ')",
        "severity_rank": f"max(CASE severity {ranks} END)",
        "age_days": "max(age_days)",
        "financial_exposure_inr": "max(financial_exposure_inr)",
        "overdue_cash_inr": "max(overdue_cash_inr)",
        "historical_late_cash_inr": "max(historical_late_cash_inr)",
        "recommended_actions": "array_join(array_sort(collect_set(recommended_action)), '; ')",
        "historical_only": f"every(case_status = '{SETTLED_LATE_REVIEW}')",
    }
    return detected.groupBy("transaction_id").agg(*aggregates(rolled))

"""The ten-rule detector: no cutoff, no due window, dynamic reasons.

It differs from the operational rules on purpose: a duplicate is valued at its largest
row, an unsettled payment is missing at once, and reasons quote the values found.
Amounts are decimals here too, so a difference of exactly the tolerance never flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.config import ReconciliationConfig
from tallyweave.functions.clock import MICROS_PER_DAY, days_between, micros_between
from tallyweave.functions.money import AMOUNT, TOTAL
from tallyweave.functions.text import two_decimals
from tallyweave.operators.facts import IN_LEDGER, PAIRED, SUCCESS, payment_facts
from tallyweave.operators.rules import CORE_RULES, RULES_BY_NAME, exception_signals
from tallyweave.sources.contracts import LEGACY_CONTRACTS, UNKNOWN, typed
from tallyweave.sources.validation import validate_legacy

# Nothing is in the future for this detector.
END_OF_TIME = "9999-12-31T23:59:59"

COLUMNS = ("exception_type", "transaction_id", "severity", "amount_at_risk", "exposure_kind", "reason")


def reconcile(
    internal: DataFrame,
    gateway: DataFrame,
    settlement: DataFrame,
    config: ReconciliationConfig = ReconciliationConfig(),
    *,
    checked: bool = True,
) -> DataFrame:
    """Detections of the ten-rule detector; one grouping exchange for all rules."""
    feeds = dict(zip((c.name for c in LEGACY_CONTRACTS), (internal, gateway, settlement)))
    if checked:
        validate_legacy(feeds, LEGACY_CONTRACTS)
    return detections(
        {c.name: typed(feeds[c.name], c, lower_status=False) for c in LEGACY_CONTRACTS}, config
    )


def detections(feeds: dict[str, DataFrame], config: ReconciliationConfig = ReconciliationConfig()) -> DataFrame:
    ledger = feeds["internal"]
    absent = [name for name in ("merchant_id", "payment_method") if name not in ledger.columns]
    ledger = ledger.selectExpr("*", *[f"'{UNKNOWN}' AS {name}" for name in absent])
    facts = payment_facts({**feeds, "internal": ledger}, END_OF_TIME, config)
    signals = ", ".join(
        f"IF({condition}, named_struct('exception_type', '{name}', "
        f"'severity', '{RULES_BY_NAME[name].severity}', "
        f"'amount_at_risk', CAST(IF({amount} < 0, 0, {amount}) AS {AMOUNT}), "
        f"'exposure_kind', '{RULES_BY_NAME[name].exposure_kind}', 'reason', {reason}), NULL)"
        for name, (condition, amount, reason) in FINDINGS.items()
    )
    # Most facts raise nothing and build no detections.
    return (
        facts.filter(" OR ".join(f"({condition})" for condition, _, _ in FINDINGS.values()))
        .selectExpr("transaction_id", f"inline(array({signals}))")
        .filter("exception_type IS NOT NULL")
        .select(*COLUMNS)
    )


GATEWAY_SUCCEEDED = f"lower(gateway_status) = '{SUCCESS}'"
DELAY = days_between("gateway_event_at", "settled_at")
MICROS = MICROS_PER_DAY.rstrip("D")

# Condition, amount and reason of each rule over one fact row.
# Wording of the reasons.
FINDINGS = {
    "duplicate_gateway": (
        "gateway_rows > 1",
        "gateway_amount",
        "concat(gateway_rows, ' gateway records share the same transaction_id.')",
    ),
    "duplicate_settlement": (
        "settlement_rows > 1",
        "bank_net",
        "concat(settlement_rows, ' settlement lines share the same transaction_id.')",
    ),
    "missing_gateway": (
        "has_internal AND gateway_rows = 0",
        "internal_gross",
        "'Internal payment exists but no gateway record was found.'",
    ),
    "orphan_gateway": (
        "gateway_rows = 1 AND NOT has_internal",
        "gateway_amount",
        "'Gateway transaction has no matching internal payment.'",
    ),
    "orphan_settlement": (
        "settlement_rows = 1 AND NOT has_internal",
        "bank_net",
        "'Settlement line has no matching internal payment.'",
    ),
    "amount_mismatch": (
        "abs(ledger_gateway_gross_delta) > amount_tolerance",
        "abs(ledger_gateway_gross_delta)",
        "concat('Internal gross ', internal_gross, ' differs from gateway amount ', gateway_amount, '.')",
    ),
    "status_mismatch": (
        f"{IN_LEDGER} AND lower(internal_status) != lower(gateway_status)",
        "internal_gross",
        "concat('Internal status ', internal_status, ' differs from gateway status ', gateway_status, '.')",
    ),
    "missing_settlement": (
        f"{IN_LEDGER} AND settlement_rows = 0 AND lower(internal_status) = '{SUCCESS}' AND {GATEWAY_SUCCEEDED}",
        "gateway_net",
        "'Successful payment has no bank settlement line.'",
    ),
    "fee_mismatch": (
        f"{GATEWAY_SUCCEEDED} AND fee_tax_abs_delta > fee_tolerance",
        "fee_tax_abs_delta",
        "'Bank-reported fee/tax differs from gateway fee/tax.'",
    ),
    "settlement_delay": (
        f"{PAIRED} AND {GATEWAY_SUCCEEDED} AND {DELAY} > max_settlement_days",
        "gateway_net",
        f"concat('Settlement occurred after ', {two_decimals(micros_between('gateway_event_at', 'settled_at'), MICROS)}, "
        f"' days; maximum allowed is ', {two_decimals('max_settlement_days * 1000000', 1_000_000)}, '.')",
    ),
}


def detection_order() -> list[Column]:
    return [
        F.col("severity").asc(),
        F.col("amount_at_risk").desc(),
        F.col("exception_type").asc(),
        F.col("transaction_id").asc(),
    ]


COMPARED_COLUMNS = ("exception_type", "transaction_id", "severity", "amount_at_risk", "exposure_kind")


def detector_differences(legacy: DataFrame, cases: DataFrame) -> DataFrame:
    """Core-rule signals that only one detector raises, with the side that raised them.

    Both sides are grouped together once; signals that both raise cancel out.
    """
    core = ", ".join(f"'{name}'" for name in CORE_RULES)
    current = exception_signals(cases).filter(f"exception_type IN ({core})")
    compared = [f"CAST({c} AS {TOTAL}) AS {c}" if c == "amount_at_risk" else c for c in COMPARED_COLUMNS]
    signed = legacy.selectExpr(*compared, "1 AS _sign").union(current.selectExpr(*compared, "-1 AS _sign"))
    return (
        signed.groupBy(*COMPARED_COLUMNS)
        .agg(F.expr("sum(_sign) AS _balance"))
        .filter("_balance != 0")
        .selectExpr(*COMPARED_COLUMNS, "IF(_balance > 0, 'legacy', 'current') AS only_in")
    )

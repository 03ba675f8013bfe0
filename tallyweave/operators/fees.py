"""Expected processing fees from the rate card, and what the gateway charged."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyweave.functions.money import AMOUNT, fee_on, fee_rate, tax_on
from tallyweave.operators.facts import IN_LEDGER, payment_facts


def expected_fees(payments: DataFrame, amount: str = "gross_amount") -> DataFrame:
    """Add rate, fee, tax and net by payment method; an unknown method has none."""
    return (
        payments.selectExpr("*", f"{fee_rate('payment_method')} AS fee_rate")
        .selectExpr("*", f"{fee_on(amount, 'fee_rate')} AS expected_fee")
        .selectExpr("*", f"{tax_on('expected_fee')} AS expected_tax")
        .selectExpr("*", f"CAST({amount} - expected_fee - expected_tax AS {AMOUNT}) AS expected_net")
    )


def fee_variance(feeds: dict[str, DataFrame], as_of) -> DataFrame:
    """Charged minus expected fee, tax and net for uniquely matched ledger payments."""
    matched = payment_facts(feeds, as_of).filter(IN_LEDGER)
    return expected_fees(matched, "gateway_amount").selectExpr(
        "transaction_id",
        "payment_method",
        "expected_fee",
        "gateway_fee",
        "gateway_fee - expected_fee AS fee_variance",
        "gateway_tax - expected_tax AS tax_variance",
        "gateway_net - expected_net AS net_variance",
    )

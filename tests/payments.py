"""Hand-made payments. Each scenario owns its transaction ids, so many share one run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LEDGER = (
    "transaction_id string, order_id string, merchant_id string, payment_method string, currency string, "
    "internal_status string, created_at string, gross_amount string"
)
GATEWAY = (
    "transaction_id string, gateway_record_id string, gateway_status string, gateway_event_at string, "
    "gateway_amount string, gateway_fee string, gateway_tax string, gateway_net string, gateway_id string"
)
BANK = (
    "transaction_id string, settlement_line_id string, settled_at string, gross_amount string, fee_amount string, "
    "tax_amount string, net_amount string"
)


def ledger_row(tx: str, **changes) -> dict:
    return {
        "transaction_id": tx,
        "order_id": f"O-{tx}",
        "merchant_id": "M1",
        "payment_method": "card",
        "currency": "INR",
        "internal_status": "success",
        "created_at": "2026-01-01T00:00:00Z",
        "gross_amount": "1000.00",
    } | changes


def gateway_row(tx: str, **changes) -> dict:
    return {
        "transaction_id": tx,
        "gateway_record_id": f"G-{tx}",
        "gateway_status": "success",
        "gateway_event_at": "2026-01-01T01:00:00Z",
        "gateway_amount": "1000.00",
        "gateway_fee": "20.00",
        "gateway_tax": "3.60",
        "gateway_net": "976.40",
        "gateway_id": None,
    } | changes


def bank_row(tx: str, **changes) -> dict:
    return {
        "transaction_id": tx,
        "settlement_line_id": f"S-{tx}",
        "settled_at": "2026-01-02T01:00:00Z",
        "gross_amount": "1000.00",
        "fee_amount": "20.00",
        "tax_amount": "3.60",
        "net_amount": "976.40",
    } | changes


class Payments:
    """Collects rows of the three feeds."""

    def __init__(self):
        self.ledger, self.gateway, self.bank = [], [], []

    def add(self, tx: str, ledger=({},), gateway=({},), bank=({},)) -> Payments:
        """Add one payment; each argument lists the changes of that feed's rows."""
        self.ledger += [ledger_row(tx, **c) for c in ledger]
        self.gateway += [gateway_row(tx, **{"gateway_record_id": f"G{n}-{tx}"} | c) for n, c in enumerate(gateway)]
        self.bank += [bank_row(tx, **{"settlement_line_id": f"S{n}-{tx}"} | c) for n, c in enumerate(bank)]
        return self

    def feeds(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {
            "internal": frame(spark, self.ledger, LEDGER),
            "gateway": frame(spark, self.gateway, GATEWAY),
            "settlement": frame(spark, self.bank, BANK),
        }


def frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def by_id(df: DataFrame, *keys: str) -> dict:
    keys = keys or ("transaction_id",)
    found = {}
    for row in df.collect():
        found[tuple(row[k] for k in keys) if len(keys) > 1 else row[keys[0]]] = row
    return found

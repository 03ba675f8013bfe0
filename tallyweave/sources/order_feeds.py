"""Payment feeds derived from an ``orders`` table by integer arithmetic.

The order key decides which defect an order carries: its last two digits name the
case, the digits above choose variants. Each feed is one scan of ``orders``; repeated
records come from a row-local array, so no step shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyweave.functions import named
from tallyweave.functions.money import AMOUNT, fee_on, fee_rate, tax_on

# Case numbers of the derived feeds.
MISSING_GATEWAY = 0
MISSING_SETTLEMENT = 1
AMOUNT_MISMATCH = 2
STATUS_MISMATCH = 3
DUPLICATE_GATEWAY = 4
DUPLICATE_SETTLEMENT = 5
FEE_MISMATCH = 6
SETTLEMENT_DELAY = 7
ORPHAN_GATEWAY = 8
ORPHAN_SETTLEMENT = 9
GROSS_MISMATCH = 10
NET_MISMATCH = 11
ORPHAN_BOTH = 12
BOTH_FAILED = 13
TOLERANCE_BOUNDARY = 14

DEFAULT_AS_OF = "2001-07-30 00:00:00"
EARLIER_AS_OF = "1998-07-01 00:00:00"


def read_orders(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/orders.parquet")


def order_feeds(orders: DataFrame) -> dict[str, DataFrame]:
    return {
        "internal": internal_feed(orders),
        "gateway": gateway_feed(orders),
        "settlement": settlement_feed(orders),
    }


def internal_feed(orders: DataFrame) -> DataFrame:
    orphans = f"{ORPHAN_GATEWAY}, {ORPHAN_SETTLEMENT}, {ORPHAN_BOTH}"
    return (
        _payments(orders)
        .filter(f"case_no NOT IN ({orphans})")
        .selectExpr(
            "transaction_id",
            "concat('O', digits) AS order_id",
            "concat('M', lpad(CAST(o_custkey % 20 AS STRING), 3, '0')) AS merchant_id",
            "payment_method",
            "'INR' AS currency",
            f"IF(case_no = {BOTH_FAILED}, 'failed', 'success') AS internal_status",
            "created_at",
            "gross_amount",
        )
    )


def gateway_feed(orders: DataFrame) -> DataFrame:
    copies = f"IF(case_no = {DUPLICATE_GATEWAY}, IF(variant % 3 = 0, 3, 2), 1)"
    return (
        _captured(orders)
        .filter(f"case_no NOT IN ({MISSING_GATEWAY}, {ORPHAN_SETTLEMENT})")
        .selectExpr("*", f"explode(sequence(1, {copies})) AS copy")
        .selectExpr(
            "transaction_id",
            f"{_record_id('G')} AS gateway_record_id",
            f"IF(case_no IN ({STATUS_MISMATCH}, {BOTH_FAILED}), 'failed', 'success') AS gateway_status",
            "gateway_event_at",
            "gateway_amount",
            "gateway_fee",
            "gateway_tax",
            "gateway_net",
            f"IF(copy = 2 AND variant % 2 = 1, 'gw_x', {_pick('key', 'gw_a', 'gw_b', 'gw_c')}) AS gateway_id",
        )
    )


def settlement_feed(orders: DataFrame) -> DataFrame:
    days = f"CASE WHEN case_no = {SETTLEMENT_DELAY} THEN 7 WHEN key % 7 < 5 THEN 1 ELSE 2 END"
    net = (
        f"CASE WHEN copy = 2 THEN round(gateway_net * 0.5, 2) WHEN case_no = {FEE_MISMATCH} THEN gateway_net - 2.50 "
        f"WHEN case_no = {NET_MISMATCH} THEN gateway_net - 7.25 ELSE gateway_net END"
    )
    return (
        _captured(orders)
        .filter(f"case_no NOT IN ({MISSING_SETTLEMENT}, {ORPHAN_GATEWAY}, {BOTH_FAILED})")
        .filter(f"NOT (case_no = {MISSING_GATEWAY} AND variant % 2 = 1)")
        .selectExpr(
            "*",
            f"gateway_event_at + make_dt_interval({days}) AS settled_at",
            f"explode(sequence(1, IF(case_no = {DUPLICATE_SETTLEMENT}, 2, 1))) AS copy",
        )
        .selectExpr(
            "transaction_id",
            f"{_record_id('S')} AS settlement_line_id",
            f"{settlement_batch('settled_at')} AS settlement_batch_id",
            "settled_at",
            f"CAST(IF(case_no = {GROSS_MISMATCH}, gateway_amount + 10.00, gateway_amount) AS {AMOUNT}) AS gross_amount",
            f"CAST(IF(case_no = {FEE_MISMATCH}, gateway_fee + 2.50, gateway_fee) AS {AMOUNT}) AS fee_amount",
            "gateway_tax AS tax_amount",
            f"CAST({net} AS {AMOUNT}) AS net_amount",
        )
    )


def settlement_batch(settled_at: str) -> str:
    """Batch label of a bank line: B followed by the cash date."""
    return f"concat('B', date_format({settled_at}, 'yyyyMMdd'))"


def truth_labels(orders: DataFrame) -> DataFrame:
    """Intended defects with their amounts, for evaluation only."""
    amounts = {
        MISSING_GATEWAY: ("missing_gateway", "gross_amount"),
        MISSING_SETTLEMENT: ("missing_settlement", "gateway_net"),
        AMOUNT_MISMATCH: ("amount_mismatch", "25.00"),
        STATUS_MISMATCH: ("status_mismatch", "gross_amount"),
        DUPLICATE_GATEWAY: ("duplicate_gateway", "gateway_amount"),
        DUPLICATE_SETTLEMENT: ("duplicate_settlement", "gateway_net"),
        FEE_MISMATCH: ("fee_mismatch", "2.50"),
        SETTLEMENT_DELAY: ("settlement_delay", "gateway_net"),
        ORPHAN_GATEWAY: ("orphan_gateway", "gateway_amount"),
        ORPHAN_SETTLEMENT: ("orphan_settlement", "gateway_net"),
    }
    labels = [(case, *label) for case, label in amounts.items()]
    labels += [(ORPHAN_BOTH, *amounts[case]) for case in (ORPHAN_GATEWAY, ORPHAN_SETTLEMENT)]
    listed = ", ".join(
        f"IF(case_no = {case}, named_struct('exception_type', '{name}', "
        f"'reference_amount', CAST({amount} AS {AMOUNT})), NULL)"
        for case, name, amount in labels
    )
    return (
        _captured(orders)
        .filter(f"case_no <= {ORPHAN_BOTH}")
        .selectExpr("transaction_id", f"inline(array({listed}))")
        .filter("exception_type IS NOT NULL")
    )


# Case number -> (column, faulty text) of the faulty ledger.
LEDGER_FAULTS = {
    20: ("merchant_id", "  "),
    21: ("currency", "USD"),
    22: ("created_at", "12:30"),
    23: ("gross_amount", "1d"),
    24: ("gross_amount", "-5.00"),
    25: ("gross_amount", "1.001"),
    26: ("gross_amount", "10000000000000"),
    28: ("merchant_id", "\u00a0"),
    29: ("created_at", "not-a-date"),
    30: ("gross_amount", "Infinity"),
}
REPEATED_KEY = 27


def faulty_ledger(orders: DataFrame) -> DataFrame:
    """The ledger as text with known contract violations, to exercise validation."""
    case = "CAST(right(transaction_id, 2) AS INT)"
    ledger = internal_feed(orders)
    columns = {}
    for name in ledger.columns:
        faults = " ".join(f"WHEN {n} THEN '{text}'" for n, (column, text) in LEDGER_FAULTS.items() if column == name)
        columns[name] = f"CASE {case} {faults} ELSE CAST({name} AS STRING) END" if faults else f"CAST({name} AS STRING)"
    repeats = f"explode(sequence(1, IF({case} = {REPEATED_KEY}, 2, 1))) AS copy"
    return ledger.selectExpr(*named(columns), repeats).drop("copy")


def _payments(orders: DataFrame) -> DataFrame:
    digits = "lpad(CAST(o_orderkey AS STRING), 9, '0')"
    return orders.selectExpr(
        "o_custkey",
        "o_orderkey AS key",
        "CAST(o_orderkey % 100 AS INT) AS case_no",
        "o_orderkey div 100 AS variant",
        f"{digits} AS digits",
        f"concat('T', {digits}) AS transaction_id",
        f"{_pick('o_orderkey', 'card', 'upi', 'net_banking', 'wallet')} AS payment_method",
        "o_orderdate AS created_at",
        f"CAST(o_totalprice AS {AMOUNT}) AS gross_amount",
    )


def _captured(orders: DataFrame) -> DataFrame:
    """Payments with what the gateway would record for them."""
    added = f"CASE case_no WHEN {AMOUNT_MISMATCH} THEN 25.00 WHEN {TOLERANCE_BOUNDARY} THEN 0.05 ELSE 0.00 END"
    return (
        _payments(orders)
        .selectExpr(
            "*",
            "created_at + make_dt_interval(0, 0, CAST(key % 10 + 1 AS INT)) AS gateway_event_at",
            f"CAST(gross_amount + {added} AS {AMOUNT}) AS gateway_amount",
        )
        .selectExpr("*", f"{fee_on('gateway_amount', fee_rate('payment_method'))} AS gateway_fee")
        .selectExpr("*", f"{tax_on('gateway_fee')} AS gateway_tax")
        .selectExpr("*", f"CAST(gateway_amount - gateway_fee - gateway_tax AS {AMOUNT}) AS gateway_net")
    )


def _pick(key: str, *choices: str) -> str:
    return f"elt(CAST({key} % {len(choices)} + 1 AS INT), {', '.join(repr(c) for c in choices)})"


def _record_id(prefix: str) -> str:
    return f"concat('{prefix}', digits, IF(copy > 1, concat('-', copy), ''))"

"""Feed-to-feed joins on unique records, as separate operators.

Each feed is reduced to one row per id before it is joined, so a hot duplicate id
collapses on the map side and a join never fans out. Whole reconciliations should use
``payment_facts`` instead, which answers all of these with a single exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import aggregates
from tallyweave.operators.facts import SUCCESS

KEY = "transaction_id"


def ids(feed: DataFrame) -> DataFrame:
    return feed.select(KEY).distinct()


def repeated(feed: DataFrame) -> DataFrame:
    return feed.groupBy(KEY).agg(F.expr("count(*) AS rows")).filter("rows > 1")


def single_records(feed: DataFrame) -> DataFrame:
    """Rows whose id occurs once. Any value of a one-row group is that row's value."""
    values = {name: f"max({name})" for name in feed.columns if name != KEY}
    return feed.groupBy(KEY).agg(*aggregates({"_rows": "count(*)"} | values)).filter("_rows = 1").drop("_rows")


def without_duplicates(feed: DataFrame) -> DataFrame:
    """The same rows through an anti-join with the repeated ids."""
    return feed.join(repeated(feed), KEY, "left_anti")


def unmatched(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(ids(right), KEY, "left_anti")


def internal_without_gateway(feeds: dict[str, DataFrame]) -> DataFrame:
    return unmatched(feeds["internal"], feeds["gateway"]).select(KEY, "gross_amount")


def gateway_without_internal(feeds: dict[str, DataFrame]) -> DataFrame:
    return unmatched(_gateway_singles(feeds), feeds["internal"]).select(KEY, "gateway_amount")


def settlement_without_internal(feeds: dict[str, DataFrame]) -> DataFrame:
    return unmatched(_bank_singles(feeds), feeds["internal"]).select(KEY, "net_amount")


def only_records(feed: DataFrame, name: str) -> DataFrame:
    """One row an id; the first id that occurs twice ends the query, like a one-to-one assertion."""
    values = {column: f"max({column})" for column in feed.columns if column != KEY}
    message = f"concat('{name} holds a repeated {KEY}: ', {KEY})"
    rows = feed.groupBy(KEY).agg(*aggregates({"_rows": "count(*)"} | values))
    return rows.filter(f"assert_true(_rows = 1, {message}) IS NULL").drop("_rows")


def matched_ledger_gateway(feeds: dict[str, DataFrame]) -> DataFrame:
    """One-to-one ledger and gateway pairs with their gross difference. The ledger must hold an id once."""
    ledger = only_records(feeds["internal"].select(KEY, "internal_status", "gross_amount"), "internal")
    pairs = ledger.join(_gateway_singles(feeds), KEY, "inner")
    return pairs.selectExpr(
        KEY,
        "internal_status",
        "gateway_status",
        "gross_amount",
        "gateway_amount",
        "gateway_net",
        "abs(gross_amount - gateway_amount) AS gross_difference",
    )


def matched_gateway_settlement(feeds: dict[str, DataFrame]) -> DataFrame:
    """One-to-one gateway and bank pairs with their fee and tax difference."""
    return _gateway_singles(feeds).join(_bank_singles(feeds), KEY, "inner").selectExpr(
        KEY,
        "gateway_status",
        "gateway_event_at",
        "settled_at",
        "abs(gateway_fee - fee_amount) + abs(gateway_tax - tax_amount) AS fee_tax_difference",
    )


def eligible_without_settlement(feeds: dict[str, DataFrame]) -> DataFrame:
    """Successful pairs without any bank line; repeated bank ids count as present."""
    eligible = matched_ledger_gateway(feeds).filter(
        f"lower(internal_status) = '{SUCCESS}' AND lower(gateway_status) = '{SUCCESS}'"
    )
    return unmatched(eligible, feeds["settlement"]).select(KEY, "gateway_net")


def _gateway_singles(feeds: dict[str, DataFrame]) -> DataFrame:
    return single_records(feeds["gateway"].drop("gateway_record_id", "gateway_id"))


def _bank_singles(feeds: dict[str, DataFrame]) -> DataFrame:
    return single_records(feeds["settlement"].select(KEY, "settled_at", "net_amount", "fee_amount", "tax_amount"))

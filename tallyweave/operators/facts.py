"""One fact row per transaction id.

The feeds are projected to one schema, stacked and grouped once. Every aggregate is
algebraic, so repeated records of a hot id collapse on the map side and the whole
three-way match costs a single exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tallyweave.config import ReconciliationConfig, cutoff_literal, parse_cutoff
from tallyweave.functions import aggregates, named
from tallyweave.functions.clock import days_between
from tallyweave.operators.intervals import prefix_merged
from tallyweave.sources.contracts import MULTIPLE, UNKNOWN

SUCCESS = "success"

# Fact column -> source expression, by feed. Each feed marks its rows, because only ids are sure to
# be present in feeds that were not validated. The gross amounts of ledger and bank share
# a name in the feeds and part here.
_LEDGER_COLUMNS = {
    "ledger_row": "true",
    "merchant_id": "merchant_id",
    "payment_method": "payment_method",
    "internal_status": "internal_status",
    "created_at": "created_at",
    "internal_gross": "gross_amount",
}
_GATEWAY_COLUMNS = {
    "gateway_row": "true",
    "gateway_id": "gateway_id",
    "gateway_status": "gateway_status",
    "gateway_event_at": "gateway_event_at",
    "gateway_amount": "gateway_amount",
    "gateway_net": "gateway_net",
    "gateway_fee": "gateway_fee",
    "gateway_tax": "gateway_tax",
}
_BANK_COLUMNS = {
    "bank_row": "true",
    "settled_at": "settled_at",
    "bank_gross": "gross_amount",
    "bank_net": "net_amount",
    "bank_fee": "fee_amount",
    "bank_tax": "tax_amount",
}

_LEDGER_AGGREGATES = {
    "has_internal": "count(ledger_row) > 0",
    "merchant_id": f"coalesce(max(merchant_id), '{UNKNOWN}')",
    "payment_method": f"coalesce(max(payment_method), '{UNKNOWN}')",
    "internal_status": "max(internal_status)",
    "created_at": "max(created_at)",
    "internal_gross": "max(internal_gross)",
}
_GATEWAY_AGGREGATES = {
    "gateway_rows": "count(gateway_row)",
    # The only provider of a group, or the label for several; no distinct count needed.
    "gateway_id": (
        f"CASE WHEN min(gateway_id) = max(gateway_id) THEN min(gateway_id) "
        f"WHEN count(gateway_id) > 0 THEN '{MULTIPLE}' ELSE '{UNKNOWN}' END"
    ),
    "gateway_event_at": "min(gateway_event_at)",
    "gateway_status": "min(gateway_status)",
    "gateway_gross_total": "sum(gateway_amount)",
    "gateway_net_total": "sum(gateway_net)",
    "gateway_amount": "max(gateway_amount)",
    "gateway_net": "max(gateway_net)",
    "gateway_fee": "max(gateway_fee)",
    "gateway_tax": "max(gateway_tax)",
    "gateway_duplicate_excess": "sum(gateway_amount) - max(gateway_amount)",
}
_BANK_AGGREGATES = {
    "settlement_rows": "count(bank_row)",
    "settled_at": "min(settled_at)",
    "bank_gross_total": "sum(bank_gross)",
    "bank_net_total": "sum(bank_net)",
    "bank_gross": "max(bank_gross)",
    "bank_net": "max(bank_net)",
    "bank_fee": "max(bank_fee)",
    "bank_tax": "max(bank_tax)",
    "settlement_duplicate_excess": "sum(bank_net) - max(bank_net)",
}
_ALL_AGGREGATES = {**_LEDGER_AGGREGATES, **_GATEWAY_AGGREGATES, **_BANK_AGGREGATES}


def gateway_rollup(gateway: DataFrame) -> DataFrame:
    return _renamed(gateway, _GATEWAY_COLUMNS).groupBy("transaction_id").agg(*aggregates(_GATEWAY_AGGREGATES))


def settlement_rollup(settlement: DataFrame) -> DataFrame:
    return _renamed(settlement, _BANK_COLUMNS).groupBy("transaction_id").agg(*aggregates(_BANK_AGGREGATES))


def payment_facts(feeds: dict[str, DataFrame], as_of, config: ReconciliationConfig = ReconciliationConfig()):
    """Facts for one cutoff. The feeds must be typed and already cut at ``as_of``."""
    matched = _stacked(feeds).groupBy("transaction_id").agg(*aggregates(_ALL_AGGREGATES))
    return _compared(matched, config, as_of)


ACTIVITY_AT = "coalesce(created_at, gateway_event_at, settled_at)"


def snapshot_facts(feeds: dict[str, DataFrame], cutoffs, config: ReconciliationConfig = ReconciliationConfig()):
    """Facts for several cutoffs in one pass over the feeds, as rows of (as_of, transaction_id).

    ``feeds`` are typed but not cut. Each event is given to the first cutoff that sees it; the states of
    a transaction are merged along the cutoffs, and only merged rows are written out for each
    cutoff, after the last shuffle.
    """
    moments = [cutoff_literal(c) for c in sorted({parse_cutoff(c) for c in cutoffs})]
    return _compared(prefix_merged(_stacked(feeds), "transaction_id", ACTIVITY_AT, moments, _ALL_AGGREGATES), config)


def facts_by_joins(feeds: dict[str, DataFrame], as_of, config: ReconciliationConfig = ReconciliationConfig()):
    """The same facts from an id universe and three left joins.

    Costs one exchange per input instead of one in all; kept to cross-check
    ``payment_facts``. Both rollups are unique per id, so no join fans out.
    """
    ids = reduce(DataFrame.union, [feed.select("transaction_id") for feed in feeds.values()]).distinct()
    ledger = _renamed(feeds["internal"], _LEDGER_COLUMNS)
    defaults = {
        "merchant_id": f"'{UNKNOWN}'",
        "payment_method": f"'{UNKNOWN}'",
        "gateway_id": f"'{UNKNOWN}'",
        "gateway_rows": "0L",
        "settlement_rows": "0L",
    }
    joined = (
        ids.join(ledger, "transaction_id", "left")
        .join(gateway_rollup(feeds["gateway"]), "transaction_id", "left")
        .join(settlement_rollup(feeds["settlement"]), "transaction_id", "left")
    )
    columns = {n: f"coalesce({n}, {defaults[n]})" if n in defaults else n for n in joined.columns if n != "ledger_row"}
    return _compared(joined.selectExpr(*named(columns), "ledger_row IS NOT NULL AS has_internal"), config, as_of)


def _renamed(feed: DataFrame, columns: dict[str, str]) -> DataFrame:
    return feed.selectExpr("transaction_id", *named(columns))


def _stacked(feeds: dict[str, DataFrame]) -> DataFrame:
    """All feeds in one schema; a feed is null in the columns of the others."""
    parts = [
        _renamed(feeds["internal"], _LEDGER_COLUMNS),
        _renamed(feeds["gateway"], _GATEWAY_COLUMNS),
        _renamed(feeds["settlement"], _BANK_COLUMNS),
    ]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


PAIRED = "(gateway_rows = 1 AND settlement_rows = 1)"
IN_LEDGER = "(has_internal AND gateway_rows = 1)"


def _compared(matched: DataFrame, config: ReconciliationConfig, as_of=None) -> DataFrame:
    """Add run parameters, dates and the deltas of uniquely matched records.

    A delta is null unless both sides are single records, and a null delta never
    breaks a tolerance.
    """
    moment = "as_of" if as_of is None else cutoff_literal(as_of)
    both_succeeded = f"internal_status = '{SUCCESS}' AND gateway_status = '{SUCCESS}'"
    added = {
        "activity_at": ACTIVITY_AT,
        "activity_date": f"CAST({ACTIVITY_AT} AS DATE)",
        "max_settlement_days": config.settlement_days(),
        "amount_tolerance": config.amount_limit(),
        "fee_tolerance": config.fee_limit(),
        "settlement_due_at": f"gateway_event_at + {config.settlement_window()}",
        "elapsed_days": days_between("gateway_event_at", moment),
        "settlement_delay_days": (
            f"IF({PAIRED} AND gateway_status = '{SUCCESS}', {days_between('gateway_event_at', 'settled_at')}, NULL)"
        ),
        "settlement_eligible": f"coalesce({IN_LEDGER} AND {both_succeeded}, false)",
        "ledger_gateway_gross_delta": f"IF({IN_LEDGER}, gateway_amount - internal_gross, NULL)",
        "gateway_bank_gross_delta": f"IF({PAIRED}, bank_gross - gateway_amount, NULL)",
        "gateway_bank_net_delta": f"IF({PAIRED}, bank_net - gateway_net, NULL)",
        "fee_tax_abs_delta": f"IF({PAIRED}, abs(gateway_fee - bank_fee) + abs(gateway_tax - bank_tax), NULL)",
    }
    if as_of is not None:
        added["as_of"] = moment
    return matched.selectExpr("*", *named(added))

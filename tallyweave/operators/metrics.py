"""Business metrics over case facts and bank lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import aggregates, named
from tallyweave.functions.clock import MICROS_PER_DAY, micros_between
from tallyweave.functions.money import GRAND_TOTAL, ratio
from tallyweave.operators.durable import frozen
from tallyweave.operators.lattice import by_dimension
from tallyweave.operators.ordering import quantiles_by_count

# Dimension label -> fact column, and the label of the grand total.
DIMENSIONS = {
    "merchant": "merchant_id",
    "day": "activity_date",
    "payment_method": "payment_method",
    "gateway": "gateway_id",
}
ALL = "all"

_SUMMED = {
    "internal_gross_inr": "internal_gross",
    "gateway_gross_inr": "gateway_gross_total",
    "gateway_net_inr": "gateway_net_total",
    "bank_gross_inr": "bank_gross_total",
    "bank_net_inr": "bank_net_total",
}
_COMPARED = {
    "ledger_gateway_gross": "ledger_gateway_gross_delta",
    "gateway_bank_gross": "gateway_bank_gross_delta",
    "gateway_bank_net": "gateway_bank_net_delta",
}
_EXPOSURES = ("financial_exposure_inr", "overdue_cash_inr", "historical_late_cash_inr")


def _total(value: str) -> str:
    return f"coalesce(CAST(sum({value}) AS {GRAND_TOTAL}), CAST(0 AS {GRAND_TOTAL}))"


FLAGGED = "exception_count > 0"
MEASURES = {
    "observed_transactions": "count(*)",
    "internal_payments": "count_if(has_internal)",
    "orphan_transactions": "count_if(NOT has_internal)",
    "exception_count": "coalesce(sum(exception_count), 0L)",
    "exception_transactions": f"count_if({FLAGGED})",
    "internal_exception_payments": f"count_if(has_internal AND {FLAGGED})",
    "matched_payments": "count_if(reconciliation_state = 'matched')",
    "pending_payments": "count_if(settlement_state = 'pending')",
    "overdue_payments": "count_if(settlement_state = 'overdue')",
    "ledger_gateway_comparable_payments": "count(ledger_gateway_gross_delta)",
    "gateway_bank_comparable_payments": "count(gateway_bank_net_delta)",
    **{name: _total(column) for name, column in _SUMMED.items()},
    **{f"{name}_delta_inr": _total(delta) for name, delta in _COMPARED.items()},
    **{f"{name}_abs_delta_inr": _total(f"abs({delta})") for name, delta in _COMPARED.items()},
    **{name: _total(name) for name in _EXPOSURES},
    "current_exposure_inr": _total("financial_exposure_inr + overdue_cash_inr"),
}
RATES = {
    "exception_transaction_rate": ratio("exception_transactions", "observed_transactions"),
    "internal_exception_rate": ratio("internal_exception_payments", "internal_payments"),
}


def dimension_totals(
    cases: DataFrame, dimensions=tuple(DIMENSIONS), include_all: bool = True, cell_share: float = 1.0
) -> DataFrame:
    """Counts, sums and rates of all dimensions in one scan with grouping sets.

    Partial aggregation follows the expansion inside each task, so a value such as
    'unknown' that covers most rows shuffles one row per task. If a small cell_share is
    given, the finest cells per row, these are added up first and only they are expanded.
    """
    columns = [DIMENSIONS[d] for d in dimensions]
    if len(columns) == 1 and not include_all:
        grouped = cases.groupBy(columns[0]).agg(*aggregates(MEASURES))
        label, value = f"'{dimensions[0]}'", f"CAST({columns[0]} AS STRING)"
    else:
        used = {f"_without_{c}": f"grouping({c})" for c in columns}
        grouped = by_dimension(cases, columns, MEASURES, used, total=include_all, share=cell_share)
        cases_of = [(f"_without_{c} = 0", d, f"CAST({c} AS STRING)") for d, c in zip(dimensions, columns)]
        label = f"CASE {' '.join(f"WHEN {test} THEN '{d}'" for test, d, _ in cases_of)} ELSE '{ALL}' END"
        value = f"CASE {' '.join(f'WHEN {test} THEN {v}' for test, _, v in cases_of)} ELSE '{ALL}' END"
    return grouped.selectExpr(f"{label} AS dimension", f"{value} AS dimension_value", *MEASURES, *named(RATES))


def dimension_metrics(
    cases: DataFrame, dimensions=tuple(DIMENSIONS), include_all: bool = True, cell_share: float = 1.0
) -> DataFrame:
    """Totals, rates and shares per dimension value.

    The grouped table is checkpointed once; its totals per dimension (one row for each
    dimension, at most five) are broadcast back. A window per dimension would pull all
    merchants into one task.
    """
    totals = frozen(dimension_totals(cases, dimensions, include_all, cell_share))
    whole = totals.groupBy("dimension").agg(
        *aggregates({"_exposure": "sum(current_exposure_inr)", "_flagged": "sum(exception_transactions)"})
    )
    return totals.join(F.broadcast(whole), "dimension").selectExpr(
        "* EXCEPT (_exposure, _flagged)",
        f"{ratio('current_exposure_inr', '_exposure')} AS exposure_share",
        f"{ratio('exception_transactions', '_flagged')} AS exception_share",
    )


def metrics_of(metrics: DataFrame, dimension: str) -> DataFrame:
    """One dimension's view of the common metric table."""
    return metrics.filter(f"dimension = '{dimension}'").drop("dimension")


SUMMARY_COLUMNS = (
    "observed_transactions",
    "internal_payments",
    "orphan_transactions",
    "exception_count",
    "exception_transactions",
    "exception_transaction_rate",
    "internal_exception_rate",
    "matched_payments",
    "pending_payments",
    "overdue_payments",
    "internal_gross_inr",
    "gateway_gross_inr",
    "gateway_net_inr",
    "bank_gross_inr",
    "bank_net_inr",
    "financial_exposure_inr",
    "overdue_cash_inr",
    "current_exposure_inr",
    "historical_late_cash_inr",
)


def summary(cases: DataFrame) -> DataFrame:
    """Exactly one row. A global aggregate yields zero counts and null rates on no input."""
    return _summarised(cases.agg(*aggregates(MEASURES)))


def _summarised(totals: DataFrame, *keys: str) -> DataFrame:
    return totals.selectExpr(*keys, *[f"{RATES[name]} AS {name}" if name in RATES else name for name in SUMMARY_COLUMNS])


def summary_by_cutoff(cases: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """One summary row per cutoff of a parameter table, also for cutoffs without events.

    The grouped side has at most one row per cutoff.
    """
    totals = cases.groupBy("as_of").agg(*aggregates(MEASURES))
    zero = {f.name: f"coalesce({f.name}, CAST(0 AS {f.dataType.simpleString()}))" for f in totals.schema}
    del zero["as_of"]
    return _summarised(cutoffs.join(totals, "as_of", "left").selectExpr("as_of", *named(zero)), "as_of")


def exception_type_metrics(detected: DataFrame, cases: DataFrame) -> DataFrame:
    """Per rule: signals, rate over all observed ids and non-additive amounts.

    The denominator is a scalar subquery that reads nothing but the ids.
    """
    observed = cases.agg(F.expr("count(*) AS observed")).scalar()
    totals = {
        "exception_count": "count(*)",
        "rule_amount_at_risk_inr": "sum(amount_at_risk)",
        "rule_financial_exposure_inr": "sum(financial_exposure_inr)",
        "overdue_cash_inr": "sum(overdue_cash_inr)",
        "historical_late_cash_inr": "sum(historical_late_cash_inr)",
    }
    rate = F.col("exception_count").cast("double") / F.nullif(observed.cast("double"), F.lit(0.0))
    return (
        detected.groupBy("exception_type", "severity", "exposure_kind")
        .agg(*aggregates(totals))
        .withColumn("observed_transaction_rate", rate)
    )


LATE = "settlement_delay_days > max_settlement_days"


def settlement_delay_metrics(cases: DataFrame, approximate: bool = False) -> DataFrame:
    """Delay statistics per gateway with exact median and 95th percentile.

    Facts are counted per (gateway, delay in microseconds) and the counts are stored, so that
    facts are read once. Everything else is read from those counts, the quantiles by histograms that
    close in on them, so a gateway that holds most rows never meets in one task.
    With ``approximate`` the quantiles come from ``percentile_approx`` instead.
    """
    if approximate:
        statistics = {
            "observed_unique_settlements": "count(settlement_delay_days)",
            "late_settlements": f"count_if({LATE})",
            "mean_delay_days": "avg(settlement_delay_days)",
            "median_delay_days": "percentile_approx(settlement_delay_days, 0.5)",
            "p95_delay_days": "percentile_approx(settlement_delay_days, 0.95)",
            "max_delay_days": "max(settlement_delay_days)",
            "overdue_payments": "count_if(settlement_state = 'overdue')",
            "pending_payments": "count_if(settlement_state = 'pending')",
        }
        return cases.groupBy("gateway_id").agg(*aggregates(statistics))
    delay = f"IF(settlement_delay_days IS NULL, NULL, {micros_between('gateway_event_at', 'settled_at')})"
    counted = {
        "settlements": "count(settlement_delay_days)",
        "late": f"count_if({LATE})",
        "overdue": "count_if(settlement_state = 'overdue')",
        "pending": "count_if(settlement_state = 'pending')",
    }
    counts = frozen(
        cases.selectExpr("*", f"{delay} AS delay_micros")
        .groupBy("gateway_id", "delay_micros")
        .agg(*aggregates(counted))
    )
    weighted = "sum(CAST(delay_micros AS DECIMAL(20,0)) * settlements)"
    basics = {
        "observed_unique_settlements": "sum(settlements)",
        "late_settlements": "sum(late)",
        "mean_delay_days": f"{ratio(weighted, 'sum(settlements)')} / {MICROS_PER_DAY}",
        "max_delay_days": f"max(delay_micros) / {MICROS_PER_DAY}",
        "overdue_payments": "sum(overdue)",
        "pending_payments": "sum(pending)",
    }
    quantiles = quantiles_by_count(
        counts,
        group="gateway_id",
        value="delay_micros",
        count="settlements",
        shares={"median_micros": 0.5, "p95_micros": 0.95},
    )
    return (
        counts.groupBy("gateway_id")
        .agg(*aggregates(basics))
        .join(quantiles, "gateway_id", "left")
        .selectExpr(
            "* EXCEPT (median_micros, p95_micros)",
            f"median_micros / {MICROS_PER_DAY} AS median_delay_days",
            f"p95_micros / {MICROS_PER_DAY} AS p95_delay_days",
        )
    )


def daily_settlements(settlement: DataFrame) -> DataFrame:
    """Bank cash by actual cash date, from raw lines with their duplicates."""
    totals = {
        "settlement_lines": "count(*)",
        "settled_transactions": "count(DISTINCT transaction_id)",
        "bank_gross_inr": "sum(gross_amount)",
        "bank_fee_inr": "sum(fee_amount)",
        "bank_tax_inr": "sum(tax_amount)",
        "bank_net_inr": "sum(net_amount)",
    }
    return settlement.groupBy(F.expr("CAST(settled_at AS DATE) AS settlement_date")).agg(*aggregates(totals))


TIED_MEASURES = (
    "observed_transactions",
    "internal_payments",
    "exception_count",
    "exception_transactions",
    "internal_gross_inr",
    "gateway_net_inr",
    "bank_net_inr",
    "current_exposure_inr",
    "historical_late_cash_inr",
)


def dimension_tie_out(metrics: DataFrame) -> DataFrame:
    """Control: every dimension must add up to the grand total.

    Works on the grouped table, brought down to five rows before it meets itself.
    """
    sums = metrics.groupBy("dimension").agg(
        *aggregates({m: f"CAST(sum({m}) AS {GRAND_TOTAL})" for m in TIED_MEASURES})
    )
    long = sums.unpivot("dimension", list(TIED_MEASURES), "measure", "dimension_total")
    grand = long.filter(f"dimension = '{ALL}'").selectExpr("measure", "dimension_total AS summary_total")
    return (
        long.filter(f"dimension != '{ALL}'")
        .join(F.broadcast(grand), "measure")
        .selectExpr("*", "dimension_total = summary_total AS ties")
    )

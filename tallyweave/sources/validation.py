"""Contract checks as one aggregate per feed. Only counts reach the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import aggregates
from tallyweave.functions.clock import as_utc
from tallyweave.functions.money import AMOUNT_CEILING, as_number, has_fractional_paise
from tallyweave.functions.text import is_blank
from tallyweave.sources.contracts import CONTRACTS, CURRENCY, INTERNAL, FeedContract

BLANK_TEXT = "blank_text"
INVALID_TIME = "invalid_time"
NOT_FINITE = "not_finite"
NEGATIVE = "negative"
FRACTIONAL_PAISE = "fractional_paise"
TOO_LARGE = "too_large"
FOREIGN_CURRENCY = "foreign_currency"
DUPLICATE_KEY = "duplicate_key"

MESSAGES = {
    BLANK_TEXT: "contains missing or blank values",
    INVALID_TIME: "contains missing or invalid timestamps",
    NOT_FINITE: "contains values that are not finite numbers",
    NEGATIVE: "contains negative money",
    FRACTIONAL_PAISE: "contains money with more than two decimal places",
    TOO_LARGE: "contains money at or above 10^13",
    FOREIGN_CURRENCY: "must be INR; currency conversion is not supported",
    DUPLICATE_KEY: "must be unique",
}


def checks(feed: DataFrame, contract: FeedContract) -> dict[tuple[str, str], str]:
    """Map (check, column) to the condition that marks a bad row."""
    types = {field.name: field.dataType for field in feed.schema}
    bad = {(BLANK_TEXT, name): is_blank(f"CAST({name} AS STRING)") for name in contract.text}
    bad[INVALID_TIME, contract.time] = f"({as_utc(contract.time, types[contract.time])}) IS NULL"
    for name in contract.money:
        number = f"({as_number(name, types[name])})"
        bad[NOT_FINITE, name] = f"{number} IS NULL OR isnan({number}) OR abs({number}) = DOUBLE('Infinity')"
        bad[NEGATIVE, name] = f"{number} < 0"
        bad[FRACTIONAL_PAISE, name] = has_fractional_paise(number)
        bad[TOO_LARGE, name] = f"{number} >= {AMOUNT_CEILING}"
    if "currency" in contract.text:
        bad[FOREIGN_CURRENCY, "currency"] = f"currency != '{CURRENCY}'"
    return bad


def violations(feed: DataFrame, contract: FeedContract) -> DataFrame:
    """One row per check: feed, check, column_name, violations."""
    contract.require(feed)
    bad = checks(feed, contract)
    counted = feed.agg(*aggregates({f"bad_{i}": f"count_if({test})" for i, test in enumerate(bad.values())}))
    rows = ", ".join(
        f"named_struct('feed', '{contract.name}', 'check', '{check}', 'column_name', '{column}', 'violations', bad_{i})"
        for i, (check, column) in enumerate(bad)
    )
    report = counted.selectExpr(f"inline(array({rows}))")
    if contract.name == INTERNAL.name:
        report = report.unionByName(_repeated_keys(feed, contract))
    return report


def repeated_keys(feed: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Keys that occur more than once; repeats collapse before the shuffle."""
    return feed.groupBy(F.expr(f"CAST({key} AS STRING) AS {key}")).agg(F.expr("count(*) AS rows")).filter("rows > 1")


def _repeated_keys(feed: DataFrame, contract: FeedContract) -> DataFrame:
    return repeated_keys(feed).selectExpr(
        f"'{contract.name}' AS feed",
        f"'{DUPLICATE_KEY}' AS check",
        "'transaction_id' AS column_name",
        "count(*) AS violations",
    )


def validation_report(feeds: dict[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """Every check of every feed; all input rows count, also those after the cutoff."""
    return reduce(DataFrame.unionByName, [violations(feeds[c.name], c) for c in contracts])


def validate(feeds: dict[str, DataFrame], contracts=CONTRACTS) -> None:
    """Raise ValueError naming each broken check. The driver sees one count per check."""
    for contract in contracts:
        contract.require(feeds[contract.name])
    broken = validation_report(feeds, contracts).filter("violations > 0").orderBy("feed", "column_name", "check")
    problems = [
        f"{row['feed']}.{row['column_name']} {MESSAGES[row['check']]} ({row['violations']} found)"
        for row in broken.collect()
    ]
    if problems:
        raise ValueError("; ".join(problems))


def validate_legacy(feeds: dict[str, DataFrame], contracts) -> None:
    """Checks of the ten-rule detector: columns, null keys, readable times and money, a unique ledger key."""
    for contract in contracts:
        contract.require(feeds[contract.name])
    null_keys = [
        feeds[c.name].selectExpr(
            f"'{c.name}.transaction_id contains null values' AS problem", "count_if(transaction_id IS NULL) AS bad"
        )
        for c in contracts
    ]
    unreadable = [
        feeds[c.name].selectExpr(
            f"'{c.name}.{c.time} contains invalid timestamps' AS problem",
            f"count_if({c.time} IS NOT NULL AND ({as_utc(c.time, feeds[c.name].schema[c.time].dataType)}) IS NULL) AS bad",
        )
        for c in contracts
    ]
    for c in contracts:
        for name in c.money:
            number = f"({as_number(name, feeds[c.name].schema[name].dataType)})"
            unreadable.append(
                feeds[c.name].selectExpr(
                    f"'{c.name}.{name} {MESSAGES[NOT_FINITE]}' AS problem",
                    f"count_if({name} IS NOT NULL AND ({number} IS NULL OR isnan({number}) OR abs({number}) = DOUBLE('Infinity'))) AS bad",
                )
            )
    repeats = repeated_keys(feeds[INTERNAL.name]).selectExpr(
        "'internal ledger holds repeated transaction_id values' AS problem", "count(*) AS bad"
    )
    broken = reduce(DataFrame.unionByName, [*null_keys, *unreadable, repeats]).filter("bad > 0")
    problems = [f"{row['problem']}: {row['bad']}" for row in broken.collect()]
    if problems:
        raise ValueError("; ".join(problems))

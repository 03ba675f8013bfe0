"""Registered queries: each derives the feeds from a folder's tables and runs whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.functions import named, text_literal
from tallyweave.operators import matching, metrics
from tallyweave.operators.audit import source_counts, table_fingerprint
from tallyweave.operators.durable import shared_folder, stored
from tallyweave.operators.evaluation import (
    comparison,
    evaluate_detections,
    evaluation_by_type,
    evaluation_summary,
    outcome_counts,
)
from tallyweave.operators.facts import facts_by_joins, gateway_rollup, payment_facts, settlement_rollup
from tallyweave.operators.fees import expected_fees, fee_variance
from tallyweave.operators.hash_tree import hash_tree, range_borders, tree_difference
from tallyweave.operators.legacy import COLUMNS as DETECTION_COLUMNS
from tallyweave.operators.legacy import detections, detector_differences
from tallyweave.operators.repeats import repeated_keys
from tallyweave.operators.queue import aging_metrics, investigation_queue, top_cases
from tallyweave.operators.rules import (
    CORE_RULES,
    RULES,
    case_facts,
    detected_exceptions,
    exception_rollup,
    exception_signals,
    reconciliation_facts,
    rule_signals,
)
from tallyweave.plans import operations, reports
from tallyweave.sources.bucketed import bucket_count, write_bucketed
from tallyweave.sources.contracts import CONTRACTS, INTERNAL, LEGACY_CONTRACTS, typed
from tallyweave.sources.csv_feeds import read_text, read_text_feeds, write_feeds
from tallyweave.sources.order_feeds import (
    DEFAULT_AS_OF,
    EARLIER_AS_OF,
    faulty_ledger,
    order_feeds,
    read_orders,
    truth_labels,
)
from tallyweave.sources.validation import validation_report, violations

Query = Callable[[SparkSession, str], DataFrame]

BEFORE_ALL_EVENTS = "1990-01-01 00:00:00"
SNAPSHOTS = (BEFORE_ALL_EVENTS, EARLIER_AS_OF, DEFAULT_AS_OF)
QUARTER_ENDS = tuple(f"{year}-{day} 23:59:59" for year in range(1993, 1999) for day in ("03-31", "06-30", "09-30", "12-31"))


#: Bytes of a feed row, for the number of buckets.
FEED_ROW_BYTES = 120


class Inputs:
    """Lazy relations over one folder. Nothing is cached between queries."""

    def __init__(self, spark: SparkSession, orders: DataFrame, as_of: str = DEFAULT_AS_OF):
        self.spark = spark
        self.orders = orders
        self.as_of = as_of

    def at(self, as_of: str) -> Inputs:
        return Inputs(self.spark, self.orders, as_of)

    @property
    def raw(self) -> dict[str, DataFrame]:
        return order_feeds(self.orders)

    @property
    def feeds(self) -> dict[str, DataFrame]:
        return operations.cut_feeds(operations.typed_feeds(self.raw), self.as_of)

    @property
    def unfiltered(self) -> dict[str, DataFrame]:
        raw = self.raw
        return {c.name: typed(raw[c.name], c, lower_status=False) for c in LEGACY_CONTRACTS}

    def bucketed(self, feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The same feeds, stored in buckets. A feed has about a row an order, and Parquet knows how many there are."""
        return write_bucketed(feeds, max(2, bucket_count(self.orders.count() * FEED_ROW_BYTES))).feeds()

    @property
    def facts(self) -> DataFrame:
        return payment_facts(self.feeds, self.as_of)

    @property
    def cases(self) -> DataFrame:
        return case_facts(self.facts)

    @property
    def detected(self) -> DataFrame:
        return detected_exceptions(self.cases)

    @property
    def truth(self) -> DataFrame:
        return truth_labels(self.orders)

    @property
    def core_detected(self) -> DataFrame:
        return self.detected.filter(f"exception_type IN ({', '.join(map(text_literal, CORE_RULES))})")


def presented(df: DataFrame) -> DataFrame:
    """Plain types at the query's edge: money and ratios as double, times as text."""
    forms = {
        T.DecimalType: "CAST({c} AS DOUBLE)",
        T.DoubleType: "round({c}, 6)",
        T.DateType: "CAST({c} AS STRING)",
        T.TimestampNTZType: "date_format({c}, 'yyyy-MM-dd HH:mm:ss')",
        T.IntegerType: "CAST({c} AS BIGINT)",
    }
    return df.selectExpr(*named({f.name: forms.get(type(f.dataType), "{c}").format(c=f.name) for f in df.schema}))


def _feed(name: str, i: Inputs) -> DataFrame:
    return i.feeds[name]


def _rule(name: str, i: Inputs) -> DataFrame:
    return rule_signals(i.facts, name)


def _one_dimension(dimension: str, i: Inputs) -> DataFrame:
    return metrics.metrics_of(metrics.dimension_metrics(i.cases, (dimension,), include_all=False), dimension)


def _summary_empty(i: Inputs) -> DataFrame:
    return metrics.summary(i.at(BEFORE_ALL_EVENTS).cases)


def _fingerprint_difference(i: Inputs) -> DataFrame:
    """Facts against a version with a cent added to some ledger amounts and some rows gone: the key ranges that differ.

    The facts are written once; the borders and both trees read them from there instead of matching the feeds three times.
    """
    key, facts = "transaction_id", stored(i.facts, "facts")
    mark = f"left(md5(concat('change', {key})), 3)"
    changed = facts.where(f"{mark} <> '003'").withColumn(
        "internal_gross", F.expr(f"IF({mark} < '003', CAST(coalesce(internal_gross, 0) + 0.01 AS {facts.schema['internal_gross'].dataType.simpleString()}), internal_gross)")
    )
    borders = range_borders(facts, key)
    return tree_difference(hash_tree(facts, key, borders), hash_tree(changed, key, borders), borders)


def _top_merchants(i: Inputs) -> DataFrame:
    totals = metrics.dimension_totals(i.cases, ("merchant",), include_all=False)
    return reports.top_bars(totals, "dimension_value", "current_exposure_inr")


def _top_rules(i: Inputs) -> DataFrame:
    counts = i.detected.groupBy("exception_type").agg(F.expr("count(*) AS exception_count"))
    return reports.top_bars(counts, "exception_type", "exception_count")


def _earliest_cohorts(i: Inputs) -> DataFrame:
    totals = metrics.dimension_totals(i.cases, ("day",), include_all=False)
    return reports.daily_cohorts(totals).orderBy("dimension_value").limit(10)


def _csv_round_trip(i: Inputs) -> DataFrame:
    """Write the feeds as CSV, scan them back as text and audit the typed result."""
    folder = f"{shared_folder(i.spark)}/tallyweave-{uuid.uuid4().hex}/feeds"
    write_feeds(i.raw, None, folder)
    feeds = operations.cut_feeds(operations.typed_feeds(read_text_feeds(i.spark, folder)), i.as_of)
    parts = []
    for contract in CONTRACTS:
        amount = contract.money[0]
        parts.append(
            feeds[contract.name].selectExpr(
                f"'{contract.name}' AS feed",
                "count(*) AS rows",
                "count(DISTINCT transaction_id) AS transactions",
                f"sum({amount}) AS amount",
                f"max({contract.time}) AS latest",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _duplicates_by_feed(i: Inputs) -> DataFrame:
    parts = [
        repeated_keys(i.unfiltered[name], matching.KEY).selectExpr(f"'{name}' AS feed", "transaction_id", "rows")
        for name in ("gateway", "settlement")
    ]
    return reduce(DataFrame.unionByName, parts)


def _deduplicated_counts(i: Inputs) -> DataFrame:
    """Unique-record tables of both feeds, by grouping and by anti-join."""
    parts = []
    for name, amount in (("gateway", "gateway_amount"), ("settlement", "net_amount")):
        feed = i.unfiltered[name].select("transaction_id", amount)
        for method, rows in (
            ("grouping", matching.single_records(feed)),
            ("anti_join", matching.without_duplicates(feed)),
        ):
            parts.append(
                rows.selectExpr(
                    f"'{name}' AS feed", f"'{method}' AS method", "count(*) AS rows", f"sum({amount}) AS amount"
                )
            )
    return reduce(DataFrame.unionByName, parts)


#: Every join and grouping between feeds, by query; each runs on feeds as derived and on bucketed ones.
SHAPES: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "internal_without_gateway": matching.internal_without_gateway,
    "gateway_without_internal": matching.gateway_without_internal,
    "settlement_without_internal": matching.settlement_without_internal,
    "eligible_without_settlement": matching.eligible_without_settlement,
    "matched_ledger_gateway": matching.matched_ledger_gateway,
    "matched_gateway_settlement": matching.matched_gateway_settlement,
}


def _bucketed(shape: str, i: Inputs) -> DataFrame:
    return SHAPES[shape](i.bucketed(i.unfiltered))


def _bucketed_facts(i: Inputs) -> DataFrame:
    feeds = i.bucketed(operations.typed_feeds(i.raw))
    return facts_by_joins(operations.cut_feeds(feeds, i.as_of), i.as_of)


def _operational_run(i: Inputs) -> DataFrame:
    """Row counts of all twelve reports from one complete run."""
    result = operations.run_operations(**i.raw, as_of=i.as_of)
    parts = [
        table.selectExpr(f"'{name}' AS report", "count(*) AS rows")
        for name, table in result.tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _read_back(i: Inputs, path: str, like: DataFrame) -> DataFrame:
    """A written CSV report with the types of the table that it was written from."""
    text = read_text(i.spark, path)
    return text.selectExpr(*named({f.name: f"CAST({f.name} AS {f.dataType.simpleString()})" for f in like.schema}))


def _scratch(i: Inputs) -> str:
    return f"{shared_folder(i.spark)}/tallyweave-{uuid.uuid4().hex}"


def _queue_file(i: Inputs) -> DataFrame:
    """The ranked queue as its CSV report holds it."""
    queue, path = investigation_queue(i.cases), f"{_scratch(i)}/investigation_queue.csv"
    reports.write_csv(operations.in_report_order("investigation_queue", queue), path)
    return _read_back(i, path, queue)


def _summary_file(i: Inputs) -> DataFrame:
    """The summary as its JSON document holds it."""
    summary, path = metrics.summary(i.cases), f"{_scratch(i)}/summary.json"
    reports.summary_json(summary).write.text(path)
    return i.spark.read.schema(summary.schema).json(path)


def _evaluation_file(i: Inputs) -> DataFrame:
    """The comparison with labels as its CSV file holds it."""
    folder, detected = _scratch(i), i.core_detected
    result = evaluate_detections(i.truth, detected)
    reports.write_evaluation(detected.select(*DETECTION_COLUMNS), result, folder)
    return _read_back(i, f"{folder}/truth_vs_detection.csv", result.comparison)


def _manifest_file(i: Inputs) -> DataFrame:
    """Rows of every report as the manifest of a complete, written run holds them."""
    folder = _scratch(i)
    reports.write_reports(operations.run_operations(**i.raw, as_of=i.as_of), folder)
    entries = "from_json(get_json_object(value, '$.outputs'), 'MAP<STRING, STRUCT<rows: BIGINT>>')"
    written = i.spark.read.text(f"{folder}/manifest.json").selectExpr(f"explode({entries}) AS (report, entry)")
    return written.selectExpr("report", "entry.rows AS rows")


PLANS: dict[str, Callable[[Inputs], DataFrame]] = {
    "feed_internal": partial(_feed, "internal"),
    "feed_gateway": partial(_feed, "gateway"),
    "feed_settlement": partial(_feed, "settlement"),
    "csv_round_trip": _csv_round_trip,
    "source_counts": lambda i: source_counts(i.raw, i.as_of),
    "validation_report": lambda i: validation_report(i.raw),
    "validation_faults": lambda i: violations(faulty_ledger(i.orders), INTERNAL).filter("violations > 0"),
    "gateway_rollup": lambda i: gateway_rollup(i.feeds["gateway"]),
    "settlement_rollup": lambda i: settlement_rollup(i.feeds["settlement"]),
    "payment_facts": lambda i: i.facts,
    "facts_by_joins": lambda i: facts_by_joins(i.feeds, i.as_of),
    "exception_signals": lambda i: exception_signals(i.cases),
    **{f"signals_{rule.name}": partial(_rule, rule.name) for rule in RULES},
    "detected_exceptions": lambda i: i.detected,
    "exception_rollup": lambda i: exception_rollup(i.detected),
    "reconciliation_facts": lambda i: reconciliation_facts(i.cases),
    "investigation_queue": lambda i: investigation_queue(i.cases),
    "queue_top25": lambda i: top_cases(i.cases, reports.QUEUE_ROWS),
    "top10_merchants": _top_merchants,
    "top10_rules": _top_rules,
    "first10_days": _earliest_cohorts,
    "dimension_metrics": lambda i: metrics.dimension_metrics(i.cases),
    "dimension_metrics_by_cells": lambda i: metrics.dimension_metrics(i.cases, cell_share=0.0),
    "merchant_metrics": partial(_one_dimension, "merchant"),
    "daily_metrics": partial(_one_dimension, "day"),
    "payment_method_metrics": partial(_one_dimension, "payment_method"),
    "gateway_metrics": partial(_one_dimension, "gateway"),
    "payment_method_concentration": lambda i: reports.payment_method_concentration(
        _one_dimension("payment_method", i)
    ),
    "summary": lambda i: metrics.summary(i.cases),
    "summary_empty": _summary_empty,
    "source_controls": lambda i: reports.source_controls(metrics.summary(i.cases)),
    "exception_type_metrics": lambda i: metrics.exception_type_metrics(i.detected, i.cases),
    "aging_metrics": lambda i: aging_metrics(i.cases),
    "settlement_delay_metrics": lambda i: metrics.settlement_delay_metrics(i.cases),
    "daily_settlements": lambda i: metrics.daily_settlements(i.feeds["settlement"]),
    "dimension_tie_out": lambda i: metrics.dimension_tie_out(metrics.dimension_metrics(i.cases)),
    "duplicate_ids": _duplicates_by_feed,
    "repeated_ledger_ids": lambda i: repeated_keys(faulty_ledger(i.orders), matching.KEY),
    "deduplicated_feeds": _deduplicated_counts,
    **{name: lambda i, shape=shape: shape(i.unfiltered) for name, shape in SHAPES.items()},
    **{f"bucketed_{name}": partial(_bucketed, name) for name in SHAPES},
    "bucketed_facts": _bucketed_facts,
    "legacy_detections": lambda i: detections(i.unfiltered),
    "legacy_vs_current": lambda i: detector_differences(detections(i.unfiltered), i.cases),
    "truth_labels": lambda i: i.truth,
    "evaluation_summary": lambda i: evaluation_summary(outcome_counts(i.truth, i.core_detected)),
    "evaluation_by_type": lambda i: evaluation_by_type(outcome_counts(i.truth, i.core_detected)),
    "evaluation_comparison": lambda i: comparison(i.truth, i.core_detected),
    "snapshot_comparison": lambda i: operations.snapshot_comparison(i.spark, i.raw, SNAPSHOTS),
    "quarterly_snapshots": lambda i: operations.snapshot_comparison(i.spark, i.raw, QUARTER_ENDS),
    "expected_fees": lambda i: expected_fees(i.feeds["internal"]).select(
        "transaction_id", "payment_method", "gross_amount", "fee_rate", "expected_fee", "expected_tax", "expected_net"
    ),
    "fee_variance": lambda i: fee_variance(i.feeds, i.as_of),
    "report_cards": lambda i: reports.report_cards(metrics.summary(i.cases)),
    "exception_rate_text": lambda i: reports.rate_text(metrics.summary(i.cases)),
    "table_fingerprint": lambda i: table_fingerprint(i.facts, "payment_facts"),
    "fingerprint_difference": _fingerprint_difference,
    "operational_run": _operational_run,
    "queue_file": _queue_file,
    "summary_file": _summary_file,
    "evaluation_file": _evaluation_file,
    "manifest_file": _manifest_file,
}


def queries() -> dict[str, Query]:
    return {name: partial(_run, plan) for name, plan in PLANS.items()}


def _run(plan: Callable[[Inputs], DataFrame], spark: SparkSession, folder: str) -> DataFrame:
    return presented(plan(Inputs(spark, read_orders(spark, folder))))

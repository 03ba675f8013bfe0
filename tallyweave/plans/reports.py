"""Report sections as tables, and the file sinks of a run."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.functions import named, text_literal
from tallyweave.functions.money import GRAND_TOTAL
from tallyweave.functions.text import grouped_thousands, html_escaped, percentage
from tallyweave.operators.audit import file_digests, fingerprints, watched
from tallyweave.operators.evaluation import EvaluationResult
from tallyweave.operators.legacy import detection_order
from tallyweave.operators.run_store import Files, RunStore, run_key
from tallyweave.plans.operations import OperationalResult, in_report_order
from tallyweave.sources.csv_feeds import CSV_DIALECT

# Sizes of the report's top lists.
BAR_ROWS = 10
QUEUE_ROWS = 25

# Headline cards (label, summary column, is money).
CARDS = (
    ("Internal payments", "internal_payments", False),
    ("Payments with exceptions (all sources)", "exception_transactions", False),
    ("Rule signals", "exception_count", False),
    ("Current estimated exposure", "current_exposure_inr", True),
    ("Of which: overdue cash", "overdue_cash_inr", True),
    ("Historical late cash · excluded from current", "historical_late_cash_inr", True),
)
UNDEFINED_RATE = "undefined (no observations)"

# Bounded part files keep a report file well below what one task can hash.
ROWS_PER_FILE = 200_000


def report_cards(summary: DataFrame) -> DataFrame:
    """Headline figures, one row per card, with display text."""
    rows = ", ".join(
        f"named_struct('position', {position}, 'card', {text_literal(label)}, "
        f"'value', CAST({column} AS {GRAND_TOTAL}), 'display', {_card_text(column, money)})"
        for position, (label, column, money) in enumerate(CARDS, start=1)
    )
    return summary.selectExpr(f"inline(array({rows}))")


def _card_text(value: str, money: bool) -> str:
    return f"concat('₹', {grouped_thousands(value, 2)})" if money else grouped_thousands(value)


def rate_text(summary: DataFrame) -> DataFrame:
    return summary.selectExpr(
        f"coalesce({percentage('exception_transactions', 'observed_transactions')}, '{UNDEFINED_RATE}') AS exception_rate"
    )


def top_bars(table: DataFrame, label: str, value: str, rows: int = BAR_ROWS) -> DataFrame:
    """The largest values with escaped labels and bar widths in percent."""
    head = table.select(label, value).orderBy(F.col(value).desc(), F.col(label).asc()).limit(rows)
    return head.selectExpr(
        label,
        f"{html_escaped(label)} AS label_html",
        value,
        f"CAST({value} AS DOUBLE) / greatest(max(CAST({value} AS DOUBLE)) OVER (), 1D) * 100 AS bar_percent",
    )


def report_sections(result: OperationalResult) -> dict[str, DataFrame]:
    """Every data section of the management report."""
    tables = result.tables
    queue_head = (
        tables["investigation_queue"]
        .filter(f"priority_rank <= {QUEUE_ROWS}")
        .selectExpr(
            "priority_rank",
            "transaction_id",
            f"{html_escaped('merchant_id')} AS merchant_id",
            "severity",
            "exception_types",
            "current_exposure_inr",
            "age_days",
            "case_status",
            "recommended_actions",
        )
    )
    return {
        "cards": report_cards(tables["summary"]),
        "exception_rate": rate_text(tables["summary"]),
        "exposure_by_merchant": top_bars(tables["merchant_metrics"], "dimension_value", "current_exposure_inr"),
        "signals_by_rule": top_bars(tables["exception_type_metrics"], "exception_type", "exception_count"),
        "queue_head": queue_head,
        "aging": tables["aging_metrics"],
        "daily_cohorts": daily_cohorts(tables["daily_metrics"]),
        "settlement_delay": tables["settlement_delay_metrics"],
        "payment_methods": payment_method_concentration(tables["payment_method_metrics"]),
        "source_controls": source_controls(tables["summary"]),
    }


def daily_cohorts(daily: DataFrame) -> DataFrame:
    return daily.select(
        "dimension_value",
        "internal_payments",
        "exception_count",
        "exception_transactions",
        "exception_transaction_rate",
        "current_exposure_inr",
        "overdue_cash_inr",
    )


def payment_method_concentration(methods: DataFrame) -> DataFrame:
    return methods.select(
        "dimension_value",
        "observed_transactions",
        "exception_transactions",
        "exception_transaction_rate",
        "current_exposure_inr",
        "exposure_share",
    )


def source_controls(summary: DataFrame) -> DataFrame:
    return summary.select(
        "internal_gross_inr", "gateway_gross_inr", "gateway_net_inr", "bank_gross_inr", "bank_net_inr"
    )


def as_report_text(table: DataFrame) -> DataFrame:
    """Numbers with six decimals, ISO seconds and capitalised booleans."""
    forms = {
        T.DecimalType: "CAST(CAST({c} AS DECIMAL(38,6)) AS STRING)",
        T.DoubleType: "IF({c} IS NULL, NULL, format_string('%.6f', {c}))",
        T.DateType: "date_format(CAST({c} AS TIMESTAMP_NTZ), \"yyyy-MM-dd'T'HH:mm:ss\")",
        T.TimestampNTZType: "date_format({c}, \"yyyy-MM-dd'T'HH:mm:ss\")",
        T.BooleanType: "initcap(CAST({c} AS STRING))",
    }
    return table.selectExpr(*named({f.name: forms.get(type(f.dataType), "{c}").format(c=f.name) for f in table.schema}))


def write_csv(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    options = {**CSV_DIALECT, "emptyValue": "", "maxRecordsPerFile": ROWS_PER_FILE}
    as_report_text(table).write.mode(mode).options(**options).csv(path)


def summary_json(summary: DataFrame) -> DataFrame:
    """The summary as one JSON document with sorted keys and explicit nulls."""
    document = f"struct({', '.join(sorted(summary.columns))})"
    return summary.selectExpr(f"to_json({document}, map('ignoreNullFields', 'false')) AS value")


def write_reports(
    result: OperationalResult, folder: str, *, sources: dict[str, DataFrame] | None = None, overwrite: bool = False
) -> dict:
    """Write reports as partitioned CSV, the summary as JSON and a manifest.

    The manifest holds run parameters, row counts and order-insensitive fingerprints,
    so two runs over the same data give the same manifest. It returns what it wrote.
    The manifest is written last: a folder without one is unfinished. An unfinished run over the same
    inputs, told by the fingerprints of ``sources``, goes on behind the reports that it has committed. With overwrite, an
    earlier run's files are replaced one by one.
    """
    spark = result.tables["summary"].sparkSession
    prints = _recorded(fingerprints(sources)) if sources else {}
    # Without the inputs' fingerprints nothing tells whether an earlier run had the same inputs.
    store = RunStore(spark, folder, run_key({**result.metadata, "sources": prints or uuid.uuid4().hex}))
    if store.published() and not overwrite:
        raise FileExistsError(f"PATH_ALREADY_EXISTS: {folder} holds a published run")
    Files(spark).delete(f"{folder}/manifest.json")
    done = store.committed()
    outputs = {name: store.write(name, in_report_order(name, table), _written_report, done) for name, table in result.tables.items()}
    summary_json(result.tables["summary"]).write.mode("overwrite").text(f"{folder}/summary.json")
    for name, section in report_sections(result).items():
        write_csv(section, f"{folder}/sections/{name}.csv", "overwrite")
    manifest = {**result.metadata, "spark_version": spark.version, "outputs": outputs, "sources": prints}
    store.publish(manifest_table(spark, manifest))
    return manifest


def _written_report(table: DataFrame, path: str) -> dict:
    """Write a report; its rows and content hash are observed on the way."""
    # Watched above the sort: sorting samples its input, which must not be counted.
    report, observation = watched(table)
    write_csv(report, path, "overwrite")
    return observation.get


def _recorded(prints: DataFrame) -> dict:
    """One row per table comes to the driver, never table content."""
    return {r["table_name"]: {"rows": r["rows"], "content_hash": r["content_hash"]} for r in prints.collect()}


def manifest_table(spark: SparkSession, manifest: dict) -> DataFrame:
    return spark.range(1).select(F.lit(json.dumps(manifest, sort_keys=True, allow_nan=False)).alias("value"))


def output_digests(spark: SparkSession, folder: str) -> DataFrame:
    """SHA-256 of each written report file; part files are bounded by ROWS_PER_FILE."""
    return file_digests(spark, folder).filter(F.col("file").startswith("part-"))


def write_evaluation(detected: DataFrame, result: EvaluationResult, folder: str, *, overwrite: bool = False) -> None:
    """Benchmark outputs: detections, scores by type, label comparison and metrics."""
    mode = "overwrite" if overwrite else "errorifexists"
    write_csv(detected.orderBy(*detection_order()), f"{folder}/detected_exceptions.csv", mode)
    write_csv(result.by_type.orderBy("exception_type"), f"{folder}/metrics_by_type.csv", mode)
    write_csv(result.comparison.orderBy("exception_type", "transaction_id"), f"{folder}/truth_vs_detection.csv", mode)
    summary_json(result.summary).write.mode(mode).text(f"{folder}/metrics.json")

"""The operational run: validate, cut, match, classify, rank and measure."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import asdict, dataclass
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyweave.config import ReconciliationConfig, cutoff_literal, parse_cutoff
from tallyweave.functions import aggregates
from tallyweave.operators import metrics
from tallyweave.operators.audit import source_counts
from tallyweave.operators.durable import new_folder, written
from tallyweave.operators.facts import payment_facts, snapshot_facts
from tallyweave.operators.lattice import cell_estimate, cell_share
from tallyweave.operators.queue import aging_metrics, investigation_queue
from tallyweave.operators.run_store import Files
from tallyweave.operators.rules import case_facts, detected_exceptions, reconciliation_facts
from tallyweave.sources.contracts import CONTRACTS, CURRENCY, typed, until
from tallyweave.sources.validation import validate

# Fixed value: version label of the manifest.
SCHEMA_VERSION = "phase2-v1"

# Report names, and the key that puts each report in a repeatable order.
# Every key is unique within its report.
REPORT_KEYS = {
    "reconciliation_facts": ("transaction_id",),
    "detected_exceptions": ("transaction_id", "exception_type"),
    "investigation_queue": ("priority_rank",),
    "summary": (),
    "merchant_metrics": ("dimension_value",),
    "daily_metrics": ("dimension_value",),
    "payment_method_metrics": ("dimension_value",),
    "gateway_metrics": ("dimension_value",),
    "exception_type_metrics": ("exception_type",),
    "aging_metrics": ("case_status", "aging_bucket"),
    "settlement_delay_metrics": ("gateway_id",),
    "daily_settlements": ("settlement_date",),
}
REPORTS = tuple(REPORT_KEYS)


@dataclass(frozen=True)
class OperationalResult:
    tables: Mapping[str, DataFrame]
    metadata: dict
    #: Where the run keeps what its reports share, until `release`.
    scratch: str | None = None

    def release(self) -> None:
        """Delete what the reports share; they cannot be read from this result afterwards."""
        if self.scratch:
            Files(self.tables["summary"].sparkSession).delete(self.scratch)


class Reports(Mapping):
    """Named reports, each built on first access and kept."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = {name: cache(build) for name, build in builders.items()}

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def typed_feeds(feeds: dict[str, DataFrame], contracts=CONTRACTS) -> dict[str, DataFrame]:
    return {c.name: typed(feeds[c.name], c) for c in contracts}


def cut_feeds(feeds: dict[str, DataFrame], as_of, contracts=CONTRACTS) -> dict[str, DataFrame]:
    return {c.name: until(feeds[c.name], c, as_of) for c in contracts}


def cases_at(feeds: dict[str, DataFrame], as_of, config: ReconciliationConfig = ReconciliationConfig()) -> DataFrame:
    """Case facts of untyped feeds at one cutoff, without validation or storage."""
    return case_facts(payment_facts(cut_feeds(typed_feeds(feeds), as_of), as_of, config))


def run_operations(
    internal: DataFrame,
    gateway: DataFrame,
    settlement: DataFrame,
    *,
    as_of,
    config: ReconciliationConfig = ReconciliationConfig(),
    folder: str | None = None,
) -> OperationalResult:
    """Reconcile three feeds as of an explicit, inclusive event-time cutoff.

    Case facts are written once to shared storage (``folder``, or the session's
    checkpoint folder) and every report reads only the columns it needs from there. A report
    is planned, with whatever jobs that takes, when it is first asked for.
    """
    cutoff = parse_cutoff(as_of)
    feeds = dict(zip((c.name for c in CONTRACTS), (internal, gateway, settlement)))
    validate(feeds)
    visible = cut_feeds(typed_feeds(feeds), cutoff)
    scratch = new_folder(internal.sparkSession, folder)
    estimate = Observation()
    observed = case_facts(payment_facts(visible, cutoff, config)).observe(
        estimate, *aggregates(cell_estimate(list(metrics.DIMENSIONS.values())))
    )
    cases = written(observed, f"{scratch}/case_facts")
    counts = {
        row["feed"]: {k: row[k] for k in ("input_rows", "included_rows", "future_rows_excluded")}
        for row in source_counts(feeds, cutoff).collect()
    }
    return OperationalResult(
        tables=report_tables(cases, visible["settlement"], cell_share(estimate.get)),
        metadata={
            "schema_version": SCHEMA_VERSION,
            "as_of_utc": cutoff.isoformat(),
            "currency": CURRENCY,
            "config": asdict(config),
            "source_counts": counts,
        },
        scratch=scratch,
    )


def report_tables(cases: DataFrame, settlement: DataFrame, share: float = 1.0) -> Reports:
    """The twelve reports over stored case facts and visible bank lines; share is the finest cells per fact."""
    detected = cache(lambda: detected_exceptions(cases))
    dimensions = cache(lambda: metrics.dimension_metrics(cases, cell_share=share))
    return Reports(
        {
            "reconciliation_facts": lambda: reconciliation_facts(cases),
            "detected_exceptions": detected,
            "investigation_queue": lambda: investigation_queue(cases),
            "summary": lambda: metrics.summary(cases),
            "merchant_metrics": lambda: metrics.metrics_of(dimensions(), "merchant"),
            "daily_metrics": lambda: metrics.metrics_of(dimensions(), "day"),
            "payment_method_metrics": lambda: metrics.metrics_of(dimensions(), "payment_method"),
            "gateway_metrics": lambda: metrics.metrics_of(dimensions(), "gateway"),
            "exception_type_metrics": lambda: metrics.exception_type_metrics(detected(), cases),
            "aging_metrics": lambda: aging_metrics(cases),
            "settlement_delay_metrics": lambda: metrics.settlement_delay_metrics(cases),
            "daily_settlements": lambda: metrics.daily_settlements(settlement),
        }
    )


def in_report_order(name: str, table: DataFrame) -> DataFrame:
    keys = REPORT_KEYS[name]
    return table.orderBy(*[F.col(k).asc_nulls_last() for k in keys]) if keys else table


def snapshot_comparison(
    spark: SparkSession,
    feeds: dict[str, DataFrame],
    cutoffs,
    config: ReconciliationConfig = ReconciliationConfig(),
) -> DataFrame:
    """Summary rows for several cutoffs from one pass over the feeds.

    The feeds are cut at the latest cutoff before each event is given to the first
    snapshot that sees it. A cutoff before all events still gets its row.
    """
    moments = sorted({parse_cutoff(c) for c in cutoffs})
    parameters = spark.range(1).selectExpr(f"explode(array({', '.join(map(cutoff_literal, moments))})) AS as_of")
    visible = cut_feeds(typed_feeds(feeds), moments[-1])
    cases = case_facts(snapshot_facts(visible, moments, config))
    return metrics.summary_by_cutoff(cases, parameters)

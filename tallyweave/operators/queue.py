"""Investigation queue: one scored case per flagged transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions import aggregates
from tallyweave.operators.ordering import ranked
from tallyweave.operators.rules import OPEN_REVIEW, SETTLED_LATE_REVIEW, SEVERITY_RANKS, flagged_cases

# Score weights and caps, and the ageing buckets with their upper ends
# in days (each bucket includes its upper end).
SEVERITY_WEIGHT = 100
RUPEES_PER_POINT = 10000.0
EXPOSURE_CAP = 30.0
AGE_CAP = 30.0
AGING_BUCKETS = ((0, "0 days"), (3, "0-3 days"), (7, "3-7 days"), (14, "7-14 days"), (30, "14-30 days"))
OLDEST_BUCKET = "30+ days"


def aging_bucket(age_days: str) -> str:
    buckets = " ".join(f"WHEN {age_days} <= {upper} THEN '{label}'" for upper, label in AGING_BUCKETS)
    return f"CASE {buckets} ELSE '{OLDEST_BUCKET}' END"


CURRENT_EXPOSURE = "(financial_exposure_inr + overdue_cash_inr)"

# Doubles in a fixed order of operations, so that scores repeat exactly.
PRIORITY_SCORE = (
    f"severity_rank * {SEVERITY_WEIGHT} "
    f"+ least(CAST({CURRENT_EXPOSURE} AS DOUBLE) / {RUPEES_PER_POINT}D, {EXPOSURE_CAP}D) "
    f"+ least(exception_age_days, {AGE_CAP}D)"
)


def scored_cases(cases: DataFrame) -> DataFrame:
    """The queue without its rank: row-local, so it adds no exchange."""
    severities = " ".join(f"WHEN {rank} THEN '{name}'" for name, rank in SEVERITY_RANKS.items())
    return flagged_cases(cases).selectExpr(
        "transaction_id",
        "merchant_id",
        "payment_method",
        "gateway_id",
        "exception_types",
        "exception_count",
        f"CASE severity_rank {severities} END AS severity",
        f"IF(historical_only, '{SETTLED_LATE_REVIEW}', '{OPEN_REVIEW}') AS case_status",
        "financial_exposure_inr",
        "overdue_cash_inr",
        "historical_late_cash_inr",
        f"{CURRENT_EXPOSURE} AS current_exposure_inr",
        "exception_age_days AS age_days",
        "recommended_actions",
        f"{PRIORITY_SCORE} AS priority_score",
        f"{aging_bucket('exception_age_days')} AS aging_bucket",
    )


def queue_order() -> list[Column]:
    """A total order: the transaction id settles every tie."""
    return [
        F.col("priority_score").desc(),
        F.col("current_exposure_inr").desc(),
        F.col("age_days").desc(),
        F.col("transaction_id").asc(),
    ]


def investigation_queue(cases: DataFrame) -> DataFrame:
    return ranked(scored_cases(cases), queue_order(), "priority_rank")


def top_cases(cases: DataFrame, size: int) -> DataFrame:
    """The head of the queue; each task keeps only ``size`` rows, so no full ranking runs."""
    head = scored_cases(cases).orderBy(*queue_order()).limit(size)
    return head.withColumn("priority_rank", F.row_number().over(Window.orderBy(*queue_order())))


def aging_metrics(cases: DataFrame) -> DataFrame:
    amounts = ("financial_exposure_inr", "overdue_cash_inr", "current_exposure_inr", "historical_late_cash_inr")
    totals = {"investigation_count": "count(*)"} | {name: f"sum({name})" for name in amounts}
    return scored_cases(cases).groupBy("case_status", "aging_bucket").agg(*aggregates(totals))

"""Scores of detections against labelled truth. Detection never sees these labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import aggregates, named
from tallyweave.functions.money import GRAND_TOTAL, ratio_or_zero
from tallyweave.operators.durable import stored

KEYS = ["exception_type", "transaction_id"]


@dataclass(frozen=True)
class EvaluationResult:
    summary: DataFrame
    by_type: DataFrame
    comparison: DataFrame


def evaluate_detections(truth: DataFrame, detected: DataFrame) -> EvaluationResult:
    for name, frame, needed in (
        ("truth", truth, {*KEYS, "reference_amount"}),
        ("detected", detected, {*KEYS, "amount_at_risk"}),
    ):
        missing = sorted(needed - set(frame.columns))
        if missing:
            raise ValueError(f"{name} is missing required columns: {missing}")
    counted = outcome_counts(truth, detected)
    return EvaluationResult(
        summary=evaluation_summary(counted), by_type=evaluation_by_type(counted), comparison=comparison(truth, detected)
    )


def distinct_detections(detected: DataFrame) -> DataFrame:
    """One detection per key; the smallest amount makes the choice repeatable."""
    return detected.groupBy(*KEYS).agg(F.expr("min(amount_at_risk) AS amount_at_risk"))


def comparison(truth: DataFrame, detected: DataFrame) -> DataFrame:
    """Every label and every unlabelled detection with its outcome: a full outer join.

    Truth may repeat a key and is kept whole. The join is written as a left join plus
    the detections without a label: a left join lets Spark split a hot truth key over
    tasks, which it cannot do for a full outer join. Both joins read the detections from
    storage, so that they are found once.
    """
    found = stored(distinct_detections(detected), "detections").selectExpr("*", "true AS _found")
    labels = truth.select(*KEYS, "reference_amount")
    labelled = labels.join(found, KEYS, "left").selectExpr(
        "* EXCEPT (_found)",
        "true AS truth_present",
        "_found IS NOT NULL AS detected_present",
        "IF(_found, 'tp', 'fn') AS outcome",
    )
    unlabelled = found.join(labels.select(*KEYS).distinct(), KEYS, "left_anti").selectExpr(
        "* EXCEPT (_found)", "false AS truth_present", "true AS detected_present", "'fp' AS outcome"
    )
    return labelled.unionByName(unlabelled, allowMissingColumns=True)


def outcome_counts(truth: DataFrame, detected: DataFrame) -> DataFrame:
    """Outcome counts and amounts per key, from one grouping of both sides.

    Repeated labels collapse before the shuffle, and no join is needed for totals.
    """
    labels = truth.selectExpr(
        *KEYS, f"CAST(reference_amount AS {GRAND_TOTAL}) AS amount", "1 AS labels", "0 AS detections"
    )
    found = detected.selectExpr(*KEYS, f"CAST(NULL AS {GRAND_TOTAL}) AS amount", "0 AS labels", "1 AS detections")
    totals = {"labels": "sum(labels)", "detected": "max(detections)", "amount": "sum(amount)"}
    return (
        labels.unionByName(found)
        .groupBy(*KEYS)
        .agg(*aggregates(totals))
        .selectExpr(
            "exception_type",
            "labels",
            "detected",
            "amount",
            "IF(detected = 1, labels, 0L) AS tp",
            "IF(detected = 1 AND labels = 0, 1L, 0L) AS fp",
            "IF(detected = 1, 0L, labels) AS fn",
        )
    )


SCORES = {
    "precision": ratio_or_zero("tp", "tp + fp"),
    "recall": ratio_or_zero("tp", "tp + fn"),
    "f1": ratio_or_zero("2 * tp", "2 * tp + fp + fn"),
}
OUTCOMES = {name: f"coalesce(sum({name}), 0L)" for name in ("tp", "fp", "fn")}


def evaluation_by_type(counted: DataFrame) -> DataFrame:
    return counted.groupBy("exception_type").agg(*aggregates(OUTCOMES)).selectExpr("*", *named(SCORES))


def evaluation_summary(counted: DataFrame) -> DataFrame:
    nothing = f"CAST(0 AS {GRAND_TOTAL})"
    totals = {
        "truth_exceptions": "coalesce(sum(labels), 0L)",
        "detected_exceptions": "coalesce(sum(detected), 0L)",
        **OUTCOMES,
        "injected_reference_amount": f"coalesce(sum(amount), {nothing})",
        "captured_reference_amount": f"coalesce(sum(IF(tp > 0, amount, NULL)), {nothing})",
    }
    capture = ratio_or_zero("captured_reference_amount", "injected_reference_amount")
    return counted.agg(*aggregates(totals)).selectExpr("*", *named(SCORES), f"{capture} AS amount_capture_rate")

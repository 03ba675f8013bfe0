"""Three-way payment reconciliation on Spark."""

from tallyweave.config import ReconciliationConfig
from tallyweave.operators.evaluation import EvaluationResult, evaluate_detections
from tallyweave.operators.legacy import reconcile
from tallyweave.plans.operations import OperationalResult, run_operations, snapshot_comparison
from tallyweave.plans.reports import write_reports

__all__ = [
    "EvaluationResult",
    "OperationalResult",
    "ReconciliationConfig",
    "evaluate_detections",
    "reconcile",
    "run_operations",
    "snapshot_comparison",
    "write_reports",
]

"""Command line, for spark-submit or ``python -m tallyweave``.

The master, memory and checkpoint folder come from the Spark configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tallyweave import ReconciliationConfig, evaluate_detections, reconcile, run_operations, write_reports
from tallyweave.config import DEFAULT_AMOUNT_TOLERANCE, DEFAULT_FEE_TOLERANCE, DEFAULT_MAX_SETTLEMENT_DAYS
from tallyweave.plans.reports import write_evaluation
from tallyweave.sources.csv_feeds import read_text_feeds, read_truth, read_typed_feeds


def operations(spark: SparkSession, args: argparse.Namespace) -> None:
    feeds = read_text_feeds(spark, args.input_dir)
    config = ReconciliationConfig(args.amount_tolerance, args.fee_tolerance, args.max_settlement_days)
    result = run_operations(**feeds, as_of=args.as_of, config=config)
    write_reports(result, args.output_dir, sources=feeds)
    result.tables["summary"].show(vertical=True, truncate=False)
    result.release()


def evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    detected = reconcile(**read_typed_feeds(spark, args.input_dir))
    result = evaluate_detections(read_truth(spark, args.input_dir), detected)
    write_evaluation(detected, result, args.output_dir)
    result.summary.show(vertical=True, truncate=False)


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyweave", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("operations", help="reconcile the three CSV feeds of a folder")
    run.add_argument("--as-of", required=True, help="inclusive cutoff; text without an offset means UTC")
    run.add_argument("--amount-tolerance", type=float, default=DEFAULT_AMOUNT_TOLERANCE)
    run.add_argument("--fee-tolerance", type=float, default=DEFAULT_FEE_TOLERANCE)
    run.add_argument("--max-settlement-days", type=float, default=DEFAULT_MAX_SETTLEMENT_DAYS)
    run.set_defaults(job=operations)
    score = commands.add_parser("evaluate", help="score the ten-rule detector against a folder's truth file")
    score.set_defaults(job=evaluate)
    for command in (run, score):
        command.add_argument("--input-dir", required=True)
        command.add_argument("--output-dir", required=True)
    return parser.parse_args(argv)


def main(argv=None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"tallyweave {args.command}").getOrCreate()
    args.job(spark, args)


if __name__ == "__main__":
    main()

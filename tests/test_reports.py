"""The complete run, its files, and CSV feeds."""

import csv
import glob
import json

import pytest

from payments import Payments, by_id
from tallyweave import run_operations, write_reports
from tallyweave.__main__ import main
from tallyweave.operators.audit import table_fingerprint
from tallyweave.operators.evaluation import evaluate_detections
from tallyweave.plans.operations import REPORTS, snapshot_comparison
from tallyweave.plans.reports import output_digests, report_sections, summary_json, write_evaluation
from tallyweave.sources.csv_feeds import read_text_feeds, read_truth, read_typed_feeds, write_feeds
from tallyweave.sources.order_feeds import faulty_ledger, order_feeds, read_orders, truth_labels
from tallyweave.sources.validation import validate

AS_OF = "2026-02-10"


def payments() -> Payments:
    p = Payments()
    for tx in ("001", "NA", "NULL"):
        p.add(tx)
    p.add("bad", ledger=[{"merchant_id": "<b>&'\"", "gross_amount": "12000.00"}], gateway=[], bank=[])
    p.add("quote", ledger=[{"merchant_id": 'a,"b"'}], bank=[])
    return p


@pytest.fixture(scope="module")
def result(spark):
    return run_operations(**payments().feeds(spark), as_of=AS_OF)


def read_report(folder, name):
    rows = []
    for part in sorted(glob.glob(f"{folder}/{name}.csv/part-*.csv")):
        with open(part, newline="", encoding="utf-8") as file:
            rows += list(csv.DictReader(file))
    return rows


def test_run_has_all_reports_and_metadata(result):
    assert tuple(result.tables) == REPORTS
    assert result.metadata["as_of_utc"] == "2026-02-10T00:00:00"
    assert result.metadata["source_counts"]["internal"] == {
        "input_rows": 5,
        "included_rows": 5,
        "future_rows_excluded": 0,
    }
    queue = sorted(result.tables["investigation_queue"].collect(), key=lambda r: r.priority_rank)
    assert [r.transaction_id for r in queue] == ["quote", "bad"]
    shares = [r.exposure_share for r in result.tables["merchant_metrics"].collect()]
    assert sum(shares) == pytest.approx(1)


def test_files_repeat_and_keep_keys(spark, result, tmp_path):
    first = write_reports(result, f"{tmp_path}/a", sources=payments().feeds(spark))
    again = run_operations(**payments().feeds(spark), as_of=AS_OF)
    second = write_reports(again, f"{tmp_path}/b", sources=payments().feeds(spark))
    assert first == second
    for name, table in result.tables.items():
        (row,) = table_fingerprint(table, name).collect()
        assert first["outputs"][name] == {"rows": row.rows, "content_hash": row.content_hash}
    assert set(first["sources"]) == {"internal", "gateway", "settlement"}
    for name in REPORTS:
        assert read_report(f"{tmp_path}/a", name) == read_report(f"{tmp_path}/b", name)
    facts = read_report(f"{tmp_path}/a", "reconciliation_facts")
    assert [r["transaction_id"] for r in facts] == ["001", "NA", "NULL", "bad", "quote"]
    assert facts[0]["internal_gross"] == "1000.000000"
    assert facts[0]["has_internal"] == "True"
    assert facts[0]["created_at"] == "2026-01-01T00:00:00"
    assert facts[3]["gateway_net"] == ""
    assert facts[4]["merchant_id"] == 'a,"b"'
    (document,) = glob.glob(f"{tmp_path}/a/summary.json/part-*")
    with open(document, encoding="utf-8") as file:
        found = json.load(file)
    assert list(found) == sorted(found)
    assert found["observed_transactions"] == 5
    digests = output_digests(spark, f"{tmp_path}/a").collect()
    assert len(digests) >= len(REPORTS) and all(len(d.sha256) == 64 for d in digests)


def test_sections(result):
    sections = report_sections(result)
    bars = by_id(sections["exposure_by_merchant"], "dimension_value")
    assert bars["<b>&'\""].label_html == "&lt;b&gt;&amp;&#x27;&quot;"
    assert bars["<b>&'\""].bar_percent == 100
    cards = by_id(sections["cards"], "card")
    assert cards["Current estimated exposure"].display == "₹12,976.40"
    assert cards["Internal payments"].display == "5"
    assert sections["exception_rate"].collect()[0].exception_rate == "40.00%"
    assert sections["queue_head"].count() == 2


def test_empty_run(spark, tmp_path):
    feeds = {name: df.limit(0) for name, df in payments().feeds(spark).items()}
    result = run_operations(**feeds, as_of=AS_OF)
    rows = {name: table.count() for name, table in result.tables.items()}
    assert rows.pop("summary") == 1
    assert set(rows.values()) == {0}
    assert report_sections(result)["exception_rate"].collect()[0].exception_rate == "undefined (no observations)"
    (document,) = summary_json(result.tables["summary"]).collect()
    assert json.loads(document.value)["exception_transaction_rate"] is None
    written = write_reports(result, f"{tmp_path}/empty")["outputs"]
    assert {name for name, found in written.items() if found["rows"]} == {"summary"}


def test_csv_feeds_ignore_a_broken_truth_file(spark, tmp_path):
    p = Payments()
    for tx in ("001", "NA", "NULL"):
        p.add(tx)
    write_feeds(p.feeds(spark), None, str(tmp_path))
    (tmp_path / "truth_exceptions.csv").write_bytes(b"\xff\xfe\x00")
    feeds = read_text_feeds(spark, str(tmp_path))
    validate(feeds)
    result = run_operations(**feeds, as_of=AS_OF)
    assert {r.transaction_id for r in result.tables["reconciliation_facts"].collect()} == {"001", "NA", "NULL"}


def test_typed_csv_and_evaluation_files(spark, tmp_path):
    orders = read_orders(spark, "/root/testdata/sf0.001").filter("o_orderkey < 200")
    write_feeds(order_feeds(orders), truth_labels(orders), f"{tmp_path}/data")
    typed = read_typed_feeds(spark, f"{tmp_path}/data")
    for name, df in order_feeds(orders).items():
        assert sorted(typed[name].collect()) == sorted(df.select(*typed[name].columns).collect())
    truth = read_truth(spark, f"{tmp_path}/data")
    detected = run_operations(**typed, as_of="2010-01-01").tables["detected_exceptions"]
    write_evaluation(detected, evaluate_detections(truth, detected), f"{tmp_path}/scores")
    rows = read_report(f"{tmp_path}/scores", "truth_vs_detection")
    assert {r["outcome"] for r in rows} >= {"tp"}


def test_command_line(spark, tmp_path, capsys):
    orders = read_orders(spark, "/root/testdata/sf0.001").filter("o_orderkey < 200")
    write_feeds(order_feeds(orders), truth_labels(orders), f"{tmp_path}/data")
    folders = ["--input-dir", f"{tmp_path}/data", "--output-dir"]
    main(["operations", "--as-of", "2010-01-01", *folders, f"{tmp_path}/run"])
    main(["evaluate", *folders, f"{tmp_path}/scores"])
    assert read_report(f"{tmp_path}/run", "summary")[0]["observed_transactions"] == "200"
    (document,) = glob.glob(f"{tmp_path}/scores/metrics.json/part-*")
    with open(document, encoding="utf-8") as file:
        assert json.load(file)["recall"] == 1
    with pytest.raises(SystemExit):
        main(["operations", *folders, f"{tmp_path}/none"])


def test_truth_columns_change_nothing(spark, result):
    feeds = {
        name: df.selectExpr("*", "'X' AS truth_exception_id", "999999 AS reference_amount")
        for name, df in payments().feeds(spark).items()
    }
    other = run_operations(**feeds, as_of=AS_OF)
    for name in ("reconciliation_facts", "summary"):
        assert sorted(other.tables[name].collect(), key=repr) == sorted(result.tables[name].collect(), key=repr)


def test_snapshots_equal_single_runs(spark):
    feeds = payments().add("late", bank=[{"settled_at": "2026-01-20T00:00:00"}]).feeds(spark)
    cutoffs = ("2020-01-01", "2026-01-10", "2026-02-10")
    rows = sorted(snapshot_comparison(spark, feeds, cutoffs).collect(), key=lambda r: r.as_of)
    assert len(rows) == 3
    for cutoff, row in zip(cutoffs, rows):
        (single,) = run_operations(**feeds, as_of=cutoff).tables["summary"].collect()
        assert tuple(row)[1:] == tuple(single)


def test_faulty_ledger_is_rejected(spark):
    orders = read_orders(spark, "/root/testdata/sf0.001")
    with pytest.raises(ValueError, match="internal.currency must be INR"):
        validate(order_feeds(orders) | {"internal": faulty_ledger(orders)})

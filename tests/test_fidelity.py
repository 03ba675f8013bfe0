"""Nothing is trimmed, dropped, moved or reread as something else without a word."""

import pytest
from pyspark.sql import functions as F

from payments import Payments
from tallyweave.functions.text import percentage, two_decimals
from tallyweave.functions.clock import as_utc
from tallyweave.operators.audit import table_fingerprint
from tallyweave.plans.operations import Reports, run_operations
from tallyweave.plans.reports import write_reports
from tallyweave.sources.contracts import LEGACY_CONTRACTS
from tallyweave.sources.csv_feeds import read_text, read_text_feeds, read_typed_feeds, write_feeds
from tallyweave.sources.validation import validate_legacy


def test_blanks_around_keys_survive_the_round_trip(spark, tmp_path):
    ids = ["A", " A", "A ", "  A  "]
    p = Payments()
    for tx in ids:
        p.add(tx)
    write_feeds(p.feeds(spark), None, str(tmp_path / "feeds"))
    for feed in read_text_feeds(spark, str(tmp_path / "feeds")).values():
        assert sorted(r.transaction_id for r in feed.collect()) == sorted(ids)
    for feed in read_typed_feeds(spark, str(tmp_path / "feeds")).values():
        assert feed.count() == len(ids)


def test_a_record_with_another_number_of_fields_ends_the_read(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("a,b\n1,2\n3,4,5\n")
    (tmp_path / "short.csv").write_text("a,b\n1,2\n3\n")
    for file in ("wide.csv", "short.csv"):
        with pytest.raises(Exception, match="FAILED_READ_FILE|PATH_ALREADY_EXISTS"):
            read_text(spark, str(tmp_path / file)).select("a").collect()


def test_part_files_with_another_column_order_end_the_read(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "part-0.csv").write_text("a,b\n1,2\n")
    (folder / "part-1.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_text(spark, str(folder)).collect()


def test_line_breaks_in_quotes_need_the_option(spark, tmp_path):
    (tmp_path / "broken.csv").write_text('a,b\n"1\n2",3\n')
    with pytest.raises(Exception, match="FAILED_READ_FILE|PATH_ALREADY_EXISTS"):
        read_text(spark, str(tmp_path / "broken.csv")).collect()
    assert [tuple(r) for r in read_text(spark, str(tmp_path / "broken.csv"), multiline=True).collect()] == [("1\n2", "3")]


def test_zones_that_cannot_be_read_make_a_time_invalid(spark):
    good = ["2026-01-02", "2026-01-02 06:30", "2026-01-02T06:30:00Z", "2026-01-02T06:30:00.5+05:30", "2026-01-02 06:30:00 UTC"]
    bad = [f"2026-01-02T06:30:00{z}" for z in ("+5:30", "UTC+05:30", "+05:30:00", " EST", " America/New_York", "x")] + ["12:30"]
    df = spark.createDataFrame([(t,) for t in good + bad], "t string")
    found = {r.t: r.at for r in df.select("t", F.expr(as_utc("t", df.schema["t"].dataType)).alias("at")).collect()}
    assert all(found[t] is not None for t in good)
    assert [t for t in bad if found[t] is not None] == []
    assert found[good[3]].hour == 1


def test_unreadable_money_and_times_fail_the_first_detector_s_checks(spark):
    feeds = Payments().add("001").feeds(spark)
    validate_legacy(feeds, LEGACY_CONTRACTS)
    for column, value in (("gateway_amount", "100.00 INR"), ("gateway_event_at", "yesterday")):
        broken = feeds | {"gateway": feeds["gateway"].withColumn(column, F.lit(value).cast("string"))}
        with pytest.raises(ValueError, match=f"gateway.{column}"):
            validate_legacy(broken, LEGACY_CONTRACTS)


def test_a_run_always_checks_its_feeds(spark):
    feeds = Payments().add("001").feeds(spark)
    broken = feeds | {"internal": feeds["internal"].withColumn("created_at", F.lit(None).cast("string"))}
    with pytest.raises(ValueError, match="created_at"):
        run_operations(**broken, as_of="2026-02-10")
    with pytest.raises(TypeError):
        run_operations(**feeds, as_of="2026-02-10", checked=False)


def test_a_value_that_moves_to_another_column_changes_the_fingerprint(spark):
    rows = [
        spark.sql("SELECT CAST(1.5 AS DECIMAL(18,2)) AS a, CAST(NULL AS DECIMAL(18,2)) AS b"),
        spark.sql("SELECT CAST(NULL AS DECIMAL(18,2)) AS a, CAST(1.5 AS DECIMAL(18,2)) AS b"),
    ]
    one, two = (table_fingerprint(df, "t").first() for df in rows)
    assert one["rows"] == two["rows"] == 1 and one["content_hash"] != two["content_hash"]


def test_reports_are_built_on_first_access_and_once():
    built = []
    reports = Reports({"a": lambda: built.append("a") or "A", "b": lambda: built.append("b") or "B"})
    assert list(reports) == ["a", "b"] and len(reports) == 2 and built == []
    assert reports["b"] == reports["b"] == "B" and built == ["b"]


def test_a_second_run_into_the_same_folder(spark, tmp_path):
    result = run_operations(**Payments().add("001").feeds(spark), as_of="2026-02-10")
    first = write_reports(result, str(tmp_path / "out"))
    with pytest.raises(Exception, match="FAILED_READ_FILE|PATH_ALREADY_EXISTS"):
        write_reports(result, str(tmp_path / "out"))
    assert write_reports(result, str(tmp_path / "out"), overwrite=True) == first


def test_two_decimals_are_exact_and_ties_go_to_the_even_digit(spark):
    day = 86_400_000_000
    shown = {
        (3 * day + 3 * 3_600_000_000, day): "3.12",  # 3.125 days
        (3 * day + 9 * 3_600_000_000, day): "3.38",  # 3.375 days
        (-3 * 3_600_000_000, day): "-0.12",
        (3 * day, day): "3.00",
        (3 * day + 3 * 3_600_000_000 + 1, day): "3.13",
    }
    for (part, whole), text in shown.items():
        assert spark.sql(f"SELECT {two_decimals(part, whole)}").first()[0] == text
    assert spark.sql(f"SELECT {percentage('1L', '800L')}").first()[0] == "0.12%"
    assert spark.sql(f"SELECT {percentage('0L', '0L')}").first()[0] is None

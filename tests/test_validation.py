"""Contracts: what is rejected, what is kept as it is."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from payments import Payments, by_id
from tallyweave.config import ReconciliationConfig, parse_cutoff
from tallyweave.operators.audit import source_counts
from tallyweave.plans.operations import cut_feeds, run_operations, typed_feeds
from tallyweave.sources.validation import validate, validation_report


@pytest.fixture
def feeds(spark):
    return Payments().add("001").feeds(spark)


def test_clean_feeds_pass(feeds):
    validate(feeds)


FAULTS = {
    "null key": ("gateway", "transaction_id", None, "gateway.transaction_id contains missing or blank"),
    "blank status": ("internal", "internal_status", " \t", "internal.internal_status contains missing or blank"),
    "no-break space": ("internal", "merchant_id", " ", "internal.merchant_id contains missing or blank"),
    "currency": ("internal", "currency", "USD", "must be INR"),
    "missing money": ("gateway", "gateway_net", None, "not finite"),
    "not a number": ("gateway", "gateway_net", "nan", "not finite"),
    "infinite": ("gateway", "gateway_net", "1e999", "not finite"),
    "suffix": ("gateway", "gateway_net", "1d", "not finite"),
    "negative": ("gateway", "gateway_net", "-1", "negative"),
    "fraction of a paisa": ("gateway", "gateway_net", "1.001", "two decimal places"),
    "too large": ("settlement", "net_amount", "10000000000000", "10^13"),
    "no date": ("settlement", "settled_at", "not-a-date", "invalid timestamps"),
    "time only": ("settlement", "settled_at", "12:30", "invalid timestamps"),
    "year only": ("settlement", "settled_at", "2026", "invalid timestamps"),
}


def test_all_faults_are_found(spark, feeds):
    """Every fault in a feed set of its own; one job reports them together."""
    reports = []
    for label, (feed, column, value, _) in FAULTS.items():
        broken = dict(feeds)
        broken[feed] = feeds[feed].withColumn(column, F.lit(value).cast("string"))
        reports.append(validation_report(broken).filter("violations > 0").selectExpr(f"'{label}' AS label", "*"))
    found = reports[0]
    for report in reports[1:]:
        found = found.unionByName(report)
    rows = by_id(found, "label", "column_name")
    for label, (_, column, _, _) in FAULTS.items():
        assert rows[label, column].violations == 1, label
    assert len(rows) == len(FAULTS)


@pytest.mark.parametrize("label", ["null key", "no date"])
def test_fault_raises(feeds, label):
    feed, column, value, message = FAULTS[label]
    broken = feeds | {feed: feeds[feed].withColumn(column, F.lit(value).cast("string"))}
    with pytest.raises(ValueError, match=message.replace("^", r"\^")):
        run_operations(**broken, as_of="2026-02-10")


def test_repeated_ledger_key_raises(feeds):
    with pytest.raises(ValueError, match="must be unique"):
        validate(feeds | {"internal": feeds["internal"].union(feeds["internal"])})


def test_missing_column_is_named(feeds):
    with pytest.raises(ValueError, match=r"internal missing columns: \['merchant_id'\]"):
        validate(feeds | {"internal": feeds["internal"].drop("merchant_id")})


def test_rows_after_the_cutoff_are_validated_too(spark):
    feeds = Payments().add("001", ledger=[{"created_at": "2030-01-01", "currency": "USD"}]).feeds(spark)
    with pytest.raises(ValueError, match="must be INR"):
        run_operations(**feeds, as_of="2026-02-10")


@pytest.mark.parametrize("field", ["amount_tolerance", "fee_tolerance", "max_settlement_days"])
@pytest.mark.parametrize("value", [-1, float("nan"), float("inf")])
def test_bad_configuration(field, value):
    with pytest.raises(ValueError, match=field):
        ReconciliationConfig(**{field: value})


def test_cutoff_parsing():
    midnight = datetime(2026, 2, 10)
    for value in ("2026-02-10", "2026-02-10T00:00:00Z", "2026-02-10T05:30:00+05:30", date(2026, 2, 10), midnight):
        assert parse_cutoff(value) == midnight
    for value in (None, "soon", 5):
        with pytest.raises(ValueError):
            parse_cutoff(value)


def test_keys_are_kept_as_written_and_labels_dropped(spark):
    p = Payments()
    for tx in ("001", "NA", "NULL", " padded "):
        p.add(tx)
    feeds = {name: df.withColumn("exception_type", F.lit("leak")) for name, df in p.feeds(spark).items()}
    for df in typed_feeds(feeds).values():
        assert "exception_type" not in df.columns
        assert {r.transaction_id for r in df.collect()} == {"001", "NA", "NULL", " padded "}


def test_event_times_do_not_depend_on_the_session_zone(spark):
    texts = {
        "z": "2026-01-02T01:00:00Z",
        "offset": "2026-01-02T06:30:00+05:30",
        "naive": "2026-01-02 01:00:00",
        "compact": "2026-01-02T06:30:00+0530",
    }
    p = Payments()
    for tx, at in texts.items():
        p.add(tx, bank=[{"settled_at": at}])
    feeds = p.feeds(spark)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            times = {r.settled_at for r in typed_feeds(feeds)["settlement"].collect()}
            assert times == {datetime(2026, 1, 2, 1)}
            instants = feeds | {
                "settlement": feeds["settlement"].withColumn(
                    "settled_at", F.expr("timestamp_micros(unix_micros(TIMESTAMP'2026-01-02 01:00:00 UTC'))")
                )
            }
            assert {r.settled_at for r in typed_feeds(instants)["settlement"].collect()} == times
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_source_counts(spark):
    feeds = Payments().add("001").add("002", bank=[{"settled_at": "2027-01-01"}]).feeds(spark)
    counts = by_id(source_counts(feeds, "2026-02-10"), "feed")
    assert tuple(counts["settlement"])[1:] == (2, 1, 1)
    assert tuple(counts["internal"])[1:] == (2, 2, 0)
    assert cut_feeds(typed_feeds(feeds), "2026-02-10")["settlement"].count() == 1

"""CSV scans and the CSV writer for feed sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyweave.sources.contracts import CONTRACTS, typed
from tallyweave.sources.validation import validate

# File name of each feed. Nothing else in the folder is opened.
FEED_FILES = {
    "internal": "internal_payments.csv",
    "gateway": "gateway_transactions.csv",
    "settlement": "bank_settlements.csv",
}
TRUTH_FILE = "truth_exceptions.csv"

# Quotes inside a field are doubled, an empty field stays empty, and blanks around a field
# belong to it.
CSV_DIALECT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# A record with more or fewer fields than the header, or a part file with another header, ends the
# read with an error, also when only some columns are asked for.
STRICT = {"mode": "FAILFAST", "enforceSchema": "false", "columnPruning": "false"}


def read_text_feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All columns as text: ids such as 001, NA and NULL keep their spelling."""
    return {name: read_text(spark, f"{folder}/{file}") for name, file in FEED_FILES.items()}


def read_text(spark: SparkSession, path: str, *, multiline: bool = False) -> DataFrame:
    """Every field as text, none dropped or moved. With multiline, quoted fields may hold line breaks."""
    lines = {"multiLine": "true"} if multiline else {}
    header = spark.read.options(**CSV_DIALECT, **lines, inferSchema="false").csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return spark.read.options(**CSV_DIALECT, **STRICT, **lines).schema(schema).csv(path)


def read_typed_feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Feeds typed by their contracts; raises ValueError if a value cannot be read as its type."""
    feeds = read_text_feeds(spark, folder)
    validate(feeds)
    return {contract.name: typed(feeds[contract.name], contract) for contract in CONTRACTS}


def read_truth(spark: SparkSession, folder: str) -> DataFrame:
    truth = read_text(spark, f"{folder}/{TRUTH_FILE}")
    return truth.withColumn("reference_amount", truth["reference_amount"].cast("decimal(18,2)"))


def write_feeds(feeds: dict[str, DataFrame], truth: DataFrame | None, folder: str) -> dict[str, str]:
    """Write a feed set, and its truth if there is one, one CSV folder each."""
    frames = {FEED_FILES[name]: frame for name, frame in feeds.items()}
    if truth is not None:
        frames[TRUTH_FILE] = truth
    for file, frame in frames.items():
        frame.write.options(**CSV_DIALECT, timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(f"{folder}/{file}")
    return {file: f"{folder}/{file}" for file in frames}

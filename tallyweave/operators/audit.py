"""Row-count audit and fingerprints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from tallyweave.config import cutoff_literal
from tallyweave.functions import aggregates, named, text_literal
from tallyweave.functions.clock import as_utc
from tallyweave.sources.contracts import CONTRACTS


def source_counts(feeds: dict[str, DataFrame], as_of) -> DataFrame:
    """Input, included and future rows per feed; reads one column of each feed."""
    cutoff = cutoff_literal(as_of)
    parts = []
    for contract in CONTRACTS:
        feed = feeds[contract.name]
        event_at = as_utc(contract.time, feed.schema[contract.time].dataType)
        parts.append(
            feed.selectExpr(
                f"'{contract.name}' AS feed",
                "count(*) AS input_rows",
                f"count_if({event_at} <= {cutoff}) AS included_rows",
                f"count_if({event_at} > {cutoff}) AS future_rows_excluded",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _canonical(field: T.StructField) -> str:
    """A value as text that any engine can repeat; null differs from every text.

    It has few calls, because all columns of a row are compiled as one method, and the JVM only interprets one above 8000 bytes.
    """
    forms = {
        T.DoubleType: "CAST(CAST({c} AS DECIMAL(38,6)) AS STRING)",
        T.TimestampNTZType: "date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
    }
    text = forms.get(type(field.dataType), "CAST({c} AS STRING)").format(c=f"`{field.name}`")
    return f"coalesce(concat({text_literal(field.name + '=v')}, {text}), {text_literal(field.name + '=null')})"


def row_hash(table: DataFrame) -> str:
    """The first 60 bits of the MD5 of a row's values with their column names, so a value that moves to another column changes it."""
    row = f"concat_ws('|', {', '.join(_canonical(f) for f in sorted(table.schema, key=lambda f: f.name))})"
    return f"CAST(conv(left(md5({row}), 15), 16, 10) AS DECIMAL(38,0))"


def content_hash(hashes: str) -> str:
    """Row hashes are summed as decimals."""
    return f"CAST(coalesce(sum({hashes}), 0) AS STRING)"


def fingerprint_aggregates(table: DataFrame) -> dict[str, str]:
    """Row count and a content hash that depends on names and values, not on row order."""
    return {"rows": "count(*)", "content_hash": content_hash(row_hash(table))}


def table_fingerprint(table: DataFrame, name: str) -> DataFrame:
    return table.selectExpr(f"'{name}' AS table_name", *named(fingerprint_aggregates(table)))


def watched(table: DataFrame) -> tuple[DataFrame, Observation]:
    """The table and its fingerprint, which fills when the table is next written.

    The fingerprint rides on that job, so a large report is not computed twice.
    """
    observation = Observation()
    return table.observe(observation, *aggregates(fingerprint_aggregates(table))), observation


def fingerprints(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_fingerprint(table, name) for name, table in tables.items()])


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """SHA-256 per file below a folder, for report files of bounded size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.selectExpr(
        "substring_index(path, '/', -1) AS file", "path", "length", "sha2(content, 256) AS sha256"
    )

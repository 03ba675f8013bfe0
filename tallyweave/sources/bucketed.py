"""Feeds stored once, bucketed and sorted by transaction id, so that matching them needs no exchange.

Every join and grouping of the feeds is by transaction id. A bucketed table is dealt to buckets by the
hash of the id when it is written; from then on each of these operators reads bucket k of one feed beside
bucket k of another.

The bucket count is part of the layout, and only tables of one count (or of counts that divide each
other) are joined without an exchange. `bucket_count` takes the next power of two that keeps a bucket of the
largest feed near TARGET_BYTES, so that a count doubles only when a feed has doubled; then all feeds are written
again, together, under new names, and the old tables are dropped. Never append to a bucketed feed: each append
adds one file to every bucket.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TARGET_BYTES = 128 * 1024 * 1024
KEY = "transaction_id"


def bucket_count(largest_bytes: int, target: int = TARGET_BYTES) -> int:
    """The least power of two of buckets of at most target bytes."""
    count = 1
    while count * target < largest_bytes:
        count *= 2
    return count


@dataclass(frozen=True)
class BucketedFeeds:
    """Tables of one layout. They stay until `drop` is called."""

    spark: SparkSession
    tables: dict[str, str]
    buckets: int

    def feeds(self) -> dict[str, DataFrame]:
        """The stored feeds; joins between them merge sorted buckets instead of broadcasting."""
        return {name: self.spark.table(table).hint("merge") for name, table in self.tables.items()}

    def drop(self) -> None:
        for table in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def write_bucketed(feeds: dict[str, DataFrame], buckets: int, key: str = KEY) -> BucketedFeeds:
    """Store typed feeds as managed tables of the warehouse. Each is shuffled once, here."""
    spark = next(iter(feeds.values())).sparkSession
    run = uuid.uuid4().hex
    tables = {name: f"tallyweave_{name}_{run}" for name in feeds}
    for name, feed in feeds.items():
        # One task a bucket, so that a bucket is one file.
        feed.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).saveAsTable(tables[name])
    return BucketedFeeds(spark, tables, buckets)

"""A folder that a run owns while it writes: commit records, resuming, publishing, clean-up.

A report is committed by a record (its row count and content hash) that is written after its files. A
run that was ended goes on behind its last record, and a record counts only for the same run: its key covers the
parameters and the fingerprints of the inputs, so other inputs start afresh. The manifest is written
last and publishes the folder; then the records and everything else that only the run needed are deleted.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORK = "_run"
RECORD = "report string, run string, rows long, content_hash string"


def run_key(parameters: dict) -> str:
    """What a run is known by: the same parameters and inputs give the same key."""
    return hashlib.sha256(json.dumps(parameters, sort_keys=True, default=str).encode()).hexdigest()


class Files:
    """Existence and removal of paths in whatever store a path names."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        location = self._jvm.org.apache.hadoop.fs.Path(path)
        return location.getFileSystem(self._conf), location

    def exists(self, path: str) -> bool:
        store, location = self._at(path)
        return store.exists(location)

    def delete(self, path: str) -> None:
        store, location = self._at(path)
        store.delete(location, True)


@dataclass
class RunStore:
    spark: SparkSession
    folder: str
    key: str
    #: Paths outside the folder that only this run needs, such as stored relations.
    owned: list[str] = field(default_factory=list)

    @property
    def records(self) -> str:
        return f"{self.folder}/{WORK}/records"

    def published(self) -> bool:
        return Files(self.spark).exists(f"{self.folder}/manifest.json")

    def committed(self) -> dict[str, dict]:
        """The records of this run, by report; those of a run with another key are dropped."""
        files = Files(self.spark)
        if not files.exists(self.records):
            return {}
        rows = self.spark.read.schema(RECORD).json(self.records).collect()
        own = {r["report"]: {"rows": r["rows"], "content_hash": r["content_hash"]} for r in rows if r["run"] == self.key}
        if not own:
            files.delete(f"{self.folder}/{WORK}")
        return own

    def commit(self, report: str, found: dict) -> None:
        """Record a report whose files are complete. One small file; records are added, never changed."""
        values = [F.lit(report).alias("report"), F.lit(self.key).alias("run"), F.lit(found["rows"]).alias("rows"), F.lit(found["content_hash"]).alias("content_hash")]
        self.spark.range(1).select(*values).coalesce(1).write.mode("append").json(self.records)

    def write(self, report: str, table: DataFrame, write: Callable[[DataFrame, str], dict], done: dict[str, dict]) -> dict:
        """Write a report unless it is committed; what its manifest entry says."""
        if report not in done:
            found = write(table, f"{self.folder}/{report}.csv")
            self.commit(report, found)
            return found
        return done[report]

    def publish(self, manifest: DataFrame) -> None:
        """Write the manifest, which makes the folder complete, and remove what only the run needed."""
        manifest.write.mode("overwrite").text(f"{self.folder}/manifest.json")
        files = Files(self.spark)
        for path in (f"{self.folder}/{WORK}", *self.owned):
            files.delete(path)

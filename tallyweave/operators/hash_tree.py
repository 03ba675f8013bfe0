"""Fingerprints per key range with a tree over them: where two versions of a table differ.

The borders of the ranges come from the keys with the least MD5 of one version, so they repeat for the same
rows in any order and partitioning. A tree has FAN inner nodes and FAN * FAN leaves however large the
table is; it takes one pass with partial aggregation, may be kept beside a report, and is
compared without its table. Rows without a key are in the first range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import aggregates, text_literal
from tallyweave.operators.audit import content_hash, row_hash

FAN = 16
RANGES = FAN * FAN
#: Keys that the borders are drawn from: all that is collected, whatever the size of the table.
DRAWN = 16 * RANGES


def range_borders(table: DataFrame, key: str) -> list[str]:
    """Up to RANGES - 1 keys, in order, that cut the table into ranges of about equal size. The key is text, unique in the table."""
    drawn = table.where(f"{key} IS NOT NULL").select(key).orderBy(F.md5(key), key).limit(DRAWN)
    keys = sorted(row[0] for row in drawn.collect())
    return sorted({keys[k * len(keys) // RANGES] for k in range(1, RANGES)}) if keys else []


def range_number(key: str, borders: list[str]) -> str:
    """How many borders are at or before the key, found among every FAN-th border first."""
    def listed(texts: list[str]) -> str:
        return f"array({', '.join(map(text_literal, texts))})"

    if not borders:
        return "0"
    # Border number FAN * (j + 1) - 1, from 0, opens the range FAN * (j + 1).
    coarse = borders[FAN - 1 :: FAN]
    above = f"{FAN} * size(filter({listed(coarse)}, b -> b <= {key}))" if coarse else "0"
    return f"coalesce({above} + size(filter(slice({listed(borders)}, {above} + 1, {FAN - 1}), b -> b <= {key})), 0)"


def hash_tree(table: DataFrame, key: str, borders: list[str]) -> DataFrame:
    """(level, node, rows, content_hash): the root is level 0, a node of level 1 holds FAN ranges, level 2 are the ranges."""
    # A row's hash is taken beside its range: Spark compiles a projection that has lambdas in small methods, however wide the table is.
    hashed = table.selectExpr(f"{range_number(key, borders)} AS _range", f"{row_hash(table)} AS _hash")
    leaves = hashed.groupBy("_range").agg(*aggregates({"rows": "count(*)", "content_hash": content_hash("_hash")}))
    nodes = ", ".join(f"named_struct('level', {level}, 'node', CAST(_range DIV {FAN ** (2 - level)} AS INT))" for level in range(3))
    each = leaves.selectExpr("rows", "CAST(content_hash AS DECIMAL(38,0)) AS content", f"inline(array({nodes}))")
    return each.groupBy("level", "node").agg(F.expr("sum(rows) AS rows"), F.expr("CAST(sum(content) AS STRING) AS content_hash"))


def tree_difference(before: DataFrame, after: DataFrame, borders: list[str], level: int = 2) -> DataFrame:
    """The nodes of a level that differ: (node, from_key, until_key, rows_before, rows_after); a null key is an open end."""
    sides = [tree.where(f"level = {level}").selectExpr("node", f"rows AS rows_{name}", f"content_hash AS hash_{name}") for tree, name in ((before, "before"), (after, "after"))]
    found = sides[0].join(sides[1], "node", "full").where("NOT hash_before <=> hash_after")
    ends = f"CAST(array({', '.join(map(text_literal, borders))}) AS ARRAY<STRING>)"
    width = FAN ** (2 - level)
    return found.selectExpr(
        "CAST(node AS BIGINT) AS node",
        f"get({ends}, CAST(node * {width} - 1 AS INT)) AS from_key",
        f"get({ends}, CAST((node + 1) * {width} - 1 AS INT)) AS until_key",
        "coalesce(rows_before, 0L) AS rows_before",
        "coalesce(rows_after, 0L) AS rows_after",
    )

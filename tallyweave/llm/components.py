"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.storage import stored, written


#: Edges of a part, 16 bytes each.
PART_ROWS = 100_000


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(high, low))").alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    both = edges.selectExpr("high AS node", "low AS other").union(edges.selectExpr("low AS node", "high AS other")).coalesce(parts)
    least = stored(both.groupBy("node").agg(F.min("other").alias("m")).selectExpr("node", "least(node, m) AS low").coalesce(parts))
    moved = both.where("other > node").join(least, "node").selectExpr("other AS high", "low").where("high <> low")
    return moved.coalesce(parts).distinct().coalesce(parts)


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    least = stored(edges.groupBy("high").agg(F.min("low").alias("m")).coalesce(parts))
    moved = edges.join(least, "high").where("low <> m").selectExpr("low AS high", "m AS low")
    return moved.union(least.selectExpr("high", "m AS low")).coalesce(parts).distinct().coalesce(parts)


def components(edges: DataFrame, first: str, second: str, part_rows: int = PART_ROWS) -> DataFrame:
    """(node, component) for every node that has an edge; the component is its smallest node.

    Null ends and loops are ignored; repeated edges count once. The number of rounds grows with
    the logarithm of the longest path, not with the size of a component, and no round gathers a
    component or the edges of a node in one place. Minima are pre-aggregated and stored, so the
    joins with them can be split where a node has very many edges. A round is a handful of shuffles
    and tables, each of about one part for part_rows edges: with the session's number of partitions the files
    of a short edge list, three a map task and two a stored part, outweigh its rows.
    """
    high, low = F.greatest(first, second).alias("high"), F.least(first, second).alias("low")
    current = written(edges.where(F.col(first) != F.col(second)).select(high, low).distinct())
    mark, parts = _mark(current), 1
    while mark[0]:
        parts = 1 + mark[0] // part_rows
        current = written(_small_star(stored(_large_star(current, parts)), parts))
        before, mark = mark, _mark(current)
        if before == mark:
            break
    stars = current.selectExpr("high AS node", "low AS component")
    return stars.union(stars.select(F.col("component").alias("node"), "component").coalesce(parts).distinct()).coalesce(parts)

"""Approximate nearest neighbours with a hash-prefix forest.

A vector's hash string in a tree is LENGTH bits: on which side of as many random planes it lies. A tree
is the sorted array of the strings of its vectors, so vectors with a common prefix stand together.
A query descends each tree to its longest matching prefix by binary search. Then all trees ascend
together, one bit at a time, until the ranges under the query's prefixes hold enough candidates,
and enough different ones besides the query's own rows; distances to these are computed exactly, in double precision.

The forest is kept in parts of PART vectors each, dealt by hash, and every block of queries asks
every part: parts and query blocks have a fixed size, so a task's memory does not grow with the
table. A part answers with its nearest few for each query, and those are merged.

Vectors that are null, zero or hold null or non-finite components, and vectors of another length
than the query, take no part. Ties go to the smaller vec_id; a row that repeats the query's
vec_id is the query's own. With fewer candidates than wanted, all are returned.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.vector_blocks import matrix, valid

TREES = 32
LENGTH = 32
PART = 2048
QUERIES = 512
#: Share of a part's vectors that the ranges of all trees must hold together; vectors may be in several ranges.
ENOUGH = 1.5


def planes(dim: int) -> np.ndarray:
    return np.random.default_rng(10).standard_normal((dim, TREES * LENGTH))


def hash_strings(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """One row a tree: the strings of all points as numbers, the first bit highest."""
    bits = (points - centre) @ planes(points.shape[1]) > 0
    bits = bits.reshape(len(points), TREES, LENGTH).astype(np.uint64)
    return (bits << np.arange(LENGTH - 1, -1, -1, dtype=np.uint64)).sum(2, dtype=np.uint64).T


class Forest:
    """Sorted arrays of hash strings of some vectors."""

    def __init__(self, points: np.ndarray, centre: np.ndarray):
        self.n, self.centre = len(points), centre
        strings = hash_strings(points, centre)
        self.order = strings.argsort(axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, 1)

    def ranges(self, strings: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """By tree and query the range of the vectors that share the query's first length bits."""
        free = np.uint64((1 << LENGTH - length) - 1)
        low = np.stack([np.searchsorted(s, q & ~free, "left") for s, q in zip(self.sorted, strings)])
        high = np.stack([np.searchsorted(s, q | free, "right") for s, q in zip(self.sorted, strings)])
        return low, high

    def candidates(self, queries: np.ndarray, enough: int, others: np.ndarray, least: int) -> list[np.ndarray]:
        """Places of the candidates of each query: at least least of its row of others, or all of them."""
        strings = hash_strings(queries, self.centre)
        found: list[np.ndarray] = [np.zeros(0, int)] * len(queries)
        climbing = np.arange(len(queries))
        for length in range(LENGTH, -1, -1):  # from the longest match upwards, all trees at once
            low, high = self.ranges(strings[:, climbing], length)
            done = (high - low).sum(0) >= enough if length else np.ones(len(climbing), bool)
            for k in np.flatnonzero(done):
                if not length:
                    found[climbing[k]] = np.flatnonzero(others[climbing[k]])
                    continue
                inside = np.zeros(self.n, bool)
                for tree in range(TREES):
                    inside[self.order[tree, low[tree, k] : high[tree, k]]] = True
                inside &= others[climbing[k]]
                found[climbing[k]] = np.flatnonzero(inside)
                done[k] = inside.sum() >= min(least, others[climbing[k]].sum())
            climbing = climbing[~done]
            if not len(climbing):
                break
        return found


def _answered(nearest: int, share: float) -> Callable:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows["asks"].to_numpy()
        out = []
        points, queries = rows[~asks], rows[asks]
        if len(points) and len(queries):
            x, ids = matrix(points["embedding"]), points["vec_id"].to_numpy()
            y, asked = matrix(queries["embedding"]), queries["vec_id"].to_numpy()
            forest = Forest(x, x.mean(0))
            enough = min(TREES * len(x), max(int(share * len(x)), 4 * nearest))
            others = ids[None] != asked[:, None]
            for query, vector, places in zip(asked, y, forest.candidates(y, enough, others, 4 * nearest)):
                distance = np.sqrt(((x[places] - vector) ** 2).sum(1))
                best = np.lexsort((ids[places], distance))[:nearest]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[places[best]], "score": distance[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return run


def nearest(rows: DataFrame, queries: str, count: int = 10, share: float = ENOUGH) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of (vec_id, embedding) that the SQL condition queries picks."""
    able = valid(rows.select("vec_id", "embedding"), "embedding").withColumn("dim", F.expr("size(embedding)"))
    asking = able.where(queries)
    sizes = able.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(F.expr(queries)).alias("q")).collect()
    out = None
    for size in sizes:  # one round for each vector length
        parts, blocks = -(-size["n"] // PART), -(-size["q"] // QUERIES)
        if not blocks:
            continue
        each = f"explode(sequence(0, {{}})) AS {{}}"
        part, block = (f"CAST(pmod(xxhash64(vec_id, embedding), {n}) AS INT) AS {c}" for n, c in ((parts, "part"), (blocks, "block")))
        points = able.where(f"dim = {size['dim']}").selectExpr("vec_id", "embedding", "false AS asks", part, each.format(blocks - 1, "block"))
        asks = asking.where(f"dim = {size['dim']}").selectExpr("vec_id", "embedding", "true AS asks", block, each.format(parts - 1, "part"))
        met = points.unionByName(asks).groupBy("part", "block")
        found = met.applyInPandas(_answered(count, share), "query_id long, vec_id long, score double")
        out = found if out is None else out.union(found)
    if out is None:
        out = able.where("false").selectExpr("vec_id AS query_id", "vec_id", "0D AS score")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = out.withColumn("rank", F.row_number().over(order)).where(f"rank <= {int(count)}")
    return ranked.select("query_id", "rank", "vec_id", "score")

"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length 1 and split in halves; each half has a codebook of its own, and a
pair of code words is a cell of the product grid. A vector lives in the cell of its nearest words,
and visits the cells in which its near-duplicates may live. How far a vector is from a word's region
is bounded from below by the planes between code words; cells are visited in the order of that
bound, by multi-sequence traversal of the two sorted halves, until the target recall. The bound at
which the traversal stops is calibrated: sample vectors are moved to the threshold's cosine
along differences between vectors of the sample, and it is where RECALL of them are found.
Cosines are then verified on the original vectors in double precision.

Equal vectors of a label are one class with a count. A cell's residents and visitors meet in
blocks of at most about BLOCK rows each, so a hot cell is many small products; a block
returns a count of links and a component label for each of its vectors, never pairs.

Codebooks are fitted on a bounded sample of CODEBOOK_ROWS vectors; every vector is indexed.
Vectors that are null, zero or hold null or non-finite components, and those without label, link
with nothing; so do vectors of different lengths. Rows that repeat a vec_id are vectors of
their own; empty tables give empty results.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.components import components
from tallyweave.llm.storage import stored
from tallyweave.llm.vector_blocks import VALID, matrix, valid

WORDS = 8
CODEBOOK_ROWS = 4096
BLOCK = 1024
#: Share of vectors moved to the very threshold whose cell the traversal must reach.
RECALL = 0.9995


def codebook(points: np.ndarray, words: int, rounds: int = 15, seed: int = 6) -> np.ndarray:
    """Code words by k-means; with fewer distinct points than words, those points."""
    points = np.unique(points, axis=0)
    if len(points) <= words:
        return points
    centres = points[np.random.default_rng(seed).choice(len(points), words, replace=False)]
    for _ in range(rounds):
        near = ((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)).argmin(1)
        centres = np.array([points[near == k].mean(0) if (near == k).any() else centres[k] for k in range(words)])
    return np.unique(centres, axis=0)


class Grid:
    """Two codebooks and the bound at which the traversal of their product stops."""

    def __init__(self, points: np.ndarray, words: int, threshold: float):
        points = points / np.linalg.norm(points, axis=1, keepdims=True)
        self.half = points.shape[1] // 2
        self.books = codebook(points[:, : self.half], words), codebook(points[:, self.half :], words, seed=7)
        self.reach = np.inf
        draw = np.random.default_rng(8)
        at, one, two = (draw.integers(0, len(points), 2 * CODEBOOK_ROWS) for _ in range(3))
        way = points[one] - points[two]
        way -= (way * points[at]).sum(1, keepdims=True) * points[at]
        length = np.linalg.norm(way, axis=1)
        at, way, length = at[length > 1e-6], way[length > 1e-6], length[length > 1e-6]
        if len(at) >= CODEBOOK_ROWS // 4:
            moved = threshold * points[at] + np.sqrt(1 - threshold**2) * way / length[:, None]
            bounds = []
            for start in range(0, len(at), 512):
                a, b = self.bounds(points[at[start : start + 512]])
                i, j = self.homes(moved[start : start + 512])
                rows = np.arange(len(i))
                bounds.append(a[rows, i] + b[rows, j])
            self.reach = float(np.quantile(np.concatenate(bounds), RECALL))

    def bounds(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return region_bounds(points[:, : self.half], self.books[0]), region_bounds(points[:, self.half :], self.books[1])

    def homes(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        halves = points[:, : self.half], points[:, self.half :]
        return tuple(((x[:, None, :] - w[None]) ** 2).sum(2).argmin(1) for x, w in zip(halves, self.books))


def grids(rows: DataFrame, words: int, threshold: float, sample_rows: int) -> dict[int, Grid]:
    """A grid for each vector length, from about sample_rows vectors of that length drawn by hash."""
    sizes = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    found = {}
    for dim, n in sizes.items():
        chance = max(1, int(min(1.0, sample_rows / n) * 1000003))
        drawn = rows.where(f"dim = {dim} AND pmod(xxhash64(embedding), 1000003) < {chance}").select("embedding").toPandas()
        found[dim] = Grid(matrix(drawn["embedding"]) if len(drawn) else np.ones((1, dim)), words, threshold)
    return found


def region_bounds(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each point and word a lower bound of the squared distance from the point to the word's region."""
    to = ((points[:, None, :] - words[None]) ** 2).sum(2)
    apart = np.sqrt(((words[:, None, :] - words[None]) ** 2).sum(2))
    np.fill_diagonal(apart, 1)
    beyond = ((to[:, :, None] - to[:, None, :]) / (2 * apart)).max(2)
    return np.maximum(beyond, 0) ** 2


def visited(first: np.ndarray, second: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Cells in the order of the sum of their halves' bounds, up to reach."""
    one, two = first.argsort(kind="stable"), second.argsort(kind="stable")
    a, b = first[one].tolist(), second[two].tolist()
    heap, out = [(a[0] + b[0], 0, 0)], []
    while heap:
        bound, i, j = heapq.heappop(heap)
        if bound > reach:
            break
        out.append((int(one[i]), int(two[j])))
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return out


def _celled(shared) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every = shared.value
        for frame in frames:
            home, visits = np.zeros(len(frame), np.int64), [[] for _ in range(len(frame))]
            for dim, at in frame.groupby("dim").indices.items():
                for part in np.array_split(at, -(-len(at) // 512)):
                    points = matrix(frame["embedding"].iloc[part])
                    points /= np.linalg.norm(points, axis=1, keepdims=True)
                    grid, width = every[dim], len(every[dim].books[1])
                    for row, i, j, first, second in zip(part, *grid.homes(points), *grid.bounds(points)):
                        home[row] = own = i * width + j
                        cells = {own, *(i * width + j for i, j in visited(first, second, grid.reach))}
                        visits[row] = sorted(c for c in cells if c >= own)
            yield frame.assign(home=home, visits=visits)[["cid", "copies", "label", "dim", "embedding", "home", "visits"]]

    return run


def local_components(linked: np.ndarray) -> np.ndarray:
    """Smallest reachable place for each row of a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None], len(linked)).min(1, initial=len(linked))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _linked(threshold: float) -> Callable:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        at_home = rows["resident"].to_numpy()
        if at_home.all() or not at_home.any():
            return pd.DataFrame({"cid": [], "links": [], "mark": []}).astype("int64")
        here, there = rows[at_home], rows[~at_home]
        x, y = matrix(there["embedding"]), matrix(here["embedding"])
        cosine = (x @ y.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(y, axis=1)[None]
        a, b = there["cid"].to_numpy(), here["cid"].to_numpy()
        hit = (cosine >= threshold) & (a[:, None] != b[None])
        # Residents visit their own cell as well and meet each other there from both sides.
        stranger = there["home"].to_numpy() != key[2]
        ids, n_a = np.concatenate((a, b)), len(a)
        links = np.concatenate((hit @ here["copies"].to_numpy(), (hit & stranger[:, None]).T @ there["copies"].to_numpy()))
        full = np.zeros((len(ids), len(ids)), bool)
        full[:n_a, n_a:], full[n_a:, :n_a] = hit, hit.T
        full |= ids[:, None] == ids[None]
        busy = np.flatnonzero(full.sum(1) > 1)
        label = local_components(full[np.ix_(busy, busy)])
        return pd.DataFrame({"cid": ids[busy], "links": links[busy], "mark": ids[busy][label]})

    return run


def near_duplicates(rows: DataFrame, threshold: float = 0.93, words: int = WORDS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label)."""
    every = rows.select("vec_id", "embedding", "label")
    able = valid(every.where("label IS NOT NULL"), "embedding").withColumn("dim", F.expr("size(embedding)"))
    groups = able.groupBy("label", "dim", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = stored(stored(groups).withColumn("cid", F.monotonically_increasing_id()))
    shared = rows.sparkSession.sparkContext.broadcast(grids(classes, words, threshold, CODEBOOK_ROWS))
    kind = dict(classes.dtypes)
    schema = f"cid long, copies long, label {kind['label']}, dim int, embedding {kind['embedding']}, home long, visits array<long>"
    celled = stored(classes.select("cid", "copies", "label", "dim", "embedding").mapInPandas(_celled(shared), schema))
    residents = celled.selectExpr("* EXCEPT (visits)", "home AS cell", "true AS resident")
    visitors = celled.selectExpr("* EXCEPT (visits)", "explode(visits) AS cell", "false AS resident")
    cell = ["label", "dim", "cell"]
    met = residents.union(visitors)
    parts = met.groupBy(*cell).agg(
        F.expr(f"CAST(ceil(count_if(resident) / {BLOCK}) AS INT) AS homes"),
        F.expr(f"CAST(ceil(count_if(NOT resident) / {BLOCK}) AS INT) AS guests"),
    )
    dealt = met.join(stored(parts.where("homes > 0")), cell)
    own = "CAST(pmod(xxhash64(cid), IF(resident, homes, guests)) AS INT)"
    others = "sequence(0, IF(resident, guests, homes) - 1)"
    spread = dealt.selectExpr("*", f"{own} AS own", f"explode({others}) AS other").selectExpr(
        "*", "IF(resident, own, other) AS h", "IF(resident, other, own) AS g"
    )
    narrow = spread.select("cid", "copies", "embedding", "home", "resident", *cell, "h", "g")
    found = stored(narrow.groupBy(*cell, "h", "g").applyInPandas(_linked(threshold), "cid long, links long, mark long"))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(found.select("cid", "mark"), "cid", "mark").withColumnRenamed("node", "cid")
    facts = classes.join(links, "cid", "left").join(joined, "cid", "left")
    facts = stored(facts.selectExpr("label", "embedding", "least", "copies - 1 + coalesce(links, 0) AS n_links", "coalesce(component, cid) AS component"))
    smallest = stored(facts.groupBy("component").agg(F.min("least").alias("component_id")))
    facts = stored(facts.join(smallest, "component").select("label", "embedding", "n_links", "component_id"))
    placed = able.select("vec_id", "label", "embedding").join(facts, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    usable = f"label IS NOT NULL AND {VALID.format(v='embedding')}"
    unable = every.where(f"NOT coalesce({usable}, false)").selectExpr("vec_id", "0L AS n_links", "vec_id AS component_id")
    return placed.union(unable).selectExpr("vec_id", "n_links", "component_id", "coalesce(vec_id = component_id, true) AS kept")

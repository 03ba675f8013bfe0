"""Repeated keys without shuffling the keys.

Two levels. First every key is hashed to 64 bits: the upper half chooses a block, the lower half is a cell
of the block. A task keeps the cells that it has met as a compressed bitmap (sorted cells, and a flag for those met more
than once), so repeats within a task collapse at once and a row costs at most 4 bytes. The bitmaps of a
block are merged to the cells that were met twice: the suspects. Then only the rows whose hash is a suspect
are counted by their full keys, so that a clash of hashes costs a little work and changes nothing.

Suspects are about as many as repeated keys. Where they are few, which is counted, they are sent to all
executors and no row moves but suspected ones; where they are many, a join by hash finds these rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.durable import frozen

#: Cells of a task that are sorted at once, and those of a block for which blocks are chosen.
BATCH, BLOCK_CELLS = 4_000_000, 1_000_000
#: Suspects that are broadcast, 8 bytes each.
FEW = 1_000_000
_BITMAP = "block long, once binary, twice binary"


def _packed(hashes: np.ndarray, blocks: int) -> pa.RecordBatch:
    """The bitmaps of some hashes, by block."""
    cells, counts = np.unique(hashes, return_counts=True)
    home = ((cells >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    edges = np.flatnonzero(np.concatenate(([True], home[1:] != home[:-1])))
    rows = []
    for first, last in zip(edges, np.append(edges[1:], len(cells))):
        cell, several = (cells[first:last] & np.uint64(0xFFFFFFFF)).astype(np.uint32), counts[first:last] > 1
        rows.append((int(home[first]), cell[~several].tobytes(), cell[several].tobytes()))
    kinds = (pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["block", "once", "twice"])


def _bitmaps(blocks: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            hashes = batch.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
            held.append(hashes)
            size += len(hashes)
            if size >= BATCH:
                yield _packed(np.concatenate(held), blocks)
                held, size = [], 0
        if size:
            yield _packed(np.concatenate(held), blocks)

    return run


def _met_twice(blocks: int) -> Callable:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(v.as_buffer(), np.uint32) for name in ("once", "twice", "twice") for v in table.column(name)]
        cells, counts = np.unique(np.concatenate(parts), return_counts=True)
        return pa.table({"block": pa.array([key[0].as_py()] * int((counts > 1).sum()), pa.int64()), "cell": pa.array(cells[counts > 1].astype(np.int64))})

    return run


def _home(blocks: int) -> str:
    return f"shiftright(shiftrightunsigned(_hash, 32) * {blocks}L, 32)"


def suspects(feed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, cell) of the hashes that several rows have; null keys are left out."""
    hashes = feed.filter(f"{key} IS NOT NULL").selectExpr(f"xxhash64({key}) AS _hash")
    return hashes.mapInArrow(_bitmaps(blocks), _BITMAP).groupBy("block").applyInArrow(_met_twice(blocks), "block long, cell long")


def suspected(feed: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """The rows of feed whose key may be repeated; all rows of repeated keys are among them."""
    count = feed.count() if rows is None else rows
    blocks = max(1, -(-count // BLOCK_CELLS))
    found = frozen(suspects(feed, key, blocks))
    found = F.broadcast(found) if found.count() <= FEW else found
    hashed = feed.selectExpr("*", f"xxhash64({key}) AS _hash")
    placed = hashed.selectExpr("* EXCEPT (_hash)", f"{_home(blocks)} AS block", "_hash & 4294967295L AS cell")
    return placed.join(found, ["block", "cell"], "left_semi").drop("block", "cell")


def repeated_keys(feed: DataFrame, key: str) -> DataFrame:
    """(key, rows) of the keys that occur more than once. A null key is no key."""
    keys = feed.select(key)
    return suspected(keys, key).groupBy(key).agg(F.expr("count(*) AS rows")).filter("rows > 1")

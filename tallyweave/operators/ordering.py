"""Exact global positions without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import aggregates, named
from tallyweave.operators.durable import frozen

SLICE = "_slice"
POSITION = "_position"

# monotonically_increasing_id() keeps the row's place within its partition in the low
# 33 bits and the partition number above them.
_POSITION_BITS = 33


def sliced_by(df: DataFrame, *keys: Column) -> DataFrame:
    """Range-partition by the full key, sort each slice and number its rows.

    The key must be unique: then even a third of all rows with equal leading values is
    split over slices. The result is checkpointed, because slice borders come from a
    sample and must not be drawn twice.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = ordered.selectExpr("*", "monotonically_increasing_id() AS _id")
    return frozen(
        numbered.selectExpr(
            "* EXCEPT (_id)",
            f"shiftright(_id, {_POSITION_BITS}) AS {SLICE}",
            f"_id & {(1 << _POSITION_BITS) - 1}L AS {POSITION}",
        )
    )


def ranked(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """Add the 1-based rank of every row under a total order.

    Only the row count of each slice is brought together: one row per shuffle
    partition, which bounds both the window and the broadcast.
    """
    slices = sliced_by(df, *keys)
    offsets = slices.groupBy(SLICE).agg(F.expr("count(*) AS _size")).selectExpr(SLICE, f"{_before(SLICE)} AS _before")
    placed = slices.join(F.broadcast(offsets), SLICE)
    return placed.selectExpr(f"* EXCEPT ({SLICE}, {POSITION}, _before)", f"_before + {POSITION} + 1 AS {name}")


def _before(order: str, group: str = "", size: str = "_size") -> str:
    """Sum of the sizes ahead of a row."""
    partition = f"PARTITION BY {group} " if group else ""
    frame = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"coalesce(sum({size}) OVER ({partition}ORDER BY {order} {frame}), 0L)"


#: Bits that a round of quantiles_by_count adds: three rounds tell all values below 2 ** 59 apart.
_DIGIT = 20


def quantiles_by_count(counts: DataFrame, group: str, value: str, count: str, shares: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles of a whole number per group, from (group, value, count) rows.

    Three rounds of histograms select the order statistics: the first counts by the leading bits of the value, the
    next ones only look into the cells that hold a wanted place. Cells are pre-aggregated in the tasks, and a
    group has at most 2 ** 20 cells a round wherever its rows are, so nothing is sorted as a whole and no rows
    have to be stored between the rounds. Rows without a group or value are left out; values are below 2 ** 59.
    """
    known = counts.where(f"{group} IS NOT NULL AND {value} IS NOT NULL AND {count} > 0")
    ends = [f"struct('{name}_{end}' AS _name, CAST({f}((_total - 1) * {share!r}D) AS BIGINT) AS _place)"
            for name, share in shares.items() for end, f in (("low", "floor"), ("high", "ceil"))]
    held = "_first <= _place AND _place < _first + _size"
    found = [group, "_total", "_name", "_place - _first AS _place", "_cell AS _inside"]

    def cells(rows: DataFrame, digits: int, *keys: str) -> DataFrame:
        """Sizes of the cells of a round and of what lies before them within the keys."""
        cell = F.expr(f"shiftright({value}, {digits * _DIGIT}) AS _cell")
        return rows.groupBy(*keys, cell).agg(F.expr(f"sum({count}) AS _size")).selectExpr("*", f"{_before('_cell', ', '.join(keys))} AS _first")

    leading = cells(known, 2, group).selectExpr("*", f"sum(_size) OVER (PARTITION BY {group}) AS _total")
    wanted = leading.selectExpr("*", f"inline(array({', '.join(ends)}))").where(held).selectExpr(*found)
    for digits in (1, 0):
        keys = [group, "_inside"]
        inside = known.selectExpr("*", f"shiftright({value}, {(digits + 1) * _DIGIT}) AS _inside").join(wanted, keys, "left_semi")
        wanted = wanted.join(cells(inside, digits, *keys), keys).where(held).selectExpr(*found)
    picks, results = {"_total": "max(_total)"}, {}
    for name, share in shares.items():
        place = f"((_total - 1) * {share!r}D)"
        for end in ("low", "high"):
            picks[f"_{name}_{end}"] = f"max(IF(_name = '{name}_{end}', CAST(_inside AS DOUBLE), NULL))"
        results[name] = f"_{name}_low + (_{name}_high - _{name}_low) * ({place} - floor({place}))"
    return wanted.groupBy(group).agg(*aggregates(picks)).selectExpr(group, *named(results))

"""Sharding by a hierarchical weighted hash tree, with DataFrame functions only.

A topology is a tree of regions, racks and shards. A key descends it: at each level every child
draws -ln(u) / weight, where u in (0, 1) comes from a hash of the key and the child's name and the
weight of a child is the sum over its shards, and the smallest draw wins. A draw depends on one
child alone, so raising one child's weight moves keys into that child and never between others:
movement stays within the subtrees whose weights changed. `grown` adds a shard as a region of
its own, whose only leaf it is; then every key that moves, moves into the new shard.

Null keys are keys like any other, equal keys meet in one shard, empty tables give empty results
and other columns pass through.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class Shard(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


#: Parts that the rows of a shard are numbered in side by side.
SLOT_PARTS = 256


def even_topology(regions: int = 3, racks: int = 2, shards: int = 4) -> list[Shard]:
    """Shards 0, 1, ... of equal weight, filled in rack by rack."""
    return [Shard(n // (racks * shards), n // shards % racks, n) for n in range(regions * racks * shards)]


def grown(topology: list[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard, numbered next, in a region of its own."""
    return [*topology, Shard(max(s.region for s in topology) + 1, 0, max(s.shard for s in topology) + 1, weight)]


def _draw(key: str, name: str, weight: float) -> str:
    """-ln(u) / weight; u is the middle of one of 2^52 equal steps of (0, 1)."""
    hashed = f"conv(substring(md5(concat(coalesce(CAST({key} AS STRING), '?'), '{name}')), 1, 13), 16, 10)"
    return f"-ln((CAST({hashed} AS DOUBLE) + 0.5D) / 4503599627370496D) / {weight!r}D"


def _winner(key: str, level: str, children: dict[str, tuple[int, float]]) -> str:
    """The SQL of the number of the child that draws least; a child's name leads to (number, weight), ties go to the lower number."""
    if len(children) == 1:
        return str(next(iter(children.values()))[0])
    draws = ", ".join(
        f"named_struct('draw', {_draw(key, f'|{level}{name}', weight)}, 'child', {number})"
        for name, (number, weight) in children.items()
    )
    return f"array_min(array({draws})).child"


def _cases(column: str, branches: dict[int, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {value} THEN {sql}" for value, sql in branches.items()) + " END"


def placed(rows: DataFrame, key: str, topology: list[Shard], name: str = "shard") -> DataFrame:
    """rows with the shard of each key; the levels are columns of their own, so only the branch taken is drawn."""
    tree: dict[int, dict[int, list[Shard]]] = {}
    for leaf in sorted(topology):
        tree.setdefault(leaf.region, {}).setdefault(leaf.rack, []).append(leaf)
    weight = {(r, k): sum(s.weight for s in leaves) for r, racks in tree.items() for k, leaves in racks.items()}
    region = _winner(key, "region", {f"{r}": (r, sum(weight[r, k] for k in racks)) for r, racks in tree.items()})
    rack = {r: _winner(key, "rack", {f"{r}.{k}": (k, weight[r, k]) for k in racks}) for r, racks in tree.items()}
    leaf = {
        r: _cases("__rack", {k: _winner(key, "shard", {f"{r}.{k}.{s.shard}": (s.shard, s.weight) for s in leaves}) for k, leaves in racks.items()})
        for r, racks in tree.items()
    }
    descended = rows.withColumn("__region", F.expr(region)).withColumn("__rack", F.expr(_cases("__region", rack)))
    return descended.withColumn(name, F.expr(f"CAST({_cases('__region', leaf)} AS INT)")).drop("__region", "__rack")


def with_slots(rows: DataFrame, shard: str, order: list[str], parts: int = SLOT_PARTS) -> DataFrame:
    """Number the rows of each shard from 0 without a gap.

    A shard's rows are dealt to parts by a hash of the order columns; each part is numbered by
    itself and starts after the parts before it. Counts are one row a part: bounded by the
    topology. Rows that agree in all order columns may swap numbers, which shows nowhere.
    """
    dealt = rows.withColumn("__part", F.expr(f"CAST(pmod(xxhash64({', '.join(order)}), {parts}) AS INT)"))
    sizes = dealt.groupBy(shard, "__part").agg(F.count("*").alias("__size"))
    ahead = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(shard, "__part", F.coalesce(F.sum("__size").over(ahead), F.lit(0)).alias("__before"))
    own = Window.partitionBy(shard, "__part").orderBy(*order)
    numbered = dealt.withColumn("__own", F.row_number().over(own))
    joined = numbered.join(F.broadcast(before), [shard, "__part"])
    return joined.withColumn("slot", F.expr("CAST(__before + __own - 1 AS BIGINT)")).select(*rows.columns, "slot")

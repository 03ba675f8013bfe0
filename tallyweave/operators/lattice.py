"""Additive measures by several dimensions, rolled up from the finest cells.

Grouping sets copy every input row once per dimension before anything is added up. Where many rows
share their values in all dimensions, it is cheaper to add up the finest cells first and to copy
only those. Whether that pays depends on the data, so it is decided by an estimate of their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import aggregates

#: The first step pays if there are at most so many cells per row: it costs an exchange of all cells and saves
#: the copies of the rows.
PAYING_SHARE = 0.25


def cell_estimate(columns: Sequence[str]) -> dict[str, str]:
    """Aggregates behind `cell_share`; both merge, so they can ride on any job that passes the rows."""
    return {"rows": "count(*)", "cells": f"approx_count_distinct(xxhash64({', '.join(columns)}))"}


def cell_share(estimate: dict | None) -> float:
    """Cells per row by a computed estimate; 1 without rows."""
    return estimate["cells"] / estimate["rows"] if estimate and estimate["rows"] else 1.0


def finest_cells(table: DataFrame, columns: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """One row per combination of the columns. Nulls are values of their own."""
    return table.groupBy(*columns).agg(*aggregates(measures))


def rolled_up(cells: DataFrame, measures: Sequence[str]) -> dict[str, str]:
    """Aggregates that add up cells, in the types that the measures have there."""
    types = {f.name: f.dataType.simpleString() for f in cells.schema}
    return {m: f"coalesce(CAST(sum({m}) AS {types[m]}), CAST(0 AS {types[m]}))" for m in measures}


def by_dimension(
    table: DataFrame, columns: Sequence[str], measures: dict[str, str], extra: dict[str, str], *, total: bool, share: float
) -> DataFrame:
    """Measures per value of each column, and of all rows if total; extra aggregates, such as grouping(), see the sets.

    The measures must be sums or counts, which add up over cells.
    """
    if share <= PAYING_SHARE:
        table = finest_cells(table, columns, measures)
        measures = rolled_up(table, list(measures))
    sets = [[F.col(c)] for c in columns] + ([[]] if total else [])
    return table.groupingSets(sets, *[F.col(c) for c in columns]).agg(*aggregates(measures | extra))

"""Places of rows within their groups without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.storage import stored


def numbered(rows: DataFrame, group: str, order: list[str], place: str = "__at", size: str = "__n") -> DataFrame:
    """rows with their place in the group (from 0, by order) and the group's number of rows.

    Rows are range-sorted by group and order, so a large group is spread over many partitions. Only
    one row for each pair of partition and group is windowed: their number is at most that of partitions and groups
    together. Rows that agree in the whole order are interchangeable. `group` must not be null.
    """
    sorted_rows = stored(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order))
    # In a stored table this id is the partition in the high bits and the place in it in the low ones.
    known = sorted_rows.withColumn("__row", F.monotonically_increasing_id()).withColumn("__part", F.expr("shiftright(__row, 33)"))
    runs = stored(known.groupBy("__part", group).agg(F.min("__row").alias("__first"), F.count("*").alias("__rows")))
    whole = Window.partitionBy(group)
    ahead = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        "__part", group, (F.coalesce(F.sum("__rows").over(ahead), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(whole).alias(size),
    )
    joined = known.join(offsets, ["__part", group]).withColumn(place, F.expr("__row + __shift"))
    return joined.select(*rows.columns, place, size)

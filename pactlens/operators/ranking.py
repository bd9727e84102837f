"""Ranks within groups of any size.

A window over a group sorts all its rows in one task. Here rows are range-partitioned by group and order, so
a group may lie in many partitions; a row's rank is its place in its partition less that of the group's first
row there, plus the group's rows in earlier partitions. Those numbers, one row per group and partition, are
all that is ever aggregated by group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PLACES = (1 << 33) - 1  # a row's place is in these bits of Spark's increasing id


def ranked(
    df: DataFrame, groups: list[str], order: list[Column], keep: Callable[[DataFrame], DataFrame], name: str = "rank"
) -> DataFrame:
    """``df`` with each row's ``name`` (1, 2, ...) in its group, which has no null.

    ``order`` must tell all rows of a group apart. ``keep`` writes a table and reads it back: places hold
    only once they are written, as a range partitioning made anew may cut elsewhere.
    """
    columns = [*[F.asc(g) for g in groups], *order]
    placed = keep(
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(_PLACES))
    )
    by = ", ".join(f"`{g}`" for g in groups)
    partition = f"PARTITION BY {by} " if groups else ""
    starts = (
        placed.groupBy(*groups, "_part")
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
        .selectExpr(*[f"`{g}`" for g in groups], "_part", "_first", f"sum(_rows) OVER ({partition}ORDER BY _part) - _rows AS _before")
    )
    return (
        placed.join(starts, [*groups, "_part"])
        .withColumn(name, F.expr("_before + _at - _first + 1"))
        .drop("_part", "_at", "_first", "_before")
    )

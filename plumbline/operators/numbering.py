"""Consecutive numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows per slice: the largest set one window partition has to sort.
SLICE = 10_000


def number_within(df: DataFrame, groups: list[str], ordinal: str, name: str) -> DataFrame:
    """Add ``name`` = 1, 2, ... within each group, in the order of ``ordinal``.

    ``ordinal`` is a number unique within the group.  It is cut into slices, rows are
    numbered inside their slice, and every slice starts where the ones before it ended,
    so a group that holds most of the rows is still numbered by many tasks.
    """
    sliced = df.withColumn("__slice", F.floor(F.col(ordinal) / F.lit(SLICE)))
    sizes = sliced.groupBy(*groups, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        *groups, "__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    inside = Window.partitionBy(*groups, "__slice").orderBy(ordinal)
    numbered = sliced.withColumn("__at", F.row_number().over(inside))
    return (
        numbered.join(starts, [*groups, "__slice"])
        .withColumn(name, F.col("__start") + F.col("__at"))
        .drop("__slice", "__start", "__at")
    )

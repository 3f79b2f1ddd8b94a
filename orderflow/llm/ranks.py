"""Places of rows within ordered groups, counted without gathering a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import stage

_AT, _TASK, _FIRST, _SKIP = "__at", "__task", "__first", "__skip"


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``rank``, a row's place from 0 in its group, and ``group_rows``, the group's rows.

    ``group`` names columns without nulls; ``order`` names the columns that the places follow,
    nulls first. Rows that agree in all of them take neighbouring places in any order. Columns of
    these two names are replaced.

    The rows are dealt by ranges of (group, order), sorted, and written to the shared folder with
    their place in the whole order. A group that spans many tasks needs one small row per task
    for the offsets, so no task holds more than a range. An empty table gives no rows.
    """
    # a single partition has no ranges to sample, but needs the same columns
    placed = stage(df.drop("rank", "group_rows").repartitionByRange(*group, *order)
                   .sortWithinPartitions(*group, *order)
                   .withColumn(_AT, F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn(_TASK, F.shiftright(_AT, 33))
    parts = placed.groupBy(*group, _TASK).agg(
        F.min(_AT).alias(_FIRST), F.count("*").alias("n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(parts.select(
        *group, _TASK, _FIRST, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_SKIP),
        F.sum("n").over(whole).alias("group_rows")), "offsets")
    return (placed.join(offsets, [*group, _TASK])
            .withColumn("rank", F.col(_AT) - F.col(_FIRST) + F.col(_SKIP))
            .drop(_AT, _TASK, _FIRST, _SKIP))

"""Tables kept per area: one table partitioned by ``shard_id``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARD = "shard_id"


def write_by_area(df: DataFrame, path: str) -> None:
    """Write one folder per area.

    The rebalance hint groups an area's rows into few files and lets Spark cut an area that is
    larger than the advisory partition size into several tasks.
    """
    df.hint("rebalance", SHARD).write.mode("overwrite").partitionBy(SHARD).parquet(path)


def read_area(source: SparkSession, path: str, areas: Iterable[int] | None = None) -> DataFrame:
    """Read the folders of the given areas only (partition pruning); all areas for ``None``."""
    table = source.read.parquet(path)
    return table if areas is None else table.where(F.col(SHARD).isin(list(areas)))

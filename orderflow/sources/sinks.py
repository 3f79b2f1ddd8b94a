"""Writers: increments, and report tables replaced one campaign at a time."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.session import shared_folder, stage


def work_database(spark: SparkSession, name: str) -> str:
    """Create (if needed) a database whose managed tables live in the shared folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} "
              f"LOCATION '{shared_folder(spark)}/orderflow/{name}.db'")
    return name


def append_new(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key the target does not hold yet."""
    return new.join(target.select(key), key, "left_anti")


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """Overwrite only the partitions that receive rows, for the statements inside."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_slice(new: DataFrame, table: str, key: str, values: Sequence[int]) -> None:
    """Replace the slices ``values`` of a table partitioned by ``key`` with ``new``.

    Slices other than ``values`` stay untouched, and a requested slice without new rows ends up
    empty. A rerun after a failure gives the same table. The new rows and their slices are fixed
    before anything is written, so they may come from the table itself.
    """
    spark = new.sparkSession
    wanted = stage(new.where(F.col(key).isin(list(values))), "slice")
    # at most as many as ``values``
    filled = {row[0] for row in wanted.select(key).distinct().collect()}
    # partition column last, as the table stores it
    ordered = wanted.select(*[c for c in wanted.columns if c != key], key).hint("rebalance", key)
    if not spark.catalog.tableExists(table):
        ordered.write.partitionBy(key).format("parquet").saveAsTable(table)
        return
    with _dynamic_overwrite(spark):
        ordered.write.mode("overwrite").insertInto(table)
    # Dynamic overwrite leaves a slice alone when nothing new arrives for it.
    for value in values:
        part = f"PARTITION ({key} = {int(value)})"
        if value not in filled and spark.sql(f"SHOW PARTITIONS {table} {part}").head():
            spark.sql(f"TRUNCATE TABLE {table} {part}")

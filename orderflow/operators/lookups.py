"""Single-value lookups in dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(dim: DataFrame, key: str, value: str) -> DataFrame:
    """``dim`` reduced to key, smallest value and number of rows, with map-side combine."""
    return dim.groupBy(F.col(key).alias("_key")).agg(
        F.min(value).alias("_value"), F.count(F.lit(1)).alias("_rows"))


def only_keys(table: DataFrame, key: str, wanted: DataFrame, on: str) -> DataFrame:
    """The rows of a large table whose ``key`` is among ``wanted[on]``.

    For a day's few keys and a look-up in a fact-size table: pass ``wanted`` staged, so that Spark
    knows how few there are, broadcasts them, and aggregates only the rows that are left.
    """
    return table.join(wanted.select(F.col(on).alias(key)).distinct(), key, "left_semi").select(
        table.columns)


def lookup(df: DataFrame, dim: DataFrame, on: str, key: str, value: str, out: str,
           on_dup: str = "error") -> DataFrame:
    """Add column ``out``: the value ``dim`` holds for ``df[on]``, NULL when it has none.

    ``on_dup='error'`` fails the job when a key that is really looked up has several rows, as a
    scalar subquery does; ``'any'`` takes the smallest value, so the choice is repeatable.
    """
    if on_dup not in ("error", "any"):
        raise ValueError(f"unknown on_dup {on_dup!r}")
    joined = df.join(one_per_key(dim, key, value), F.col(on) == F.col("_key"), "left")
    found = F.col("_value")
    if on_dup == "error":
        message = F.concat(F.lit(f"several rows in lookup of {value} for {key} "),
                           F.col("_key").cast("string"))
        dtype = dim.schema[value].dataType
        found = F.when(F.col("_rows") > 1, F.raise_error(message).cast(dtype)).otherwise(found)
    return joined.withColumn(out, found).drop("_key", "_value", "_rows")


def user_names(system_users: DataFrame, staff: DataFrame) -> DataFrame:
    """user_id -> user_name over the user's staff record; one name per user."""
    return (system_users.join(staff, "staff_id")
            .groupBy(F.col("system_user_id").alias("user_id"))
            .agg(F.min("staff_name").alias("user_name")))


def with_user_name(df: DataFrame, on: str, system_users: DataFrame, staff: DataFrame,
                   out: str = "user_name") -> DataFrame:
    names = user_names(system_users, staff).toDF("_user", "_name")
    return (df.join(names, F.col(on) == F.col("_user"), "left")
            .withColumn(out, F.col("_name")).drop("_user", "_name"))


def org_regions(organization: DataFrame, regions: DataFrame) -> DataFrame:
    """org_id -> region of the organisation, for regions that exist."""
    known = regions.select(F.col("region_id").alias("common_region_id"))
    return organization.select("org_id", "common_region_id").join(known, "common_region_id")

"""Delimited attribute columns as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.text import nth_part, part_count, parts


def explode_conditions(df: DataFrame, col: str, *, id_col: str = "id", pair_sep: str = ",",
                       kv_sep: str = ":") -> DataFrame:
    """One row per ``key:value`` pair of a text: id, pos (from 1), key, value, n_parts.

    A missing value is NULL; a NULL or empty text gives no rows.
    """
    text = F.nullif(F.col(col), F.lit(""))
    pairs = df.select(F.col(id_col), part_count(F.col(col), pair_sep).alias("n_parts"),
                      F.posexplode(parts(text, pair_sep)).alias("pos", "pair"))
    return pairs.select(
        id_col, (F.col("pos") + 1).alias("pos"),
        nth_part(F.col("pair"), 1, kv_sep).alias("key"),
        nth_part(F.col("pair"), 2, kv_sep).alias("value"), "n_parts")


def pick_part(df: DataFrame, col: str, n: str, from_left: str, out: str,
              sep: str = ",") -> DataFrame:
    """Add the part of ``col`` whose position and direction are columns themselves."""
    return df.withColumn(out, nth_part(F.col(col), F.col(n), sep, F.col(from_left) > 0))

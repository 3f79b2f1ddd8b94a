"""Full refresh of a dimension table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.functions.clock import AsOf, instant


def refresh_snapshot(src: DataFrame, columns: Sequence[str] | None = None, *,
                     load_ts: AsOf | None = None, distinct: bool = False,
                     ts_column: str = "load_date") -> DataFrame:
    """Project ``src`` on an explicit column list, optionally de-duplicated and stamped.

    The stamp is added after the de-duplication, so it takes no part in it.
    """
    out = src.select(*columns) if columns else src
    if distinct:
        out = out.distinct()
    if load_ts is not None:
        out = out.withColumn(ts_column, instant(load_ts))
    return out


def empty_text_as_null(df: DataFrame) -> DataFrame:
    """Empty strings mean NULL in the source system; normalise them once at ingest."""
    return df.select(*[
        F.nullif(F.col(f.name), F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def conform(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Give ``df`` exactly the named columns in order; missing ones become typed NULLs."""
    present = set(df.columns)
    return df.select(*[
        (F.col(name) if name in present else F.lit(None)).cast(dtype).alias(name)
        for name, dtype in columns.items()
    ])

"""The as-of instant. Nothing in the library reads the wall clock."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = datetime | str


def _moment(as_of: AsOf) -> datetime:
    return as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)


def _literal(moment: datetime, dtype: str = "timestamp_ntz") -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast(dtype)


def instant(as_of: AsOf, days: int = 0) -> Column:
    """The as-of moment shifted by whole days, time of day kept."""
    return _literal(_moment(as_of) + timedelta(days=days))


def midnight(as_of: AsOf, days: int = 0, dtype: str = "timestamp_ntz") -> Column:
    """Start of the as-of day shifted by whole days, as a foldable literal of type ``dtype``."""
    start = _moment(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    return _literal(start + timedelta(days=days), dtype)


def as_text(as_of: AsOf, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(instant(as_of), pattern)


def day_window(df: DataFrame, col: str, as_of: AsOf, days: int = 1,
               closed_start: bool = True) -> DataFrame:
    """Rows whose ``col`` lies in the ``days`` whole days before the as-of day.

    The end is always open. ``closed_start=False`` drops rows exactly at the first midnight.
    Both bounds are literals of the column's own type, so parquet can skip row groups.
    """
    dtype = df.schema[col].dataType.simpleString()
    start = midnight(as_of, -days, dtype)
    after = F.col(col) >= start if closed_start else F.col(col) > start
    return df.where(after & (F.col(col) < midnight(as_of, 0, dtype)))

"""Delimited text as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def parts(col: Column, sep: str) -> Column:
    """All parts of a delimited text, empty ones included; separators of any length."""
    return F.split(col, re.escape(sep), -1)


def part_count(col: Column, sep: str) -> Column:
    """Number of parts: separators + 1, and 0 for NULL or empty text."""
    text = F.nullif(col, F.lit(""))
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(parts(text, sep)))


def nth_part(col: Column, n: Column | int, sep: str, from_left: Column | bool = True) -> Column:
    """The n-th part counted from the left, else from the right.

    NULL unless n is positive, and for a position out of range or an empty part. A NULL
    direction counts from the right.
    """
    position = F.lit(n) if isinstance(n, int) else n
    left = F.lit(from_left) if isinstance(from_left, bool) else F.coalesce(from_left, F.lit(False))
    signed = F.when(left, position).otherwise(-position)
    # split_part refuses position 0, so that case never reaches it
    found = F.split_part(col, F.lit(sep), F.when(signed != 0, signed).otherwise(F.lit(1)))
    return F.when(position > 0, F.nullif(found, F.lit("")))

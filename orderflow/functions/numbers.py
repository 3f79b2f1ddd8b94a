"""Conversions that never abort a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number with more decimals than these is not compared, because the cast would round it.
_PLACES = 18
_EXACT = f"DECIMAL(38, {_PLACES})"
_DECIMALS, _EXPONENT = "[.]([0-9]*?)0*([^0-9]|$)", "[eE]([+-]?[0-9]+)"
# A cast that fails takes many times as long as one that doesn't, also with try_cast, so texts
# that can't be cast are told by their characters first: ASCII ones that no number has, signs behind
# digits, second points and exponents, nothing but blanks. Other texts may still fail to cast.
_NO_NUMBER = "[!-*,/:-DF-df-~]|[0-9.][+-]|[.].*[.]|[eE].*[.eE]|^ *$"
_NO_INTEGER = "[.eE]"


def whole_sql(v: str) -> str:
    """SQL for :func:`to_bigint` of a text column."""
    exact, power = f"try_cast({v} AS {_EXACT})", f"regexp_extract({v}, '{_EXPONENT}', 1)"
    return (f"CASE WHEN NOT {v} RLIKE '{_NO_NUMBER}' THEN coalesce("
            f"CASE WHEN NOT {v} RLIKE '{_NO_INTEGER}' THEN try_cast({v} AS BIGINT) END, "
            f"CASE WHEN {exact} = try_cast({exact} AS BIGINT) "
            f"AND length(regexp_extract({v}, '{_DECIMALS}', 1)) - coalesce("
            f"CASE WHEN {power} <> '' THEN try_cast({power} AS INT) END, 0) <= {_PLACES} "
            f"THEN try_cast({exact} AS BIGINT) END) END")


def to_bigint(col: Column | str) -> Column:
    """Text to bigint, NULL when it is not a whole number.

    ``12.00`` and ``1.2E3`` are whole numbers, ``12.0000001`` is none: nothing is rounded. A number
    written with over 18 decimals that are not zeros is none.
    """
    text = F.col(col) if isinstance(col, str) else col
    exact, power = text.try_cast(_EXACT), F.regexp_extract(text, _EXPONENT, 1)
    decimals = F.length(F.regexp_extract(text, _DECIMALS, 1)) - F.coalesce(
        F.when(power != "", power.try_cast("int")), F.lit(0))
    whole = exact.try_cast("bigint")
    return F.when(~text.rlike(_NO_NUMBER), F.coalesce(
        F.when(~text.rlike(_NO_INTEGER), text.try_cast("bigint")),
        F.when((exact == whole) & (decimals <= _PLACES), whole)))


def null_as_zero(col: Column | str) -> Column:
    """Zero and NULL count as the same value in change detection."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(0))

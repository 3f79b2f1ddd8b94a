"""Rows that cannot be processed: logged and skipped, the run goes on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts and job names of the error log.
NO_DATA = "ORA-01403: no data found"
RECEIVE_JOB = "p_order_receive_detail_call"
OUTCALL_JOB = "p_order_outcall_detail_call"


def split_valid(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows passing every check, rows failing one with the first failed check as ``reason``).

    A check that evaluates to NULL has failed.
    """
    reason = F.coalesce(*[
        F.when(~F.coalesce(check, F.lit(False)), F.lit(name)) for name, check in checks.items()])
    marked = df.withColumn("reason", reason)
    return (marked.where(F.col("reason").isNull()).drop("reason"),
            marked.where(F.col("reason").isNotNull()))


def cast_check(col: str, dtype: str = "bigint") -> Column:
    """True when a text column is NULL or converts to ``dtype``."""
    return F.col(col).isNull() | F.col(col).try_cast(dtype).isNotNull()


def typed(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows with the named columns cast, rows in which one of them does not convert).

    The place to turn text ids and codes into numbers, once, before anything joins on them.
    """
    good, bad = split_valid(df, {f"{c} is not a valid {t}": cast_check(c, t)
                                 for c, t in types.items()})
    return good.withColumns({c: F.col(c).cast(t) for c, t in types.items()}), bad


def order_message(campaign: str, order: str, message: Column) -> Column:
    """Error text naming campaign and order; the message is kept whole."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.concat(F.lit("活动["), shown(campaign), F.lit("]的工单["), shown(order), F.lit("]"),
                    message)


def error_log(df: DataFrame, job: str, order: str, message: Column, code: Column) -> DataFrame:
    """Rows for the error table, with the order id in a column of its own."""
    return df.select(F.col(order).cast("bigint").alias("order_id"), message.alias("errormsg"),
                     F.lit(job).alias("pro_name"), code.cast("string").alias("errorcode"))


def outcall_errors(resolved: DataFrame) -> DataFrame:
    """Error rows of unresolvable telephone orders.

    A missing record is logged as fixed text with the order id as error code.
    """
    failed = resolved.where(F.col("problem").isNotNull())
    missing = F.col("problem") == "missing"
    return error_log(
        failed, OUTCALL_JOB, "list_id",
        F.when(missing, F.lit(NO_DATA)).otherwise(
            order_message("campaign_id", "list_id", F.lit("several rows in lookup"))),
        F.when(missing, F.col("list_id").cast("string")).otherwise(F.lit("-1422")))

"""Which rule makes an order successful, and what that changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.clock import AsOf, instant
from orderflow.operators.apply import apply_changes
from orderflow.operators.orders import COMPLETED

# Fixed values.
KEEPS_STATUS_ABOVE = 2000
COMPLETE_TEXT = "successed complete"

_WINNER = ("suc_rule_id", "rule_name", "report_column", "value")


def first_success(hits: DataFrame) -> DataFrame:
    """The first successful rule of every order, in rule order; the later ones do not count.

    Should a campaign hang on several catalogues, the smallest catalogue comes first.
    """
    first = hits.groupBy("list_id").agg(
        F.min(F.struct("main_campaign_id", "seq_no", *_WINNER)).alias("w"))
    return first.select("list_id", "w.seq_no", *[f"w.{c}" for c in _WINNER])


def outcall_success(hits: DataFrame) -> DataFrame:
    """First and last successful rule of every order that was not successful before.

    The detail keeps the first one, the executor ends with the last one. Both come from the
    smallest catalogue that has a success; a later one finds the order successful already.
    """
    rule = ("seq_no", "suc_rule_id", "rule_name", "value")
    main = F.col("main_campaign_id")
    ends = (hits.where(F.col("old_is_success") == 0).groupBy("list_id")
            .agg(F.min(F.struct(main, *rule)).alias("f"),
                 F.max(F.struct((-main).alias("catalogue"), *rule)).alias("l"),
                 F.max("status_cd").alias("status_cd")))
    return ends.select(
        "list_id", "status_cd",
        *[F.col(f"{side}.{name}").alias(f"{prefix}_{name}")
          for side, prefix in (("f", "first"), ("l", "last"))
          for name in ("suc_rule_id", "rule_name", "value")])


def _open(flag: str = "is_success") -> Column:
    return F.coalesce(F.col(flag), F.lit(0)) == 0


def _unless_done(column: str, value: Column) -> Column:
    return F.when(_open(), value).otherwise(F.col(column))


def receive_win(as_of: AsOf) -> dict[str, Column]:
    """Assignments of a winning rule to a detail row that was not successful yet."""
    return {
        "is_success": F.lit(1),
        "update_date": _unless_done("update_date", instant(as_of)),
        "suc_rule_id": _unless_done("suc_rule_id", F.col("chg.suc_rule_id")),
        "suc_rule_name": _unless_done("suc_rule_name", F.col("chg.rule_name")),
        "suc_order_id": _unless_done("suc_order_id", F.col("chg.value"))}


def receive_success_detail(detail: DataFrame, winners: DataFrame, as_of: AsOf) -> DataFrame:
    """Mark orders not yet successful with their winning rule."""
    return apply_changes(detail, winners, "list_id", receive_win(as_of))


def receive_success_executor(executors: DataFrame, winners: DataFrame,
                             as_of: AsOf) -> DataFrame:
    return apply_changes(executors, winners.select(
        F.col("list_id").alias("initiative_order_id"), "suc_rule_id", "rule_name", "value"),
        "initiative_order_id", {
            "is_success": F.lit(1), "suc_rule_id": F.col("chg.suc_rule_id"),
            "suc_rule_name": F.col("chg.rule_name"), "suc_order_id": F.col("chg.value"),
            "suc_time": instant(as_of)})


def _outcall_status(current: Column) -> Column:
    """Statuses above 2000 stay, any other (NULL included) becomes 7000."""
    return F.when(F.col("chg.status_cd") > KEEPS_STATUS_ABOVE, current).otherwise(
        F.lit(COMPLETED))


def outcall_win(as_of: AsOf) -> dict[str, Column]:
    """Assignments of the first winning rule to a detail row that was not successful yet."""
    return {
        "status_cd": _unless_done("status_cd", _outcall_status(F.col("status_cd"))),
        "is_success": F.lit(1),
        "update_date": _unless_done("update_date", instant(as_of, -1)),
        "suc_rule_id": _unless_done("suc_rule_id", F.col("chg.first_suc_rule_id")),
        "suc_rule_name": _unless_done("suc_rule_name", F.col("chg.first_rule_name")),
        "suc_order_id": _unless_done("suc_order_id", F.col("chg.first_value"))}


def outcall_success_detail(detail: DataFrame, ends: DataFrame, as_of: AsOf) -> DataFrame:
    """Mark orders not yet successful with their first successful rule.

    Whether the status stays is decided by the executor's status at the start.
    """
    return apply_changes(detail, ends, "list_id", outcall_win(as_of))


def outcall_success_executor(executors: DataFrame, ends: DataFrame, as_of: AsOf) -> DataFrame:
    """The executor takes the last successful rule and is closed."""
    hand_call = F.when(F.col("chg.status_cd") > KEEPS_STATUS_ABOVE, F.col("hand_call")).otherwise(
        F.lit(0))
    return apply_changes(executors, ends.withColumnRenamed("list_id", "initiative_order_id"),
                         "initiative_order_id", {
        "is_success": F.lit(1), "suc_rule_id": F.col("chg.last_suc_rule_id"),
        "suc_rule_name": F.col("chg.last_rule_name"), "suc_order_id": F.col("chg.last_value"),
        "suc_time": instant(as_of), "status_date": instant(as_of),
        "last_opt_date": instant(as_of), "last_opt_desc": F.lit(COMPLETE_TEXT),
        "status_cd": _outcall_status(F.col("status_cd")), "hand_call": hand_call})

"""Keyed updates of the detail tables, as new versions of the whole DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.clock import AsOf, instant
from orderflow.operators.campaigns import MAX_RULES
from orderflow.operators.quality import error_log

FLAG_COLUMNS = tuple(f"col_{i}" for i in range(1, MAX_RULES + 1))
_FLAGS = dict.fromkeys(FLAG_COLUMNS, "int")
_SUCCESS = {"suc_rule_id": "bigint", "suc_rule_name": "string", "suc_order_id": "bigint"}

# Full column sets of the two detail tables.
RECEIVE_DETAIL = {
    "report_date": "string", "update_date": "timestamp_ntz", "latn_id": "int",
    "region_id": "int", "org_id": "bigint", "org_jt_code": "bigint", "fir_grid_id": "bigint",
    "sec_grid_id": "bigint", "thi_grid_id": "bigint", "z_mkt_campaign_id": "bigint",
    "a_mkt_campaign_id": "bigint", "list_id": "bigint", "status_cd": "int",
    "old_org_id": "bigint", "old_org_jt_code": "bigint", "old_status_cd": "int",
    "is_success": "int", "user_id": "bigint", "user_name": "string", "cust_id": "bigint",
    "cust_name": "string", "acc_nbr": "string", "cop_channel_id": "int", **_SUCCESS, **_FLAGS}
OUTCALL_DETAIL = {
    "main_campaign_id": "bigint", "main_campaign_name": "string", "sub_campaign_id": "bigint",
    "sub_campaign_name": "string", "region_id": "int", "prov_dept_id": "bigint",
    "prov_dept_name": "string", "city_dept_id": "bigint", "city_dept_name": "string",
    "team_dept_id": "bigint", "team_dept_name": "string", "class_dept_id": "bigint",
    "class_dept_name": "string", "caller_id": "bigint", "caller_name": "string",
    "list_id": "bigint", "status_cd": "int", "create_date": "timestamp_ntz",
    "is_success": "int", "order_result": "bigint", "update_date": "timestamp_ntz",
    "cust_name": "string", "prod_inst_id": "bigint", "cust_id": "bigint", "city_region": "int",
    "old_status_cd": "int", "old_class_dept_id": "bigint", **_SUCCESS, **_FLAGS}
# Columns a success writes to the executor table.
EXECUTOR_SUCCESS = {
    **_SUCCESS, "suc_time": "timestamp_ntz", "hand_call": "int",
    "status_date": "timestamp_ntz", "last_opt_desc": "string"}


def apply_changes(target: DataFrame, changes: DataFrame, key: str,
                  assign: Mapping[str, Column]) -> DataFrame:
    """New version of ``target``: rows with a change get the assignments, others stay.

    ``changes`` holds at most one row per key. Assignments see the row's current values by name
    and the change's values as fields of ``chg``, so ``old_x`` can take the current ``x``. Every
    assignment reads the state before the update.
    """
    fields = [c for c in changes.columns if c != key]
    packed = changes.select(F.col(key).alias("_key"), F.struct(*fields).alias("chg"))
    joined = target.join(packed, F.col(key) == F.col("_key"), "left")
    hit = F.col("_key").isNotNull()
    types = {f.name: f.dataType for f in target.schema.fields}
    return joined.select(*[
        F.when(hit, assign[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in assign
        else F.col(c) for c in target.columns])


def change_set(key: str, sets: Mapping[str, DataFrame]) -> DataFrame:
    """One row per key of any of the ``sets``: a struct column per set, NULL where it lacks the key.

    Every set holds at most one row per key. The sets meet in one aggregation.
    """
    fields = {name: [c for c in df.columns if c != key] for name, df in sets.items()}
    types = {name: df.select(F.struct(*fields[name]).alias("s")).schema["s"].dataType
             for name, df in sets.items()}
    parts = [df.select(F.col(key), *[
        (F.struct(*fields[name]) if other == name else F.lit(None).cast(types[other])).alias(other)
        for other in sets]) for name, df in sets.items()]
    return reduce(DataFrame.union, parts).groupBy(key).agg(
        *[F.first(name, ignorenulls=True).alias(name) for name in sets])


def apply_all(target: DataFrame, changes: DataFrame, key: str,
              steps: Sequence[tuple[str, Mapping[str, Column]]]) -> DataFrame:
    """Several :func:`apply_changes`, one after the other, in one join.

    ``changes`` is a :func:`change_set`; a step names one of its sets and the assignments, which
    see what the steps before it have assigned.
    """
    packed = changes.select(F.col(key).alias("_key"), *[
        F.col(name).alias(f"_{name}") for name, _ in steps])
    out = target.join(packed, F.col(key) == F.col("_key"), "left")
    types = {f.name: f.dataType for f in target.schema.fields}
    for name, assign in steps:
        hit = F.col(f"_{name}").isNotNull()
        out = out.withColumn("chg", F.col(f"_{name}")).select(*[
            F.when(hit, assign[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in assign
            else F.col(c) for c in target.columns], *[f"_{other}" for other, _ in steps])
    return out.select(target.columns)


def receive_change(as_of: AsOf) -> dict[str, Column]:
    """Assignments: current status, organisation and owner; the values before to ``old_`` ones."""
    new = {"status_cd": "status_cd", "org_id": "org_id", "org_jt_code": "dept_id",
           "fir_grid_id": "fir_grid_id", "sec_grid_id": "sec_grid_id",
           "thi_grid_id": "thi_grid_id", "user_id": "curr_user_id", "user_name": "user_name"}
    return {
        "old_status_cd": F.col("status_cd"), "old_org_id": F.col("org_id"),
        "old_org_jt_code": F.col("org_jt_code"), "update_date": instant(as_of),
        **{column: F.col(f"chg.{field}") for column, field in new.items()}}


def apply_receive_changes(detail: DataFrame, changes: DataFrame, as_of: AsOf) -> DataFrame:
    """Current status, organisation and owner; the values before go to the ``old_`` columns.

    ``changes``: list_id, status_cd, dept_id, curr_user_id, user_name and the grid columns.
    """
    return apply_changes(detail, changes, "list_id", receive_change(as_of))


def usable_changes(resolved: DataFrame) -> DataFrame:
    """Resolved telephone changes that say something and have no problem."""
    return resolved.where(F.col("problem").isNull() & (F.col("action") != "none"))


def outcall_change(as_of: AsOf, *, legacy: bool = False) -> dict[str, Column]:
    """Assignments of a resolved change, see :func:`apply_outcall_changes`."""
    action = F.col("chg.action")
    by_class = action.isin("user", "class")

    def when_class(field: str) -> Column:
        return F.when(by_class, F.col(f"chg.{field}")).otherwise(F.col(field))

    def when_user(field: str) -> Column:
        return F.when(action == "user", F.col(f"chg.{field}")).otherwise(F.col(field))

    old_class = F.col("old_class_dept_id") if legacy else F.when(
        by_class, F.col("class_dept_id")).otherwise(F.col("old_class_dept_id"))
    return {
        "old_status_cd": F.col("status_cd"), "old_class_dept_id": old_class,
        "status_cd": F.col("chg.status_cd"), "update_date": instant(as_of, -1),
        "team_dept_id": F.col("chg.team_dept_id"),
        "team_dept_name": F.col("chg.team_dept_name"),
        "class_dept_id": when_class("class_dept_id"),
        "class_dept_name": when_class("class_dept_name"),
        "caller_id": when_user("caller_id"), "caller_name": when_user("caller_name"),
        "order_result": F.when(by_class, F.coalesce("chg.order_result", "order_result"))
        .otherwise(F.col("order_result"))}


def apply_outcall_changes(detail: DataFrame, resolved: DataFrame, as_of: AsOf, *,
                          legacy: bool = False) -> DataFrame:
    """Status, team, class, caller and call result of resolved changes.

    A team-level change leaves class, caller and result alone, a class-level one the caller. The
    previous class is kept in ``old_class_dept_id``; ``legacy`` never fills that column.
    """
    return apply_changes(detail, usable_changes(resolved), "list_id",
                         outcall_change(as_of, legacy=legacy))


def flag_columns(hits: DataFrame, columns: tuple[str, ...] = FLAG_COLUMNS) -> DataFrame:
    """One row per order: the column a successful rule names in ``report_column`` is 1.

    The column name is compared as data; a rule with an unknown name succeeds without a flag (see
    :func:`unknown_columns`).
    """
    named = hits.withColumn("report_column", F.lower("report_column")).where(
        F.col("report_column").isin(*columns))
    return named.groupBy("list_id").agg(*[
        F.max(F.when(F.col("report_column") == c, F.lit(1))).alias(c) for c in columns])


def unknown_columns(hits: DataFrame, job: str,
                    columns: tuple[str, ...] = FLAG_COLUMNS) -> DataFrame:
    """Error rows of successful rules whose ``report_column`` the report does not have."""
    odd = hits.where(~F.coalesce(F.lower("report_column").isin(*columns), F.lit(False)))
    return error_log(odd, job, "list_id",
                     F.concat(F.lit("unknown report column "),
                              F.coalesce("report_column", F.lit("NULL"))), F.lit("-904"))


def apply_flags(detail: DataFrame, hits: DataFrame) -> DataFrame:
    """Set the rule columns of successful orders; a set flag is never cleared."""
    return apply_changes(detail, flag_columns(hits), "list_id", set_flags())


def set_flags() -> dict[str, Column]:
    """Assignments of the rule columns; a set flag is never cleared."""
    return {c: F.coalesce(f"chg.{c}", c) for c in FLAG_COLUMNS}


def success_log(hits: DataFrame, as_of: AsOf, days: int = 0) -> DataFrame:
    """Log rows (order, rule, date, rule name, matched order) of successful rules."""
    return hits.select("list_id", "suc_rule_id", instant(as_of, days).alias("suc_date"),
                       F.col("rule_name").alias("suc_rule_name"),
                       F.col("value").alias("suc_order_id"))


def run_log(pairs: DataFrame, start: AsOf, end: AsOf, *, log_type: int = 11) -> DataFrame:
    """One row per (campaign, area) pair: day, type, campaign, start, end, area."""
    return pairs.select(
        F.date_format(instant(end), "yyyyMMdd").alias("run_day"),
        F.lit(log_type).alias("log_type"), F.col("sub_campaign_id").alias("campaign_id"),
        instant(start).alias("start_date"), instant(end).alias("end_date"), "latn_id")

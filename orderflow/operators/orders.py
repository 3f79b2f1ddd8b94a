"""Orders with their execution state, registration of new orders, change detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.clock import AsOf, as_text, day_window, instant
from orderflow.functions.numbers import null_as_zero
from orderflow.operators.campaigns import ACTIVE, PROVINCE_AREA, TELEPHONE
from orderflow.operators.lookups import lookup, only_keys, org_regions, with_user_name
from orderflow.session import stage

KEY = ["shard_id", "initiative_order_id"]


def orders_with_state(orders: DataFrame, executors: DataFrame) -> DataFrame:
    """Orders with their executor row of the same area; executor area becomes ``ex_latn_id``.

    The steps below start from this join. Filters they put on either side reach its scan.
    """
    state = executors.select(*KEY, "status_cd", "dept_id", "curr_user_id",
                             F.col("latn_id").alias("ex_latn_id"), "last_opt_date", "is_success")
    return orders.join(state, KEY)


def in_scope(orders: DataFrame, pairs: DataFrame) -> DataFrame:
    """Orders of the pairs' campaigns kept in the pairs' areas."""
    scope = pairs.select(F.col("sub_campaign_id").alias("campaign_id"),
                         F.col("latn_id").alias("shard_id")).distinct()
    return orders.join(scope, ["campaign_id", "shard_id"], "left_semi")


def _one_main_per_pair(pairs: DataFrame, names: tuple[str, ...] = ()) -> DataFrame:
    """(sub-campaign, area) with its first catalogue; an order is registered only once.

    Staged plainly: by the size of encoded files Spark would broadcast millions of pairs.
    """
    first = F.min(F.struct("main_campaign_id", *names)).alias("m")
    return stage(pairs.groupBy("sub_campaign_id", "latn_id").agg(first).select(
        F.col("sub_campaign_id").alias("campaign_id"), "latn_id", "m.*"), "mains", plain=True)


def _unknown(orders: DataFrame, detail: DataFrame) -> DataFrame:
    return orders.join(detail.select(F.col("list_id").alias("initiative_order_id")),
                       "initiative_order_id", "left_anti")


def new_receive_orders(held: DataFrame, grid: DataFrame, detail: DataFrame,
                       organization: DataFrame, regions: DataFrame, system_users: DataFrame,
                       staff: DataFrame, pairs: DataFrame, as_of: AsOf, *,
                       dedupe: bool = False, on_dup: str = "error") -> DataFrame:
    """Detail rows of active non-telephone orders the detail does not hold yet.

    ``held``: output of orders_with_state. ``pairs``: (main_campaign_id, sub_campaign_id,
    latn_id). An order whose department has several grid rows gives several detail rows, unless
    ``dedupe`` keeps the smallest one.
    """
    fresh = _unknown(
        held.where((F.col("state") == ACTIVE) & (F.col("channel_id") != TELEPHONE)
                   & (F.col("shard_id") == F.col("latn_id")))
        .join(_one_main_per_pair(pairs), ["campaign_id", "latn_id"]), detail)
    codes = grid.select("org_jt_code", "org_id", "fir_grid_id", "sec_grid_id", "thi_grid_id")
    if dedupe:
        codes = codes.groupBy("org_jt_code").agg(
            F.min(F.struct("org_id", "fir_grid_id", "sec_grid_id", "thi_grid_id")).alias("g")
        ).select("org_jt_code", "g.*")
    placed = fresh.join(codes, fresh["dept_id"] == codes["org_jt_code"], "left")
    placed = lookup(placed, org_regions(organization, regions), "org_id", "org_id",
                    "common_region_id", "region_id", on_dup)
    placed = with_user_name(placed, "curr_user_id", system_users, staff)
    return placed.select(
        as_text(as_of).alias("report_date"),
        instant(as_of).alias("update_date"),
        "latn_id", "region_id", "org_id", "org_jt_code",
        "fir_grid_id", "sec_grid_id", "thi_grid_id",
        F.col("main_campaign_id").alias("z_mkt_campaign_id"),
        F.col("campaign_id").alias("a_mkt_campaign_id"),
        F.col("initiative_order_id").alias("list_id"),
        "status_cd",
        F.col("org_id").alias("old_org_id"),
        F.col("org_jt_code").alias("old_org_jt_code"),
        F.col("status_cd").alias("old_status_cd"),
        F.lit(0).alias("is_success"),
        F.col("curr_user_id").alias("user_id"),
        "user_name", "cust_id", "cust_name", "acc_nbr",
        F.col("channel_id").alias("cop_channel_id"))


def new_outcall_orders(held: DataFrame, results: DataFrame, cities: DataFrame,
                       detail: DataFrame, pairs: DataFrame, as_of: AsOf, *,
                       mode: str) -> DataFrame:
    """Detail rows of active telephone orders the detail does not hold yet.

    ``cities`` is the output of ``city_with_province``.
    ``area``: orders of the campaign's own area, attached to the city of the executor's area.
    ``province``: orders kept in the province-wide area 999, attached to that area's city rows
    whatever area the order itself belongs to; adds ``city_region``, the order's area.
    """
    named = _one_main_per_pair(pairs, ("main_campaign_name", "sub_campaign_name"))
    calls = held.where((F.col("state") == ACTIVE) & (F.col("channel_id") == TELEPHONE))
    if mode == "area":
        calls = calls.where((F.col("shard_id") == F.col("latn_id"))
                            & (F.col("shard_id") != PROVINCE_AREA))
        calls = calls.join(named, ["campaign_id", "latn_id"])
    elif mode == "province":
        wide = named.where(F.col("latn_id") == PROVINCE_AREA).drop("latn_id")
        calls = calls.where(F.col("shard_id") == PROVINCE_AREA).join(wide, "campaign_id")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    # the new orders of a day are few: only their call results are read on
    fresh = stage(_unknown(calls, detail), "fresh_calls")
    mine = only_keys(results, "list_id", fresh, "initiative_order_id")
    answered = fresh.join(
        mine.select(F.col("list_id").alias("initiative_order_id"), "order_result").distinct(),
        "initiative_order_id", "left")
    # area mode: campaign area = executor area = city area; province mode: the 999 city rows
    if mode == "area":
        area = F.when(F.col("ex_latn_id") == F.col("latn_id"), F.col("latn_id"))
    else:
        area = F.col("shard_id")
    placed = answered.withColumn("_area", area).join(
        cities.distinct(), F.col("_area") == F.col("region_id"))
    nothing = {c: F.lit(None).cast("string" if c.endswith("name") else "bigint").alias(c)
               for c in ("team_dept_id", "team_dept_name", "class_dept_id", "class_dept_name",
                         "caller_id", "caller_name")}
    columns = [
        "main_campaign_id", "main_campaign_name",
        F.col("campaign_id").alias("sub_campaign_id"), "sub_campaign_name",
        "region_id", "prov_dept_id", "prov_dept_name", "city_dept_id", "city_dept_name",
        *nothing.values(),
        F.col("initiative_order_id").alias("list_id"), "status_cd",
        instant(as_of, -1).alias("create_date"), F.lit(0).alias("is_success"), "order_result",
        instant(as_of, -1).alias("update_date"), "cust_name", "prod_inst_id", "cust_id"]
    if mode == "province":
        columns.append(F.col("latn_id").alias("city_region"))
    return placed.select(*columns).distinct()


def changed_receive(held: DataFrame, detail: DataFrame, channels: DataFrame, as_of: AsOf, *,
                    days: int = 1) -> DataFrame:
    """Orders on an application channel whose state differs from the detail; one row per order.

    Status compares plainly (a NULL never differs); for department and user 0 equals NULL. The
    window excludes its first midnight.
    """
    touched = day_window(held.where(F.col("state") == ACTIVE), "last_opt_date", as_of, days,
                         closed_start=False)
    now = touched.join(channels, "channel_id", "left_semi")
    before = detail.select(F.col("list_id"), F.col("status_cd").alias("was_status"),
                           F.col("org_jt_code").alias("was_dept"),
                           F.col("user_id").alias("was_user"))
    differs = ((F.col("status_cd") != F.col("was_status"))
               | (null_as_zero("dept_id") != null_as_zero("was_dept"))
               | (null_as_zero("curr_user_id") != null_as_zero("was_user")))
    # a semi-join, so repeated detail rows of an order give one change
    return now.join(before, (F.col("initiative_order_id") == F.col("list_id")) & differs,
                    "left_semi").select(
        F.col("initiative_order_id").alias("list_id"), "campaign_id", "shard_id", "status_cd",
        "dept_id", "curr_user_id")


# Statuses that are no change to report.
UNASSIGNED, COMPLETED = 1100, 7000


def changed_outcall(held: DataFrame, detail: DataFrame, results: DataFrame, org: DataFrame,
                    as_of: AsOf, *, days: int = 1, on_dup: str = "error") -> DataFrame:
    """Telephone orders whose status differs from the detail, with call result and org type."""
    calls = held.where((F.col("state") == ACTIVE) & (F.col("channel_id") == TELEPHONE)
                       & ~F.col("status_cd").isin(UNASSIGNED, COMPLETED))
    now = day_window(calls, "last_opt_date", as_of, days)
    before = detail.select("list_id", F.col("status_cd").alias("was_status"))
    changed = stage(now.join(
        before, (F.col("initiative_order_id") == F.col("list_id"))
        & (F.col("status_cd") != F.col("was_status")), "left_semi"), "changed_calls")
    changed = lookup(changed, only_keys(results, "list_id", changed, "initiative_order_id"),
                     "initiative_order_id", "list_id", "order_result", "order_result", on_dup)
    changed = lookup(changed, org, "dept_id", "bss_org_id", "bss_org_type_id", "org_type_id",
                     on_dup)
    return changed.select(
        F.col("initiative_order_id").alias("list_id"), "campaign_id", "shard_id", "status_cd",
        "dept_id", "curr_user_id", "order_result",
        F.coalesce("org_type_id", F.lit(0)).alias("org_type_id"))

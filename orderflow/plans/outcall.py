"""Daily run for telephone orders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.clock import AsOf
from orderflow.operators.apply import (OUTCALL_DETAIL, apply_all, change_set, flag_columns,
                                       outcall_change, set_flags, success_log, unknown_columns,
                                       usable_changes)
from orderflow.operators.campaigns import (PROVINCE_AREA, active_campaigns, campaigns_by_area,
                                           success_rules)
from orderflow.operators.orders import (changed_outcall, in_scope, new_outcall_orders,
                                        orders_with_state)
from orderflow.operators.orgs import city_with_province, resolve_outcall_org
from orderflow.operators.quality import OUTCALL_JOB, outcall_errors
from orderflow.operators.rules import (Evaluation, evaluate_rules, rule_pairs, rule_texts,
                                       skip_logged, success_candidates)
from orderflow.operators.success import (outcall_success, outcall_success_executor,
                                         outcall_win)
from orderflow.plans.receive import (RunOptions, changed_rows, numeric_departments, rule_failures,
                                     running_slice, slice_marker, touched, with_success_columns)
from orderflow.session import stage, together
from orderflow.sources.snapshots import conform


def outcall_candidates(held: DataFrame, purchases: DataFrame, areas: list[int], as_of: AsOf,
                       days: int) -> DataFrame:
    """Success candidates of ordinary areas, and of area 999 on the orders' own areas.

    Province-wide orders count only when their own area is one of ``areas``.
    """
    ordinary, wide = (success_candidates(held, purchases, as_of, mode=mode, days=days)
                      for mode in ("area", "province"))
    return ordinary.unionByName(wide.where(F.col("area").isin(areas)))


def run_outcall(tables: Mapping[str, DataFrame], catalog: int | None, as_of: AsOf,
                options: RunOptions = RunOptions()) -> dict[str, DataFrame]:
    """One day for one catalogue (all for ``None``), every campaign and area together.

    Returns the new versions of ``detail`` and ``executor``, their rows that are new or changed
    (``detail_updates``, ``executor_updates``), and the rows to append to ``success_log`` and
    ``errors``.
    """
    t = tables
    active = active_campaigns(t["pms_campaign"], t["mkt_cam_conf_attr"], t["common_region"],
                              catalog, as_of, attr_name=options.attr_name)
    pairs = stage(campaigns_by_area(active, t["pms_campaign_chl_rel"], mode="outcall",
                                    areas=options.areas), "pairs")
    before = running_slice(conform(t["callout_detail"], OUTCALL_DETAIL), "sub_campaign_id",
                           pairs, options)
    executors, dept_errors = numeric_departments(t["initiative_order_executor"], OUTCALL_JOB)
    # the big join once, for the running campaigns' orders only; all steps read its result
    held = stage(in_scope(orders_with_state(t["initiative_order"], executors), pairs), "held")

    def registration() -> tuple[DataFrame, DataFrame]:
        cities = stage(city_with_province(t["sys_bss_org"]), "cities")
        new = stage(conform(_registered(held, t["exe_order_result"], cities, before, pairs,
                                        as_of), OUTCALL_DETAIL), "new_orders")
        changed = changed_outcall(held, before.unionByName(new), t["exe_order_result"],
                                  t["sys_bss_org"], as_of, days=options.change_days,
                                  on_dup=options.on_duplicate)
        return new, stage(resolve_outcall_org(changed, t["sys_bss_org"], t["sys_user"]),
                          "changes")

    def evaluation() -> tuple[DataFrame, Evaluation]:
        rules = stage(success_rules(t["mkt_success_rule"], t["mkt_campaign_suc_rule_rel"],
                                    pairs), "rules")
        candidates = outcall_candidates(held, t["customer_order_syn"],
                                        options.area_numbers(), as_of, options.purchase_days)
        # new rows and status changes carry no success, so the flags at the start suffice
        asked = stage(skip_logged(rule_pairs(candidates, rules), before, t["success_log"]),
                      "rule_pairs", "suc_rule_id")
        return asked, evaluate_rules(asked, rule_texts(rules), t, isolate="orders",
                                     null_is_success=options.null_is_success)

    (new, resolved), (asked, evaluated) = together(pairs.sparkSession, registration, evaluation)
    hits = evaluated.successes()
    ends = outcall_success(hits)
    # one row per changed order, so the detail is joined once
    changed = stage(change_set("list_id", {
        "changes": usable_changes(resolved), "ends": ends, "flags": flag_columns(hits)}),
        "change_set")
    steps = [("changes", outcall_change(as_of, legacy=options.legacy_old_class)),
             ("ends", outcall_win(as_of)), ("flags", set_flags())]

    state = with_success_columns(t["initiative_order_executor"])
    return {
        "detail": apply_all(before.unionByName(new), changed, "list_id", steps),
        "detail_updates": apply_all(changed_rows(before, new, changed), changed, "list_id", steps),
        "executor": outcall_success_executor(state, ends, as_of),
        "executor_updates": outcall_success_executor(touched(state, ends), ends, as_of),
        "new_orders": new,
        "success_log": success_log(hits, as_of, -1),
        "errors": outcall_errors(resolved).unionByName(
            rule_failures(evaluated, asked, OUTCALL_JOB)).unionByName(dept_errors)
        .unionByName(unknown_columns(hits, OUTCALL_JOB)),
        **slice_marker("sub_campaign_id", pairs, options),
    }


def _registered(held: DataFrame, results: DataFrame, cities: DataFrame, before: DataFrame,
                pairs: DataFrame, as_of: AsOf) -> DataFrame:
    named = pairs.select("main_campaign_id", "main_campaign_name", "sub_campaign_id",
                         "sub_campaign_name", "latn_id")
    ordinary = named.where(F.col("latn_id") != PROVINCE_AREA)
    area, province = (
        new_outcall_orders(held, results, cities, before, scope, as_of, mode=mode)
        for mode, scope in (("area", ordinary), ("province", named)))
    return area.unionByName(province, allowMissingColumns=True)

"""Daily run for received orders (every channel but telephone)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.clock import AsOf
from orderflow.operators.apply import (EXECUTOR_SUCCESS, RECEIVE_DETAIL, apply_all, change_set,
                                       flag_columns, receive_change, run_log, set_flags,
                                       success_log, unknown_columns)
from orderflow.operators.campaigns import (APPLICATION, AREAS, CATALOG_ATTRIBUTE,
                                           active_campaigns, app_channels, campaigns_by_area,
                                           success_rules)
from orderflow.operators.lookups import with_user_name
from orderflow.operators.orders import (changed_receive, in_scope, new_receive_orders,
                                        orders_with_state)
from orderflow.operators.orgs import grid_lookup
from orderflow.operators.quality import RECEIVE_JOB, cast_check, error_log
from orderflow.operators.rules import (Evaluation, evaluate_in_waves, evaluate_rules,
                                       rule_pairs, rule_texts, success_candidates)
from orderflow.operators.success import (first_success, receive_success_executor,
                                         receive_win)
from orderflow.session import stage, together
from orderflow.sources.snapshots import conform


@dataclass(frozen=True)
class RunOptions:
    """What the installation fixes: names, areas and the length of the look-back windows.

    ``slice_only`` reads and returns the detail of the running campaigns only: with a detail
    partitioned by sub-campaign, Spark prunes all other partitions, and ``replace_slice`` writes
    the result back. It relies on orders never moving to another campaign. ``on_duplicate`` is
    what lookups do when a key has several rows: ``error`` stops the run, ``any`` takes the
    smallest value. ``early_stop`` evaluates an order's rules only up to its first success, in
    waves; it pays where a rule costs more than a wave's fixed cost.
    """

    attr_name: str = CATALOG_ATTRIBUTE
    app: str = APPLICATION
    areas: str | Iterable[int] = AREAS
    change_days: int = 1
    purchase_days: int = 1
    null_is_success: bool = True
    legacy_old_class: bool = False
    slice_only: bool = False
    on_duplicate: str = "error"
    early_stop: bool = False

    def area_numbers(self) -> list[int]:
        given = self.areas.split(",") if isinstance(self.areas, str) else self.areas
        return [int(a) for a in given if str(a).strip()]


def with_success_columns(executors: DataFrame) -> DataFrame:
    missing = {c: t for c, t in EXECUTOR_SUCCESS.items() if c not in executors.columns}
    return executors.withColumns(
        {c: F.lit(None).cast(t) for c, t in missing.items()}) if missing else executors


def touched(executors: DataFrame, winners: DataFrame) -> DataFrame:
    """Executor rows of successful orders."""
    return executors.join(winners.select(F.col("list_id").alias("initiative_order_id")),
                          "initiative_order_id", "left_semi").select(executors.columns)


def slice_marker(key: str, pairs: DataFrame, options: RunOptions) -> dict[str, DataFrame]:
    """The output ``slices`` of a run on a slice: the campaigns that its detail is limited to."""
    if not options.slice_only:
        return {}
    return {"slices": pairs.select(F.col("sub_campaign_id").alias(key)).distinct()}


def running_slice(detail: DataFrame, key: str, pairs: DataFrame,
                  options: RunOptions) -> DataFrame:
    """The detail rows a run works on: all, or those of the running campaigns."""
    if not options.slice_only:
        return detail
    running = pairs.select(F.col("sub_campaign_id").alias(key)).distinct()
    return detail.join(running, key, "left_semi").select(detail.columns)


def changed_rows(before: DataFrame, new: DataFrame, changes: DataFrame) -> DataFrame:
    """The detail rows that a run adds or changes, in the state before the changes."""
    return before.join(changes.select("list_id"), "list_id", "left_semi").select(
        before.columns).unionByName(new)


def rule_failures(evaluation: Evaluation, pairs: DataFrame, job: str) -> DataFrame:
    """Error-log rows of the evaluation: unusable results, and one row per failing rule."""
    if not evaluation.failed_rules:
        return evaluation.errors
    spark = pairs.sparkSession
    rows = [(None, f"rule {rule}: {text}", job, "-1")
            for rule, text in evaluation.failed_rules.items()]
    broken = spark.createDataFrame(
        rows, "order_id bigint, errormsg string, pro_name string, errorcode string")
    return evaluation.errors.unionByName(broken)


def numeric_departments(executors: DataFrame, job: str) -> tuple[DataFrame, DataFrame]:
    """Executor rows with a numeric department, and error rows of those that had another text.

    Such a row keeps its order: only its department is unknown, so it has no organisation, while
    rules, which never read the department, are evaluated as for any other.
    """
    bad = error_log(executors.where(~cast_check("dept_id")), job, "initiative_order_id",
                    F.concat(F.lit("department is not a number: "),
                             F.col("dept_id").cast("string")), F.lit("-6502"))
    return executors.withColumn("dept_id", F.col("dept_id").try_cast("bigint")), bad


def run_receive(tables: Mapping[str, DataFrame], catalog: int | None, as_of: AsOf,
                options: RunOptions = RunOptions()) -> dict[str, DataFrame]:
    """One day for one catalogue (all for ``None``), every campaign and area together.

    Returns the new versions of ``detail`` and ``executor``, their rows that are new or changed
    (``detail_updates``, ``executor_updates``), and the rows to append to ``success_log``,
    ``run_log`` and ``errors``. ``save_run`` writes the versions, ``merge_run`` what changes. With ``slice_only``
    there is also ``slices``, the campaigns that ``detail`` is limited to, and ``save_run`` refuses. Small or shared
    intermediate results are staged in the shared folder.
    """
    t = tables
    active = active_campaigns(t["pms_campaign"], t["mkt_cam_conf_attr"], t["common_region"],
                              catalog, as_of, attr_name=options.attr_name)
    channels = app_channels(t["initiative_order_channel"], options.app)
    pairs = stage(campaigns_by_area(active, t["pms_campaign_chl_rel"], mode="receive",
                                    channels=channels, areas=options.areas)
                  .select("main_campaign_id", "sub_campaign_id", "latn_id"), "pairs")
    executors, dept_errors = numeric_departments(t["initiative_order_executor"], RECEIVE_JOB)
    before = running_slice(conform(t["detail"], RECEIVE_DETAIL), "a_mkt_campaign_id", pairs,
                           options)
    # the big join once, for the running campaigns' orders only; all steps read its result
    held = stage(in_scope(orders_with_state(t["initiative_order"], executors), pairs), "held")

    def registration() -> tuple[DataFrame, DataFrame]:
        new = stage(new_receive_orders(
            held, t["grid_org_code_rel"], before, t["organization"], t["common_region"],
            t["system_user"], t["staff"], pairs, as_of, on_dup=options.on_duplicate),
            "new_orders")
        changed = changed_receive(held, before.unionByName(conform(new, RECEIVE_DETAIL)),
                                  channels, as_of, days=options.change_days)
        return new, stage(
            with_user_name(grid_lookup(changed, t["grid_org_code_rel"]), "curr_user_id",
                           t["system_user"], t["staff"]), "changes")

    def evaluation() -> tuple[DataFrame, Evaluation]:
        rules = stage(success_rules(t["mkt_success_rule"], t["mkt_campaign_suc_rule_rel"],
                                    pairs), "rules")
        candidates = success_candidates(held, t["customer_order_syn"], as_of, mode="receive",
                                        days=options.purchase_days)
        asked = stage(rule_pairs(candidates, rules), "rule_pairs", "suc_rule_id")
        evaluate = evaluate_in_waves if options.early_stop else evaluate_rules
        return asked, evaluate(asked, rule_texts(rules), t, isolate="orders",
                               null_is_success=options.null_is_success)

    # neither needs the other: registration leaves the success flags alone
    (new, changes), (asked, evaluated) = together(pairs.sparkSession, registration, evaluation)
    winners = first_success(evaluated.successes())
    # one row per changed order, so the detail is joined once
    changed = stage(change_set("list_id", {
        "changes": changes, "winners": winners, "flags": flag_columns(winners)}), "change_set")
    steps = [("changes", receive_change(as_of)), ("winners", receive_win(as_of)),
             ("flags", set_flags())]
    added = conform(new, RECEIVE_DETAIL)
    state = with_success_columns(t["initiative_order_executor"])
    return {
        "detail": apply_all(before.unionByName(added), changed, "list_id", steps),
        "detail_updates": apply_all(changed_rows(before, added, changed), changed, "list_id",
                                    steps),
        "executor": receive_success_executor(state, winners, as_of),
        "executor_updates": receive_success_executor(touched(state, winners), winners, as_of),
        "new_orders": new,
        "success_log": success_log(winners, as_of),
        "run_log": run_log(pairs, as_of, as_of),
        "errors": dept_errors.unionByName(rule_failures(evaluated, asked, RECEIVE_JOB))
        .unionByName(unknown_columns(winners, RECEIVE_JOB)),
        **slice_marker("a_mkt_campaign_id", pairs, options),
    }

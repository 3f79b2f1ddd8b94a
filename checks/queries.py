"""One query per operator over the role views; every query reads whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.roles import (AREAS, AS_OF, CHANGE_DAYS, FAILING_RULES, NESTED_RULES, PURCHASE_DAYS,
                          RANGE_RULES, SHARED_RULES, Roles)
from orderflow.functions import clock
from orderflow.operators import apply as ap
from orderflow.operators import campaigns as ca
from orderflow.operators import lookups as lo
from orderflow.operators import orders as od
from orderflow.operators import orgs as og
from orderflow.operators import quality as qu
from orderflow.operators import reports as re
from orderflow.operators import rules as ru
from orderflow.operators import success as su
from orderflow.operators.text_jobs import explode_conditions
from orderflow.plans import (merge_run, rebuild_reports, refresh_dimensions, refresh_reports,
                             refresh_store, run_outcall, run_receive, start_store)
from orderflow.plans.receive import RunOptions, with_success_columns
from orderflow.session import fresh_path, stage
from orderflow.sources import (SNAPSHOTS, Snapshot, Store, append_new, conform, read_area,
                               refresh_snapshot, replace_slice, work_database, write_bucketed,
                               write_by_area)

OPTIONS = RunOptions(attr_name="CATALOG", app="call", areas=AREAS, change_days=CHANGE_DAYS,
                     purchase_days=PURCHASE_DAYS)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Roles(spark, folder))
    return build


# ---- steps several queries start from ----------------------------------------------------

def _active(r: Roles) -> DataFrame:
    return ca.active_campaigns(r["pms_campaign"], r["mkt_cam_conf_attr"], r["common_region"],
                               None, AS_OF, attr_name="CATALOG")


def _channels(r: Roles) -> DataFrame:
    return ca.app_channels(r["initiative_order_channel"], "call")


def _pairs(r: Roles, mode: str) -> DataFrame:
    channels = _channels(r) if mode == "receive" else None
    return ca.campaigns_by_area(_active(r), r["pms_campaign_chl_rel"], mode=mode,
                                channels=channels, areas=AREAS)


def _rules(r: Roles) -> DataFrame:
    return ca.success_rules(r["mkt_success_rule"], r["mkt_campaign_suc_rule_rel"], _active(r))


def _held(r: Roles) -> DataFrame:
    return od.orders_with_state(r["initiative_order"], r["initiative_order_executor"])


def _candidates(r: Roles, mode: str) -> DataFrame:
    return ru.success_candidates(_held(r), r["customer_order_syn"], AS_OF, mode=mode,
                                 days=PURCHASE_DAYS)


def _rule_tables(r: Roles) -> dict[str, DataFrame]:
    return {"customer_order_syn": r["customer_order_syn"], "part": r["part"]}


def _receive_evaluation(r: Roles) -> ru.Evaluation:
    rules = stage(_rules(r), "rules")
    asked = stage(ru.rule_pairs(_candidates(r, "receive"), rules), "rule_pairs", "suc_rule_id")
    return ru.evaluate_rules(asked, ru.rule_texts(rules), _rule_tables(r))


def _outcall_pairs(r: Roles, rules: DataFrame) -> DataFrame:
    candidates = _candidates(r, "area").unionByName(_candidates(r, "province"))
    return ru.skip_logged(ru.rule_pairs(candidates, rules), r["outcall_target"],
                          r["success_log"])


def _outcall_hits(r: Roles) -> DataFrame:
    rules = stage(_rules(r), "rules")
    asked = stage(_outcall_pairs(r, rules), "rule_pairs", "suc_rule_id")
    return ru.evaluate_rules(asked, ru.rule_texts(rules), _rule_tables(r)).successes()


def _receive_changes(r: Roles) -> DataFrame:
    return od.changed_receive(_held(r), r["receive_target"], _channels(r), AS_OF,
                              days=CHANGE_DAYS)


def _outcall_changes(r: Roles) -> DataFrame:
    return od.changed_outcall(_held(r), r["outcall_target"], r["exe_order_result"],
                              r["sys_bss_org"], AS_OF, days=CHANGE_DAYS)


def _resolved(r: Roles) -> DataFrame:
    return og.resolve_outcall_org(_outcall_changes(r), r["sys_bss_org"], r["sys_user"])


def _winner_columns(df: DataFrame) -> DataFrame:
    return df.select("list_id", "suc_rule_id", "seq_no", "rule_name", "value")


# ---- sources, snapshots, sinks -----------------------------------------------------------

@query
def dim_snapshot(r):
    return stage(refresh_snapshot(r["staff"], ["staff_id", "staff_name"]), "staff")


@query
def dim_snapshot_stamped(r):
    return stage(refresh_snapshot(r["grid_org_code_rel"], load_ts=AS_OF), "grid_rel")


@query
def dim_snapshot_distinct(r):
    columns = ["latn_id", "latn_name", "area_id", "area_name", "obu_id", "obu_name", "block_id",
               "block_name", "staff_id", "staff_name", "staff_code"]
    return stage(refresh_snapshot(r["block_contractor"], columns, distinct=True), "contractors")


@query
def area_scan(r):
    path = fresh_path(r.spark, "initiative_order")
    write_by_area(r["initiative_order"], path)
    wanted = [int(a) for a in AREAS.split(",")]
    return read_area(r.spark, path, wanted).select(
        "initiative_order_id", "campaign_id", "latn_id", "shard_id", "channel_id", "state")


@query
def append_new_only(r):
    new = r["initiative_order"].select(F.col("initiative_order_id").alias("list_id"),
                                       "campaign_id", "latn_id")
    return append_new(r["detail"], new, "list_id")


@query
def replace_campaign_slice(r):
    # catalogues 1 and 3 get new rows, catalogue 2 ends empty, catalogue 0 stays
    keys = ["main_campaign_id", "sub_campaign_id"]
    old = r["callout_detail"].groupBy(*keys).agg(F.count("list_id").alias("orders"))
    new = (r["receive_detail"].withColumnsRenamed({"z_mkt_campaign_id": "main_campaign_id",
                                                   "a_mkt_campaign_id": "sub_campaign_id"})
           .where(F.col("main_campaign_id").isin(1, 3))
           .groupBy(*keys).agg(F.count("list_id").alias("orders")))
    table = f"{work_database(r.spark, 'orderflow_checks')}.slice_{uuid.uuid4().hex}"
    replace_slice(old, table, "main_campaign_id", [0, 1, 2, 3])
    replace_slice(new, table, "main_campaign_id", [1, 2, 3])
    return r.spark.table(table).select(*keys, "orders")


@query
def receive_apply_changes(r):
    placed = og.grid_lookup(_receive_changes(r), r["grid_org_code_rel"])
    named = stage(lo.with_user_name(placed, "curr_user_id", r["system_user"], r["staff"]),
                  "changes")
    detail = conform(r["receive_target"], ap.RECEIVE_DETAIL)
    return ap.apply_receive_changes(detail, named, AS_OF).drop(*ap.FLAG_COLUMNS)


@query
def outcall_apply_changes(r):
    detail = conform(r["outcall_target"], ap.OUTCALL_DETAIL)
    changed = ap.apply_outcall_changes(detail, stage(_resolved(r), "changes"), AS_OF)
    return changed.drop(*ap.FLAG_COLUMNS)


@query
def success_log(r):
    winners = su.first_success(_receive_evaluation(r).successes())
    return ap.success_log(winners, AS_OF)


@query
def quarantine_errors(r):
    _, bad = qu.typed(r["raw_executor"], {"dept_id": "bigint", "curr_user_id": "bigint"})
    ingest = qu.error_log(
        bad, qu.RECEIVE_JOB, "initiative_order_id",
        qu.order_message("campaign_id", "initiative_order_id", F.col("reason")),
        F.lit("-6502"))
    return ingest.unionByName(qu.outcall_errors(_resolved(r)))


@query
def run_log(r):
    return ap.run_log(_pairs(r, "receive"), AS_OF, AS_OF)


# ---- filters, predicates, generators ------------------------------------------------------

@query
def active_campaigns(r):
    return _active(r)


@query
def day_window(r):
    return clock.day_window(r["customer_order_syn"], "status_date", AS_OF, PURCHASE_DAYS)


@query
def day_window_open_start(r):
    return clock.day_window(r["initiative_order_executor"], "last_opt_date", AS_OF, CHANGE_DAYS,
                            closed_start=False)


@query
def receive_changed_orders(r):
    return _receive_changes(r)


@query
def outcall_changed_orders(r):
    return _outcall_changes(r)


@query
def area_list(r):
    return ca.explode_list(r["campaign_scope"], "areas", "latn_id").select("campaign_id",
                                                                           "latn_id")


@query
def area_list_errors(r):
    return ca.list_errors(r["campaign_scope"], "areas", "campaign_id", qu.OUTCALL_JOB)


@query
def receive_new_orders(r):
    return od.new_receive_orders(
        _held(r), r["grid_org_code_rel"], r["detail"], r["organization"], r["common_region"],
        r["system_user"], r["staff"], stage(_pairs(r, "receive"), "pairs"), AS_OF)


@query
def receive_new_orders_bucketed(r):
    """As receive_new_orders, with the large tables in buckets by order."""
    database = work_database(r.spark, "orderflow_checks")
    tables = {}
    for name, key in (("initiative_order", "initiative_order_id"),
                      ("initiative_order_executor", "initiative_order_id"),
                      ("detail", "list_id")):
        table = f"{database}.{name}_{uuid.uuid4().hex}"
        write_bucketed(r[name], table, key, 8)
        tables[name] = r.spark.table(table)
    held = od.orders_with_state(tables["initiative_order"], tables["initiative_order_executor"])
    return od.new_receive_orders(
        held, r["grid_org_code_rel"], tables["detail"], r["organization"], r["common_region"],
        r["system_user"], r["staff"], stage(_pairs(r, "receive"), "pairs"), AS_OF)


def _new_outcall(r, org: str, mode: str) -> DataFrame:
    return od.new_outcall_orders(
        _held(r), r["exe_order_result"], stage(og.city_with_province(r[org]), "cities"),
        r["detail"], stage(_pairs(r, "outcall"), "pairs"), AS_OF, mode=mode)


@query
def outcall_new_orders_area(r):
    return _new_outcall(r, "sys_bss_org", "area")


@query
def outcall_new_orders_province(r):
    return _new_outcall(r, "sys_bss_org_hq", "province")


@query
def outcall_org_resolution(r):
    return _resolved(r)


@query
def outcall_rule_pairs(r):
    return _outcall_pairs(r, _rules(r)).select(
        "list_id", "campaign_id", "area", "status_cd", "suc_rule_id", "rel_id", "seq_no",
        "old_is_success")


# ---- joins --------------------------------------------------------------------------------

@query
def orders_with_state(r):
    return _held(r)


@query
def receive_success_candidates(r):
    return _candidates(r, "receive")


@query
def outcall_success_candidates(r):
    return _candidates(r, "area")


@query
def outcall_candidates_province(r):
    return _candidates(r, "province")


@query
def campaigns_by_area_receive(r):
    return _pairs(r, "receive")


@query
def campaigns_by_area_outcall(r):
    return _pairs(r, "outcall")


@query
def success_rules_ranked(r):
    return _rules(r)


@query
def org_hierarchy_flatten(r):
    return og.org_callers(r["sys_bss_org"], r["sys_user_job"], r["sys_user"], AS_OF)


@query
def city_province(r):
    return og.city_with_province(r["sys_bss_org"])


@query
def class_team_lookup(r):
    return og.class_with_team(r["sys_bss_org"])


@query
def scalar_lookup(r):
    dim = lo.org_regions(r["organization"], r["common_region"])
    return lo.lookup(r["receive_detail"].select("list_id", "org_id"), dim, "org_id", "org_id",
                     "common_region_id", "region_id")


@query
def user_name_lookup(r):
    held = r["initiative_order_executor"].select("initiative_order_id", "curr_user_id")
    return lo.with_user_name(held, "curr_user_id", r["system_user"], r["staff"])


# ---- ranking ------------------------------------------------------------------------------

@query
def grid_lookup_top1(r):
    held = r["initiative_order_executor"].select("initiative_order_id", "dept_id")
    return og.grid_lookup(held, r["grid_org_code_rel"])


@query
def receive_first_success(r):
    return _winner_columns(su.first_success(_receive_evaluation(r).successes()))


@query
def receive_first_success_waves(r):
    """As receive_first_success, asking an order's rules only up to its first success."""
    rules = stage(_rules(r), "rules")
    asked = stage(ru.rule_pairs(_candidates(r, "receive"), rules), "rule_pairs")
    done = ru.evaluate_in_waves(asked, ru.rule_texts(rules), _rule_tables(r))
    return _winner_columns(su.first_success(done.successes()))


@query
def outcall_success_detail(r):
    ends = su.outcall_success(_outcall_hits(r))
    return ends.select("list_id", "status_cd", *[c for c in ends.columns
                                                 if c.startswith("first_")])


@query
def outcall_success_executor(r):
    ends = su.outcall_success(_outcall_hits(r))
    return ends.select("list_id", "status_cd", *[c for c in ends.columns
                                                 if c.startswith("last_")])


# ---- reports ------------------------------------------------------------------------------

def _report_rules(r, detail: DataFrame) -> DataFrame:
    return ca.success_rules(r["mkt_success_rule"], r["mkt_campaign_suc_rule_rel"], detail)


def _names(r) -> re.Names:
    return re.Names(
        r["mkt_cam_conf_attr"].select("attr_value_id", "attr_value"),
        r["pms_campaign"].select("campaign_id", "campaign_name"),
        r["sys_bss_org"].select("bss_org_id", "bss_org_name"),
        r["sys_user"].select("user_id", "user_name"))


def _receive_names(r) -> dict[str, DataFrame]:
    return {"campaign": r["pms_campaign"].select("campaign_id", "campaign_name"),
            "grid": r["grid_tree"],
            "organization": r["organization"].select("org_id", "org_name")}


def _callout(r, level: str) -> DataFrame:
    detail = r["callout_detail"]
    return re.callout_report(detail, _report_rules(r, detail), _names(r), level=level)


@query
def callout_report_prov(r):
    return _callout(r, "prov")


@query
def callout_report_city(r):
    return _callout(r, "city")


@query
def callout_report_team(r):
    return _callout(r, "team")


@query
def callout_report_class(r):
    return _callout(r, "class")


@query
def callout_report_all_levels(r):
    detail = r["callout_detail"]
    return re.callout_report_all(detail, _report_rules(r, detail))


@query
def receive_report_sec(r):
    return re.receive_report(r["receive_detail"], level="sec", names=_receive_names(r))


@query
def receive_report_org(r):
    return re.receive_report(r["receive_detail"], level="org", names=_receive_names(r))


@query
def success_flag_columns(r):
    return ap.flag_columns(_receive_evaluation(r).successes(), ap.FLAG_COLUMNS[:5])


# ---- rules and delimited text -------------------------------------------------------------

@query
def rule_eval(r):
    return _receive_evaluation(r).answers.select("list_id", "suc_rule_id", "seq_no", "hit",
                                                 "value", "success")


def _asked(r: Roles, rules: dict[int, str], **options) -> ru.Evaluation:
    """Every receive candidate asked every rule."""
    pairs = _candidates(r, "receive").select(
        "list_id", "cust_id", "prod_inst_id", "area", F.col("campaign_id").alias("main_campaign_id"),
        F.explode(F.array(*map(F.lit, rules))).alias("suc_rule_id"), F.lit(0).alias("rel_id"),
        F.lit(1).alias("seq_no"))
    return ru.evaluate_rules(stage(pairs, "asked", "suc_rule_id"), list(rules.items()),
                             _rule_tables(r), **options)


def _answers(evaluation: ru.Evaluation) -> DataFrame:
    return evaluation.answers.select("list_id", "suc_rule_id", "hit", "value", "success")


@query
def rule_eval_range(r):
    return _answers(_asked(r, RANGE_RULES))


@query
def rule_eval_nested(r):
    return _answers(_asked(r, NESTED_RULES))


@query
def rule_eval_shared(r):
    return _answers(_asked(r, SHARED_RULES))


@query
def rule_errors(r):
    """The first words of the error rows of rules that fail for some orders."""
    errors = _asked(r, FAILING_RULES, isolate="orders").errors
    return errors.select("order_id", "pro_name", "errorcode",
                         F.regexp_extract("errormsg", r"^rule \d+: (\[DIVIDE_BY_ZERO\]|\d+ results)",
                                          0).alias("problem"))


@query
def rule_first_value(r):
    return ru.reduce_rule_rows(r["rule_rows"])


@query
def receive_success_apply(r):
    winners = stage(su.first_success(_receive_evaluation(r).successes()), "winners")
    detail = conform(r["receive_target"], ap.RECEIVE_DETAIL)
    done = ap.apply_flags(su.receive_success_detail(detail, winners, AS_OF), winners)
    return done.select("list_id", "update_date", "is_success", "suc_rule_id", "suc_rule_name",
                       "suc_order_id", *ap.FLAG_COLUMNS[:5])


@query
def receive_success_state(r):
    winners = stage(su.first_success(_receive_evaluation(r).successes()), "winners")
    return su.receive_success_executor(
        with_success_columns(r["initiative_order_executor"]), winners, AS_OF)


@query
def outcall_success_apply(r):
    hits = stage(_outcall_hits(r), "hits")
    detail = conform(r["outcall_target"], ap.OUTCALL_DETAIL)
    done = ap.apply_flags(
        su.outcall_success_detail(detail, su.outcall_success(hits), AS_OF), hits)
    return done.select("list_id", "status_cd", "update_date", "is_success", "suc_rule_id",
                       "suc_rule_name", "suc_order_id", *ap.FLAG_COLUMNS[:5])


@query
def outcall_success_state(r):
    ends = su.outcall_success(_outcall_hits(r))
    return su.outcall_success_executor(
        with_success_columns(r["initiative_order_executor"]), ends, AS_OF)


@query
def condition_explode(r):
    return explode_conditions(r["condition_text"], "conditions")


# ---- daily runs ---------------------------------------------------------------------------

@query
def receive_daily_run(r):
    return run_receive(r.receive_tables, None, AS_OF, OPTIONS)["detail"]


@query
def receive_daily_executor(r):
    return run_receive(r.receive_tables, None, AS_OF, OPTIONS)["executor"]


@query
def receive_daily_log(r):
    return run_receive(r.receive_tables, None, AS_OF, OPTIONS)["success_log"]


@query
def outcall_daily_run(r):
    return run_outcall(r.outcall_tables, None, AS_OF, OPTIONS)["detail"]


@query
def outcall_daily_executor(r):
    return run_outcall(r.outcall_tables, None, AS_OF, OPTIONS)["executor"]


@query
def outcall_daily_log(r):
    return run_outcall(r.outcall_tables, None, AS_OF, OPTIONS)["success_log"]


def _faulty(r: Roles, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with departments as texts and a rule that answers texts."""
    return {**tables, "initiative_order_executor": r["executor_text"],
            "mkt_success_rule": r["rule_of_texts"]}


@query
def receive_daily_errors(r):
    return run_receive(_faulty(r, r.receive_tables), None, AS_OF, OPTIONS)["errors"]


@query
def outcall_daily_errors(r):
    return run_outcall(_faulty(r, r.outcall_tables), None, AS_OF, OPTIONS)["errors"]


def _merged(r: Roles, run, tables: dict[str, DataFrame], detail: str, columns) -> Store:
    """A store of detail and executor with one day merged into it."""
    store = Store(r.spark, fresh_path(r.spark, "store"))
    start_store(conform(tables[detail], columns),
                with_success_columns(tables["initiative_order_executor"]), store)
    now = {**tables, detail: store.read("detail"),
           "initiative_order_executor": store.read("executor")}
    merge_run(run(now, None, AS_OF, OPTIONS), store)
    return store


@query
def detail_merge(r):
    """The receive day, written by rewriting the files with changed orders."""
    return _merged(r, run_receive, r.receive_tables, "detail", ap.RECEIVE_DETAIL).read("detail")


@query
def executor_merge(r):
    store = _merged(r, run_receive, r.receive_tables, "detail", ap.RECEIVE_DETAIL)
    return store.read("executor")


@query
def callout_detail_merge(r):
    return _merged(r, run_outcall, r.outcall_tables, "callout_detail",
                   ap.OUTCALL_DETAIL).read("detail")


@query
def replace_partitions_at_once(r):
    """As replace_campaign_slice, with all slices changing in one moment."""
    keys = ["main_campaign_id", "sub_campaign_id"]
    store = Store(r.spark, fresh_path(r.spark, "store"))
    old = r["callout_detail"].groupBy(*keys).agg(F.count("list_id").alias("orders"))
    store.change().replace_all("slices", old, "main_campaign_id").publish()
    new = (r["receive_detail"].withColumnsRenamed({"z_mkt_campaign_id": "main_campaign_id",
                                                   "a_mkt_campaign_id": "sub_campaign_id"})
           .groupBy(*keys).agg(F.count("list_id").alias("orders")))
    store.change().replace_partitions(
        "slices", new.where(F.col("main_campaign_id") != 2), [1, 2, 3]).publish()
    return store.read("slices")


REBUILT = {"callout_prov": "main_campaign_id", "callout_city": "main_campaign_id",
           "callout_team": "main_campaign_id", "callout_class": "main_campaign_id",
           "receive_sec": "z_mkt_campaign_id", "receive_org": "z_mkt_campaign_id"}


@query
def report_rebuild(r):
    """Totals per report and catalogue, read back from the six rebuilt tables."""
    callout = r["callout_detail"]
    database = work_database(r.spark, f"orderflow_{uuid.uuid4().hex}")
    tables = rebuild_reports(callout, r["receive_detail"], _report_rules(r, callout), _names(r),
                             _receive_names(r), [0, 1, 2, 3], database)
    parts = []
    for report, key in REBUILT.items():
        total, won = (("all_num", "mktsucc_num") if report.startswith("callout")
                      else ("receive_num", "receive_suc_num"))
        parts.append(r.spark.table(tables[report]).groupBy(key).agg(
            F.count(F.lit(1)).alias("report_rows"), F.sum(total).alias("orders"),
            F.sum(won).alias("successes"))
            .select(F.lit(report).alias("report"),
                    F.col(key).cast("bigint").alias("catalogue"), "report_rows", "orders",
                    "successes"))
    return reduce(DataFrame.unionByName, parts)


def _refreshed(r: Roles, report: str) -> DataFrame:
    """A report made in two steps: without some orders, then their campaigns anew."""
    store = Store(r.spark, fresh_path(r.spark, "reports"))
    callout, receive = r["callout_detail"], r["receive_detail"]
    late = [3, 8, 21]  # the sub-campaigns whose orders come later
    rest = (_report_rules(r, callout), _names(r), _receive_names(r))
    refresh_reports(store, callout.where(~F.col("sub_campaign_id").isin(late)),
                    receive.where(~F.col("a_mkt_campaign_id").isin(late)
                                  | (F.col("status_cd") > 2000)), *rest, reports=[])
    refresh_reports(store, callout, receive, *rest, changed=late, reports=[report])
    return store.read(report)


@query
def report_incremental(r):
    return _refreshed(r, "receive_sec")


@query
def report_incremental_org(r):
    return _refreshed(r, "receive_org")


@query
def report_incremental_class(r):
    return _refreshed(r, "callout_class")


@query
def dimension_rows(r):
    """Every row of the nine dimension tables, refreshed with their real column lists."""
    store = Store(r.spark, fresh_path(r.spark, "dimensions"))
    refresh_store({name: r[f"source_{name}"] for name in SNAPSHOTS}, store, AS_OF)
    return reduce(DataFrame.unionByName, [
        store.read(name).select(F.lit(name).alias("table_name"), F.concat_ws("|", *[
            F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss") if c == "load_date"
                       else F.col(c).cast("string"), F.lit("~"))
            for c in store.read(name).columns]).alias("row_text")) for name in SNAPSHOTS])


@query
def dimension_refresh(r):
    """Row counts of the refreshed tables next to the caller mapping's distinct callers."""
    sources = {"staff": r["staff"], "system_user": r["system_user"],
               "organization": r["organization"], "t_grid_org_code_rel": r["grid_org_code_rel"],
               "tb_pty_grid_tree": r["grid_tree"], "mkt_campaign_all": r["pms_campaign"],
               "channel": r["pms_campaign_chl_rel"], "block_contractor_rela":
               r["block_contractor"].drop("quantity"), "sys_bss_org": r["sys_bss_org"],
               "sys_user_job": r["sys_user_job"], "sys_user": r["sys_user"]}
    specs = {name: Snapshot(distinct=name == "block_contractor_rela",
                            stamped=name == "t_grid_org_code_rel") for name in sources
             if not name.startswith("sys_")}
    done = refresh_dimensions(sources, fresh_path(r.spark, "dimensions"), AS_OF,
                              snapshots=specs)
    keys = {"staff": "staff_id", "system_user": "system_user_id", "organization": "org_id",
            "t_grid_org_code_rel": "org_jt_code", "tb_pty_grid_tree": "tree_id",
            "mkt_campaign_all": "campaign_id", "channel": "campaign_id",
            "block_contractor_rela": "block_id", "callout_bssorg_caller_rel": "caller_id"}
    counts = [df.agg(F.count(F.lit(1)).alias("rows_loaded"),
                     F.count_distinct(keys[name]).alias("keys_loaded"))
              .select(F.lit(name).alias("table_name"), "rows_loaded", "keys_loaded")
              for name, df in done.items()]
    return reduce(DataFrame.unionByName, counts)

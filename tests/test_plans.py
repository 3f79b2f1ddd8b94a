import threading
import uuid
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import OPTIONS, _names, _receive_names, _report_rules
from checks.roles import AS_OF, CHANGE_DAYS, Roles
from orderflow.operators.orders import changed_receive, orders_with_state
from orderflow.plans import (rebuild_reports, refresh_dimensions, run_outcall, run_receive,
                             save_run)
from orderflow.session import fresh_path
from orderflow.sources import Snapshot, work_database

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def roles(spark):
    return Roles(spark, SMALL)


def test_second_receive_run_changes_nothing(roles):
    tables = roles.receive_tables
    first = run_receive(tables, None, AS_OF, OPTIONS)
    assert first["new_orders"].count() > 0
    again = run_receive({**tables, "detail": first["detail"],
                         "initiative_order_executor": first["executor"]}, None, AS_OF, OPTIONS)
    assert again["new_orders"].count() == 0
    assert again["success_log"].join(first["success_log"], "list_id").count() == 0
    now = again["detail"].drop("update_date")
    assert now.count() == first["detail"].count()


def test_saved_versions_feed_the_next_run(spark, roles):
    tables = roles.receive_tables
    folder = fresh_path(spark, "store")
    first = run_receive(tables, None, AS_OF, OPTIONS)
    saved = save_run(first, f"{folder}/day1", f"{folder}/logs")
    assert saved["detail"].exceptAll(first["detail"]).count() == 0
    assert saved["executor"].count() == tables["initiative_order_executor"].count()
    again = run_receive({**tables, "detail": saved["detail"],
                         "initiative_order_executor": saved["executor"]}, None, AS_OF, OPTIONS)
    save_run(again, f"{folder}/day2", f"{folder}/logs")
    logged = spark.read.parquet(f"{folder}/logs/success_log")
    assert logged.count() == first["success_log"].count() > 0
    assert logged.count() == logged.dropDuplicates(["list_id"]).count()


def test_executor_updates_are_the_changed_rows(roles):
    for run, tables in ((run_receive, roles.receive_tables), (run_outcall, roles.outcall_tables)):
        out = run(tables, None, AS_OF, OPTIONS)
        marked = out["executor"].where("suc_rule_id IS NOT NULL")
        assert out["executor_updates"].count() == marked.count() > 0
        assert marked.exceptAll(out["executor_updates"]).count() == 0


def test_catalogue_limits_the_run(roles):
    tables = roles.receive_tables
    one = run_receive(tables, 1, AS_OF, OPTIONS)
    keys = {r[0] for r in one["new_orders"].select("z_mkt_campaign_id").distinct().collect()}
    assert keys <= {1}


def test_second_outcall_run_skips_logged_rules(roles):
    tables = roles.outcall_tables
    first = run_outcall(tables, None, AS_OF, OPTIONS)
    logged = first["success_log"].select("list_id", "suc_rule_id")
    again = run_outcall({**tables, "callout_detail": first["detail"],
                         "success_log": tables["success_log"].unionByName(logged)},
                        None, AS_OF, OPTIONS)
    assert again["new_orders"].count() == 0
    known = first["detail"].select("list_id").distinct()
    assert (again["success_log"].join(logged, ["list_id", "suc_rule_id"])
            .join(known, "list_id").count()) == 0


@pytest.mark.parametrize("run, kind, name, key", [
    (run_receive, "receive", "detail", "a_mkt_campaign_id"),
    (run_outcall, "outcall", "callout_detail", "sub_campaign_id")])
def test_slices_give_the_same_detail(roles, run, kind, name, key):
    tables = getattr(roles, f"{kind}_tables")
    whole = run(tables, None, AS_OF, OPTIONS)["detail"]
    part = run(tables, None, AS_OF, replace(OPTIONS, slice_only=True))["detail"]
    touched = part.select(key).distinct()
    assert 0 < part.count() < whole.count()
    assert whole.join(touched, key, "left_semi").select(part.columns).exceptAll(
        part).count() == 0
    rest = whole.join(touched, key, "left_anti")
    old = tables[name].join(touched, key, "left_anti")
    columns = [c for c in tables[name].columns if c in rest.columns]
    assert rest.select(columns).exceptAll(old.select(columns)).count() == 0
    assert part.count() + rest.count() == whole.count()


@pytest.mark.parametrize("run, kind, key", [(run_receive, "receive", "a_mkt_campaign_id"),
                                            (run_outcall, "outcall", "sub_campaign_id")])
def test_a_slice_is_not_saved_as_the_whole_detail(spark, roles, tmp_path, run, kind, key):
    part = run(getattr(roles, f"{kind}_tables"), None, AS_OF, replace(OPTIONS, slice_only=True))
    held = {r[0] for r in part["detail"].select(key).distinct().collect()}
    assert held and held <= {r[0] for r in part["slices"].select(key).collect()}
    with pytest.raises(ValueError, match="slice"):
        save_run(part, str(tmp_path / "day"), str(tmp_path / "logs"))
    assert not list(tmp_path.iterdir())


def test_broken_rule_is_logged_and_the_run_goes_on(roles):
    tables = dict(roles.receive_tables)
    tables["mkt_success_rule"] = tables["mkt_success_rule"].withColumn(
        "sql_text_order", F.when(F.col("suc_rule_id") == 4, "select nothing from nowhere")
        .otherwise(F.col("sql_text_order")))
    out = run_receive(tables, None, AS_OF, OPTIONS)
    assert [r.errormsg[:7] for r in out["errors"].collect()] == ["rule 4:"]
    assert out["success_log"].where("suc_rule_id = 4").count() == 0
    assert out["success_log"].count() > 0


def test_non_numeric_department_is_logged_and_the_run_goes_on(roles):
    tables = dict(roles.receive_tables)
    good = run_receive(tables, None, AS_OF, OPTIONS)
    change = changed_receive(
        orders_with_state(tables["initiative_order"], tables["initiative_order_executor"]),
        tables["detail"], tables["initiative_order_channel"].select("channel_id"), AS_OF,
        days=CHANGE_DAYS)
    victim = change.head().list_id
    spoilt = tables["initiative_order_executor"].withColumn(
        "dept_id", F.when(F.col("initiative_order_id") == victim, "n/a")
        .otherwise(F.col("dept_id").cast("string")))
    out = run_receive({**tables, "initiative_order_executor": spoilt}, None, AS_OF, OPTIONS)
    assert [(r.order_id, r.errorcode) for r in out["errors"].collect()] == [(victim, "-6502")]
    assert out["executor"].count() == good["executor"].count()
    rest = F.col("list_id") != victim
    assert out["detail"].where(rest).exceptAll(good["detail"].where(rest)).count() == 0
    assert out["detail"].count() == good["detail"].count()


def test_rebuild_empties_a_catalogue_without_orders(spark, roles):
    callout, receive = roles["callout_detail"], roles["receive_detail"]
    database = work_database(spark, f"orderflow_{uuid.uuid4().hex}")
    args = (_report_rules(roles, callout), _names(roles), _receive_names(roles), [0, 1, 2, 3],
            database)
    tables = rebuild_reports(callout, receive, *args)
    before = spark.table(tables["callout_team"]).where("main_campaign_id = 0").count()
    rebuild_reports(callout.where("main_campaign_id <> 2"),
                    receive.where("z_mkt_campaign_id <> 2"), *args)
    for name, table in tables.items():
        key = "main_campaign_id" if name.startswith("callout") else "z_mkt_campaign_id"
        assert spark.table(table).where(F.col(key) == 2).count() == 0
    assert spark.table(tables["callout_team"]).where("main_campaign_id = 0").count() == before


def test_dimension_versions(spark, make, rows):
    folder = fresh_path(spark, "dimensions")
    sources = {"a": make("k int, t string", (1, ""), (1, "")), "unused": make("k int", (1,))}
    out = refresh_dimensions(sources, folder, "2024-05-10 12:00:00", snapshots={
        "a": Snapshot(("t", "k"), distinct=True, stamped=True), "missing": Snapshot()})
    assert list(out) == ["a"]
    assert rows(out["a"]) == [(None, 1, datetime(2024, 5, 10, 12))]


def test_dimensions_are_written_at_the_same_time(spark, make, monkeypatch):
    from orderflow.plans import refresh_store
    from orderflow.sources import Store, versions
    names = ["staff", "channel", "organization"]
    sources = {name: make("id long, name string", (i, name)) for i, name in enumerate(names)}
    meeting, write = threading.Barrier(len(names)), versions.Change.replace_all

    def met(change, name, rows, by=None):
        meeting.wait(60)  # breaks unless all tables have come
        return write(change, name, rows, by)

    monkeypatch.setattr(versions.Change, "replace_all", met)
    store = Store(spark, fresh_path(spark, "store"))
    refresh_store(sources, store, AS_OF, snapshots={name: Snapshot() for name in names})
    assert {name: store.read(name).collect()[0][1] for name in names} == {n: n for n in names}

"""Reports from a stored state, bucketed tables, and the plans they are made for."""

import uuid

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES, _names, _pairs, _receive_names, _report_rules
from checks.roles import AS_OF, Roles
from orderflow.operators import orders as od
from orderflow.operators import reports as re
from orderflow.plans import refresh_reports, refresh_store
from orderflow.session import fresh_path, stage
from orderflow.sources import Snapshot, Store, work_database, write_bucketed
from tests.plans import plan

SMALL = "/root/testdata/sf0.001"
DETAIL = ("list_id bigint, z_mkt_campaign_id bigint, a_mkt_campaign_id bigint, fir_grid_id int, "
          "sec_grid_id int, thi_grid_id bigint, org_id bigint, org_jt_code bigint, "
          "user_id bigint, status_cd int, is_success int, cop_channel_id int, report_date string, "
          "col_3 int")
DAY = "2024-05-09 10:00:00"


@pytest.fixture(scope="module")
def roles(spark):
    return Roles(spark, SMALL)


def test_orders_and_offices_are_counted_distinct(make):
    detail = make(
        DETAIL,
        (1, 7, 70, 1, 2, 3, 11, 5, 9, 3100, 1, 4, DAY, 1),
        (1, 7, 70, 1, 2, 4, 12, 5, None, 1100, 0, 4, DAY, None),  # the order's second office
        (1, 7, 70, 1, 2, 3, 11, 5, None, 1100, 0, 4, DAY, None),  # a repeated row
        (2, 7, 70, 1, 2, 3, 11, 5, None, 3200, 1, 4, DAY, 1),
        (3, 7, 71, 1, 2, 3, 12, 5, None, 1100, 0, 4, DAY, None),  # another sub-campaign
        (4, 7, 71, 1, 2, None, None, None, 8, 1100, 0, 4, DAY, None),  # no office, claimed
        (None, 7, 71, 1, 2, None, None, None, None, None, None, 4, None, None))
    names = {"campaign": make("id bigint, n string"), "organization": make("id bigint, n string"),
             "grid": make("tree_id bigint, tree_name string, tree_level int")}
    sec = {r.report_day: r for r in re.receive_report(detail, level="sec", names=names).collect()}
    r = sec["2024-05-09"]
    assert (r.receive_num, r.receive_suc_num, r.claimed_count, r.exe_count, r.exe_suc_count,
            r.receive_org_count, r.claimed_org_count, r.col_3) == (4, 2, 2, 2, 2, 2, 1, 2)
    assert (sec[None].receive_num, sec[None].receive_org_count) == (0, 0)
    org = re.receive_report(detail, level="org", names=names)
    assert sorted((r.a_mkt_campaign_id, r.org_id or 0, r.thi_grid_id or 0, r.receive_num)
                  for r in org.where("report_day IS NOT NULL").collect()) == [
        (70, 11, 3, 2), (70, 12, 4, 1), (71, 0, 0, 1), (71, 12, 3, 1)]


def test_distinct_counts_do_not_multiply_the_rows(roles):
    for level in ("sec", "org"):
        assert "Expand" not in plan(re.receive_report(
            roles["receive_detail"], level=level, names=_receive_names(roles)))


def test_only_changed_campaigns_are_read_and_written(spark, roles, tmp_path):
    details = {}
    for name, key in (("callout_detail", "sub_campaign_id"),
                      ("receive_detail", "a_mkt_campaign_id")):
        path = str(tmp_path / name)
        roles[name].write.partitionBy(key).parquet(path)
        details[name] = spark.read.schema(roles[name].schema).parquet(path)
    store = Store(spark, fresh_path(spark, "store"))
    rest = (_report_rules(roles, details["callout_detail"]), _names(roles),
            _receive_names(roles))
    for changed in (None, [4, 9, 1000]):
        refresh_reports(store, *details.values(), *rest, changed=changed,
                        reports=["receive_sec", "callout_prov"])
    first, second = (store.tables(n)[1]["receive_cube"].files for n in (0, 1))
    parts = {f.split("a_mkt_campaign_id=")[1].split("/")[0] for f in set(first) ^ set(second)}
    assert parts == {"4", "9"} and set(first) & set(second)
    for table in ("receive_sec", "callout_prov"):
        one, two = store.read(table, 0), store.read(table, 1)
        assert one.exceptAll(two).count() == two.exceptAll(one).count() == 0 < one.count()


def test_dimensions_change_in_one_moment(spark, make):
    store = Store(spark, fresh_path(spark, "store"))
    specs = {"staff": Snapshot(("id", "name")), "grid": Snapshot(stamped=True)}
    sources = {"staff": make("id int, name string, password string", (1, "", "p")),
               "grid": make("code int", (5,))}
    refresh_store(sources, store, "2024-05-10 02:00:00", snapshots=specs)
    broken = {**sources, "grid": sources["grid"].withColumn(
        "code", F.raise_error(F.lit("gone")).cast("int"))}
    with pytest.raises(Exception, match="gone"):
        refresh_store({**broken, "staff": make("id int, name string, password string", (2, "b", "p"))},
                      store, "2024-05-11 02:00:00", snapshots=specs)
    assert [tuple(r) for r in store.read("staff").collect()] == [(1, None)]
    assert store.read("grid").columns == ["code", "load_date"] and store.numbers() == [0]


def test_bucketed_tables_are_joined_without_an_exchange(spark, roles):
    database = work_database(spark, "orderflow_tests")
    tables = {}
    for name, key in (("initiative_order", "initiative_order_id"),
                      ("initiative_order_executor", "initiative_order_id"), ("detail", "list_id")):
        table = f"{database}.{name}_{uuid.uuid4().hex}"
        write_bucketed(roles[name], table, key, 4)
        tables[name] = spark.table(table)
    pairs = stage(_pairs(roles, "receive"), "pairs")
    held = od.orders_with_state(tables["initiative_order"], tables["initiative_order_executor"])
    joined = od._unknown(held.where("state = '10A'"), tables["detail"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(joined).count("SortMergeJoin") == 2 and "Exchange" not in plan(joined)
        plain = od._unknown(od.orders_with_state(
            roles["initiative_order"], roles["initiative_order_executor"]), roles["detail"])
        assert "Exchange" in plan(plain)
        rows = od.new_receive_orders(
            held, *[roles[t] for t in ("grid_org_code_rel",)], tables["detail"],
            *[roles[t] for t in ("organization", "common_region", "system_user", "staff")], pairs,
            AS_OF)
        assert rows.count() == QUERIES["receive_new_orders"](spark, SMALL).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from checks.queries import _names, _report_rules
from checks.roles import Roles
from orderflow.operators import reports as re

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def roles(spark):
    return Roles(spark, SMALL)


def test_widths(roles):
    detail = roles["callout_detail"]
    rules, names = _report_rules(roles, detail), _names(roles)
    widths = {level: len(re.callout_report(detail, rules, names, level=level).columns)
              for level in re.LEVELS}
    assert widths == {"prov": 59, "city": 61, "team": 63, "class": 65}


def test_levels_add_up(roles):
    detail = roles["callout_detail"]
    out = re.callout_report_all(detail, _report_rules(roles, detail))
    totals = {r.level: tuple(r)[1:] for r in out.groupBy("level").agg(
        F.sum("all_num"), F.sum("mktsucc_num"), F.sum("exe_num"), F.sum("col_1_num")).collect()}
    assert len(totals) == 4 and len(set(totals.values())) == 1
    assert totals["prov"][0] == detail.count()


CALLOUT = ("list_id bigint, main_campaign_id bigint, sub_campaign_id bigint, region_id int, "
           "prov_dept_id int, city_dept_id int, team_dept_id bigint, class_dept_id bigint, "
           "caller_id bigint, status_cd int, order_result bigint, is_success int, col_1 int")


def test_an_order_counts_once_per_group(make, rows):
    base = (7, 70, 1, 2, 3)
    detail = make(CALLOUT,
                  (1, *base, 4, 5, 6, 3100, 0, 1, 1), (1, *base, 4, 5, 6, 3100, 1, 1, 1),
                  (1, *base, 4, 5, 8, 1100, 0, 0, None),   # same order, other caller
                  (1, *base, None, None, None, 1100, 0, 0, None),  # and without a team
                  (2, *base, 4, 5, 6, 1100, 2, 0, None))
    rules = make("main_campaign_id bigint, sub_campaign_id bigint, suc_rule_id int, "
                 "rule_name string, report_column string", (7, 70, 1, "r1", "COL_1"),
                 (7, 70, 2, "r2", "col_4"))
    out = re.callout_report_all(detail, rules)
    count = {(r.level, r.team_dept_id, r.class_dept_id, r.caller_id): (
        r.all_num, r.assign_num, r.exe_num, r.mktsucc_num, r.callsucc_num, r.col_1_num,
        r.valid_col_num) for r in out.collect()}
    assert count == {
        ("prov", None, None, None): (2, 2, 2, 2, 3, 2, 2),
        ("city", 4, None, None): (2, 2, 2, 2, 2, 2, 2),
        ("city", None, None, None): (1, 0, 0, 0, 1, 0, 2),
        ("team", 4, 5, None): (2, 2, 2, 2, 2, 2, 2),
        ("team", None, None, None): (1, 0, 0, 0, 1, 0, 2),
        ("class", 4, 5, 6): (2, 2, 2, 2, 1, 2, 2), ("class", 4, 5, 8): (1, 0, 0, 0, 1, 0, 2),
        ("class", None, None, None): (1, 0, 0, 0, 1, 0, 2)}
    names = re.Names(*[make("id bigint, name string", (i, f"n{i}")) for i in (7, 70, 2, 6)])
    one = re.callout_report(detail, rules, names, level="class", codes=re.ResultCodes(
        callsucc_num=(0, 1)))
    assert rows(one, "or_seq", "team_dept_id", "caller_id", "caller_name", "all_num",
                "callsucc_num", "col_1_name", "col_4_name", "col_2_name", "prov_dept_name",
                "main_campaign_name") == [
        (1, None, None, None, 1, 1, "r1", "r2", None, "n2", "n7"),
        (2, 4, 6, "n6", 2, 2, "r1", "r2", None, "n2", "n7"),
        (3, 4, 8, None, 1, 1, "r1", "r2", None, "n2", "n7")]


def test_position_across_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"),
                                      F.when(F.col("id") % 3 == 0, 1).when(
                                          F.col("id") % 97 == 1, None).otherwise(2).alias("g"))
        out = re.with_ordinal(df, ["g", "k"], "g", "pos")
        wanted = out.withColumn("want", F.row_number().over(
            W.partitionBy("g").orderBy("k")))
        assert out.count() == 5000 and wanted.where("pos <> want").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


RECEIVE = ("list_id bigint, z_mkt_campaign_id bigint, a_mkt_campaign_id bigint, fir_grid_id int, "
           "sec_grid_id int, thi_grid_id bigint, org_id bigint, org_jt_code bigint, "
           "user_id bigint, status_cd int, is_success int, cop_channel_id int, "
           "report_date string")


def test_receive_report(make, rows):
    detail = make(RECEIVE,
                  (1, 7, 70, 1, 2, 3, 30, 300, None, 3100, 1, 3, "2024-05-09 10:00:00"),
                  (2, 7, 70, 1, 2, 3, 31, 301, 9, 1100, 0, 3, "2024-05-09 23:59:59"),
                  (2, 7, 70, 1, 2, 3, 32, 302, 9, 1100, 0, 3, "2024-05-09 23:59:59"),
                  (3, 7, 70, 1, 2, 3, None, None, None, 1100, 0, 3, "2024-05-10 00:00:00"))
    names = {"campaign": make("id bigint, n string", (7, "main"), (70, "sub")),
             "grid": make("tree_id bigint, tree_name string, tree_level int", (2, "g2", 2),
                          (3, "g3", 3), (2, "wrong", 3)),
             "organization": make("org_id bigint, n string", (30, "office"))}
    sec = re.receive_report(detail, level="sec", names=names)
    assert len(sec.columns) == 38
    assert rows(sec, "report_day", "receive_num", "receive_suc_num", "claimed_count",
                "exe_suc_count", "receive_org_count", "claimed_org_count", "suc_rec_per",
                "claimed_org_per", "dept_name") == [
        ("2024-05-09", 2, 1, 2, 1, 3, 2, 0.5, 2 / 3, "g2"),
        ("2024-05-10", 1, 0, 0, 0, 0, 0, 0.0, None, "g2")]
    org = re.receive_report(detail, level="org", names=names)
    assert len(org.columns) == 42
    assert rows(org, "org_id", "dept_name", "c_campaign_name", "thi_grid_name", "grid_id",
                "receive_num", "order_claimed_per") == [
        (None, None, "sub", "g3", 3, 1, 0.0), (30, "office", "sub", "g3", 3, 1, 0.0),
        (31, None, "sub", "g3", 3, 1, 1.0), (32, None, "sub", "g3", 3, 1, 1.0)]

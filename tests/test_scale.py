"""What the plans must look like, and results under one key with a third of the rows."""

import random
import re

import pytest

import checks.queries as queries
import orderflow.operators.rules as rules
from checks.compare import differences, duck
from checks.oracles import ORACLES
from checks.roles import BASE_TABLES, Roles
from orderflow.functions import day_window
from orderflow.operators import orders as od
from orderflow.session import stage
from tests.plans import plan

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def long_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_filters_and_columns_reach_the_scan(spark, long_plans):
    r = Roles(spark, SMALL)
    text = plan(day_window(r["customer_order_syn"], "status_date", "1998-07-01 08:30:00", 30)
                .select("cust_id"))
    assert "GreaterThanOrEqual(l_shipdate,1998-06-01T00:00)" in text
    assert "LessThan(l_shipdate,1998-07-01T00:00)" in text
    scan = next(line for line in text.splitlines() if "l_shipdate" in line and "FileScan" in line)
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_linestatus:string,"
                     r"l_shipdate:timestamp_ntz>|ReadSchema: struct<l_orderkey:bigint,"
                     r"l_shipdate:timestamp_ntz>", scan)


def test_window_reaches_the_executor_scan_through_the_join(spark, long_plans):
    r = Roles(spark, SMALL)
    executors = stage(r["initiative_order_executor"], "executors")
    orders = stage(r["initiative_order"], "orders")
    changed = od.changed_receive(
        od.orders_with_state(orders, executors), stage(r["receive_target"], "detail"),
        r["initiative_order_channel"].select("channel_id"), "1998-07-01 08:30:00", days=365)
    text = plan(changed)
    assert "GreaterThan(last_opt_date,1997-07-01T00:00)" in text
    assert "EqualTo(state,10A)" in text
    detail = next(line for line in text.splitlines() if "FileScan" in line and "list_id" in line)
    assert "cust_name" not in detail


def test_rule_rows_are_combined_before_the_exchange(spark):
    """The purchases of a rule are aggregated map-side; the join meets one row per customer."""
    r = Roles(spark, SMALL)
    ranked = stage(queries._rules(r), "rules")
    asked = stage(rules.rule_pairs(queries._candidates(r, "receive"), ranked), "pairs")
    purchases = {"customer_order_syn": stage(r["customer_order_syn"], "purchases"),
                 "part": r["part"]}
    first = [t for t in rules.rule_texts(ranked) if t[0] == 2]
    text = plan(rules.evaluate_rules(asked, first, purchases).answers)
    assert text.count("Join") == 1
    below = text[text.index("HashAggregate"):]
    assert below.index("Exchange") < below.index("partial_min") < below.index("amount")


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The small tables with a third of the rows on one customer, part and supplier."""
    folder = tmp_path_factory.mktemp("skewed")
    connection = duck("/root/testdata/sf0.001")
    hot = {"orders": "* REPLACE (CASE WHEN hash(o_orderkey) % 3 = 0 THEN 7 ELSE o_custkey END "
                     "AS o_custkey)",
           "lineitem": "* REPLACE (CASE WHEN hash(l_orderkey, l_linenumber) % 3 = 0 THEN 3 "
                       "ELSE l_partkey END AS l_partkey, CASE WHEN hash(l_linenumber, "
                       "l_orderkey) % 3 = 0 THEN 2 ELSE l_suppkey END AS l_suppkey)"}
    for table in BASE_TABLES:
        connection.execute(f"COPY (SELECT {hot.get(table, '*')} FROM {table}) "
                           f"TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", [
    "rule_eval", "receive_success_candidates", "receive_daily_run", "outcall_daily_run",
    "callout_report_class", "callout_report_all_levels", "receive_report_sec",
    "grid_lookup_top1", "dim_snapshot_distinct", "success_rules_ranked", "rule_first_value"])
def test_one_hot_key(spark, skewed, name):
    found = differences(queries.QUERIES[name](spark, skewed), duck(skewed), ORACLES[name])
    assert found == []


def test_random_rule_rows_against_brute_force(spark, make, rows):
    """Half of all rows on one customer; answers equal a plain loop."""
    chance = random.Random(5)
    values = [(1 if chance.random() < 0.5 else chance.randrange(2, 40),
               chance.choice([None, "-999999999", "-1", "x", *map(str, range(3, 60))]))
              for _ in range(2000)]
    pairs = [(i, 1 if chance.random() < 0.5 else chance.randrange(2, 45), 0, 1, 7, 1, 2, 1)
             for i in range(300)]
    out = rules.evaluate_rules(
        make("list_id bigint, cust_id bigint, prod_inst_id bigint, area int, "
             "main_campaign_id bigint, suc_rule_id int, rel_id bigint, seq_no int", *pairs),
        [(1, "select v from vals where vals.cust_id = [CUSTID]")],
        {"vals": make("cust_id bigint, v string", *values)})
    expected = []
    for pair in pairs:
        mine = [v for c, v in values if c == pair[1]]
        numbers = [int(v) for v in mine if v not in (None, "x", "-999999999")]
        value = min(numbers) if numbers else None
        hit = value is not None or None in mine
        expected.append((pair[0], int(hit), value, int(hit and value != -1)))
    assert rows(out.answers, "list_id", "hit", "value", "success") == expected


def test_pairs_are_broadcast_by_their_size_in_memory(spark, make):
    """Repeated names and areas make small files of many pairs; joins must see the rows."""
    def size(df):
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))

    many = spark.range(50_000).selectExpr(
        "id % 4 as main_campaign_id", "'a catalogue' as main_campaign_name",
        "id div 10 as sub_campaign_id", "'the same campaign' as sub_campaign_name",
        "int(id % 10) as latn_id")
    named = od._one_main_per_pair(stage(many, "pairs"), ("main_campaign_name", "sub_campaign_name"))
    assert named.count() == 50_000 and size(named) > 50_000 * 40
    few = make("main_campaign_id bigint, sub_campaign_id bigint, latn_id int",
               (2, 7, 1), (1, 7, 1), (3, 7, 999))
    one = od._one_main_per_pair(few)
    assert sorted(map(tuple, one.collect())) == [(7, 1, 1), (7, 999, 3)]
    calls = make("campaign_id bigint, latn_id int, initiative_order_id bigint", (7, 1, 5))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        joined = calls.join(named, ["campaign_id", "latn_id"])
        assert "SortMergeJoin" in plan(joined)
        assert [r.sub_campaign_name for r in joined.collect()] == ["the same campaign"]
        assert "BroadcastHashJoin" in plan(calls.join(one, ["campaign_id", "latn_id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

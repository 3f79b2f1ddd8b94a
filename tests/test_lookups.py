import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks.roles import Roles
from orderflow.operators import lookups as lo
from orderflow.operators import orders as od
from orderflow.operators import rules as ru
from orderflow.operators.lookups import lookup, only_keys
from orderflow.session import stage
from tests.plans import plan


def test_error_only_for_keys_that_are_looked_up(make, rows):
    dim = make("k int, v int", (1, 10), (2, 20), (2, 21))
    df = make("id int, k int", (1, 1), (2, None), (3, 9))
    assert rows(lo.lookup(df, dim, "k", "k", "v", "out"), "id", "out") == [
        (1, 10), (2, None), (3, None)]
    with pytest.raises(PySparkException, match="several rows in lookup"):
        lo.lookup(make("id int, k int", (1, 2)), dim, "k", "k", "v", "out").collect()


def test_any_is_repeatable(make, rows):
    dim = make("k int, v int", (2, 21), (2, 20))
    df = make("id int, k int", (1, 2))
    assert rows(lo.lookup(df, dim, "k", "k", "v", "out", "any"), "out") == [(20,)]
    with pytest.raises(ValueError):
        lo.lookup(df, dim, "k", "k", "v", "out", "last")


def test_user_names(make, rows):
    users = make("system_user_id bigint, staff_id bigint", (1, 100), (2, 100), (3, 300))
    staff = make("staff_id bigint, staff_name string", (100, "b"), (100, "a"))
    held = make("id int, u bigint", (1, 1), (2, 2), (3, 3), (4, None))
    assert rows(lo.with_user_name(held, "u", users, staff), "id", "user_name") == [
        (1, "a"), (2, "a"), (3, None), (4, None)]


def test_region_needs_a_known_region(make, rows):
    organization = make("org_id bigint, common_region_id int", (1, 5), (2, 6))
    regions = make("region_id int, region_name string", (5, "x"))
    assert rows(lo.org_regions(organization, regions), "org_id", "common_region_id") == [(1, 5)]


def _below(text, inner, outer):
    """Whether the plan has a step named ``inner`` under one named ``outer``."""
    lines = text.splitlines()
    return any(outer in a and any(inner in b and len(b) - len(b.lstrip(" :+-|")) >
                                  len(a) - len(a.lstrip(" :+-|")) for b in lines[i + 1:])
               for i, a in enumerate(lines))


def test_only_a_days_keys_are_aggregated(spark, tmp_path):
    facts = spark.range(100_000).selectExpr("id AS list_id", "id % 4 AS order_result")
    facts.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    day = stage(spark.range(0, 100_000, 9_000).selectExpr("id AS order_id"), "day")
    out = lookup(day, only_keys(facts, "list_id", day, "order_id"), "order_id", "list_id",
                 "order_result", "result")
    assert _below(plan(out), "LeftSemi", "HashAggregate(keys=[list_id")
    assert {(r.order_id, r.result) for r in out.collect()} == {
        (i, i % 4) for i in range(0, 100_000, 9_000)}
    whole = lookup(day, facts, "order_id", "list_id", "order_result", "result")
    assert not _below(plan(whole), "LeftSemi", "HashAggregate")


def test_calls_and_logs_are_reduced_before_they_are_aggregated(spark):
    r = Roles(spark, "/root/testdata/sf0.001")
    held = od.orders_with_state(r["initiative_order"], r["initiative_order_executor"])
    results = stage(r["exe_order_result"], "results")
    changed = od.changed_outcall(held, r["outcall_target"], results, r["sys_bss_org"],
                                 "1998-07-01 08:30:00", days=365)
    assert _below(plan(changed), "LeftSemi", "HashAggregate(keys=[list_id")
    pairs = held.select(F.col("initiative_order_id").alias("list_id"), F.lit(1).alias(
        "suc_rule_id")).limit(50)
    log, detail = stage(r["success_log"], "log"), stage(r["outcall_target"], "detail")
    text = plan(ru.skip_logged(pairs, detail, log))
    assert text.count("LeftSemi") == 2
    assert _below(text, "LeftSemi", "HashAggregate(keys=[list_id")

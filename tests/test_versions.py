"""Versioned tables: copy-on-write updates, slices that change together, clean-up."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks.queries import OPTIONS
from checks.roles import AS_OF, Roles
from orderflow.operators.apply import (OUTCALL_DETAIL, RECEIVE_DETAIL, apply_all, apply_changes,
                                       change_set)
from orderflow.plans import merge_run, run_outcall, run_receive, start_store
from orderflow.plans.receive import with_success_columns
from orderflow.session import clear_staged, fresh_path, shared_folder, stage
from orderflow.sources import Store, VersionConflict, conform

SMALL = "/root/testdata/sf0.001"
DDL = "k bigint, v string, part int"


@pytest.fixture
def store(spark, make):
    out = Store(spark, fresh_path(spark, "store"))
    rows = make(DDL, *[(i, f"v{i}", i % 4) for i in range(40)], (3, "again", 3), (None, "n", 0))
    out.change().replace_all("t", rows, "part").publish()
    return out


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_read_back(store):
    assert store.numbers() == [0] and store.read("t").columns == ["k", "v", "part"]
    assert store.read("t").count() == 42
    with pytest.raises(ValueError):
        store.read("other")
    with pytest.raises(ValueError):
        store.read("t", 5)


def test_upsert_rewrites_only_files_with_a_changed_key(store, make):
    before = store.tables()[1]["t"].files
    updates = make(DDL, (3, "new", 3), (3, "new2", 3), (100, "added", 3), (None, "null", 3))
    assert store.change().upsert("t", updates, "k").publish() == 1
    after = store.tables()[1]["t"].files
    untouched = {f for f in before if "/part=3/" not in f}
    assert untouched and untouched <= set(after)
    assert all("/part=3/" in f for f in set(after) - untouched)
    want = [(i, f"v{i}", i % 4) for i in range(40) if i != 3]
    want += [(3, "new", 3), (3, "new2", 3), (100, "added", 3), (None, "null", 3), (None, "n", 0)]
    assert content(store.read("t")) == sorted(want, key=str)
    # the version before is still there
    assert store.read("t", 0).count() == 42 and store.read("t", 0).where("k = 3").count() == 2


def test_rows_that_change_their_partition(store, make):
    store.change().upsert("t", make(DDL, (3, "moved", 1)), "k").publish()
    assert content(store.read("t").where("k = 3")) == [(3, "moved", 1)]


def test_stays_looks_into_the_partitions_of_the_updates(store, make, spark):
    change = store.change()
    keys = make("k bigint, part int", (3, 3), (8, 3))
    assert {f.split("/part=")[1][0] for f in change.touched("t", keys)} == {"3"}
    change.upsert("t", make(DDL, (3, "x", 3)), "k", stays=True).publish()
    assert content(store.read("t").where("k = 3")) == [(3, "x", 3)]


def test_nothing_is_seen_before_it_is_published(store, make):
    change = store.change()
    change.upsert("t", make(DDL, (1, "x", 1)), "k")
    change.replace_partitions("t", make(DDL, (5, "y", 2)), [2, 3])
    change.append("log", make("line string", ("a",)))
    assert store.read("t").where("v = 'x'").count() == 0 and store.numbers() == [0]
    change.publish()
    rows = store.read("t")
    assert content(rows.where("part in (2, 3)")) == [(5, "y", 2)]
    assert rows.where("v = 'x'").count() == 1 and rows.where("part = 0").count() == 11
    store.change().append("log", make("line string", ("b",))).publish()
    assert content(store.read("log")) == [("a",), ("b",)] and content(
        store.read("log", 1)) == [("a",)]


def test_a_failure_between_the_steps_leaves_the_old_tables(store, make):
    change = store.change().replace_partitions("t", make(DDL, (5, "y", 2)), [0, 1, 2])
    broken = make(DDL, (1, "x", 3)).withColumn("v", F.raise_error(F.lit("stop")))
    with pytest.raises(Exception, match="stop"):
        change.replace_partitions("t", broken, [3])
    assert store.read("t").count() == 42 and store.numbers() == [0]


def test_a_second_writer_is_refused(store, make):
    one, two = store.change(), store.change()
    one.append("t", make(DDL, (50, "one", 1))).publish()
    two.append("t", make(DDL, (51, "two", 1)))
    with pytest.raises(VersionConflict):
        two.publish()
    assert store.read("t").where("k >= 50").count() == 1


def test_empty_tables(store, make):
    store.change().replace_partitions("t", make(DDL), [0, 1, 2, 3]).publish()
    assert store.read("t").count() == 0 and store.read("t").columns == ["k", "v", "part"]
    store.change().upsert("t", make(DDL, (1, "x", 1)), "k").publish()
    store.change().upsert("t", make(DDL), "k").publish()
    assert content(store.read("t")) == [(1, "x", 1)]


def test_partition_column_is_a_whole_number(store, make):
    with pytest.raises(ValueError):
        store.change().replace_all("u", make("a string", ("x",)), "a")


def test_expire(store, make):
    for i in (0, 1, 2, 3, 0):
        store.change().upsert("t", make(DDL, (i, f"x{i}", i)), "k").publish()
    kept = content(store.read("t")), content(store.read("t", 4))
    commits = set(os.listdir(f"{store.path}/t"))
    assert store.expire(2) == [0, 1, 2, 3] and store.numbers() == [4, 5]
    assert kept == (content(store.read("t")), content(store.read("t", 4)))
    assert store.expire(2) == []
    named = {f.split("/")[0] for n in (4, 5) for f in store.tables(n)[1]["t"].files}
    assert set(os.listdir(f"{store.path}/t")) == named < commits


# ---- daily runs ---------------------------------------------------------------------------

def test_steps_in_one_join_equal_one_after_the_other(make, rows):
    target = make("list_id bigint, a int, b int", (1, 1, 1), (2, 2, 2), (3, 3, 3), (1, 9, 9),
                  (None, 4, 4))
    one = make("list_id bigint, x int", (1, 10), (2, 20), (7, 70), (None, 5))
    two = make("list_id bigint, y string", (1, "5"), (3, None))
    steps = [("one", {"a": F.col("chg.x"), "b": F.col("a")}),
             ("two", {"b": F.col("a") + F.coalesce(F.col("chg.y").cast("int"), F.lit(0))})]
    changes = change_set("list_id", {"one": one, "two": two})
    want = apply_changes(apply_changes(target, one, "list_id", steps[0][1]), two, "list_id",
                         steps[1][1])
    assert rows(apply_all(target, changes, "list_id", steps)) == rows(want) == [
        (None, 4, 4), (1, 10, 15), (1, 10, 15), (2, 20, 2), (3, 3, 3)]


@pytest.fixture(scope="module", params=["receive", "outcall"])
def day(request, spark):
    r = Roles(spark, SMALL)
    run, tables, columns = ((run_receive, r.receive_tables, RECEIVE_DETAIL)
                            if request.param == "receive"
                            else (run_outcall, r.outcall_tables, OUTCALL_DETAIL))
    detail = "detail" if request.param == "receive" else "callout_detail"
    store = Store(spark, fresh_path(spark, "store"))
    start_store(conform(tables[detail], columns),
                with_success_columns(tables["initiative_order_executor"]), store)

    def once(**options):
        own = {**tables, detail: store.read("detail"),
               "initiative_order_executor": store.read("executor")}
        return run(own, None, AS_OF, replace(OPTIONS, **options))
    return store, once


def test_merged_run_equals_the_full_new_version(day):
    store, once = day
    out = once()
    whole = {name: content(out[name].select(store.read(name).columns))
             for name in ("detail", "executor")}
    assert merge_run(out, store) == store.numbers()[-1]
    for name in ("detail", "executor"):
        assert content(store.read(name)) == whole[name]
    assert store.read("success_log").count() == out["success_log"].count() > 0
    # the next run of the day starts from the new version; a slice is merged like a whole run
    again = once(slice_only=True)
    assert again["new_orders"].count() == 0
    merge_run(again, store)
    assert store.read("detail").count() == len(whole["detail"])
    assert store.read("executor").count() == len(whole["executor"])


def test_staged_tables_are_cleared(spark, make):
    kept = stage(make("a int", (1,)), "kept")
    folder = shared_folder(spark)
    assert kept.count() == 1 and clear_staged(spark) > 0
    assert clear_staged(spark) == 0
    assert not [f for _, _, files in os.walk(f"{folder}/orderflow") for f in files
                if f.startswith("part-") and "kept" in f]

import re
import uuid

from pyspark.sql import functions as F

from orderflow.session import fresh_path, stage
from orderflow.sources import (SNAPSHOTS, append_new, append_rows, conform, empty_text_as_null,
                               read_area, refresh_snapshot, replace_slice, work_database,
                               write_by_area)


def test_replace_slice(spark, make, rows):
    table = f"{work_database(spark, 'orderflow_tests')}.t_{uuid.uuid4().hex}"
    ddl = "k bigint, v string"
    replace_slice(make(ddl, (1, "a"), (2, "b"), (3, "c")), table, "k", [1, 2, 3])
    replace_slice(make(ddl, (1, "x"), (1, "y"), (9, "ignored")), table, "k", [1, 2, 5])
    # 1 replaced, 2 emptied, 3 untouched, 9 not asked for, 5 never existed
    assert rows(spark.table(table), "k", "v") == [(1, "x"), (1, "y"), (3, "c")]
    replace_slice(make(ddl, (1, "x"), (1, "y")), table, "k", [1, 2, 5])
    assert rows(spark.table(table), "k", "v") == [(1, "x"), (1, "y"), (3, "c")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_areas(spark, make, rows):
    path = fresh_path(spark, "areas")
    write_by_area(make("id int, shard_id int", (1, 290), (2, 910), (3, 999)), path)
    some = read_area(spark, path, [290, 999])
    assert rows(some, "id") == [(1,), (3,)]
    plan = some._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[shard_id#\d+ IN \(290,999\)\]", plan)
    assert read_area(spark, path).count() == 3


def test_append(spark, make, rows):
    target = make("k bigint", (1,), (1,))
    new = make("k bigint, v string", (1, "a"), (2, "b"))
    assert rows(append_new(target, new, "k")) == [(2, "b")]
    path = fresh_path(spark, "log")
    append_rows(new, path)
    append_rows(new, path)
    assert spark.read.parquet(path).count() == 4


def test_snapshots(make, rows):
    src = make("a int, b string, c int", (1, "x", 1), (1, "x", 2))
    assert rows(refresh_snapshot(src, ["a", "b"])) == [(1, "x"), (1, "x")]
    stamped = refresh_snapshot(src, ["b", "a"], distinct=True, load_ts="2024-05-10 12:00:00")
    assert stamped.columns == ["b", "a", "load_date"] and stamped.count() == 1
    assert [len(SNAPSHOTS[t].columns) for t in (
        "tb_pty_grid_tree", "channel", "organization", "chn_sale_outlets_grid_rel", "staff",
        "system_user", "mkt_campaign_all", "block_contractor_rela")] == [
        53, 52, 11, 4, 38, 14, 40, 11]
    assert "password" not in SNAPSHOTS["system_user"].columns


def test_conform_and_empty_text(make, rows):
    df = make("a string, b string", ("", "7"))
    assert rows(empty_text_as_null(df)) == [(None, "7")]
    out = conform(df, {"b": "bigint", "n": "int"})
    assert out.dtypes == [("b", "bigint"), ("n", "int")] and rows(out) == [(7, None)]


def test_stage_survives_its_source(spark, make):
    staged = stage(make("a int", (1,), (2,)).withColumn("b", F.col("a") + 1), "x")
    assert staged.inputFiles() and staged.count() == 2


def test_replace_slice_with_rows_of_the_table_itself(spark, make, rows):
    database = work_database(spark, f"orderflow_{uuid.uuid4().hex}")
    table = f"{database}.slices"
    replace_slice(make("v int, k int", (1, 0), (1, 1), (1, 2)), table, "k", [0, 1, 2])
    # the filter no longer holds once the rows are written
    changed = spark.table(table).where("v = 1 and k < 2").withColumn("v", F.lit(2))
    replace_slice(changed, table, "k", [0, 1])
    assert rows(spark.table(table), "k", "v") == [(0, 2), (1, 2), (2, 1)]

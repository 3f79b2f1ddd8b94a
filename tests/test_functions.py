from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderflow.functions import day_window, instant, midnight, nth_part, part_count, to_bigint
from orderflow.functions import numbers as nu
from orderflow.operators.text_jobs import explode_conditions, pick_part


@pytest.mark.parametrize("text, sep, count", [
    (None, ",", 0), ("", ",", 0), ("a", ",", 1), ("a,b", ",", 2), (",", ",", 2),
    ("a,,b,", ",", 4), ("a||b||c", "||", 3), ("a.b", ".", 2)])
def test_part_count(make, text, sep, count):
    df = make("t string", (text,))
    assert df.select(part_count(F.col("t"), sep)).head()[0] == count


@pytest.mark.parametrize("n, left, value", [
    (1, 1, "a"), (2, 1, "b"), (4, 1, None), (1, 0, "c"), (3, 0, "a"), (0, 1, None),
    (0, 0, None), (5, 0, None), (1, None, "c"), (None, 1, None), (-1, 1, None)])
def test_nth_part(make, n, left, value):
    df = make("t string, n int, l int", ("a,b,c", n, left))
    assert pick_part(df, "t", "n", "l", "out").head().out == value


def test_nth_part_empty_and_null(make):
    df = make("t string", ("a,,c",), (None,))
    assert [r[0] for r in df.select(nth_part(F.col("t"), 2, ",")).collect()] == [None, None]


def test_explode_conditions(make, rows):
    df = make("id int, c string", (1, "custId:5,relId:,x"), (2, None), (3, ""))
    assert rows(explode_conditions(df, "c")) == [
        (1, 1, "custId", "5", 3), (1, 2, "relId", None, 3), (1, 3, "x", None, 3)]


def test_window_bounds(make, rows):
    df = make("id int, t timestamp_ntz",
              (1, datetime(2024, 5, 9)), (2, datetime(2024, 5, 9, 0, 0, 1)),
              (3, datetime(2024, 5, 10)), (4, datetime(2024, 5, 8, 23, 59, 59)), (5, None))
    at = "2024-05-10 15:00:00"
    assert rows(day_window(df, "t", at), "id") == [(1,), (2,)]
    assert rows(day_window(df, "t", at, closed_start=False), "id") == [(2,)]
    assert rows(day_window(df, "t", datetime(2024, 5, 10, 1), days=2), "id") == [
        (1,), (2,), (4,)]


def test_window_on_zoned_timestamps(make, rows):
    df = make("id int, s string", (1, "2024-05-09 00:00:00"), (2, "2024-05-10 00:00:00"))
    zoned = df.withColumn("t", F.col("s").cast("timestamp"))
    assert rows(day_window(zoned, "t", "2024-05-10 15:00:00"), "id") == [(1,)]


def test_instants(spark):
    row = spark.range(1).select(instant("2024-03-01 10:20:30", -1).alias("a"),
                                midnight("2024-03-01 10:20:30").alias("b")).head()
    assert row.a == datetime(2024, 2, 29, 10, 20, 30)
    assert row.b == datetime(2024, 3, 1)


def test_to_bigint(make):
    df = make("t string", ("12",), ("x",), ("1.5",), (None,))
    assert [r[0] for r in df.select(to_bigint("t")).collect()] == [12, None, None, None]


def test_casts_are_tried_on_texts_that_they_can_read(make):
    """A cast that fails takes many times as long as one that doesn't, also with try_cast."""
    texts = ("12", "-7", " 12 ", "5.0", "1.25E1", "1200e-2", "n12", "x", "", "NaN", "1998-07-01",
             "1998-07-01 10:00:00", "1.2.3", "1e5e5", "1,000", "true", "0.5")
    number, integer = (f"NOT t RLIKE '{p}'" for p in (nu._NO_NUMBER, nu._NO_INTEGER))
    got = make("t string", *[(t,) for t in texts]).selectExpr(
        "t", f"{number} AS decimal", f"{number} AND {integer} AS whole",
        "try_cast(t AS DECIMAL(38, 18)) IS NOT NULL AS is_decimal",
        "try_cast(t AS BIGINT) IS NOT NULL AS is_whole").collect()
    assert [r.t for r in got if (r.decimal, r.whole) != (r.is_decimal, r.is_whole)] == []


def test_to_bigint_like_plain_casts(make):
    """Looking at a text's characters first loses no number, whatever they are."""
    ends = ("", " ", "\t", "\n", "\x00", "\x7f", "\x85", "\xa0", "+", "-", ".", "e", "E2", "e-1",
            "e+", "d", "\u0661")
    texts = [a + m + b for a in ends for m in ("", "7", "70.0", "1.5", "\u0662") for b in ends]
    got = make("t string", *[(t,) for t in texts]).select(
        "t", to_bigint("t").alias("new"), F.expr(nu.whole_sql("t")).alias("sql"),
        F.expr("coalesce(try_cast(t AS BIGINT), CASE WHEN try_cast(t AS DECIMAL(38, 18)) = "
               "try_cast(try_cast(t AS DECIMAL(38, 18)) AS BIGINT) THEN "
               "try_cast(try_cast(t AS DECIMAL(38, 18)) AS BIGINT) END)").alias("plain")).collect()
    assert len([r for r in got if r.plain is not None]) > 100
    assert [r.t for r in got if not r.new == r.sql == r.plain] == []

"""Exact deduplication by content sort, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import ROW_FILE, ROW_INDEX, ROW_KEY, keyed, stage

#: A text that has at least one in so many rows, or so many rows, is dealt over several ranges.
#: So no range holds more copies of a text than that.
HOT_PART, HOT_ROWS = 1000, 100_000
#: Characters of a splitter; longer equal beginnings are told apart by a hash.
SPLITTER = 48


def squeezed(text: Column) -> Column:
    """The text without blanks, tabs, line ends, vertical tabs, form feeds; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for character in (" ", "\n", "\t", "\r", "\x0b", "\x0c"):
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """Which rows have equal texts, and which row of each group stays.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Texts are equal when
    :func:`squeezed` makes them identical; null and blank texts are equal to the empty one. The
    row with the most code points in its original text stays, of these the one with the smallest
    id (no id comes last), of these the first in its file. Returns one row per input row: the row
    key, doc_id, keep_id, group_size, kept, text_sha256 (of the squeezed text). An empty table
    gives no rows.

    Sampled splitters (the text's beginning, then a hash) deal the rows into ranges; each range
    is sorted by the whole text, so equal texts are neighbours and a window compares each text
    with the one before. A text that fills a thousandth of the rows, or ``HOT_ROWS``, is salted: its
    copies form several sorted runs, whose winners (a few rows per such text) are merged by digest.
    What is written to the shared folder has no texts. The lists of such texts are staged, so Spark
    broadcasts them as long as they are small.
    """
    text = F.col("text").cast("string")
    rows = keyed(docs).select(
        *ROW_KEY, F.col("doc_id").cast("long").alias("doc_id"),
        F.length(F.coalesce(text, F.lit(""))).alias("points"), squeezed(text).alias("norm"))
    rows = rows.withColumn("hash", F.xxhash64("norm"))
    part = min(-(-rows.count() // HOT_PART), HOT_ROWS)
    hot = stage(rows.groupBy("hash").agg(F.count("*").alias("n"))
                .where((F.col("n") >= part) & (F.col("n") > 1))
                .select("hash", F.ceil(F.col("n") / max(part, 1)).cast("long").alias("runs")),
                "hot_texts")
    salt = F.when(F.col("runs").isNull(), F.lit(-1)).otherwise(
        F.pmod(F.xxhash64(*ROW_KEY), F.col("runs")))
    salted = (rows.join(hot, "hash", "left")
              .withColumn("salt", salt).withColumn("splitter", F.left("norm", F.lit(SPLITTER)))
              .drop("runs").repartitionByRange("splitter", "hash", "salt"))
    run = Window.partitionBy("splitter", "hash", "norm", "salt")
    order = [F.desc("points"), F.asc_nulls_last("doc_id"), F.asc(ROW_FILE), F.asc(ROW_INDEX)]
    best = F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("no_id"),
                    "doc_id", *ROW_KEY)
    marked = stage(salted.select(
        *ROW_KEY, "doc_id", "salt", F.sha2("norm", 256).alias("text_sha256"),
        F.first(best).over(run.orderBy(*order)).alias("best"),
        F.count("*").over(run).alias("n")), "marked")
    first = F.struct(*[F.col(f"best.{c}") for c in ROW_KEY]) == F.struct(*ROW_KEY)
    merged = (marked.where((F.col("salt") >= 0) & first).groupBy("text_sha256")
              .agg(F.min("best").alias("all_best"), F.sum("n").alias("all_n")))
    out = (marked.join(stage(merged, "merged"), "text_sha256", "left")
           .withColumn("best", F.coalesce("all_best", "best")))
    return out.select(
        *ROW_KEY, "doc_id", F.col("best.doc_id").alias("keep_id"),
        F.coalesce("all_n", "n").alias("group_size"), first.alias("kept"), "text_sha256")


def distinct_texts(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with the columns they came with."""
    rows = keyed(docs)
    gone = stage(duplicate_groups(rows).where(~F.col("kept")).select(*ROW_KEY), "gone")
    return rows.join(gone, ROW_KEY, "left_anti").drop(*ROW_KEY)

"""Row keys, staged tables and connected components shared by the operators."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from orderflow.session import fresh_path, stage

ROW_FILE, ROW_INDEX = "__row_file", "__row_index"
ROW_KEY = [ROW_FILE, ROW_INDEX]

# A to Z in lower case; every other byte is itself.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

# Bytes outside 0-9, A-Z, a-z and non-ASCII become blanks, A to Z lower case.
_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
WORDS = bytes(b if b in _WORD else 32 for b in LOWER)


_shipped: set[str] = set()

#: Bytes of the rows that a Python worker gets at once.
BATCH_BYTES = 2 << 20


def prepare(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, and bound their batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        base = os.path.join(tempfile.mkdtemp(prefix="orderflow-code-"), "orderflow_package")
        context.addPyFile(shutil.make_archive(base, "zip", top, "orderflow"))
        _shipped.add(context.applicationId)


_held: dict = {}


def worker_memory(name: str, make):
    """What a Python worker keeps between its tasks: one thing, that of the last ``name``.

    A worker serves one operator after the other, so what the earlier one kept is let go.
    """
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame) -> DataFrame:
    """``df`` with two more columns that name each row, equal rows and null ids included.

    They are the file and the row's place in it, so they do not depend on how a scan is split
    and stay the same when a lost executor's work is repeated. Rows that are not plain rows of
    files, with columns chosen or computed and rows filtered, are written to the shared folder
    first: pieces of a row would share its place. Rows that have the columns are left alone.
    """
    if set(ROW_KEY) <= set(df.columns):
        return df
    if not _plain(df):
        return _places(_staged(df))
    try:
        return _places(df)
    except AnalysisException:
        return _places(_staged(df))


#: Steps of a plan that leave at most one row of each row read.
_ROW_BY_ROW = {"Project", "Filter", "SubqueryAlias"}


def _plain(df: DataFrame) -> bool:
    """Whether ``df`` is a file scan with projections and filters that give the same each time."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in _ROW_BY_ROW:
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def _staged(df: DataFrame) -> DataFrame:
    """The rows in files of the shared folder, where any column names may stand."""
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return stage(numbered, "rows").toDF(*df.columns)


def _places(df: DataFrame) -> DataFrame:
    # the hidden column, also of a table that has one of this name
    place = df.metadataColumn("_metadata")
    out = df.select(F.xxhash64(place["file_path"]).alias(ROW_FILE),
                    place["row_index"].alias(ROW_INDEX), *[df[c] for c in df.columns])
    out.schema  # noqa: B018  analysis happens here
    return out


def hexed_ids(ids) -> object:
    """SHA-256 of an array's distinct values, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(ids)), ","), 256)


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating large and small stars.

    ``edges`` has the columns ``a`` and ``b`` of any ordered type. The result has one row
    (``node``, ``root``) for each node of an edge; the root is the component's smallest node.
    Each round is two aggregations; the rounds grow with the logarithm of the longest chain. A
    hub's neighbours are never gathered: the smallest neighbour is an aggregate that is joined
    back, and such joins are split where they are skewed. Every round is written to the shared
    folder. No edges give no rows.
    """
    now = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"),
                                             F.greatest("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = (both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b")
                 .where("a <> b").distinct())
        large = stage(large, "large_star")
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(low, "b")
        small = stage(joined.select(F.col("m").alias("a"), "b")
                      .union(joined.where("a <> m").select(F.col("m").alias("a"),
                                                           F.col("a").alias("b"))).distinct(),
                      "small_star")
        same = (now.exceptAll(small).isEmpty() and small.exceptAll(now).isEmpty())
        now = small
        if same:
            break
    return (now.select(F.col("b").alias("node"), F.col("a").alias("root"))
            .union(now.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct())


__all__ = ["LOWER", "ROW_FILE", "ROW_INDEX", "ROW_KEY", "WORDS", "components", "fresh_path",
           "hexed_ids", "keyed", "prepare", "stage", "table",
           "worker_memory"]

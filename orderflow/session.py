"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on.
#  * skew joins are split even when that costs one more exchange: a campaign, area, department
#    or customer may own a third of the rows;
#  * a table already partitioned by order id is reused for joins on (area, order id), so the
#    anti-join against the detail and the executor join share one exchange.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

_local_folders: dict[str, str] = {}
_used_folders: dict[str, set[str]] = defaultdict(set)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session and return it."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = _local_folders.get(context.applicationId)
        if folder is None:
            folder = tempfile.mkdtemp(prefix="orderflow-")
            _local_folders[context.applicationId] = folder
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody has written to yet."""
    folder = f"{shared_folder(spark)}/orderflow/{uuid.uuid4().hex}"
    _used_folders[spark.sparkContext.applicationId].add(folder)
    return f"{folder}/{name}"


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds, wherever Spark can write; False when there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_staged(spark: SparkSession) -> int:
    """Delete everything this application has staged so far; the number of folders.

    Call it when the results of a run are saved: DataFrames that read staged tables, such as a
    run's outputs, can't be used any more. Other applications' tables stay.
    """
    folders = _used_folders.pop(spark.sparkContext.applicationId, set())
    return sum(remove_folder(spark, folder) for folder in folders)


def stage(df: DataFrame, name: str, by: str | None = None, plain: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it.

    Cuts the lineage, so several outputs share one computation and a lost executor costs a
    re-read. Spark also learns the size of its files: joins against a staged table broadcast it
    when that is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffle it otherwise. Files
    of repeated values are small for their rows; with ``plain`` they are neither compressed nor
    encoded, so their size is near that of the rows in memory. With ``by`` the table is
    partitioned by that column, large values spread over several tasks.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    writer = (df if by is None else df.hint("rebalance", by)).write
    if plain:
        writer = writer.option("compression", "none").option("parquet.enable.dictionary", "false")
    (writer if by is None else writer.partitionBy(by)).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint that keeps the partitions and the row order inside them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def together(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """Run independent steps that start jobs at the same time; their results in order."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [r.result() for r in running]

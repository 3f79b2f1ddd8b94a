"""Tables kept in buckets of their key, so that joins by the key need no exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save ``df`` as a table of ``buckets`` sorted buckets by ``key``, one file each.

    Tables with the same number of buckets, or a multiple, are joined bucket by bucket; choose it
    so that a bucket of the largest table fits one task.
    """
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
     .mode("overwrite").saveAsTable(table))

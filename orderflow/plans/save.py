"""Writing what a daily run returns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from orderflow.sources.sinks import append_rows
from orderflow.sources.versions import Store

# Column a new version is partitioned by, and the outputs that only grow.
PARTITIONS = {"detail": ("a_mkt_campaign_id", "sub_campaign_id"), "executor": ("shard_id",)}
LOGS = ("success_log", "run_log", "errors")


def save_run(outputs: Mapping[str, DataFrame], version: str, logs: str) -> dict[str, DataFrame]:
    """Write the new versions below ``version`` and append the log rows below ``logs``.

    ``version`` is a new folder per run: the run reads the version before, so nothing is
    overwritten while it is read, and readers switch when all is written. The logs come last; a
    run that failed before may be repeated whole. Returns the new versions as tables.

    A run with ``slice_only`` is refused with a ValueError before anything is written: its detail
    lacks all other campaigns. ``replace_slice`` writes it back, for the values in ``slices``.
    """
    if "slices" in outputs:
        raise ValueError("detail is a slice of the running campaigns; write it with replace_slice")
    written = {}
    for name, keys in PARTITIONS.items():
        df = outputs[name]
        key = next(k for k in keys if k in df.columns)
        path = f"{version.rstrip('/')}/{name}"
        df.hint("rebalance", key).write.partitionBy(key).parquet(path)
        written[name] = df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)
    for name in LOGS:
        if name in outputs:
            append_rows(outputs[name], f"{logs.rstrip('/')}/{name}")
    return written


def start_store(detail: DataFrame, executor: DataFrame, store: Store) -> int:
    """The first version of a store's ``detail`` and ``executor``, which ``merge_run`` updates."""
    change = store.change()
    for name, df in (("detail", detail), ("executor", executor)):
        change.replace_all(name, df, next(k for k in PARTITIONS[name] if k in df.columns))
    return change.publish()


def merge_run(outputs: Mapping[str, DataFrame], store: Store, *, stays: bool = False) -> int:
    """Write what a run changes into ``store``, all tables and logs in one new version.

    Only files with a changed order are rewritten (see ``Change.upsert``, also for ``stays``), so
    this costs what the day changes, and a run with ``slice_only`` is merged like any other.
    Nothing is seen of a run that fails on the way; it is repeated whole.
    """
    change = store.change()
    for name, key in (("detail", "list_id"), ("executor", "initiative_order_id")):
        change.upsert(name, outputs[f"{name}_updates"], key, stays=stays)
    for name in LOGS:
        if name in outputs:
            change.append(name, outputs[name])
    return change.publish()

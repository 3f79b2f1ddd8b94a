"""Refresh of the dimension tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial
from typing import Any

from pyspark.sql import DataFrame

from orderflow.functions.clock import AsOf
from orderflow.operators.orgs import org_callers
from orderflow.session import together
from orderflow.sources.dimensions import SNAPSHOTS, Snapshot
from orderflow.sources.snapshots import empty_text_as_null, refresh_snapshot
from orderflow.sources.versions import Store

CALLERS = "callout_bssorg_caller_rel"


def _refreshed(sources: Mapping[str, DataFrame], as_of: AsOf,
               snapshots: Mapping[str, Snapshot]) -> dict[str, DataFrame]:
    written = {}
    for name, spec in snapshots.items():
        if name in sources:
            written[name] = refresh_snapshot(
                empty_text_as_null(sources[name]), spec.columns or None,
                distinct=spec.distinct, load_ts=as_of if spec.stamped else None)
    if {"sys_bss_org", "sys_user_job", "sys_user"} <= set(sources):
        written[CALLERS] = org_callers(sources["sys_bss_org"], sources["sys_user_job"],
                                       sources["sys_user"], as_of)
    return written


def _at_once(write: Callable[[str, DataFrame], Any], tables: dict[str, DataFrame]
             ) -> dict[str, Any]:
    """Write all tables at the same time: a dimension is often read and written by few tasks."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    done = together(spark, *[partial(write, name, df) for name, df in tables.items()])
    return dict(zip(tables, done, strict=True))


def refresh_dimensions(sources: Mapping[str, DataFrame], folder: str, as_of: AsOf, *,
                       snapshots: Mapping[str, Snapshot] = SNAPSHOTS) -> dict[str, DataFrame]:
    """Write a new version of every dimension that has a source, and of the caller mapping.

    Each goes to ``folder/<table>``; pass a new folder per run and point readers to it when the
    run is done, so nobody sees a half-loaded table. The caller mapping is written when
    ``sys_bss_org``, ``sys_user_job`` and ``sys_user`` are among the sources.
    """
    def written(name: str, df: DataFrame) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return _at_once(written, _refreshed(sources, as_of, snapshots))


def refresh_store(sources: Mapping[str, DataFrame], store: Store, as_of: AsOf, *,
                  snapshots: Mapping[str, Snapshot] = SNAPSHOTS) -> int:
    """As refresh_dimensions, into a store: all tables change in one moment."""
    change = store.change()
    _at_once(change.replace_all, _refreshed(sources, as_of, snapshots))
    return change.publish()

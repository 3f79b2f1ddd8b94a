"""Rebuild of the report tables, one slice per main campaign."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.operators.reports import (LEVELS, Names, ResultCodes, callout_level, order_cube,
                                         receive_cube, receive_level, receive_report)
from orderflow.session import stage
from orderflow.sources.sinks import replace_slice
from orderflow.sources.versions import Store


def rebuild_reports(callout: DataFrame, receive: DataFrame, rules: DataFrame, names: Names,
                    receive_names: Mapping[str, DataFrame], catalogs: Sequence[int],
                    database: str, codes: ResultCodes = ResultCodes()) -> dict[str, str]:
    """Replace the catalogues' slices of all six report tables; returns report -> table name.

    The four telephone reports share one staged cube, so their detail is read once.
    """
    wanted = list(catalogs)
    tables = {}
    mine = callout.where(F.col("main_campaign_id").isin(wanted))
    cube = stage(order_cube(mine, list(LEVELS), codes), "callout_cube")
    rules = stage(rules, "report_rules")
    for level in LEVELS:
        name = f"{database}.callout_order_detail_{level}"
        replace_slice(callout_level(cube, rules, names, level), name, "main_campaign_id", wanted)
        tables[f"callout_{level}"] = name
    received = receive.where(F.col("z_mkt_campaign_id").isin(wanted))
    for level in ("sec", "org"):
        name = f"{database}.t_order_receive_detail_{level}"
        replace_slice(receive_report(received, level=level, names=receive_names), name,
                      "z_mkt_campaign_id", wanted)
        tables[f"receive_{level}"] = name
    return tables


#: The report tables.
REPORTS = (*[f"callout_{level}" for level in LEVELS], "receive_sec", "receive_org")
#: A store's state: per table the campaign that its rows can be replaced by.
_STATE = {"callout_cube": "sub_campaign_id", "receive_cube": "a_mkt_campaign_id"}


def refresh_reports(store: Store, callout: DataFrame, receive: DataFrame, rules: DataFrame,
                    names: Names, receive_names: Mapping[str, DataFrame], *,
                    changed: Sequence[int] | None = None, reports: Sequence[str] = REPORTS,
                    codes: ResultCodes = ResultCodes()) -> int:
    """Make the six report tables of ``store`` anew, all in one new version; its number.

    The store keeps what the reports are added up from, per sub-campaign: the two cubes, whose
    counts of distinct orders add up because an order has one campaign, and whose rows name the
    offices. With ``changed``, the sub-campaigns whose details have changed since, only their
    details are read and only their part of the cubes is written; the reports, a few rows per
    campaign, come from the cubes. ``None`` reads all details. ``reports`` limits which tables
    of ``REPORTS`` are made.
    """
    change = store.change()
    made = {"callout_cube": (callout, lambda rows: order_cube(rows, list(LEVELS), codes)),
            "receive_cube": (receive, receive_cube)}
    for table, (detail, cube) in made.items():
        key = _STATE[table]
        if changed is None or table not in change.tables:
            change.replace_all(table, cube(detail), key)
        else:
            part = detail.where(F.col(key).isin([int(c) for c in changed]))
            change.replace_partitions(table, cube(part), changed)
    rules = stage(rules, "report_rules")
    for report in reports:
        kind, level = report.split("_")
        if kind == "callout":
            change.replace_all(report, callout_level(
                change.read("callout_cube"), rules, names, level), "main_campaign_id")
        else:
            change.replace_all(report, receive_level(
                change.read("receive_cube"), level=level, names=receive_names),
                "z_mkt_campaign_id")
    return change.publish()

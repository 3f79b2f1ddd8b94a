"""Active campaigns, the areas they run in, and the success rules attached to them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from orderflow.functions.clock import AsOf, midnight
from orderflow.functions.text import parts
from orderflow.operators.quality import error_log

# Fixed values.
ACTIVE = "10A"
CATALOG_ATTRIBUTE = "MKT_CPC_CAMPAIGN_CATALOG"
AREAS = "290,919,910,911,912,913,914,915,916,917"
APPLICATION = "bsscall"
TELEPHONE = 6
PROVINCE_AREA = 999
UNKNOWN_AREA = 888
ACTIVE_RULE = 10
MAX_RULES = 20


def explode_list(df: DataFrame, col: str, out: str, sep: str = ",") -> DataFrame:
    """One row per non-empty part of a delimited text column, as an integer.

    Parts that are not integers have no row here but one in :func:`list_errors`.
    """
    items = df.withColumn(out, F.explode(parts(F.col(col), sep)))
    return items.withColumn(out, F.col(out).try_cast("int")).where(F.col(out).isNotNull())


def list_errors(df: DataFrame, col: str, key: str, job: str, sep: str = ",") -> DataFrame:
    """Error rows of the parts of a delimited text column that are not integers."""
    items = df.withColumn("_part", F.explode(parts(F.col(col), sep)))
    bad = items.where((F.trim("_part") != "") & F.col("_part").try_cast("int").isNull())
    return error_log(bad, job, key, F.concat(F.lit(f"{col}: not a whole number: "), F.col("_part")),
                     F.lit("-6502"))


def area_array(areas: str | Iterable[int]) -> Column:
    """A constant area list as an array literal."""
    if isinstance(areas, str):
        areas = [int(a) for a in areas.split(",") if a.strip()]
    return F.array(*[F.lit(int(a)) for a in areas])


def active_campaigns(campaigns: DataFrame, attrs: DataFrame, regions: DataFrame,
                     catalog: int | None, as_of: AsOf, *,
                     attr_name: str = CATALOG_ATTRIBUTE, grace_days: int = 7) -> DataFrame:
    """Campaigns attached to a catalogue that are active and ended at most a week ago.

    ``catalog=None`` covers every catalogue in one job.
    """
    end_type = campaigns.schema["end_date"].dataType.simpleString()
    running = campaigns.where((F.col("state") == ACTIVE)
                              & (F.col("end_date") > midnight(as_of, -grace_days, end_type)))
    attached = attrs.where(F.col("attr_nbr") == attr_name)
    if catalog is not None:
        attached = attached.where(F.col("attr_value_id") == catalog)
    return (running
            .join(attached, running["campaign_id"] == attached["mkt_campaign_id"])
            .join(regions, "region_id")
            .select(F.col("attr_value_id").alias("main_campaign_id"),
                    F.col("attr_value").alias("main_campaign_name"),
                    F.col("campaign_id").alias("sub_campaign_id"),
                    F.col("campaign_name").alias("sub_campaign_name"),
                    "region_id", "region_name", "region_id_old"))


def app_channels(channels: DataFrame, app: str = APPLICATION) -> DataFrame:
    """Channel ids of one application."""
    return channels.where(F.col("app_name") == app).select("channel_id")


def _on_channel(active: DataFrame, channel_rel: DataFrame) -> DataFrame:
    return active.join(channel_rel, active["sub_campaign_id"] == channel_rel["campaign_id"],
                       "left_semi")


def _fan_out(active: DataFrame, province_wide: Column, own_area: Column,
             areas: str | Iterable[int]) -> DataFrame:
    # an array per campaign instead of a join with the area list: no shuffle, no cross join
    scope = F.when(province_wide, area_array(areas)).otherwise(F.array(own_area.cast("int")))
    return active.withColumn("latn_id", F.explode(scope))


def campaigns_by_area(active: DataFrame, channel_rel: DataFrame, *, mode: str,
                      channels: DataFrame | None = None,
                      areas: str | Iterable[int] = AREAS) -> DataFrame:
    """(sub-campaign, area) pairs to work on; repeated attachments stay repeated.

    ``receive``: campaigns on an application channel. Old region code 999 means every area, any
    other code is the area, and NULL stands for area 888.
    ``outcall``: campaigns on the telephone channel. A NULL old code means every area, any other
    code, 999 included, is the area.
    """
    old = F.col("region_id_old")
    if mode == "receive":
        allowed = channel_rel.join(channels, "channel_id", "left_semi")
        code = F.coalesce(old, F.lit(UNKNOWN_AREA))
        return _fan_out(_on_channel(active, allowed), code == PROVINCE_AREA, code, areas)
    if mode == "outcall":
        allowed = channel_rel.where(F.col("channel_id") == TELEPHONE)
        return _fan_out(_on_channel(active, allowed), old.isNull(), old, areas)
    raise ValueError(f"unknown mode {mode!r}")


def success_rules(rules: DataFrame, rel: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Rules attached both to the main campaign and to the sub-campaign, ranked per pair.

    Evaluation order is the main campaign's ``seq``; ties go by rule and relation id. All rules of
    a pair are ranked, however many there are; only the report has ``MAX_RULES`` columns.
    """
    pairs = campaigns.select("main_campaign_id", "sub_campaign_id").distinct()
    main = rel.where(F.col("rel_type") == 1).select(
        F.col("campaign_id").alias("main_campaign_id"), "suc_rule_id", "seq")
    sub = rel.where(F.col("rel_type") == 2).select(
        F.col("campaign_id").alias("sub_campaign_id"), "suc_rule_id", "rel_id")
    usable = rules.where(F.col("state") == ACTIVE_RULE).drop("state")
    # start from the sub-campaign's own rules: a rule attached to every campaign never meets
    # itself on both sides
    attached = (pairs.join(sub, "sub_campaign_id")
                .join(main, ["main_campaign_id", "suc_rule_id"])
                .join(usable, "suc_rule_id"))
    order = (W.partitionBy("main_campaign_id", "sub_campaign_id")
             .orderBy(F.col("seq").asc_nulls_last(), "suc_rule_id", "rel_id"))
    return attached.withColumn("seq_no", F.row_number().over(order))

"""Report tables: telephone orders by organisation level, received orders by grid and office."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from orderflow.operators.apply import FLAG_COLUMNS
from orderflow.operators.orders import UNASSIGNED
from orderflow.session import checkpointed

EXECUTED_FROM = 3100

# Report levels, coarse to fine: the keys of a level are a prefix of the next one's.
_BASE = ("main_campaign_id", "sub_campaign_id", "region_id", "prov_dept_id", "city_dept_id")
LEVELS: dict[str, tuple[str, ...]] = {
    "prov": _BASE,
    "city": (*_BASE, "team_dept_id"),
    "team": (*_BASE, "team_dept_id", "class_dept_id"),
    "class": (*_BASE, "team_dept_id", "class_dept_id", "caller_id"),
}
RESULT_MEASURES = ("callsucc_num", "next_num", "mktfail_num", "callfail_num")


@dataclass(frozen=True)
class ResultCodes:
    """Which ``order_result`` codes count as what."""

    callsucc_num: tuple[int, ...] = (0,)
    next_num: tuple[int, ...] = (1,)
    mktfail_num: tuple[int, ...] = (2,)
    callfail_num: tuple[int, ...] = (3,)


@dataclass(frozen=True)
class Names:
    """Dimensions (id, name) the report takes its names from."""

    main_campaign: DataFrame
    sub_campaign: DataFrame
    org: DataFrame
    caller: DataFrame


def _count(condition: Column) -> Column:
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def _flag_sums(detail: DataFrame, suffix: str = "") -> dict[str, Column]:
    """Sums of the rule columns the detail has; absent ones need no aggregation."""
    return {f"{c}{suffix}": F.sum(F.coalesce(F.col(c), F.lit(0)))
            for c in FLAG_COLUMNS if c in detail.columns}


def _with_absent_flags(df: DataFrame, suffix: str = "") -> DataFrame:
    absent = [f"{c}{suffix}" for c in FLAG_COLUMNS if f"{c}{suffix}" not in df.columns]
    return df.withColumns({c: F.lit(0).cast("bigint") for c in absent}) if absent else df


def _measures(detail: DataFrame, codes: ResultCodes) -> dict[str, Column]:
    return {
        "assign_num": _count(F.col("status_cd") != UNASSIGNED),
        "exe_num": _count(F.col("status_cd") >= EXECUTED_FROM),
        "mktsucc_num": _count(F.col("is_success") == 1),
        **{m: _count(F.col("order_result").isin(*getattr(codes, m))) for m in RESULT_MEASURES},
        **_flag_sums(detail, "_num"),
    }


def order_cube(detail: DataFrame, levels: Sequence[str],
               codes: ResultCodes = ResultCodes()) -> DataFrame:
    """Measures at the finest of ``levels``, with the order count of each level (``n_<level>``).

    Repeated rows of an order collapse first, map-side. An order is then counted in the first
    row of each level's group it appears in, so the counts of every level are distinct orders and
    all numbers of the small result add up to the coarser levels - the fact rows are never
    expanded once per level. The windows share one exchange and one sort; the finest level needs
    none, its groups are the collapsed rows.
    """
    finest = LEVELS[levels[-1]]
    measures = _measures(detail, codes)
    per_order = detail.groupBy("list_id", *finest).agg(
        *[m.alias(name) for name, m in measures.items()])
    for level in levels:
        rest = [k for k in finest if k not in LEVELS[level]]
        group = W.partitionBy("list_id", *LEVELS[level]).orderBy(*rest)
        first = (F.row_number().over(group) == 1).cast("int") if rest else F.lit(1)
        per_order = per_order.withColumn(f"n_{level}", first)
    return per_order.groupBy(*finest).agg(
        *[F.sum(f"n_{level}").alias(f"n_{level}") for level in levels],
        *[F.sum(name).alias(name) for name in measures])


def _totals(cube: DataFrame, order_counts: Sequence[str]) -> list[Column]:
    """Sums of every measure of the cube except the order counts of other levels."""
    return [F.sum(n).alias(n) for n in cube.columns
            if n.endswith("_num") or n in order_counts]


def with_ordinal(df: DataFrame, keys: Sequence[str], group: str, out: str) -> DataFrame:
    """Number the rows of each ``group`` by ``keys`` (NULL first) without a single-task sort.

    ``keys`` starts with ``group`` and is unique. Rows are range-partitioned and sorted; the
    positions are fixed by a reliable checkpoint, and each partition's share of a group is
    shifted by what the partitions before it hold.
    """
    placed = checkpointed(
        df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys])
        .sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id()))
    # one row per (partition, group): few, whatever the number of report rows
    runs = placed.groupBy("_part", F.col(group).alias("_group")).agg(
        F.min("_pos").alias("_start"), F.count(F.lit(1)).alias("_size"))
    before = W.partitionBy("_group").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    runs = runs.select(F.col("_part").alias("_p"), "_group", "_start", "_before")
    return (placed.join(runs, (F.col("_part") == F.col("_p"))
                        & F.col(group).eqNullSafe(F.col("_group")))
            .withColumn(out, F.col("_pos") - F.col("_start") + F.col("_before") + 1)
            .drop("_part", "_pos", "_p", "_group", "_start", "_before"))


def _with_name(df: DataFrame, dim: DataFrame, key: str, out: str) -> DataFrame:
    id_col, name_col = dim.columns
    names = dim.groupBy(F.col(id_col).alias("_id")).agg(F.min(name_col).alias(out))
    return df.join(names, F.col(key) == F.col("_id"), "left").drop("_id")


def _with_rules(cube: DataFrame, rules: DataFrame) -> DataFrame:
    """Number of configured rules and the rule name behind every rule column.

    A pair has at most as many rules as there are rule columns, so they fit one small map.
    """
    pair = ["main_campaign_id", "sub_campaign_id"]
    per_column = rules.groupBy(*pair, F.coalesce(F.lower("report_column"), F.lit("")).alias("c")
                               ).agg(F.min("rule_name").alias("rule_name"),
                                     F.collect_set("suc_rule_id").alias("ids"))
    per_pair = per_column.groupBy(*pair).agg(
        F.map_from_entries(F.collect_list(F.struct("c", "rule_name"))).alias("_rules"),
        F.size(F.array_distinct(F.flatten(F.collect_list("ids")))).cast("bigint").alias("_n"))
    joined = cube.join(per_pair, pair, "left")
    return joined.withColumns({
        "valid_col_num": F.coalesce("_n", F.lit(0).cast("bigint")),
        **{f"{c}_name": F.try_element_at("_rules", F.lit(c)) for c in FLAG_COLUMNS},
    }).drop("_rules", "_n")


def _callout_columns(level: str) -> list[str]:
    columns = ["main_campaign_id", "main_campaign_name", "sub_campaign_id", "sub_campaign_name",
               "region_id"]
    for key in LEVELS["class"][3:]:
        if key in LEVELS[level]:
            columns += [key, key.replace("_id", "_name")]
    columns += ["all_num", "assign_num", "exe_num", "callsucc_num", "next_num", "mktsucc_num",
                "mktfail_num", "callfail_num", "valid_col_num"]
    for c in FLAG_COLUMNS:
        columns += [f"{c}_num", f"{c}_name"]
    return columns


def _named(cube: DataFrame, names: Names, keys: Sequence[str]) -> DataFrame:
    cube = _with_name(cube, names.main_campaign, "main_campaign_id", "main_campaign_name")
    cube = _with_name(cube, names.sub_campaign, "sub_campaign_id", "sub_campaign_name")
    for key in keys[3:]:
        dim = names.caller if key == "caller_id" else names.org
        cube = _with_name(cube, dim, key, key.replace("_id", "_name"))
    return cube


def callout_report(detail: DataFrame, rules: DataFrame, names: Names, *, level: str,
                   codes: ResultCodes = ResultCodes()) -> DataFrame:
    """One level of the telephone report: keys with names, measures, rule columns, position."""
    return callout_level(order_cube(detail, [level], codes), rules, names, level)


def callout_level(cube: DataFrame, rules: DataFrame, names: Names, level: str) -> DataFrame:
    """One level of the telephone report from a cube that counts that level's orders."""
    keys = LEVELS[level]
    totals = cube.groupBy(*keys).agg(*_totals(cube, [f"n_{level}"])).withColumnRenamed(
        f"n_{level}", "all_num")
    placed = with_ordinal(_with_absent_flags(totals, "_num"), keys, keys[0], "or_seq")
    return _named(_with_rules(placed, rules), names, keys).select(*_callout_columns(level),
                                                                  "or_seq")


def callout_report_all(detail: DataFrame, rules: DataFrame, *,
                       codes: ResultCodes = ResultCodes()) -> DataFrame:
    """All four levels from one pass over the detail; ``level`` tells them apart.

    Keys finer than a row's level are NULL, and so may be a real team, class or caller.
    """
    levels = list(LEVELS)
    finest = LEVELS["class"]
    cube = order_cube(detail, levels, codes)
    sets = [list(LEVELS[level]) for level in levels]
    totals = cube.groupingSets([[F.col(k) for k in s] for s in sets],
                               *[F.col(k) for k in finest]).agg(
        F.grouping_id().alias("_gid"),
        *_totals(cube, [f"n_{level}" for level in levels]))
    # grouping_id sets the low bit for each finest key that is rolled up
    level_of = {(1 << (len(finest) - len(LEVELS[level]))) - 1: level for level in levels}
    name = F.coalesce(*[F.when(F.col("_gid") == g, F.lit(lv)) for g, lv in level_of.items()])
    count = F.coalesce(*[F.when(F.col("_gid") == g, F.col(f"n_{lv}"))
                         for g, lv in level_of.items()])
    out = (totals.withColumn("level", name).withColumn("all_num", count)
           .drop("_gid", *[f"n_{level}" for level in levels]))
    out = _with_rules(_with_absent_flags(out, "_num"), rules)
    return out.select("level", *finest, "all_num", "assign_num", "exe_num", "callsucc_num",
                      "next_num", "mktsucc_num", "mktfail_num", "callfail_num",
                      "valid_col_num", *[f"{c}_num" for c in FLAG_COLUMNS])


def _ratio(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))


_RECEIVE_KEYS = {
    "sec": ("z_mkt_campaign_id", "fir_grid_id", "sec_grid_id", "report_day", "cop_channel_id"),
    "org": ("z_mkt_campaign_id", "a_mkt_campaign_id", "fir_grid_id", "sec_grid_id",
            "thi_grid_id", "org_id", "org_jt_code", "report_day", "cop_channel_id")}
_RECEIVE_MEASURES = ("receive_suc_num", "claimed_count", "exe_count", "exe_suc_count")


def receive_cube(detail: DataFrame) -> DataFrame:
    """Measures of received orders per office and day, with the order count of both levels.

    Repeated rows of an order collapse first, map-side; an order is then counted in the first of
    its rows in each level's group (``n_sec``, ``n_org``), so all numbers add up to the coarser
    level, and the cubes of different campaigns' orders simply lie side by side: the cube of some
    campaigns can be made anew without the others. It relies on an order having one campaign.
    """
    day = F.col("report_date").try_cast("timestamp_ntz").cast("date")
    rows = detail.withColumn("report_day", F.date_format(day, "yyyy-MM-dd"))
    claimed, executed = F.col("user_id").isNotNull(), F.col("status_cd") >= EXECUTED_FROM
    won = F.col("is_success") == 1
    measures = dict(zip(_RECEIVE_MEASURES, map(_count, (won, claimed, executed, executed & won)),
                        strict=True)) | _flag_sums(rows)
    finest = _RECEIVE_KEYS["org"]
    per_order = rows.groupBy("list_id", *finest).agg(
        *[m.alias(name) for name, m in measures.items()])
    rest = [k for k in finest if k not in _RECEIVE_KEYS["sec"]]
    group = W.partitionBy("list_id", *_RECEIVE_KEYS["sec"]).orderBy(*rest)
    known = F.col("list_id").isNotNull()
    per_order = per_order.withColumns({
        "n_sec": (known & (F.row_number().over(group) == 1)).cast("int"),
        "n_org": known.cast("int")})
    return per_order.groupBy(*finest).agg(
        *[F.sum(name).alias(name) for name in ("n_sec", "n_org", *measures)])


def receive_report(detail: DataFrame, *, level: str,
                   names: Mapping[str, DataFrame]) -> DataFrame:
    """Received orders per day by second-level grid (``sec``) or by office (``org``).

    ``names``: ``campaign``, ``grid`` (keyed by tree_level and tree_id) and ``organization``.
    Orders and offices are counted distinct. A quotient is NULL when its divisor is 0.
    """
    return receive_level(receive_cube(detail), level=level, names=names)


def receive_level(cube: DataFrame, *, level: str, names: Mapping[str, DataFrame]) -> DataFrame:
    """One level of the report from a :func:`receive_cube`.

    Offices are counted by collapsing to one row per office first, so no row is multiplied for
    the distinct counts.
    """
    keys = _RECEIVE_KEYS[level]
    sums = [c for c in cube.columns if c in (*_RECEIVE_MEASURES, *FLAG_COLUMNS)]
    totals = [F.sum(c).alias(c) for c in sums]
    if level == "sec":
        offices = cube.groupBy(*keys, "org_id").agg(F.sum("n_sec").alias("n_sec"), *totals)
        office = F.col("org_id").isNotNull()
        counts = offices.groupBy(*keys).agg(
            F.sum("n_sec").alias("receive_num"), *totals,
            F.count_if(office).alias("receive_org_count"),
            F.count_if(office & (F.col("claimed_count") > 0)).alias("claimed_org_count"))
    else:
        counts = cube.groupBy(*keys).agg(F.sum("n_org").alias("receive_num"), *totals)
    counts = (_with_absent_flags(counts)
              .withColumn("order_claimed_per", _ratio("claimed_count", "receive_num"))
              .withColumn("report_date", F.to_timestamp_ntz("report_day", F.lit("yyyy-MM-dd"))))
    grid = names["grid"]

    def grid_name(df: DataFrame, tree_level: int, key: str, out: str) -> DataFrame:
        dim = grid.where(F.col("tree_level") == tree_level).select("tree_id", "tree_name")
        return _with_name(df, dim, key, out)

    counts = _with_name(counts, names["campaign"], "z_mkt_campaign_id", "campaign_name")
    if level == "sec":
        counts = grid_name(counts, 2, "sec_grid_id", "dept_name")
        counts = (counts.withColumn("suc_rec_per", _ratio("receive_suc_num", "receive_num"))
                  .withColumn("claimed_org_per",
                              _ratio("claimed_org_count", "receive_org_count")))
        head = ["z_mkt_campaign_id", "campaign_name", "fir_grid_id", "sec_grid_id", "dept_name",
                "receive_num", "receive_suc_num", "claimed_count", "exe_count",
                "exe_suc_count", "receive_org_count", "claimed_org_count", "suc_rec_per",
                "claimed_org_per"]
    else:
        counts = _with_name(counts, names["campaign"], "a_mkt_campaign_id", "c_campaign_name")
        counts = grid_name(counts, 2, "sec_grid_id", "sec_grid_name")
        counts = grid_name(counts, 3, "thi_grid_id", "thi_grid_name")
        counts = _with_name(counts, names["organization"], "org_id", "dept_name")
        # the most specific grid known for the office
        counts = counts.withColumn("grid_id",
                                   F.coalesce("thi_grid_id", "sec_grid_id", "fir_grid_id"))
        head = ["z_mkt_campaign_id", "a_mkt_campaign_id", "campaign_name", "c_campaign_name",
                "fir_grid_id", "sec_grid_id", "grid_id", "thi_grid_id", "org_id", "org_jt_code",
                "sec_grid_name", "thi_grid_name", "dept_name", "receive_num",
                "receive_suc_num", "claimed_count", "exe_count", "exe_suc_count"]
    return counts.select(*head, "order_claimed_per", "report_date", "report_day", *FLAG_COLUMNS,
                         "cop_channel_id")

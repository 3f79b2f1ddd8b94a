"""The organisation tree (province 1, city 2, team 3, class 4) and grid attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.clock import AsOf, instant
from orderflow.operators.campaigns import ACTIVE

# Fixed values.
CITY, TEAM, CLASS = 2, 3, 4
CALLER_ROLES = (10004, 10070, 10071)
NO_DEPARTMENT = -1
NO_GRID = -2
GRID_COLUMNS = ("fir_grid_id", "sec_grid_id", "thi_grid_id", "org_id")


def _level(org: DataFrame, name: str) -> DataFrame:
    return org.select(F.col("bss_org_id").alias(f"{name}_dept_id"),
                      F.col("bss_org_name").alias(f"{name}_dept_name"),
                      F.col("up_bss_org_id").alias(f"{name}_up"))


def org_callers(org: DataFrame, jobs: DataFrame, users: DataFrame, as_of: AsOf) -> DataFrame:
    """Callers with their class, team, city and province; organisation state is not looked at."""
    classes = org.where(F.col("bss_org_type_id") == CLASS)
    class_level = classes.select(
        F.col("area_id").alias("region_id"), F.col("bss_org_id").alias("class_dept_id"),
        F.col("bss_org_name").alias("class_dept_name"),
        F.col("up_bss_org_id").alias("class_up"))
    tree = (class_level
            .join(_level(org, "team"), F.col("class_up") == F.col("team_dept_id"))
            .join(_level(org, "city"), F.col("team_up") == F.col("city_dept_id"))
            .join(_level(org, "prov"), F.col("city_up") == F.col("prov_dept_id")))
    holders = (jobs.where(F.col("role_id").isin(*CALLER_ROLES))
               .select("user_id", F.col("bss_org_id").alias("class_dept_id")).distinct())
    callers = holders.join(users.select("user_id", "user_name"), "user_id")
    return (callers.join(tree, "class_dept_id")
            .select("region_id", "prov_dept_id", "prov_dept_name", "city_dept_id",
                    "city_dept_name", "team_dept_id", "team_dept_name", "class_dept_id",
                    "class_dept_name", F.col("user_id").alias("caller_id"),
                    F.col("user_name").alias("caller_name"),
                    instant(as_of, -1).alias("sync_date"))
            .distinct())


def city_with_province(org: DataFrame) -> DataFrame:
    """Active cities with their active province."""
    active = org.where(F.col("state") == ACTIVE)
    city = active.where(F.col("bss_org_type_id") == CITY).select(
        F.col("area_id").alias("region_id"), F.col("bss_org_id").alias("city_dept_id"),
        F.col("bss_org_name").alias("city_dept_name"),
        F.col("up_bss_org_id").alias("prov_dept_id"))
    prov = active.select(F.col("bss_org_id").alias("prov_dept_id"),
                         F.col("bss_org_name").alias("prov_dept_name"))
    return city.join(prov, "prov_dept_id").select(
        "region_id", "prov_dept_id", "prov_dept_name", "city_dept_id", "city_dept_name")


def class_with_team(org: DataFrame) -> DataFrame:
    """Active organisations with their active parent, as class and team.

    The class type is not required: whatever department an order names is looked up.
    """
    active = org.where(F.col("state") == ACTIVE)
    child = active.select(F.col("bss_org_id").alias("class_dept_id"),
                          F.col("bss_org_name").alias("class_dept_name"),
                          F.col("up_bss_org_id").alias("team_dept_id"))
    parent = active.select(F.col("bss_org_id").alias("team_dept_id"),
                           F.col("bss_org_name").alias("team_dept_name"))
    return child.join(parent, "team_dept_id").select(
        "class_dept_id", "class_dept_name", "team_dept_id", "team_dept_name")


def best_grid(grid: DataFrame) -> DataFrame:
    """One grid row per organisation code: a NULL third-level grid wins, else the largest one.

    The sentinel grid takes part in the ranking, so codes whose best grid is not above it get
    the sentinel. Ties go to the larger organisation and grid ids. A plain aggregate, hence
    combined map-side whatever the number of rows per code.
    """
    rank = F.struct(F.col("thi_grid_id").isNull().alias("open"),
                    F.col("thi_grid_id").alias("thi_grid_id"), F.col("org_id").alias("org_id"),
                    F.col("fir_grid_id").alias("fir_grid_id"),
                    F.col("sec_grid_id").alias("sec_grid_id"))
    best = grid.groupBy("org_jt_code").agg(F.max(rank).alias("g"))
    ranked = F.col("g.open") | (F.col("g.thi_grid_id") > NO_GRID)
    return best.select(
        F.col("org_jt_code"),
        *[F.when(ranked, F.col(f"g.{c}")).otherwise(F.lit(NO_GRID)).cast("bigint").alias(c)
          for c in GRID_COLUMNS])


def grid_lookup(changes: DataFrame, grid: DataFrame, dept: str = "dept_id") -> DataFrame:
    """Add the best grid of each row's department.

    No department gives grids -1 and no organisation; an unknown department gives -2 throughout.
    """
    best = best_grid(grid).select(F.col("org_jt_code").alias("_code"),
                                  *[F.col(c).alias(f"_{c}") for c in GRID_COLUMNS])
    joined = changes.join(best, F.col(dept) == F.col("_code"), "left")
    for c in GRID_COLUMNS:
        absent = F.lit(None) if c == "org_id" else F.lit(NO_DEPARTMENT)
        joined = joined.withColumn(
            c, F.when(F.col(dept).isNull(), absent.cast("bigint"))
            .when(F.col("_code").isNull(), F.lit(NO_GRID).cast("bigint"))
            .otherwise(F.col(f"_{c}")))
    return joined.drop("_code", *[f"_{c}" for c in GRID_COLUMNS])


def resolve_outcall_org(changes: DataFrame, org: DataFrame, users: DataFrame) -> DataFrame:
    """Decide what a changed telephone order's team, class and caller become.

    ``action`` is ``user`` (someone holds the order: class, team and caller), ``class`` or
    ``team`` (only a department does) or ``none``. ``problem`` says why a row cannot be applied:
    ``missing`` when a needed record does not exist, ``ambiguous`` when there are several.
    """
    tree = class_with_team(org).groupBy(F.col("class_dept_id").alias("_dept")).agg(
        F.count(F.lit(1)).alias("_tree_rows"), F.min("class_dept_name").alias("_class_name"),
        F.min("team_dept_id").alias("_team_id"), F.min("team_dept_name").alias("_team_name"))
    teams = (org.where(F.col("state") == ACTIVE)
             .groupBy(F.col("bss_org_id").alias("_org"))
             .agg(F.count(F.lit(1)).alias("_org_rows"),
                  F.min("bss_org_name").alias("_org_name")))
    names = (users.where(F.col("state") == ACTIVE)
             .groupBy(F.col("user_id").alias("_user"))
             .agg(F.count(F.lit(1)).alias("_user_rows"), F.min("user_name").alias("_user_name")))

    held = F.col("curr_user_id").isNotNull()
    dept = F.col("dept_id").isNotNull()
    action = (F.when(held, F.lit("user"))
              .when(dept & (F.col("org_type_id") == TEAM), F.lit("team"))
              .when(dept & (F.col("org_type_id") == CLASS), F.lit("class"))
              .otherwise(F.lit("none")))

    def problem(rows: str):
        count = F.coalesce(F.col(rows), F.lit(0))
        return F.when(count == 0, F.lit("missing")).when(count > 1, F.lit("ambiguous"))

    resolved = (changes
                .join(tree, F.col("dept_id") == F.col("_dept"), "left")
                .join(teams, F.col("dept_id") == F.col("_org"), "left")
                .join(names, F.col("curr_user_id") == F.col("_user"), "left")
                .withColumn("action", action))
    by_class = F.col("action").isin("user", "class")
    return resolved.select(
        *changes.columns, "action",
        F.when(F.col("action") == "user",
               F.coalesce(problem("_tree_rows"), problem("_user_rows")))
        .when(F.col("action") == "class", problem("_tree_rows"))
        .when(F.col("action") == "team", problem("_org_rows")).alias("problem"),
        F.when(by_class, F.col("_team_id"))
        .when(F.col("action") == "team", F.col("dept_id")).alias("team_dept_id"),
        F.when(by_class, F.col("_team_name"))
        .when(F.col("action") == "team", F.col("_org_name")).alias("team_dept_name"),
        F.when(by_class, F.col("dept_id")).alias("class_dept_id"),
        F.when(by_class, F.col("_class_name")).alias("class_dept_name"),
        F.when(F.col("action") == "user", F.col("curr_user_id")).alias("caller_id"),
        F.when(F.col("action") == "user", F.col("_user_name")).alias("caller_name"))

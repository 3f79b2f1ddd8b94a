"""Role views over the driver tables, as SQL that Spark and DuckDB both accept.

A view may name other views; ``with_views`` puts the ones a statement needs in front of it.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from orderflow.session import configure
from orderflow.sources.dimensions import SNAPSHOTS

# Driver tables; naming the schema spares a job per table to read it from the files.
BASE_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

AS_OF = "1998-07-01 08:30:00"
AREAS = "0,1,2,3,4,5,6,7,8,9"
CHANGE_DAYS = 365
PURCHASE_DAYS = 30

_STATUS = ("CASE {} % 6 WHEN 0 THEN 1100 WHEN 1 THEN 1101 WHEN 2 THEN 2100 WHEN 3 THEN 2200 "
           "WHEN 4 THEN 3100 ELSE 7000 END")
_ORDERS = "orders JOIN customer ON c_custkey = o_custkey"
_CHANNEL = "CAST(substr(o_orderpriority, 1, 1) AS INT) + 2"
_SHARD = "CASE WHEN o_orderkey % 10 = 0 THEN 999 ELSE c_nationkey END"

RULE_1 = ("select o.order_id from customer_order_syn o where o.cust_id = [CUSTID] "
          "and o.latn_id = [LATN_ID] and o.status_cd = 300000 and o.offer_id % 7 = 0")
RULE_2 = ("select o.order_id from customer_order_syn o where o.cust_id = [custId] "
          "and o.latn_id = [LATN_ID] and o.amount > 95000")
RULE_3 = ("select max(o.order_id) from customer_order_syn o where o.cust_id = [CUSTID] "
          "and o.latn_id = [LATN_ID] and o.offer_id % 50 = 1")
RULE_4 = ("select o.order_id from customer_order_syn o join part on p_partkey = o.offer_id "
          "where o.cust_id = [CUSTID] and o.latn_id = [LATN_ID] and p_brand = ''Brand#7''")
RULES = {1: RULE_1, 2: RULE_2, 3: RULE_3, 4: RULE_4}

# Rules as users write them. Ranges: by a band alone, and beside an equality.
RANGE_RULES = {
    21: "select o.order_id from customer_order_syn o where o.order_id between [PRODINSTID] - 35 "
        "and [PRODINSTID] + 64 and o.status_cd = 300000",
    22: "select o.order_id from customer_order_syn o where o.order_id > [PRODINSTID] and "
        "o.order_id < [PRODINSTID] + 500 * (1 + [CUSTID] % 3) and o.latn_id <> [LATN_ID]",
    23: "select o.order_id from customer_order_syn o where o.cust_id = [CUSTID] and "
        "o.order_id > [PRODINSTID] + 9",
    24: "select max(o.order_id) from customer_order_syn o where o.cust_id = [CUSTID] and "
        "o.order_id <> [PRODINSTID] + 1",
}
# Placeholders in subqueries.
NESTED_RULES = {
    31: "select o.order_id from customer_order_syn o where o.cust_id = [CUSTID] and exists "
        "(select 1 from part where p_partkey = o.offer_id and p_size % 5 = [LATN_ID] % 5)",
    32: "select o.order_id from customer_order_syn o where o.latn_id = [LATN_ID] and "
        "o.cust_id = [CUSTID] and not exists (select 1 from customer_order_syn l where "
        "l.cust_id = o.cust_id and l.order_id > o.order_id and l.order_id < [PRODINSTID])",
    33: "select o.order_id from customer_order_syn o where o.cust_id = [CUSTID] and o.amount > "
        "(select avg(l.amount) from customer_order_syn l where l.latn_id = [LATN_ID])",
}
# Many rules on one table, with the same equalities.
SHARED_RULES = {
    40 + i: "select o.order_id from customer_order_syn o where o.cust_id = [CUSTID] "
            f"and o.latn_id = [LATN_ID] and o.offer_id % 20 = {i}" for i in range(20)}
# One rule that cannot be evaluated for one customer, one whose answers are no ids.
FAILING_RULES = {
    71: "select 1000000 / (o.cust_id - 100) * 0 + 5 from customer_order_syn o "
        "where o.cust_id = [CUSTID] and o.latn_id = [LATN_ID]",
    72: "select o.order_id + 0.5 from customer_order_syn o where o.cust_id = [CUSTID] "
        "and o.latn_id = [LATN_ID] and o.amount > 95000",
}

VIEWS: dict[str, str] = {
    "common_region": """
SELECT n_nationkey AS region_id, n_name AS region_name,
       CASE WHEN n_nationkey % 5 = 0 THEN 999 WHEN n_nationkey % 5 = 1 THEN NULL
            ELSE n_nationkey END AS region_id_old
FROM nation""",
    "pms_campaign": """
SELECT p_partkey AS campaign_id, p_name AS campaign_name,
       CAST(p_partkey % 25 AS INT) AS region_id,
       TIMESTAMP '1998-07-01 00:00:00' + (p_size - 15) * INTERVAL '1' DAY AS end_date,
       CASE WHEN p_size % 10 = 0 THEN '10X' ELSE '10A' END AS state
FROM part""",
    "mkt_cam_conf_attr": """
SELECT p_partkey AS mkt_campaign_id, 'CATALOG' AS attr_nbr, p_partkey % 4 AS attr_value_id,
       concat('catalogue ', CAST(p_partkey % 4 AS VARCHAR(9))) AS attr_value
FROM part""",
    "pms_campaign_chl_rel": """
SELECT DISTINCT l_partkey AS campaign_id, CAST(l_suppkey % 8 AS INT) AS channel_id
FROM lineitem""",
    "initiative_order_channel": """
SELECT 'call' AS app_name, n_nationkey AS channel_id FROM nation WHERE n_nationkey IN (3, 4, 5)
""",
    "campaign_scope": f"""
SELECT p_partkey AS campaign_id,
       CASE p_partkey % 4 WHEN 0 THEN '{AREAS}' WHEN 1 THEN CAST(p_partkey % 25 AS VARCHAR(9))
            WHEN 2 THEN concat(',', CAST(p_partkey % 10 AS VARCHAR(9)), ',,x,',
                               CAST(p_size AS VARCHAR(9))) END AS areas
FROM part""",
    "initiative_order": f"""
SELECT o_orderkey AS initiative_order_id, o_custkey AS cust_id, c_name AS cust_name,
       concat('acc-', CAST(o_custkey AS VARCHAR(20))) AS acc_nbr,
       o_orderkey * 10 AS prod_inst_id, o_orderkey % 50 AS campaign_id, c_nationkey AS latn_id,
       {_SHARD} AS shard_id, {_CHANNEL} AS channel_id,
       CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN '10X' ELSE '10A' END AS state
FROM {_ORDERS}""",
    "initiative_order_executor": f"""
SELECT o_orderkey AS initiative_order_id, {_STATUS.format('o_orderkey')} AS status_cd,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL
            WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderkey % 120
            WHEN o_orderkey % 3 = 0 THEN 1000 + o_orderkey % 100
            ELSE 100000000 + o_orderkey % 100 END AS dept_id,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS curr_user_id,
       c_nationkey AS latn_id, {_SHARD} AS shard_id, o_orderdate AS last_opt_date,
       CASE WHEN o_orderkey % 11 = 0 THEN 1 WHEN o_orderkey % 11 = 1 THEN NULL
            ELSE 0 END AS is_success
FROM {_ORDERS}""",
    "raw_executor": """
SELECT CAST(o_orderkey AS VARCHAR(20)) AS initiative_order_id,
       CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 120 AS VARCHAR(20))
            END AS dept_id,
       CASE WHEN o_orderkey % 89 = 0 THEN concat('u', CAST(o_custkey AS VARCHAR(20)))
            WHEN o_orderkey % 7 = 0 THEN NULL
            ELSE CAST(o_custkey AS VARCHAR(20)) END AS curr_user_id,
       o_orderkey % 50 AS campaign_id
FROM orders""",
    "exe_order_result": """
SELECT o_orderkey AS list_id, o_orderkey % 4 AS order_result FROM orders
WHERE o_orderkey % 5 <> 1""",
    "customer_order_syn": """
SELECT o_custkey AS cust_id, c_nationkey AS latn_id, l_orderkey * 10 + l_linenumber AS order_id,
       CASE WHEN l_linestatus = 'F' THEN 300000 ELSE 100000 END AS status_cd,
       l_shipdate AS status_date, l_partkey AS offer_id, l_extendedprice AS amount
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey""",
    "rule_rows": """
SELECT l_orderkey AS list_id, CAST(l_suppkey % 3 AS INT) AS suc_rule_id,
       CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 5 = 1 THEN '-999999999'
            WHEN l_partkey % 35 = 2 THEN 'void' WHEN l_partkey % 35 = 3 THEN '-1'
            ELSE CAST(l_partkey AS VARCHAR(20)) END AS value
FROM lineitem""",
    "grid_org_code_rel": """
SELECT s_suppkey AS org_jt_code, 1000 + s_suppkey AS org_id, n_regionkey AS fir_grid_id,
       s_nationkey AS sec_grid_id,
       CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE s_suppkey END AS thi_grid_id
FROM supplier JOIN nation ON n_nationkey = s_nationkey
UNION ALL
SELECT s_suppkey, 100000000 + s_suppkey, n_regionkey, s_nationkey, s_suppkey + 500
FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey % 10 = 0""",
    "grid_tree": """
SELECT CAST(n_nationkey AS BIGINT) AS tree_id, n_name AS tree_name, 2 AS tree_level FROM nation
UNION ALL SELECT s_suppkey, concat('grid ', s_name), 3 FROM supplier""",
    "sys_bss_org": """
SELECT CAST(r_regionkey AS BIGINT) AS bss_org_id, r_name AS bss_org_name, 1 AS bss_org_type_id,
       CAST(NULL AS BIGINT) AS up_bss_org_id, CAST(NULL AS INT) AS area_id, '10A' AS state
FROM region
UNION ALL SELECT 100 + n_nationkey, n_name, 2, n_regionkey, n_nationkey, '10A' FROM nation
UNION ALL SELECT 1000 + s_suppkey, s_name, 3, 100 + s_nationkey, s_nationkey,
                 CASE WHEN s_suppkey % 19 = 0 THEN '10X' ELSE '10A' END FROM supplier
UNION ALL SELECT 100000000 + s_suppkey, concat(s_name, '/class'), 4, 1000 + s_suppkey,
                 s_nationkey, '10A' FROM supplier""",
    "sys_bss_org_hq": """
SELECT * FROM sys_bss_org
UNION ALL SELECT 500 + r_regionkey, concat(r_name, ' desk'), 2, r_regionkey, 999, '10A'
FROM region WHERE r_name = 'ASIA'""",
    "sys_user": """
SELECT c_custkey AS user_id, c_name AS user_name,
       CASE WHEN c_custkey % 23 = 0 THEN '10X' ELSE '10A' END AS state
FROM customer""",
    "sys_user_job": """
SELECT c_custkey AS user_id, 100000000 + c_custkey % 100 AS bss_org_id,
       CASE c_custkey % 5 WHEN 0 THEN 10004 WHEN 1 THEN 10070 WHEN 2 THEN 10071 ELSE 1 END
       AS role_id
FROM customer""",
    "detail": f"""
SELECT o_orderkey AS list_id, o_orderkey % 50 AS sub_campaign_id,
       o_orderkey % 4 AS main_campaign_id,
       {_STATUS.format('(o_orderkey + o_custkey % 2)')} AS status_cd,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE (o_orderkey + o_custkey % 3) % 120 END
       AS org_jt_code,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS user_id,
       CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS is_success
FROM orders WHERE o_orderkey % 4 <> 0""",
    "receive_target": f"""
SELECT '1998-06-01 00:00:00' AS report_date, o_orderdate AS update_date, c_nationkey AS latn_id,
       c_nationkey AS region_id, 1000 + d.org_jt_code AS org_id, d.org_jt_code,
       CAST(c_nationkey % 5 AS BIGINT) AS fir_grid_id, CAST(c_nationkey AS BIGINT) AS sec_grid_id,
       d.org_jt_code AS thi_grid_id, d.main_campaign_id AS z_mkt_campaign_id,
       d.sub_campaign_id AS a_mkt_campaign_id, d.list_id, d.status_cd,
       1000 + d.org_jt_code AS old_org_id, d.org_jt_code AS old_org_jt_code,
       d.status_cd AS old_status_cd, d.is_success, d.user_id, c_name AS user_name,
       o_custkey AS cust_id, c_name AS cust_name,
       concat('acc-', CAST(o_custkey AS VARCHAR(20))) AS acc_nbr, {_CHANNEL} AS cop_channel_id,
       CASE WHEN d.is_success = 1 THEN 1 END AS col_5
FROM {_ORDERS} JOIN detail d ON d.list_id = o_orderkey
WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "outcall_target": f"""
SELECT d.main_campaign_id, concat('catalogue ', CAST(d.main_campaign_id AS VARCHAR(9)))
       AS main_campaign_name, d.sub_campaign_id, p_name AS sub_campaign_name,
       c_nationkey AS region_id, CAST(n_regionkey AS BIGINT) AS prov_dept_id,
       r_name AS prov_dept_name, CAST(100 + n_nationkey AS BIGINT) AS city_dept_id,
       n_name AS city_dept_name,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 1000 + o_custkey % 100 END AS team_dept_id,
       CASE WHEN o_orderkey % 6 < 2 THEN NULL ELSE 100000000 + o_custkey % 100 END
       AS class_dept_id,
       CASE WHEN o_orderkey % 6 < 3 THEN NULL ELSE o_custkey END AS caller_id,
       d.list_id, d.status_cd, o_orderdate AS create_date, d.is_success,
       CASE WHEN o_orderkey % 5 = 1 THEN NULL ELSE o_orderkey % 4 END AS order_result,
       o_orderdate AS update_date, c_name AS cust_name, o_orderkey * 10 AS prod_inst_id,
       o_custkey AS cust_id, CASE WHEN d.is_success = 1 THEN 1 END AS col_1
FROM {_ORDERS} JOIN detail d ON d.list_id = o_orderkey
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
JOIN part ON p_partkey = d.sub_campaign_id
WHERE o_orderpriority = '4-NOT SPECIFIED'""",
    "mkt_success_rule": f"""
SELECT r_regionkey + 1 AS suc_rule_id, concat('rule_', r_name) AS rule_name,
       concat('col_', CAST(r_regionkey + 1 AS VARCHAR(9))) AS report_column,
       CASE WHEN r_regionkey = 4 THEN 20 ELSE 10 END AS state,
       CASE r_regionkey WHEN 0 THEN '{RULE_1}' WHEN 1 THEN '{RULE_2}' WHEN 2 THEN '{RULE_3}'
            WHEN 3 THEN '{RULE_4}' ELSE 'select 1' END AS sql_text_order
FROM region""",
    # rule i: attached to every catalogue, evaluated in descending rule order, and to two thirds
    # of the campaigns
    "mkt_campaign_suc_rule_rel": "\nUNION ALL ".join(
        f"SELECT {i + 1} AS suc_rule_id, p_partkey % 4 AS campaign_id, 1 AS rel_type, "
        f"{i * 10} + p_partkey % 4 AS rel_id, {5 - i} AS seq FROM part GROUP BY p_partkey % 4 "
        f"UNION ALL SELECT {i + 1}, p_partkey, 2, 1000 + p_partkey * 10 + {i}, 0 FROM part "
        f"WHERE (p_partkey + {i}) % 3 <> 0" for i in range(5)),
    "success_log": """
SELECT o_orderkey AS list_id, 1 AS suc_rule_id FROM orders WHERE o_orderkey % 22 = 0""",
    "organization": """
SELECT 1000 + s_suppkey AS org_id, s_nationkey AS common_region_id, s_name AS org_name
FROM supplier
UNION ALL SELECT 100000000 + s_suppkey, s_nationkey, concat(s_name, '/2') FROM supplier""",
    "system_user": """
SELECT c_custkey AS system_user_id, c_custkey - c_custkey % 3 AS staff_id FROM customer
WHERE c_custkey % 9 <> 0""",
    "staff": """
SELECT c_custkey AS staff_id, c_name AS staff_name FROM customer
UNION ALL SELECT c_custkey, concat(c_name, '/alt') FROM customer WHERE c_custkey % 10 = 0""",
    "callout_detail": f"""
SELECT o_orderkey AS list_id, o_orderkey % 4 AS main_campaign_id,
       o_orderkey % 50 AS sub_campaign_id, n_nationkey AS region_id,
       n_regionkey AS prov_dept_id, 100 + n_nationkey AS city_dept_id,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 1000 + o_custkey % 100 END AS team_dept_id,
       CASE WHEN o_orderkey % 6 < 2 THEN NULL ELSE 100000000 + o_custkey % 100 END
       AS class_dept_id,
       CASE WHEN o_orderkey % 6 < 3 THEN NULL ELSE o_custkey END AS caller_id,
       {_STATUS.format('o_orderkey')} AS status_cd,
       CASE WHEN o_orderkey % 5 = 1 THEN NULL ELSE o_orderkey % 4 END AS order_result,
       CASE WHEN o_orderkey % 6 = 5 THEN 1 ELSE 0 END AS is_success,
       CASE WHEN o_orderkey % 6 = 5 AND o_orderkey % 2 = 1 THEN 1 END AS col_1,
       CASE WHEN o_orderkey % 6 = 5 AND o_orderkey % 3 = 2 THEN 1 END AS col_2
FROM {_ORDERS} JOIN nation ON n_nationkey = c_nationkey
WHERE o_orderpriority = '4-NOT SPECIFIED'""",
    "receive_detail": f"""
SELECT o_orderkey AS list_id, o_orderkey % 4 AS z_mkt_campaign_id,
       o_orderkey % 50 AS a_mkt_campaign_id, n_regionkey AS fir_grid_id,
       n_nationkey AS sec_grid_id, o_custkey % 100 AS thi_grid_id,
       1000 + o_custkey % 100 AS org_id, o_custkey % 100 AS org_jt_code,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS user_id,
       {_STATUS.format('o_orderkey')} AS status_cd,
       CASE WHEN o_orderkey % 6 = 5 THEN 1 ELSE 0 END AS is_success,
       CASE WHEN o_orderkey % 6 = 5 AND o_orderkey % 2 = 1 THEN 1 END AS col_1,
       {_CHANNEL} AS cop_channel_id, o_orderdate AS report_date
FROM {_ORDERS} JOIN nation ON n_nationkey = c_nationkey
WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "block_contractor": """
SELECT n_nationkey AS latn_id, n_name AS latn_name, n_regionkey AS area_id, r_name AS area_name,
       s_suppkey AS obu_id, s_name AS obu_name, p_partkey AS block_id, p_name AS block_name,
       s_suppkey AS staff_id, s_name AS staff_name,
       concat('code-', CAST(s_suppkey AS VARCHAR(20))) AS staff_code, l_quantity AS quantity
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey""",
    "condition_text": """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL
            ELSE concat('custId:', CAST(o_custkey AS VARCHAR(20)), ',prodInstId:',
                        CAST(o_orderkey * 10 AS VARCHAR(20)),
                        CASE WHEN o_orderkey % 2 = 0 THEN ',relId:' ELSE '' END) END
       AS conditions
FROM orders""",
}

# Departments as texts: some no numbers, some of organisations that do not exist.
VIEWS["executor_text"] = f"""
SELECT initiative_order_id, status_cd,
       CASE WHEN initiative_order_id % 97 = 0 THEN 'n/a'
            WHEN initiative_order_id % 5 = 0 THEN '777777777'
            ELSE CAST(dept_id AS VARCHAR(20)) END AS dept_id,
       curr_user_id, latn_id, shard_id, last_opt_date, is_success
FROM ({VIEWS['initiative_order_executor']})"""
# Rule 2 answers texts instead of ids.
TEXT_RULE = ("select concat('n', cast(o.order_id as varchar(20))) from customer_order_syn o "
             "where o.cust_id = [CUSTID] and o.latn_id = [LATN_ID] and o.amount > 95000")
VIEWS["rule_of_texts"] = f"""
SELECT suc_rule_id, rule_name, report_column, state,
       CASE WHEN suc_rule_id = 2 THEN '{TEXT_RULE.replace("'", "''")}' ELSE sql_text_order END
       AS sql_text_order
FROM mkt_success_rule"""


def _source(name: str, columns: tuple[str, ...]) -> str:
    """A dimension's source table with its real columns, empty texts, repeated rows and a password."""
    filled = [f"CASE WHEN (p_partkey + {i}) % 7 = 0 THEN '' ELSE concat('{c} ', "
              f"CAST(p_size AS VARCHAR(9))) END AS {c}" for i, c in enumerate(columns[1:])]
    return (f"SELECT p_partkey % 300 AS {columns[0]}, {', '.join(filled)}, 'secret' AS password "
            f"FROM part")


# The one table without a list of columns is copied whole.
_GRID_COLUMNS = ("org_jt_code", "org_id", "fir_grid_id", "sec_grid_id", "thi_grid_id")
VIEWS |= {f"source_{name}": _source(name, spec.columns or _GRID_COLUMNS)
          for name, spec in SNAPSHOTS.items()}


def with_views(sql: str, views: dict[str, str] = VIEWS) -> str:
    """``sql`` with a WITH clause defining every view it needs, dependencies first."""
    needed: dict[str, str] = {}

    def add(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"[a-z_][a-z_0-9]*", text)):
            if name in views and name not in needed:
                add(views[name])
                needed[name] = views[name]

    add(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in needed.items()) + "\n" + sql


class Roles:
    """The role views of one data folder as DataFrames."""

    _registered: tuple[Roles, set[str]] | None = None

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def base(self, table: str) -> DataFrame:
        return self.spark.read.schema(BASE_TABLES[table]).parquet(
            f"{self.folder}/{table}.parquet")

    def sql(self, text: str) -> DataFrame:
        statement = with_views(text)
        if Roles._registered is None or Roles._registered[0] is not self:
            Roles._registered = (self, set())
        present = Roles._registered[1]
        for table in BASE_TABLES:
            if table not in present and re.search(rf"\b{table}\b", statement):
                self.base(table).createOrReplaceTempView(table)
                present.add(table)
        # the driver's timestamps carry no time zone
        return self.spark.sql(statement.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))

    def __getitem__(self, name: str) -> DataFrame:
        return self.base(name) if name in BASE_TABLES else self.sql(f"SELECT * FROM {name}")

    @cached_property
    def receive_tables(self) -> dict[str, DataFrame]:
        names = ("pms_campaign", "mkt_cam_conf_attr", "common_region", "pms_campaign_chl_rel",
                 "initiative_order_channel", "mkt_success_rule", "mkt_campaign_suc_rule_rel",
                 "initiative_order", "initiative_order_executor", "grid_org_code_rel",
                 "organization", "system_user", "staff", "customer_order_syn", "part")
        return {**{n: self[n] for n in names}, "detail": self["receive_target"]}

    @cached_property
    def outcall_tables(self) -> dict[str, DataFrame]:
        names = ("pms_campaign", "mkt_cam_conf_attr", "common_region", "pms_campaign_chl_rel",
                 "mkt_success_rule", "mkt_campaign_suc_rule_rel", "initiative_order",
                 "initiative_order_executor", "exe_order_result", "sys_user", "success_log",
                 "customer_order_syn", "part")
        return {**{n: self[n] for n in names}, "callout_detail": self["outcall_target"],
                "sys_bss_org": self["sys_bss_org_hq"]}

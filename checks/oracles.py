"""The same results in plain SQL, written the way the business rules read."""

from __future__ import annotations

from checks.roles import (AS_OF, FAILING_RULES, NESTED_RULES, RANGE_RULES, RULES, SHARED_RULES,
                          TEXT_RULE, VIEWS, _GRID_COLUMNS, with_views)
from orderflow.sources.dimensions import SNAPSHOTS

DAY = "TIMESTAMP '1998-07-01 00:00:00'"
DAY_BEFORE = "TIMESTAMP '1998-06-30 08:30:00'"
NOW = f"TIMESTAMP '{AS_OF}'"
YEAR_START = "TIMESTAMP '1997-07-01 00:00:00'"
MONTH_START = "TIMESTAMP '1998-06-01 00:00:00'"
FLAGS = [f"col_{i}" for i in range(1, 21)]


def _bound(text: str) -> str:
    for mark, column in (("[CUSTID]", "c.cust_id"), ("[custId]", "c.cust_id"),
                         ("[LATN_ID]", "c.area"), ("[PRODINSTID]", "c.prod_inst_id")):
        text = text.replace(mark, column)
    return text


def _all_asked(rules: dict[int, str], condition: str = "true") -> str:
    """Every receive candidate's answer to every rule."""
    rows = "\nUNION ALL ".join(
        f"SELECT c.list_id, {rule} AS suc_rule_id, q.v FROM o_receive_cand c, "
        f"LATERAL ({_bound(text)}) q(v) WHERE {condition}" for rule, text in rules.items())
    ids = ", ".join(f"({rule})" for rule in rules)
    return f"""
SELECT c.list_id, i.suc_rule_id, CASE WHEN r.n > 0 THEN 1 ELSE 0 END AS hit, r.value,
       CASE WHEN r.n > 0 THEN 1 ELSE 0 END AS success
FROM o_receive_cand c CROSS JOIN (VALUES {ids}) i(suc_rule_id) LEFT JOIN (
  SELECT list_id, suc_rule_id, count(*) AS n, min(v) AS value FROM ({rows}) GROUP BY ALL) r
  ON r.list_id = c.list_id AND r.suc_rule_id = i.suc_rule_id"""


def _rule_rows(rule_id: int, asked: str) -> str:
    """Rows of one rule for every asked pair, as a plain join."""
    text = _bound(RULES[rule_id].replace("''", "'"))
    return (f"SELECT c.main_campaign_id, c.list_id, c.suc_rule_id, q.v FROM {asked} c, "
            f"LATERAL ({text}) q(v) WHERE c.suc_rule_id = {rule_id}")


def _evaluated(asked: str) -> str:
    rows = "\nUNION ALL ".join(_rule_rows(i, asked) for i in RULES)
    return f"""
SELECT c.*, CASE WHEN r.n > 0 THEN 1 ELSE 0 END AS hit, r.value,
       CASE WHEN r.n > 0 AND coalesce(r.value <> -1, true) THEN 1 ELSE 0 END AS success
FROM {asked} c LEFT JOIN (
  SELECT main_campaign_id, list_id, suc_rule_id, count(*) AS n, min(v) AS value
  FROM ({rows}) GROUP BY ALL) r
  ON r.list_id = c.list_id AND r.suc_rule_id = c.suc_rule_id
     AND r.main_campaign_id = c.main_campaign_id"""


def _candidates(condition: str, area: str) -> str:
    return f"""
SELECT initiative_order_id AS list_id, campaign_id, shard_id, {area} AS area, status_cd,
       channel_id, prod_inst_id, cust_id
FROM o_held
WHERE {condition} AND (cust_id, {area}) IN (
  SELECT (cust_id, latn_id) FROM customer_order_syn
  WHERE status_cd = 300000 AND status_date >= {MONTH_START} AND status_date < {DAY})"""


def _pairs_of(candidates: str) -> str:
    return f"""
SELECT r.main_campaign_id, c.*, r.suc_rule_id, r.rel_id, r.rule_name, r.report_column, r.seq_no
FROM {candidates} c JOIN o_rules r ON r.sub_campaign_id = c.campaign_id"""


def _skip(pairs: str, detail: str) -> str:
    return f"""
SELECT * FROM (
  SELECT p.*, coalesce((SELECT max(d.is_success) FROM {detail} d
                        WHERE d.list_id = p.list_id), 0) AS old_is_success
  FROM {pairs} p) p
WHERE NOT (old_is_success = 1 AND EXISTS (
  SELECT 1 FROM success_log l
  WHERE l.list_id = p.list_id AND l.suc_rule_id = p.suc_rule_id))"""


def _first(evaluated: str) -> str:
    return f"""
SELECT list_id, suc_rule_id, seq_no, rule_name, report_column, value FROM (
  SELECT *, row_number() OVER (PARTITION BY list_id
                            ORDER BY main_campaign_id, seq_no, suc_rule_id) AS rn
  FROM {evaluated} WHERE success = 1) WHERE rn = 1"""


def _ends(hits: str) -> str:
    return f"""
SELECT list_id, max(status_cd) AS status_cd,
       max(CASE WHEN up = 1 THEN suc_rule_id END) AS first_suc_rule_id,
       max(CASE WHEN up = 1 THEN rule_name END) AS first_rule_name,
       max(CASE WHEN up = 1 THEN value END) AS first_value,
       max(CASE WHEN down = 1 THEN suc_rule_id END) AS last_suc_rule_id,
       max(CASE WHEN down = 1 THEN rule_name END) AS last_rule_name,
       max(CASE WHEN down = 1 THEN value END) AS last_value
FROM (SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY main_campaign_id, seq_no,
                                      suc_rule_id) AS up,
             row_number() OVER (PARTITION BY list_id ORDER BY main_campaign_id, seq_no DESC,
                                suc_rule_id DESC) AS down
      FROM {hits} WHERE success = 1 AND old_is_success = 0) GROUP BY list_id"""


def _flags(hits: str, count: int = 20) -> str:
    columns = ", ".join(f"max(CASE WHEN report_column = 'col_{i}' THEN 1 END) AS col_{i}"
                        for i in range(1, count + 1))
    return f"SELECT list_id, {columns} FROM {hits} WHERE success = 1 GROUP BY list_id"


def _receive_registered(detail: str) -> str:
    return f"""
SELECT '{AS_OF}' AS report_date, {NOW} AS update_date, h.latn_id, o.region_id, g.org_id,
       g.org_jt_code, g.fir_grid_id, g.sec_grid_id, g.thi_grid_id,
       s.main_campaign_id AS z_mkt_campaign_id, h.campaign_id AS a_mkt_campaign_id,
       h.initiative_order_id AS list_id, h.status_cd, g.org_id AS old_org_id,
       g.org_jt_code AS old_org_jt_code, h.status_cd AS old_status_cd, 0 AS is_success,
       h.curr_user_id AS user_id, n.user_name, h.cust_id, h.cust_name, h.acc_nbr,
       h.channel_id AS cop_channel_id
FROM o_held h
JOIN (SELECT DISTINCT main_campaign_id, sub_campaign_id, latn_id FROM o_pairs_receive) s
  ON (s.sub_campaign_id, s.latn_id, s.latn_id) = (h.campaign_id, h.latn_id, h.shard_id)
LEFT JOIN grid_org_code_rel g ON g.org_jt_code = h.dept_id
LEFT JOIN o_org_region o ON o.org_id = g.org_id
LEFT JOIN o_user_names n ON n.user_id = h.curr_user_id
WHERE h.state = '10A' AND h.channel_id <> 6
  AND h.initiative_order_id NOT IN (SELECT list_id FROM {detail})"""


def _cities(org: str) -> str:
    return f"""
SELECT c.area_id AS region_id, c.up_bss_org_id AS prov_dept_id,
       p.bss_org_name AS prov_dept_name, c.bss_org_id AS city_dept_id,
       c.bss_org_name AS city_dept_name
FROM {org} c JOIN {org} p ON p.bss_org_id = c.up_bss_org_id
WHERE c.bss_org_type_id = 2 AND (c.state, p.state) = ('10A', '10A')"""


def _outcall_registered(mode: str, org: str, detail: str, extra: str = "") -> str:
    """``area``: all areas agree; ``province``: orders kept in area 999 meet its city rows."""
    where = ("s.latn_id <> 999 AND h.latn_id = s.latn_id AND h.ex_latn_id = s.latn_id"
             if mode == "area" else "s.latn_id = 999")
    return f"""
SELECT DISTINCT s.main_campaign_id, s.main_campaign_name, s.sub_campaign_id,
       s.sub_campaign_name, c.*, NULL::BIGINT AS team_dept_id, NULL::VARCHAR AS team_dept_name,
       NULL::BIGINT AS class_dept_id, NULL::VARCHAR AS class_dept_name,
       NULL::BIGINT AS caller_id, NULL::VARCHAR AS caller_name,
       h.initiative_order_id AS list_id, h.status_cd, {DAY_BEFORE} AS create_date,
       0 AS is_success, q.order_result, {DAY_BEFORE} AS update_date, h.cust_name,
       h.prod_inst_id, h.cust_id{extra}
FROM o_held h JOIN o_pairs_outcall s
  ON (s.sub_campaign_id, s.latn_id) = (h.campaign_id, h.shard_id)
JOIN ({_cities(org)}) c ON c.region_id = s.latn_id
LEFT JOIN exe_order_result q ON q.list_id = h.initiative_order_id
WHERE {where} AND h.state = '10A' AND h.channel_id = 6
  AND h.initiative_order_id NOT IN (SELECT list_id FROM {detail})"""


_OWN_AREA = ", h.latn_id AS city_region"


def _changed_receive(detail: str, scope: str = "") -> str:
    return f"""
SELECT initiative_order_id AS list_id, campaign_id, shard_id, status_cd, dept_id, curr_user_id
FROM o_held h
WHERE state = '10A' AND last_opt_date > {YEAR_START} AND last_opt_date < {DAY}
  AND channel_id IN (SELECT channel_id FROM initiative_order_channel WHERE app_name = 'call')
  AND EXISTS (SELECT 1 FROM {detail} d WHERE d.list_id = h.initiative_order_id
              AND (d.status_cd <> h.status_cd
                   OR ifnull(d.org_jt_code, 0) <> ifnull(h.dept_id, 0)
                   OR ifnull(d.user_id, 0) <> ifnull(h.curr_user_id, 0))) {scope}"""


def _changed_outcall(detail: str, org: str, scope: str = "") -> str:
    return f"""
SELECT h.initiative_order_id AS list_id, h.campaign_id, h.shard_id, h.status_cd, h.dept_id,
       h.curr_user_id, q.order_result, ifnull(o.bss_org_type_id, 0) AS org_type_id
FROM o_held h LEFT JOIN exe_order_result q ON q.list_id = h.initiative_order_id
LEFT JOIN {org} o ON o.bss_org_id = h.dept_id
WHERE h.state = '10A' AND h.channel_id = 6 AND h.status_cd <> 1100 AND h.status_cd <> 7000
  AND h.last_opt_date >= {YEAR_START} AND h.last_opt_date < {DAY}
  AND EXISTS (SELECT 1 FROM {detail} d WHERE d.list_id = h.initiative_order_id
              AND d.status_cd <> h.status_cd) {scope}"""


def _resolved(changes: str, org: str) -> str:
    return f"""
SELECT * EXCLUDE (tree_missing, user_missing, org_missing, own_name, tree_team, tree_team_name),
       CASE action WHEN 'user' THEN CASE WHEN tree_missing OR user_missing THEN 'missing' END
                   WHEN 'class' THEN CASE WHEN tree_missing THEN 'missing' END
                   WHEN 'team' THEN CASE WHEN org_missing THEN 'missing' END END AS problem,
       CASE WHEN action IN ('user', 'class') THEN tree_team
            WHEN action = 'team' THEN dept_id END AS team_dept_id,
       CASE WHEN action IN ('user', 'class') THEN tree_team_name
            WHEN action = 'team' THEN own_name END AS team_dept_name,
       CASE WHEN action IN ('user', 'class') THEN dept_id END AS class_dept_id,
       CASE WHEN action IN ('user', 'class') AND NOT tree_missing THEN own_name END
       AS class_dept_name,
       CASE WHEN action = 'user' THEN curr_user_id END AS caller_id,
       CASE WHEN action = 'user' THEN user_name END AS caller_name
FROM (SELECT ch.*, CASE WHEN ch.curr_user_id IS NOT NULL THEN 'user'
                        WHEN ch.dept_id IS NOT NULL AND ch.org_type_id = 3 THEN 'team'
                        WHEN ch.dept_id IS NOT NULL AND ch.org_type_id = 4 THEN 'class'
                        ELSE 'none' END AS action,
             b.bss_org_id IS NULL OR g.bss_org_id IS NULL AS tree_missing,
             b.bss_org_id IS NULL AS org_missing, u.user_id IS NULL AS user_missing,
             b.bss_org_name AS own_name, g.bss_org_id AS tree_team,
             g.bss_org_name AS tree_team_name, u.user_name
      FROM {changes} ch LEFT JOIN {org} b ON b.bss_org_id = ch.dept_id AND b.state = '10A'
      LEFT JOIN {org} g ON g.bss_org_id = b.up_bss_org_id AND g.state = '10A'
      LEFT JOIN sys_user u ON u.user_id = ch.curr_user_id AND u.state = '10A')"""


def _errors(resolved: str) -> str:
    return f"""
SELECT list_id AS order_id, 'ORA-01403: no data found' AS errormsg,
       'p_order_outcall_detail_call' AS pro_name, CAST(list_id AS VARCHAR) AS errorcode
FROM {resolved} WHERE problem = 'missing'"""


def _run_errors(pairs: str, job: str) -> str:
    """Departments that are no numbers, and answers of rule 2 that are no ids."""
    return f"""
SELECT initiative_order_id AS order_id, 'department is not a number: ' || dept_id AS errormsg,
       '{job}' AS pro_name, '-6502' AS errorcode
FROM executor_text WHERE dept_id IS NOT NULL AND TRY_CAST(dept_id AS BIGINT) IS NULL
UNION ALL
SELECT list_id, 'rule 2: ' || count(*) || ' results are not numbers', 'evaluate_rules', '-6502'
FROM {pairs} c, LATERAL ({_bound(TEXT_RULE)}) q(v) WHERE c.suc_rule_id = 2
GROUP BY c.main_campaign_id, c.list_id"""


def _receive_applied(detail: str, changes: str, columns: str) -> str:
    """The receive detail after applying changes (one row per order)."""
    return f"""
SELECT {columns} FROM (
  SELECT d.* REPLACE (
    CASE WHEN c.list_id IS NULL THEN d.old_status_cd ELSE d.status_cd END AS old_status_cd,
    CASE WHEN c.list_id IS NULL THEN d.old_org_id ELSE d.org_id END AS old_org_id,
    CASE WHEN c.list_id IS NULL THEN d.old_org_jt_code ELSE d.org_jt_code END
    AS old_org_jt_code,
    CASE WHEN c.list_id IS NULL THEN d.status_cd ELSE c.status_cd END AS status_cd,
    CASE WHEN c.list_id IS NULL THEN d.org_id ELSE c.grid.org_id END AS org_id,
    CASE WHEN c.list_id IS NULL THEN d.org_jt_code ELSE c.dept_id END AS org_jt_code,
    CASE WHEN c.list_id IS NULL THEN d.fir_grid_id ELSE c.grid.fir_grid_id END AS fir_grid_id,
    CASE WHEN c.list_id IS NULL THEN d.sec_grid_id ELSE c.grid.sec_grid_id END AS sec_grid_id,
    CASE WHEN c.list_id IS NULL THEN d.thi_grid_id ELSE c.grid.thi_grid_id END AS thi_grid_id,
    CASE WHEN c.list_id IS NULL THEN d.user_id ELSE c.curr_user_id END AS user_id,
    CASE WHEN c.list_id IS NULL THEN d.user_name ELSE c.user_name END AS user_name,
    CASE WHEN c.list_id IS NULL THEN d.update_date ELSE {NOW} END AS update_date)
  FROM {detail} d LEFT JOIN (
    SELECT ch.list_id, ch.status_cd, ch.dept_id, ch.curr_user_id,
           CASE WHEN ch.dept_id IS NULL THEN
             {{'fir_grid_id': -1::BIGINT, 'sec_grid_id': -1::BIGINT,
               'thi_grid_id': -1::BIGINT, 'org_id': NULL::BIGINT}}
           WHEN g.code IS NULL THEN
             {{'fir_grid_id': -2::BIGINT, 'sec_grid_id': -2::BIGINT,
               'thi_grid_id': -2::BIGINT, 'org_id': -2::BIGINT}}
           ELSE {{'fir_grid_id': g.fir_grid_id::BIGINT, 'sec_grid_id': g.sec_grid_id::BIGINT,
                  'thi_grid_id': g.thi_grid_id::BIGINT, 'org_id': g.org_id::BIGINT}} END AS grid,
           n.user_name
    FROM {changes} ch LEFT JOIN o_grid g ON g.code = ch.dept_id
    LEFT JOIN o_user_names n ON n.user_id = ch.curr_user_id) c ON c.list_id = d.list_id)"""


def _outcall_applied(detail: str, resolved: str, columns: str) -> str:
    def keep(field: str, test: str, new: str | None = None) -> str:
        return f"CASE WHEN {test} THEN {new or 'c.' + field} ELSE d.{field} END AS {field}"

    any_, cls = "c.list_id IS NOT NULL", "c.action IN ('user', 'class')"
    return f"""
SELECT {columns} FROM (
  SELECT d.* REPLACE (
    {keep('old_status_cd', any_, 'd.status_cd')}, {keep('status_cd', any_)},
    {keep('old_class_dept_id', cls, 'd.class_dept_id')},
    {keep('update_date', any_, DAY_BEFORE)}, {keep('team_dept_id', any_)},
    {keep('team_dept_name', any_)}, {keep('class_dept_id', cls)},
    {keep('class_dept_name', cls)}, {keep('caller_id', "c.action = 'user'")},
    {keep('caller_name', "c.action = 'user'")},
    {keep('order_result', cls, 'coalesce(c.order_result, d.order_result)')})
  FROM {detail} d LEFT JOIN (SELECT * FROM {resolved} WHERE problem IS NULL
                             AND action <> 'none') c ON c.list_id = d.list_id)"""


def _receive_won(detail: str, winners: str, hits: str) -> str:
    flags = ", ".join(f"coalesce(f.{c}, d.{c}) AS {c}" for c in FLAGS)
    open_ = "w.list_id IS NOT NULL AND coalesce(d.is_success, 0) = 0"
    return f"""
SELECT d.* REPLACE (
  CASE WHEN {open_} THEN {NOW} ELSE d.update_date END AS update_date,
  CASE WHEN w.list_id IS NOT NULL THEN 1 ELSE d.is_success END AS is_success,
  CASE WHEN {open_} THEN w.suc_rule_id ELSE d.suc_rule_id END AS suc_rule_id,
  CASE WHEN {open_} THEN w.rule_name ELSE d.suc_rule_name END AS suc_rule_name,
  CASE WHEN {open_} THEN w.value ELSE d.suc_order_id END AS suc_order_id, {flags})
FROM {detail} d LEFT JOIN {winners} w ON w.list_id = d.list_id
LEFT JOIN ({_flags(hits)}) f ON f.list_id = d.list_id"""


def _outcall_won(detail: str, ends: str, hits: str) -> str:
    flags = ", ".join(f"coalesce(f.{c}, d.{c}) AS {c}" for c in FLAGS)
    open_ = "w.list_id IS NOT NULL AND coalesce(d.is_success, 0) = 0"
    return f"""
SELECT d.* REPLACE (
  CASE WHEN {open_} AND NOT coalesce(w.status_cd > 2000, false) THEN 7000
       ELSE d.status_cd END AS status_cd,
  CASE WHEN {open_} THEN {DAY_BEFORE} ELSE d.update_date END AS update_date,
  CASE WHEN w.list_id IS NOT NULL THEN 1 ELSE d.is_success END AS is_success,
  CASE WHEN {open_} THEN w.first_suc_rule_id ELSE d.suc_rule_id END AS suc_rule_id,
  CASE WHEN {open_} THEN w.first_rule_name ELSE d.suc_rule_name END AS suc_rule_name,
  CASE WHEN {open_} THEN w.first_value ELSE d.suc_order_id END AS suc_order_id, {flags})
FROM {detail} d LEFT JOIN {ends} w ON w.list_id = d.list_id
LEFT JOIN ({_flags(hits)}) f ON f.list_id = d.list_id"""


def _receive_state(winners: str) -> str:
    return f"""
SELECT e.* REPLACE (CASE WHEN w.list_id IS NULL THEN e.is_success ELSE 1 END AS is_success),
       CAST(w.suc_rule_id AS BIGINT) AS suc_rule_id, w.rule_name AS suc_rule_name,
       w.value AS suc_order_id,
       CASE WHEN w.list_id IS NOT NULL THEN {NOW} END AS suc_time,
       NULL::INT AS hand_call, NULL::TIMESTAMP AS status_date, NULL::VARCHAR AS last_opt_desc
FROM initiative_order_executor e LEFT JOIN {winners} w ON w.list_id = e.initiative_order_id"""


def _outcall_state(ends: str) -> str:
    return f"""
SELECT e.* REPLACE (CASE WHEN w.list_id IS NULL THEN e.is_success ELSE 1 END AS is_success,
                    CASE WHEN w.list_id IS NULL OR w.status_cd > 2000 THEN e.status_cd
                         ELSE 7000 END AS status_cd,
                    CASE WHEN w.list_id IS NULL THEN e.last_opt_date ELSE {NOW} END
                    AS last_opt_date),
       CAST(w.last_suc_rule_id AS BIGINT) AS suc_rule_id, w.last_rule_name AS suc_rule_name,
       w.last_value AS suc_order_id,
       CASE WHEN w.list_id IS NOT NULL THEN {NOW} END AS suc_time,
       CASE WHEN w.list_id IS NOT NULL AND NOT coalesce(w.status_cd > 2000, false) THEN 0 END
       AS hand_call,
       CASE WHEN w.list_id IS NOT NULL THEN {NOW} END AS status_date,
       CASE WHEN w.list_id IS NOT NULL THEN 'successed complete' END AS last_opt_desc
FROM initiative_order_executor e LEFT JOIN {ends} w ON w.list_id = e.initiative_order_id"""


def _log(hits: str, moment: str) -> str:
    return (f"SELECT list_id, suc_rule_id, {moment} AS suc_date, rule_name AS suc_rule_name, "
            f"value AS suc_order_id FROM {hits}")


_NULL_SUCCESS = ("NULL::BIGINT AS suc_rule_id, NULL::VARCHAR AS suc_rule_name, "
                 "NULL::BIGINT AS suc_order_id")


def _null_flags(*given: str) -> str:
    return ", ".join(c if c in given else f"NULL::INT AS {c}" for c in FLAGS)


_RECEIVE_COLUMNS = ("report_date, update_date, latn_id, region_id, org_id, org_jt_code, "
                    "CAST(fir_grid_id AS BIGINT) AS fir_grid_id, "
                    "CAST(sec_grid_id AS BIGINT) AS sec_grid_id, thi_grid_id, "
                    "z_mkt_campaign_id, a_mkt_campaign_id, list_id, status_cd, old_org_id, "
                    "old_org_jt_code, old_status_cd, is_success, user_id, user_name, cust_id, "
                    "cust_name, acc_nbr, cop_channel_id")
_OUTCALL_NAMES = ("main_campaign_id, main_campaign_name, sub_campaign_id, sub_campaign_name, "
                  "region_id, prov_dept_id, prov_dept_name, city_dept_id, city_dept_name, "
                  "team_dept_id, {team_name}, class_dept_id, {class_name}, caller_id, "
                  "{caller_name}, list_id, status_cd, create_date, is_success, order_result, "
                  "update_date, cust_name, prod_inst_id, cust_id")


def _outcall_names(nulls: bool) -> str:
    names = {n: f"NULL::VARCHAR AS {c}" if nulls else c for n, c in
             (("team_name", "team_dept_name"), ("class_name", "class_dept_name"),
              ("caller_name", "caller_name"))}
    return _OUTCALL_NAMES.format(**names)


_SCOPE = "AND ({0}.campaign_id, {0}.shard_id) IN (SELECT (sub_campaign_id, latn_id) FROM {1})"


def _ranked(source: str) -> str:
    """Active rules on both a main campaign and its sub-campaign, in the main one's order."""
    return f"""
SELECT main_campaign_id, sub_campaign_id, suc_rule_id, rule_name, report_column, sql_text_order,
       own.rel_id, main.seq,
       CAST(row_number() OVER (PARTITION BY main_campaign_id, sub_campaign_id
                               ORDER BY main.seq, suc_rule_id, own.rel_id) AS INT) AS seq_no
FROM (SELECT DISTINCT main_campaign_id, sub_campaign_id FROM {source})
JOIN (SELECT campaign_id AS sub_campaign_id, suc_rule_id, rel_id
      FROM mkt_campaign_suc_rule_rel WHERE rel_type = 2) own USING (sub_campaign_id)
JOIN (SELECT campaign_id AS main_campaign_id, suc_rule_id, seq
      FROM mkt_campaign_suc_rule_rel WHERE rel_type = 1) main
  USING (main_campaign_id, suc_rule_id)
JOIN mkt_success_rule USING (suc_rule_id) WHERE state = 10"""


_AREA_TABLE = "(SELECT CAST(unnest(string_split('0,1,2,3,4,5,6,7,8,9', ',')) AS INT) AS area)"
_ACTIVE = """
SELECT attr_value_id AS main_campaign_id, attr_value AS main_campaign_name,
       campaign_id AS sub_campaign_id, campaign_name AS sub_campaign_name, region_id,
       region_name, region_id_old
FROM pms_campaign JOIN common_region USING (region_id)
JOIN mkt_cam_conf_attr ON mkt_campaign_id = campaign_id
WHERE attr_nbr = 'CATALOG' AND state = '10A' AND end_date > TIMESTAMP '1998-06-24 00:00:00'"""
_APP_CHANNELS = "SELECT channel_id FROM initiative_order_channel WHERE app_name = 'call'"


def _fan_out(everywhere: str, own_area: str, channels: str) -> str:
    """Campaigns on one of the channels, in every listed area or in their own one."""
    return f"""
SELECT x.*, y.area AS latn_id
FROM o_active x JOIN {_AREA_TABLE} y ON {everywhere}
WHERE x.sub_campaign_id IN (SELECT campaign_id FROM pms_campaign_chl_rel
                            WHERE channel_id IN ({channels}))
UNION ALL
SELECT x.*, {own_area} FROM o_active x
WHERE NOT ({everywhere})
  AND x.sub_campaign_id IN (SELECT campaign_id FROM pms_campaign_chl_rel
                            WHERE channel_id IN ({channels}))"""


# Derived views the oracle statements share; names start with o_.
DERIVED = {
    "o_held": """
SELECT a.*, b.status_cd, b.dept_id, b.curr_user_id, b.latn_id AS ex_latn_id, b.last_opt_date,
       b.is_success
FROM initiative_order a JOIN initiative_order_executor b
  ON (a.initiative_order_id, a.shard_id) = (b.initiative_order_id, b.shard_id)""",
    "o_user_names": "SELECT system_user_id AS user_id, min(staff_name) AS user_name "
                    "FROM system_user JOIN staff USING (staff_id) GROUP BY ALL",
    "o_org_region": "SELECT org_id, common_region_id AS region_id FROM organization "
                    "WHERE common_region_id IN (SELECT region_id FROM common_region)",
    "o_active": _ACTIVE,
    "o_pairs_receive": _fan_out("ifnull(x.region_id_old, 888) = 999",
                                "ifnull(x.region_id_old, 888)", _APP_CHANNELS),
    "o_pairs_outcall": _fan_out("x.region_id_old IS NULL", "x.region_id_old", "6"),
    "o_rules": _ranked("o_active"),
    "o_report_rules": _ranked("callout_detail"),
    "o_rule_names": "SELECT main_campaign_id, sub_campaign_id, "
                    "count(DISTINCT suc_rule_id) AS valid_col_num, "
                    + ", ".join(f"min(CASE WHEN report_column = '{c}' THEN rule_name END) "
                                f"AS {c}_name" for c in FLAGS)
                    + " FROM o_report_rules GROUP BY ALL",
    "o_grid": """
SELECT code, fir_grid_id, sec_grid_id, thi_grid_id, org_id FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY thi_grid_id DESC NULLS FIRST,
         org_id DESC, fir_grid_id DESC, sec_grid_id DESC) AS rn
  FROM (SELECT org_jt_code AS code, fir_grid_id, sec_grid_id, thi_grid_id, org_id
        FROM grid_org_code_rel
        UNION SELECT org_jt_code, -2, -2, -2, -2 FROM grid_org_code_rel)) WHERE rn = 1""",
    "o_receive_cand": _candidates("channel_id <> 6 AND ifnull(is_success, 0) = 0", "shard_id"),
    "o_area_cand": _candidates("channel_id = 6 AND shard_id <> 999", "shard_id"),
    "o_prov_cand": _candidates("channel_id = 6 AND shard_id = 999", "latn_id"),
    "o_receive_pairs": _pairs_of("o_receive_cand"),
    "o_receive_eval": _evaluated("o_receive_pairs"),
    "o_receive_first": _first("o_receive_eval"),
    "o_outcall_cand": "SELECT * FROM o_area_cand UNION ALL SELECT * FROM o_prov_cand",
    "o_outcall_all_pairs": _pairs_of("o_outcall_cand"),
    "o_outcall_pairs": _skip("o_outcall_all_pairs", "outcall_target"),
    "o_outcall_eval": _evaluated("o_outcall_pairs"),
    "o_outcall_ends": _ends("o_outcall_eval"),
    "o_receive_full": f"SELECT {_RECEIVE_COLUMNS}, {_NULL_SUCCESS}, {_null_flags('col_5')} "
                      "FROM receive_target",
    "o_outcall_full": f"SELECT {_outcall_names(True)}, NULL::INT AS city_region, "
                      f"NULL::INT AS old_status_cd, NULL::BIGINT AS old_class_dept_id, "
                      f"{_NULL_SUCCESS}, {_null_flags('col_1')} FROM outcall_target",
    "o_receive_changes": _changed_receive("receive_target"),
    "o_outcall_changes": _changed_outcall("outcall_target", "sys_bss_org"),
    "o_resolved": _resolved("o_outcall_changes", "sys_bss_org"),
    # the receive run
    "o_run_r_new": _receive_registered("receive_target"),
    "o_run_r_before": f"SELECT * FROM o_receive_full UNION ALL SELECT {_RECEIVE_COLUMNS}, "
                      f"{_NULL_SUCCESS}, {_null_flags()} FROM o_run_r_new",
    "o_run_r_changes": _changed_receive("o_run_r_before",
                                        _SCOPE.format("h", "o_pairs_receive")),
    "o_run_r_changed": _receive_applied("o_run_r_before", "o_run_r_changes", "*"),
    "o_run_r_cand": "SELECT a.* FROM o_receive_cand a WHERE true "
                    + _SCOPE.format("a", "o_pairs_receive"),
    "o_run_r_pairs": _pairs_of("o_run_r_cand"),
    "o_run_r_eval": _evaluated("o_run_r_pairs"),
    "o_run_r_first": _first("o_run_r_eval"),
    "o_run_r_hits": "SELECT *, 1 AS success FROM o_run_r_first",
    # the outcall run
    "o_run_c_new": _outcall_registered("area", "sys_bss_org_hq", "outcall_target",
                                       ", NULL::INT AS city_region")
                   + "\nUNION ALL " + _outcall_registered("province", "sys_bss_org_hq",
                                                          "outcall_target", _OWN_AREA),
    "o_run_c_before": f"SELECT * FROM o_outcall_full UNION ALL SELECT {_outcall_names(False)}, "
                      f"city_region, NULL, NULL, {_NULL_SUCCESS}, {_null_flags()} "
                      "FROM o_run_c_new",
    "o_run_c_changes": _changed_outcall("o_run_c_before", "sys_bss_org_hq",
                                        _SCOPE.format("h", "o_pairs_outcall")),
    "o_run_c_resolved": _resolved("o_run_c_changes", "sys_bss_org_hq"),
    "o_run_c_changed": _outcall_applied("o_run_c_before", "o_run_c_resolved", "*"),
    "o_run_c_cand": "SELECT a.* FROM o_outcall_cand a WHERE (a.shard_id <> 999 OR a.area "
                    "BETWEEN 0 AND 9) " + _SCOPE.format("a", "o_pairs_outcall"),
    "o_run_c_all_pairs": _pairs_of("o_run_c_cand"),
    "o_run_c_pairs": _skip("o_run_c_all_pairs", "outcall_target"),
    "o_run_c_eval": _evaluated("o_run_c_pairs"),
    "o_run_c_ends": _ends("o_run_c_eval"),
}

_BASE = ["main_campaign_id", "sub_campaign_id", "region_id", "prov_dept_id", "city_dept_id"]
_FINE = ["team_dept_id", "class_dept_id", "caller_id"]
LEVEL_KEYS = {"prov": _BASE, "city": _BASE + _FINE[:1], "team": _BASE + _FINE[:2],
              "class": _BASE + _FINE}
_MEASURES = """count(DISTINCT list_id) AS all_num,
       count(*) FILTER (WHERE status_cd <> 1100) AS assign_num,
       count(*) FILTER (WHERE status_cd >= 3100) AS exe_num,
       count(*) FILTER (WHERE order_result = 0) AS callsucc_num,
       count(*) FILTER (WHERE order_result = 1) AS next_num,
       count(*) FILTER (WHERE is_success = 1) AS mktsucc_num,
       count(*) FILTER (WHERE order_result = 2) AS mktfail_num,
       count(*) FILTER (WHERE order_result = 3) AS callfail_num"""


def _flag_sum(column: str, given: tuple[str, ...]) -> str:
    return (f"CAST(sum(coalesce({column}, 0)) AS BIGINT)" if column in given
            else "CAST(0 AS BIGINT)")


_VALID = "coalesce(v.valid_col_num, 0) AS valid_col_num"
_RULE_NAMES = ("LEFT JOIN o_rule_names v ON v.main_campaign_id = t.main_campaign_id "
               "AND v.sub_campaign_id = t.sub_campaign_id")


def _callout_report(level: str) -> str:
    keys = LEVEL_KEYS[level]
    names = ["(SELECT min(attr_value) FROM mkt_cam_conf_attr n "
             "WHERE n.attr_value_id = t.main_campaign_id) AS main_campaign_name",
             "(SELECT min(campaign_name) FROM pms_campaign n "
             "WHERE n.campaign_id = t.sub_campaign_id) AS sub_campaign_name"]
    for key in keys[3:]:
        names.append(
            "(SELECT min(user_name) FROM sys_user n WHERE n.user_id = t.caller_id) "
            "AS caller_name" if key == "caller_id" else
            f"(SELECT min(bss_org_name) FROM sys_bss_org n WHERE n.bss_org_id = t.{key}) "
            f"AS {key.replace('_id', '_name')}")
    flags = ", ".join(f"{_flag_sum(c, ('col_1', 'col_2'))} AS {c}_num" for c in FLAGS)
    flag_names = ", ".join(f"v.{c}_name" for c in FLAGS)
    order = ", ".join(f"t.{k} NULLS FIRST" for k in keys[1:])
    return f"""
SELECT t.*, {', '.join(names)}, {_VALID}, {flag_names},
       row_number() OVER (PARTITION BY t.main_campaign_id ORDER BY {order}) AS or_seq
FROM (SELECT {', '.join(keys)}, {_MEASURES}, {flags} FROM callout_detail
      GROUP BY {', '.join(keys)}) t {_RULE_NAMES}"""


def _all_levels() -> str:
    flags = ", ".join(f"{_flag_sum(c, ('col_1', 'col_2'))} AS {c}_num" for c in FLAGS)
    parts = []
    for level, keys in LEVEL_KEYS.items():
        columns = ", ".join(k if k in keys else f"NULL::BIGINT AS {k}"
                            for k in LEVEL_KEYS["class"])
        parts.append(f"SELECT '{level}' AS level, {columns}, {_MEASURES}, {flags} "
                     f"FROM callout_detail GROUP BY {', '.join(keys)}")
    union = "\nUNION ALL ".join(parts)
    return f"SELECT t.*, {_VALID} FROM ({union}) t {_RULE_NAMES}"


def _receive_report(level: str) -> str:
    keys = {"sec": ["z_mkt_campaign_id", "fir_grid_id", "sec_grid_id"],
            "org": ["z_mkt_campaign_id", "a_mkt_campaign_id", "fir_grid_id", "sec_grid_id",
                    "thi_grid_id", "org_id", "org_jt_code"]}[level]
    keys = [*keys, "report_day", "cop_channel_id"]
    flags = ", ".join(f"{_flag_sum(c, ('col_1',))} AS {c}" for c in FLAGS)
    campaign = "(SELECT min(campaign_name) FROM pms_campaign n WHERE n.campaign_id = t.{})"
    grid = "(SELECT min(tree_name) FROM grid_tree n WHERE n.tree_level = {} AND n.tree_id = t.{})"
    if level == "sec":
        orgs = """, count(DISTINCT org_id) AS receive_org_count,
       count(DISTINCT CASE WHEN user_id IS NOT NULL THEN org_id END) AS claimed_org_count"""
        more = f"""{grid.format(2, 'sec_grid_id')} AS dept_name,
       receive_suc_num::DOUBLE / nullif(receive_num, 0) AS suc_rec_per,
       claimed_org_count::DOUBLE / nullif(receive_org_count, 0) AS claimed_org_per"""
    else:
        orgs = ""
        more = f"""{campaign.format('a_mkt_campaign_id')} AS c_campaign_name,
       {grid.format(2, 'sec_grid_id')} AS sec_grid_name,
       {grid.format(3, 'thi_grid_id')} AS thi_grid_name,
       (SELECT min(org_name) FROM organization n WHERE n.org_id = t.org_id) AS dept_name,
       coalesce(thi_grid_id, sec_grid_id, fir_grid_id) AS grid_id"""
    return f"""
SELECT t.*, {campaign.format('z_mkt_campaign_id')} AS campaign_name, {more},
       claimed_count::DOUBLE / nullif(receive_num, 0) AS order_claimed_per,
       CAST(report_day AS TIMESTAMP) AS report_date
FROM (SELECT {', '.join(keys)}, count(DISTINCT list_id) AS receive_num,
       count(*) FILTER (WHERE is_success = 1) AS receive_suc_num,
       count(user_id) AS claimed_count,
       count(*) FILTER (WHERE status_cd >= 3100) AS exe_count,
       count(*) FILTER (WHERE status_cd >= 3100 AND is_success = 1) AS exe_suc_count{orgs},
       {flags}
      FROM (SELECT * EXCLUDE (report_date), strftime(report_date, '%Y-%m-%d') AS report_day
            FROM receive_detail)
      GROUP BY {', '.join(keys)}) t"""


def _rebuilt() -> str:
    parts = []
    for level, keys in LEVEL_KEYS.items():
        rows = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
        parts.append(f"SELECT 'callout_{level}' AS report, main_campaign_id AS catalogue, "
                     f"count(DISTINCT {rows}) AS report_rows, count(*) AS orders, "
                     f"CAST(sum(is_success) AS BIGINT) AS successes FROM callout_detail "
                     f"GROUP BY main_campaign_id")
    for level in ("sec", "org"):
        parts.append(f"SELECT 'receive_{level}', z_mkt_campaign_id, count(*), "
                     f"CAST(sum(receive_num) AS BIGINT), CAST(sum(receive_suc_num) AS BIGINT) "
                     f"FROM ({_receive_report(level)}) GROUP BY z_mkt_campaign_id")
    return "\nUNION ALL ".join(parts)


_CALLERS = f"""
SELECT DISTINCT class.area_id AS region_id, prov.bss_org_id AS prov_dept_id,
       prov.bss_org_name AS prov_dept_name, city.bss_org_id AS city_dept_id,
       city.bss_org_name AS city_dept_name, team.bss_org_id AS team_dept_id,
       team.bss_org_name AS team_dept_name, class.bss_org_id AS class_dept_id,
       class.bss_org_name AS class_dept_name, user_id AS caller_id, user_name AS caller_name,
       {DAY_BEFORE} AS sync_date
FROM sys_user_job job JOIN sys_user USING (user_id)
JOIN sys_bss_org class ON class.bss_org_id = job.bss_org_id AND class.bss_org_type_id = 4
JOIN sys_bss_org team ON team.bss_org_id = class.up_bss_org_id
JOIN sys_bss_org city ON city.bss_org_id = team.up_bss_org_id
JOIN sys_bss_org prov ON prov.bss_org_id = city.up_bss_org_id
WHERE role_id = 10004 OR role_id BETWEEN 10070 AND 10071"""


def _dimension_counts() -> str:
    plain = {"staff": ("staff", "staff_id"), "system_user": ("system_user", "system_user_id"),
             "organization": ("organization", "org_id"),
             "t_grid_org_code_rel": ("grid_org_code_rel", "org_jt_code"),
             "tb_pty_grid_tree": ("grid_tree", "tree_id"),
             "mkt_campaign_all": ("pms_campaign", "campaign_id"),
             "channel": ("pms_campaign_chl_rel", "campaign_id"),
             "block_contractor_rela": (
                 "(SELECT DISTINCT * EXCLUDE (quantity) FROM block_contractor)", "block_id"),
             "callout_bssorg_caller_rel": (f"({_CALLERS})", "caller_id")}
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows_loaded, "
        f"count(DISTINCT {key}) AS keys_loaded FROM {source}"
        for name, (source, key) in plain.items())


def _dimension_rows() -> str:
    """Empty texts are NULL; one table is stamped, one loses repeated rows."""
    parts = []
    for name, spec in SNAPSHOTS.items():
        columns = spec.columns or (*_GRID_COLUMNS, "password")
        shown = [f"coalesce(nullif(CAST({c} AS VARCHAR), ''), '~')" for c in columns]
        if spec.stamped:
            shown.append(f"'{AS_OF}'")
        parts.append(f"SELECT {'DISTINCT' if spec.distinct else ''} '{name}' AS table_name, "
                     f"concat_ws('|', {', '.join(shown)}) AS row_text FROM source_{name}")
    return "\nUNION ALL ".join(parts)


_DETAIL_SUCCESS = ("list_id, update_date, is_success, suc_rule_id, suc_rule_name, suc_order_id, "
                   "col_1, col_2, col_3, col_4, col_5")
_WINNER = "list_id, suc_rule_id, seq_no, rule_name, value"

STATEMENTS: dict[str, str] = {
    "dim_snapshot": "SELECT staff_id, staff_name FROM staff",
    "dim_snapshot_stamped": f"SELECT *, {NOW} AS load_date FROM grid_org_code_rel",
    "dim_snapshot_distinct": "SELECT DISTINCT * EXCLUDE (quantity) FROM block_contractor",
    "area_scan": "SELECT initiative_order_id, campaign_id, latn_id, shard_id, channel_id, state "
                 "FROM initiative_order WHERE shard_id BETWEEN 0 AND 9",
    "append_new_only": "SELECT initiative_order_id AS list_id, campaign_id, latn_id "
                       "FROM initiative_order o WHERE NOT EXISTS (SELECT 1 FROM detail d "
                       "WHERE d.list_id = o.initiative_order_id)",
    "replace_campaign_slice": """
SELECT main_campaign_id, sub_campaign_id, count(*) AS orders FROM callout_detail
WHERE main_campaign_id = 0 GROUP BY ALL
UNION ALL SELECT z_mkt_campaign_id, a_mkt_campaign_id, count(*) FROM receive_detail
WHERE z_mkt_campaign_id IN (1, 3) GROUP BY ALL""",
    "receive_apply_changes": _receive_applied(
        "o_receive_full", "o_receive_changes", f"* EXCLUDE ({', '.join(FLAGS)})"),
    "outcall_apply_changes": _outcall_applied(
        "o_outcall_full", "o_resolved", f"* EXCLUDE ({', '.join(FLAGS)})"),
    "success_log": _log("o_receive_first", NOW),
    "quarantine_errors": f"""
SELECT TRY_CAST(initiative_order_id AS BIGINT) AS order_id,
       '活动[' || campaign_id || ']的工单[' || initiative_order_id || ']'
       || CASE WHEN dept_id IS NOT NULL AND TRY_CAST(dept_id AS BIGINT) IS NULL
               THEN 'dept_id' ELSE 'curr_user_id' END || ' is not a valid bigint' AS errormsg,
       'p_order_receive_detail_call' AS pro_name, '-6502' AS errorcode
FROM raw_executor
WHERE (dept_id IS NOT NULL AND TRY_CAST(dept_id AS BIGINT) IS NULL)
   OR (curr_user_id IS NOT NULL AND TRY_CAST(curr_user_id AS BIGINT) IS NULL)
UNION ALL {_errors('o_resolved')}""",
    "run_log": f"""
SELECT '19980701' AS run_day, 11 AS log_type, sub_campaign_id AS campaign_id,
       {NOW} AS start_date, {NOW} AS end_date, latn_id FROM o_pairs_receive""",
    "active_campaigns": "SELECT * FROM o_active",
    "day_window": f"SELECT * FROM customer_order_syn WHERE status_date >= "
                            f"{MONTH_START} AND status_date < {DAY}",
    "day_window_open_start": f"SELECT * FROM initiative_order_executor WHERE last_opt_date > "
                             f"{YEAR_START} AND last_opt_date < {DAY}",
    "receive_changed_orders": "SELECT * FROM o_receive_changes",
    "outcall_changed_orders": "SELECT * FROM o_outcall_changes",
    "area_list": """
SELECT campaign_id, TRY_CAST(part AS INT) AS latn_id
FROM (SELECT campaign_id, unnest(regexp_extract_all(areas, '[^,]+')) AS part
      FROM campaign_scope) WHERE TRY_CAST(part AS INT) IS NOT NULL""",
    "area_list_errors": """
SELECT campaign_id AS order_id, 'areas: not a whole number: ' || part AS errormsg,
       'p_order_outcall_detail_call' AS pro_name, '-6502' AS errorcode
FROM (SELECT campaign_id, unnest(regexp_extract_all(areas, '[^,]+')) AS part
      FROM campaign_scope) WHERE TRY_CAST(part AS INT) IS NULL""",
    "receive_new_orders": _receive_registered("detail"),
    "receive_new_orders_bucketed": _receive_registered("detail"),
    "outcall_new_orders_area": _outcall_registered("area", "sys_bss_org", "detail"),
    "outcall_new_orders_province": _outcall_registered("province", "sys_bss_org_hq", "detail",
                                                       _OWN_AREA),
    "outcall_org_resolution": "SELECT * EXCLUDE (user_name) FROM o_resolved",
    "outcall_rule_pairs": "SELECT list_id, campaign_id, area, status_cd, suc_rule_id, rel_id, "
                          "seq_no, old_is_success FROM o_outcall_pairs",
    "orders_with_state": "SELECT * FROM o_held",
    "receive_success_candidates": "SELECT * FROM o_receive_cand",
    "outcall_success_candidates": "SELECT * FROM o_area_cand",
    "outcall_candidates_province": "SELECT * FROM o_prov_cand",
    "campaigns_by_area_receive": "SELECT * FROM o_pairs_receive",
    "campaigns_by_area_outcall": "SELECT * FROM o_pairs_outcall",
    "success_rules_ranked": "SELECT * FROM o_rules",
    "org_hierarchy_flatten": _CALLERS,
    "city_province": _cities("sys_bss_org"),
    "class_team_lookup": """
SELECT child.bss_org_id AS class_dept_id, child.bss_org_name AS class_dept_name,
       parent.bss_org_id AS team_dept_id, parent.bss_org_name AS team_dept_name
FROM sys_bss_org child JOIN sys_bss_org parent ON parent.bss_org_id = child.up_bss_org_id
WHERE (child.state, parent.state) = ('10A', '10A')""",
    "scalar_lookup": "SELECT list_id, org_id, region_id FROM receive_detail "
                     "LEFT JOIN o_org_region USING (org_id)",
    "user_name_lookup": "SELECT initiative_order_id, curr_user_id, user_name "
                        "FROM initiative_order_executor "
                        "LEFT JOIN o_user_names ON user_id = curr_user_id",
    "grid_lookup_top1": """
SELECT e.initiative_order_id, e.dept_id,
       CAST(CASE WHEN e.dept_id IS NULL THEN -1 WHEN g.code IS NULL THEN -2
            ELSE g.fir_grid_id END AS BIGINT) AS fir_grid_id,
       CAST(CASE WHEN e.dept_id IS NULL THEN -1 WHEN g.code IS NULL THEN -2
            ELSE g.sec_grid_id END AS BIGINT) AS sec_grid_id,
       CAST(CASE WHEN e.dept_id IS NULL THEN -1 WHEN g.code IS NULL THEN -2
            ELSE g.thi_grid_id END AS BIGINT) AS thi_grid_id,
       CAST(CASE WHEN e.dept_id IS NULL THEN NULL WHEN g.code IS NULL THEN -2
            ELSE g.org_id END AS BIGINT) AS org_id
FROM initiative_order_executor e LEFT JOIN o_grid g ON g.code = e.dept_id""",
    "receive_first_success": f"SELECT {_WINNER} FROM o_receive_first",
    "receive_first_success_waves": f"SELECT {_WINNER} FROM o_receive_first",
    "outcall_success_detail": "SELECT list_id, status_cd, first_suc_rule_id, first_rule_name, "
                              "first_value FROM o_outcall_ends",
    "outcall_success_executor": "SELECT list_id, status_cd, last_suc_rule_id, last_rule_name, "
                                "last_value FROM o_outcall_ends",
    **{f"callout_report_{level}": _callout_report(level) for level in LEVEL_KEYS},
    "callout_report_all_levels": _all_levels(),
    "receive_report_sec": _receive_report("sec"),
    "receive_report_org": _receive_report("org"),
    "success_flag_columns": _flags("o_receive_eval", 5),
    "rule_eval": "SELECT list_id, suc_rule_id, seq_no, hit, value, success FROM o_receive_eval",
    "rule_eval_range": _all_asked(RANGE_RULES),
    "rule_eval_nested": _all_asked(NESTED_RULES),
    "rule_eval_shared": _all_asked(SHARED_RULES),
    "rule_errors": f"""
SELECT list_id AS order_id, 'evaluate_rules' AS pro_name, '-1' AS errorcode,
       'rule 71: [DIVIDE_BY_ZERO]' AS problem
FROM o_receive_cand WHERE cust_id = 100
  AND (cust_id, area) IN (SELECT (cust_id, latn_id) FROM customer_order_syn)
UNION ALL
SELECT list_id, 'evaluate_rules', '-6502', 'rule 72: ' || count(*) || ' results'
FROM o_receive_cand c, LATERAL ({_bound(FAILING_RULES[72])}) q(v) GROUP BY list_id""",
    "rule_first_value": """
SELECT list_id, suc_rule_id, value,
       CASE WHEN nulls > 0 OR value IS NOT NULL THEN 1 ELSE 0 END AS hit,
       CASE WHEN (nulls > 0 AND value IS NULL) OR value <> -1 THEN 1 ELSE 0 END AS success
FROM (SELECT list_id, suc_rule_id,
             count(*) FILTER (WHERE value IS NULL) AS nulls,
             min(CASE WHEN value NOT IN ('-999999999', 'void') THEN CAST(value AS BIGINT) END)
             AS value
      FROM rule_rows GROUP BY ALL)""",
    "receive_success_apply":
        f"SELECT {_DETAIL_SUCCESS} FROM ("
        + _receive_won("o_receive_full", "o_receive_first",
                       "(SELECT *, 1 AS success FROM o_receive_first)") + ")",
    "receive_success_state": _receive_state("o_receive_first"),
    "outcall_success_apply": f"SELECT status_cd, {_DETAIL_SUCCESS} FROM ("
                             + _outcall_won("o_outcall_full", "o_outcall_ends",
                                            "o_outcall_eval") + ")",
    "outcall_success_state": _outcall_state("o_outcall_ends"),
    "condition_explode": """
SELECT id, CAST(pos AS INT) AS pos, nullif(split_part(pair, ':', 1), '') AS key,
       nullif(split_part(pair, ':', 2), '') AS value,
       CAST(length(conditions) - length(replace(conditions, ',', '')) + 1 AS INT) AS n_parts
FROM (SELECT id, conditions, unnest(string_split(conditions, ',')) AS pair,
             unnest(range(1, len(string_split(conditions, ',')) + 1)) AS pos
      FROM condition_text WHERE conditions IS NOT NULL)""",
    "receive_daily_run": _receive_won("o_run_r_changed", "o_run_r_first", "o_run_r_hits"),
    "detail_merge": _receive_won("o_run_r_changed", "o_run_r_first", "o_run_r_hits"),
    "executor_merge": _receive_state("o_run_r_first"),
    "callout_detail_merge": _outcall_won("o_run_c_changed", "o_run_c_ends", "o_run_c_eval"),
    "replace_partitions_at_once": """
SELECT main_campaign_id, sub_campaign_id, count(*) AS orders FROM callout_detail
WHERE main_campaign_id = 0 GROUP BY ALL
UNION ALL SELECT z_mkt_campaign_id, a_mkt_campaign_id, count(*) FROM receive_detail
WHERE z_mkt_campaign_id IN (1, 3) GROUP BY ALL""",
    "receive_daily_executor": _receive_state("o_run_r_first"),
    "receive_daily_log": _log("o_run_r_first", NOW),
    "outcall_daily_run": _outcall_won("o_run_c_changed", "o_run_c_ends", "o_run_c_eval"),
    "outcall_daily_executor": _outcall_state("o_run_c_ends"),
    "outcall_daily_log": _log("o_run_c_eval", DAY_BEFORE) + " WHERE success = 1",
    "receive_daily_errors": _run_errors("o_run_r_pairs", "p_order_receive_detail_call"),
    "outcall_daily_errors": _errors("o_run_c_resolved") + "\nUNION ALL "
                            + _run_errors("o_run_c_pairs", "p_order_outcall_detail_call"),
    "report_incremental": _receive_report("sec"),
    "report_incremental_org": _receive_report("org"),
    "report_incremental_class": _callout_report("class"),
    "dimension_rows": _dimension_rows(),
    "report_rebuild": _rebuilt(),
    "dimension_refresh": _dimension_counts(),
}

# What the runs with faulty tables read in the place of the executor table.
_TYPED = {"initiative_order_executor":
          "SELECT * REPLACE (TRY_CAST(dept_id AS BIGINT) AS dept_id) FROM executor_text"}
_FAULTY = ("receive_daily_errors", "outcall_daily_errors")

ORACLES = {name: with_views(sql, {**VIEWS, **DERIVED, **(_TYPED if name in _FAULTY else {})})
           for name, sql in STATEMENTS.items()}

from datetime import datetime

import pytest

from orderflow.operators import apply as ap
from orderflow.operators import quality as qu
from orderflow.sources import conform

NOW = "2024-05-10 12:00:00"


def receive_detail(make, *rows):
    return conform(make("list_id bigint, status_cd int, org_id bigint, org_jt_code bigint, "
                        "old_status_cd int, user_id bigint, is_success int", *rows),
                   ap.RECEIVE_DETAIL)


def test_receive_change_shifts_one_level_of_history(make, rows):
    detail = receive_detail(make, (1, 1100, 300, 30, 5, 9, 0), (1, 1101, 301, 30, 6, 9, 0),
                            (2, 1100, 300, 30, 5, 9, 1))
    changes = make("list_id bigint, status_cd int, dept_id bigint, curr_user_id bigint, "
                   "user_name string, fir_grid_id bigint, sec_grid_id bigint, "
                   "thi_grid_id bigint, org_id bigint", (1, 2100, None, 8, "n", -1, -1, -1, None))
    out = ap.apply_receive_changes(detail, changes, NOW)
    # repeated detail rows each shift their own value once; no department means no organisation
    assert rows(out, "list_id", "old_status_cd", "status_cd", "old_org_id", "org_id",
                "org_jt_code", "thi_grid_id", "user_id") == [
        (1, 1100, 2100, 300, None, None, -1, 8), (1, 1101, 2100, 301, None, None, -1, 8),
        (2, 5, 1100, None, 300, 30, None, 9)]
    assert out.where("list_id = 1").head().update_date == datetime(2024, 5, 10, 12)


RESOLVED = ("list_id bigint, status_cd int, order_result bigint, action string, problem string, "
            "team_dept_id bigint, team_dept_name string, class_dept_id bigint, "
            "class_dept_name string, caller_id bigint, caller_name string")


@pytest.mark.parametrize("legacy", [False, True])
def test_outcall_change(make, rows, legacy):
    detail = conform(make("list_id bigint, status_cd int, team_dept_id bigint, "
                          "class_dept_id bigint, caller_id bigint, order_result bigint",
                          *[(i, 1100, 100, 1000, 7, 1) for i in range(1, 7)]),
                     ap.OUTCALL_DETAIL)
    resolved = make(RESOLVED,
                    (1, 2100, 5, "user", None, 101, "t", 1001, "c", 8, "n"),
                    (2, 2100, None, "class", None, 101, "t", 1001, "c", None, None),
                    (3, 2100, 5, "team", None, 101, "t", None, None, None, None),
                    (4, 2100, 5, "none", None, None, None, None, None, None, None),
                    (5, 2100, 5, "user", "missing", 101, "t", 1001, "c", 8, "n"))
    out = ap.apply_outcall_changes(detail, resolved, NOW, legacy=legacy)
    before = None if legacy else 1000
    assert rows(out, "list_id", "old_status_cd", "status_cd", "team_dept_id", "class_dept_id",
                "old_class_dept_id", "caller_id", "order_result") == [
        (1, 1100, 2100, 101, 1001, before, 8, 5), (2, 1100, 2100, 101, 1001, before, 7, 1),
        (3, 1100, 2100, 101, 1000, None, 7, 1), (4, None, 1100, 100, 1000, None, 7, 1),
        (5, None, 1100, 100, 1000, None, 7, 1), (6, None, 1100, 100, 1000, None, 7, 1)]
    assert out.where("list_id = 3").head().update_date == datetime(2024, 5, 9, 12)


HITS = "list_id bigint, suc_rule_id int, rule_name string, report_column string, value bigint"


def test_flags(make, rows):
    hits = make(HITS, (1, 1, "a", "col_1", 5), (1, 2, "b", "COL_3", 6), (1, 1, "a", "col_1", 5))
    assert rows(ap.flag_columns(hits), "list_id", "col_1", "col_2", "col_3") == [(1, 1, None, 1)]
    detail = receive_detail(make, (1, 1, 1, 1, 1, 1, 0), (2, 1, 1, 1, 1, 1, 0))
    flagged = ap.apply_flags(detail, hits)
    again = ap.apply_flags(flagged, make(HITS, (2, 1, "a", "col_2", 5)))
    assert rows(again, "list_id", "col_1", "col_2", "col_3") == [
        (1, 1, None, 1), (2, None, 1, None)]


def test_unknown_flag_column_is_logged(make, rows):
    hits = make(HITS, (1, 1, "a", "col_21; drop", 5), (1, 2, "b", "col_2", 5), (2, 3, "c", None, 5))
    assert rows(ap.flag_columns(hits), "list_id", "col_2") == [(1, 1)]
    assert rows(ap.unknown_columns(hits, "job"), "order_id", "errormsg", "errorcode") == [
        (1, "unknown report column col_21; drop", "-904"),
        (2, "unknown report column NULL", "-904")]


def test_logs(make, rows):
    hits = make(HITS, (1, 4, "a", "col_1", None))
    assert rows(ap.success_log(hits, NOW, -1)) == [
        (1, 4, datetime(2024, 5, 9, 12), "a", None)]
    pairs = make("sub_campaign_id bigint, latn_id int", (7, 290))
    assert rows(ap.run_log(pairs, "2024-05-10 11:00:00", NOW)) == [
        ("20240510", 11, 7, datetime(2024, 5, 10, 11), datetime(2024, 5, 10, 12), 290)]


def test_split_valid(make, rows):
    df = make("id string, a string, b string", ("1", "5", None), ("2", "x", "y"), ("3", "5", "y"))
    good, bad = qu.split_valid(df, {"a": qu.cast_check("a"), "b": qu.cast_check("b")})
    assert rows(good, "id") == [("1",)]
    assert rows(bad, "id", "reason") == [("2", "a"), ("3", "b")]


def test_error_texts(make, rows):
    failed = make("list_id bigint, campaign_id bigint, problem string", (1, 7, "missing"),
                  (2, 7, "ambiguous"), (3, 7, None))
    assert rows(qu.outcall_errors(failed), "order_id", "errormsg", "errorcode") == [
        (1, "ORA-01403: no data found", "1"),
        (2, "活动[7]的工单[2]several rows in lookup", "-1422")]

from datetime import datetime

from orderflow.operators import apply as ap
from orderflow.operators import success as su
from orderflow.plans.receive import with_success_columns
from orderflow.sources import conform

NOW = "2024-05-10 12:00:00"
HITS = ("list_id bigint, seq_no int, suc_rule_id int, rule_name string, report_column string, "
        "value bigint, old_is_success int, status_cd int, main_campaign_id bigint")


def hits(make, *extra):
    return make(HITS, (1, 2, 8, "b", "col_8", 50, 0, 2100, 7), (1, 1, 9, "a", "col_9", None, 0, 2100, 7),
                (1, 3, 7, "c", "col_7", 70, 0, 2100, 7), (2, 1, 9, "a", "col_9", 90, 1, 1100, 7), *extra)


def test_receive_first_rule_wins(make, rows):
    assert rows(su.first_success(hits(make)), "list_id", "seq_no", "suc_rule_id", "value") == [
        (1, 1, 9, None), (2, 1, 9, 90)]


def test_outcall_first_and_last(make, rows):
    assert rows(su.outcall_success(hits(make)), "list_id", "first_suc_rule_id", "first_value",
                "last_suc_rule_id", "last_value") == [(1, 9, None, 7, 70)]


def test_smallest_catalogue_first(make, rows):
    two = make(HITS, (1, 1, 9, "a", "col_9", 90, 0, 2100, 8), (1, 2, 8, "b", "col_8", 80, 0, 2100, 7),
               (1, 3, 6, "c", "col_6", 60, 0, 2100, 7), (1, 9, 5, "d", "col_5", 50, 0, 2100, 8))
    assert rows(su.first_success(two), "suc_rule_id") == [(8,)]
    assert rows(su.outcall_success(two), "first_suc_rule_id", "last_suc_rule_id") == [(8, 6)]


def test_receive_detail_and_executor(make, rows):
    winners = su.first_success(hits(make))
    detail = conform(make("list_id bigint, is_success int, suc_rule_id bigint", (1, None, None),
                          (1, 1, 3), (2, 1, 3), (4, 0, None)), ap.RECEIVE_DETAIL)
    out = ap.apply_flags(su.receive_success_detail(detail, winners, NOW), winners)
    # rows already successful keep their rule, the flag column is set all the same
    assert rows(out, "list_id", "is_success", "suc_rule_id", "col_9") == [
        (1, 1, 3, 1), (1, 1, 9, 1), (2, 1, 3, 1), (4, 0, None, None)]
    state = with_success_columns(make("initiative_order_id bigint, is_success int", (1, 0),
                                      (3, 0)))
    assert rows(su.receive_success_executor(state, winners, NOW), "initiative_order_id",
                "is_success", "suc_rule_id", "suc_time") == [
        (1, 1, 9, datetime(2024, 5, 10, 12)), (3, 0, None, None)]


def test_outcall_status(make, rows):
    more = hits(make, (3, 1, 9, "a", "col_9", 5, 0, 2000, 7), (4, 1, 9, "a", "col_9", 5, 0, None, 7))
    ends = su.outcall_success(more)
    detail = conform(make("list_id bigint, status_cd int, is_success int",
                          *[(i, 1101, 1 if i == 2 else 0) for i in range(1, 6)]),
                     ap.OUTCALL_DETAIL)
    out = ap.apply_flags(su.outcall_success_detail(detail, ends, NOW), more)
    # above 2000 the detail keeps its own status; 2000 and NULL become 7000
    assert rows(out, "list_id", "status_cd", "is_success", "suc_rule_id", "col_9") == [
        (1, 1101, 1, 9, 1), (2, 1101, 1, None, 1), (3, 7000, 1, 9, 1), (4, 7000, 1, 9, 1),
        (5, 1101, 0, None, None)]
    state = with_success_columns(make(
        "initiative_order_id bigint, status_cd int, is_success int, last_opt_date timestamp_ntz",
        *[(i, 1101, 0, datetime(2024, 1, 1)) for i in range(1, 6)]))
    done = su.outcall_success_executor(state, ends, NOW)
    assert rows(done, "initiative_order_id", "status_cd", "suc_rule_id", "hand_call",
                "last_opt_desc") == [
        (1, 1101, 7, None, "successed complete"), (2, 1101, None, None, None),
        (3, 7000, 9, 0, "successed complete"), (4, 7000, 9, 0, "successed complete"),
        (5, 1101, None, None, None)]

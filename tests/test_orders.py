from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from orderflow.operators import orders as od

ORDER = ("initiative_order_id bigint, cust_id bigint, cust_name string, acc_nbr string, "
         "prod_inst_id bigint, campaign_id bigint, latn_id int, shard_id int, channel_id int, "
         "state string")
EXEC = ("initiative_order_id bigint, status_cd int, dept_id bigint, curr_user_id bigint, "
        "latn_id int, shard_id int, last_opt_date timestamp_ntz, is_success int")
GRID = "org_jt_code bigint, org_id bigint, fir_grid_id int, sec_grid_id int, thi_grid_id bigint"
PAIRS = ("main_campaign_id bigint, main_campaign_name string, sub_campaign_id bigint, "
         "sub_campaign_name string, latn_id int")
NOW = "2024-05-10 12:00:00"
IN = datetime(2024, 5, 9, 10)


def order(i, campaign=7, latn=1, shard=None, channel=3, state="10A"):
    return (i, 500 + i, "c", "a", i * 10, campaign, latn, latn if shard is None else shard,
            channel, state)


def state(i, status=1100, dept=30, user=None, latn=1, shard=None, when=IN):
    return (i, status, dept, user, latn, latn if shard is None else shard, when, 0)


@pytest.fixture
def register(make):
    def run(orders, executors, detail=(), grid=((30, 300, 1, 2, 3),), dedupe=False, pairs=None):
        return od.new_receive_orders(
            od.orders_with_state(make(ORDER, *orders), make(EXEC, *executors)), make(GRID, *grid),
            make("list_id bigint", *[(i,) for i in detail]),
            make("org_id bigint, common_region_id int", (300, 5)),
            make("region_id int, region_name string", (5, "r")),
            make("system_user_id bigint, staff_id bigint", (1, 1)),
            make("staff_id bigint, staff_name string", (1, "n")),
            pairs or make(PAIRS, (70, "m", 7, "s", 1)), NOW, dedupe=dedupe)
    return run


def test_who_is_registered(register, rows):
    orders = [order(1), order(2, state="10X"), order(3, channel=6), order(4, channel=None),
              order(5, campaign=8), order(6, latn=2), order(7, shard=999), order(8)]
    out = register(orders, [state(i) for i in range(1, 9)], detail=[8])
    assert rows(out, "list_id") == [(1,)]
    row = out.head()
    assert (row.z_mkt_campaign_id, row.a_mkt_campaign_id, row.region_id) == (70, 7, 5)
    assert (row.old_org_id, row.org_id, row.is_success) == (300, 300, 0)
    assert (row.report_date, row.update_date) == (NOW, datetime(2024, 5, 10, 12))
    assert len(out.columns) == 23


def test_several_org_rows_multiply_unless_deduped(register, rows):
    grid = [(30, 300, 1, 2, 3), (30, 301, 1, 2, 4)]
    args = ([order(1)], [state(1)])
    assert rows(register(*args, grid=grid), "org_id") == [(300,), (301,)]
    assert rows(register(*args, grid=grid, dedupe=True), "org_id") == [(300,)]


def test_unknown_department_still_registers(register, rows):
    out = register([order(1)], [state(1, dept=31)])
    assert rows(out, "list_id", "org_id", "org_jt_code") == [(1, None, None)]


def test_two_catalogues_register_an_order_once(register, make, rows):
    pairs = make(PAIRS, (71, "m", 7, "s", 1), (70, "m", 7, "s", 1), (70, "m", 7, "s", 1))
    assert rows(register([order(1)], [state(1)], pairs=pairs), "z_mkt_campaign_id") == [(70,)]


def test_rerun_registers_nothing(register):
    orders, states = [order(1), order(2)], [state(1), state(2)]
    first = [r.list_id for r in register(orders, states).collect()]
    assert register(orders, states, detail=first).count() == 0


CITY = ("region_id int, prov_dept_id bigint, prov_dept_name string, city_dept_id bigint, "
        "city_dept_name string")


@pytest.mark.parametrize("mode, expected", [
    ("area", [(1, 1, 0), (1, 1, 1)]), ("province", [(4, 999, 1)])])
def test_outcall_registration(make, rows, mode, expected):
    orders = [order(1, channel=6), order(2), order(3, channel=6), order(4, channel=6, shard=999),
              order(5, channel=6, campaign=8)]
    states = [state(1), state(2), state(3, latn=2, shard=1), state(4, shard=999), state(5)]
    out = od.new_outcall_orders(
        od.orders_with_state(make(ORDER, *orders), make(EXEC, *states)),
        make("list_id bigint, order_result bigint", (1, 0), (1, 1), (1, 1), (4, 1)),
        make(CITY, (1, 9, "p", 90, "c"), (999, 9, "p", 99, "hq")),
        make("list_id bigint"), make(PAIRS, (70, "m", 7, "s", 1), (70, "m", 7, "s", 999)),
        NOW, mode=mode)
    assert rows(out, "list_id", "region_id", "order_result") == expected
    assert len(out.columns) == (24 if mode == "area" else 25)
    assert out.head().create_date == datetime(2024, 5, 9, 12)
    if mode == "province":
        assert out.head().city_region == 1


DETAIL = "list_id bigint, status_cd int, org_jt_code bigint, user_id bigint"


def test_receive_changes(make, rows):
    orders = make(ORDER, *[order(i) for i in range(1, 10)], order(10, channel=9),
                  order(11, state="10X"))
    states = make(EXEC,
                  state(1, status=2100), state(2, dept=None), state(3, dept=31),
                  state(4, user=5), state(5, status=None),
                  state(6, status=2100, when=datetime(2024, 5, 9)),
                  state(7, status=2100, when=datetime(2024, 5, 10)),
                  state(8, status=2100, when=datetime(2024, 5, 9, 0, 0, 1)), state(9),
                  state(10, status=2100), state(11, status=2100))
    detail = make(DETAIL, (1, 1100, 30, None), (1, 1101, 30, None), (2, 1100, 0, 0),
                  (3, 1100, 30, None), (4, 1100, 30, None), (5, 1100, 30, None),
                  *[(i, 1100, 30, None) for i in range(6, 12)])
    out = od.changed_receive(od.orders_with_state(orders, states), detail,
                             make("channel_id int", (3,)), NOW)
    # 2: NULL equals 0; 5: NULL status never differs; 6 lies on the open start; 7 on the end
    assert rows(out, "list_id") == [(1,), (3,), (4,), (8,)]


def test_changes_outside_the_campaigns_areas_are_left(make, rows):
    orders = make(ORDER, order(1), order(2, shard=999), order(3, campaign=8))
    states = make(EXEC, state(1, status=1), state(2, status=1, shard=999), state(3, status=1))
    detail = make(DETAIL, *[(i, 1100, 30, None) for i in (1, 2, 3)])
    held = od.in_scope(od.orders_with_state(orders, states),
                       make(PAIRS, (70, "m", 7, "s", 1), (71, "m", 7, "s", 1)))
    out = od.changed_receive(held, detail, make("channel_id int", (3,)), NOW)
    assert rows(out, "list_id") == [(1,)]


def test_outcall_changes(make, rows):
    orders = make(ORDER, *[order(i, channel=6) for i in range(1, 7)], order(7))
    states = make(EXEC, state(1, status=2100), state(2, status=1100), state(3, status=7000),
                  state(4, status=1101, dept=31), state(5, status=2100, dept=99),
                  state(6, status=2100, when=datetime(2024, 5, 9)), state(7, status=2100))
    detail = make("list_id bigint, status_cd int", (1, 1101), (2, 1101), (3, 1101), (4, 1101),
                  (5, 1101), (6, 1101), (7, 1101))
    org = make("bss_org_id bigint, bss_org_type_id int", (30, 4), (31, 3))
    results = make("list_id bigint, order_result bigint", (1, 8))
    out = od.changed_outcall(od.orders_with_state(orders, states), detail, results, org, NOW)
    assert rows(out, "list_id", "order_result", "org_type_id") == [
        (1, 8, 4), (5, None, 0), (6, None, 4)]


def test_duplicate_results_stop_the_run_unless_told_otherwise(make, rows):
    held = od.orders_with_state(make(ORDER, order(1, channel=6)), make(EXEC, state(1, status=2100)))
    args = (held, make("list_id bigint, status_cd int", (1, 1101)),
            make("list_id bigint, order_result bigint", (1, 8), (1, 3)),
            make("bss_org_id bigint, bss_org_type_id int", (30, 4)), NOW)
    with pytest.raises(PySparkException, match="several rows in lookup"):
        od.changed_outcall(*args).collect()
    assert rows(od.changed_outcall(*args, on_dup="any"), "order_result") == [(3,)]


def test_state_joins_inside_the_area(make, rows):
    out = od.orders_with_state(make(ORDER, order(1), order(2)),
                               make(EXEC, state(1), state(2, shard=999)))
    assert rows(out, "initiative_order_id", "ex_latn_id") == [(1, 1)]

import random
from datetime import datetime

import pytest

from checks.queries import _candidates, _rule_tables, _rules
from checks.roles import RULES, Roles
from orderflow.operators import rules as ru
from orderflow.operators.orders import orders_with_state
from orderflow.operators.success import first_success
from orderflow.session import stage

PAIR = ("list_id bigint, cust_id bigint, prod_inst_id bigint, area int, "
        "main_campaign_id bigint, suc_rule_id int, rel_id bigint, seq_no int")


def test_bind():
    assert ru.bind("select 'Brand[x]' where a = [custId] and b=[LATN_ID] and c=[CUSTID]") == (
        "select 'Brand[x]' where a = c.cust_id and b=c.area and c=c.cust_id",
        ["cust_id", "area"])


@pytest.fixture
def ask(make, rows):
    values = make("cust_id bigint, v string", (1, "5"), (1, None), (1, "3"), (2, None),
                  (3, "-999999999"), (4, "-1"), (5, "x"), (6, "x"), (6, "8"),
                  (7, "-999999999"), (7, "9"))
    pairs = make(PAIR, *[(10 + c, c, 0, 1, 7, 1, 2, 1) for c in range(1, 9)])

    def run(text, **options):
        return ru.evaluate_rules(pairs, [(1, text)], {"vals": values}, **options)
    return run


def test_value_semantics(ask, rows):
    out = ask("select v from vals where vals.cust_id = [CUSTID]")
    assert rows(out.answers, "list_id", "hit", "value", "success") == [
        (11, 1, 3, 1),       # smallest number
        (12, 1, None, 1),    # only NULLs: success without an id
        (13, 0, None, 0),    # only the no-row mark
        (14, 1, -1, 0),      # -1 is a failure
        (15, 0, None, 0),    # not a number never becomes a success
        (16, 1, 8, 1), (17, 1, 9, 1), (18, 0, None, 0)]
    assert rows(out.errors, "order_id") == [(15,), (16,)]


def test_null_can_be_a_failure(ask, rows):
    out = ask("select v from vals where vals.cust_id = [CUSTID]", null_is_success=False)
    assert (12, 0) in rows(out.answers, "list_id", "success")


def test_aggregate_rule_always_answers(ask, rows):
    out = ask("select max(cast(v as bigint)) from vals where vals.cust_id = [CUSTID] "
              "and v not in ('x')")
    assert (18, 1, None, 1) in rows(out.answers, "list_id", "hit", "value", "success")
    assert (11, 1, 5, 1) in rows(out.answers, "list_id", "hit", "value", "success")


def test_rule_without_placeholders(ask, rows):
    out = ask("select 4")
    assert {r[1:] for r in rows(out.answers, "list_id", "value", "success")} == {(4, 1)}


def test_ordered_limit_and_union(ask, rows):
    limited = ask("select v from vals where vals.cust_id = [CUSTID] and v is not null "
                  "order by v desc limit 1")
    assert (11, 5) in rows(limited.answers, "list_id", "value")
    union = ask("select v from vals where vals.cust_id = [CUSTID] union all select '1'")
    assert (18, 1) in rows(union.answers, "list_id", "value")


@pytest.mark.parametrize("text", ["selec v", "select v from nowhere", "select [OTHER]",
                                  "select v, v from vals"])
def test_rule_that_does_not_compile(ask, rows, text):
    out = ask(text)
    assert list(out.failed_rules) == [1]
    assert {r[1:] for r in rows(out.answers, "list_id", "value", "success")} == {(-1, 0)}


def test_rule_that_fails_while_running_spares_the_others(make, rows):
    values = make("cust_id bigint, v string", (1, "5"), (2, "x"))
    pairs = make(PAIR, *[(10 + c, c, 0, 1, 7, rule, 2, rule) for c in (1, 2) for rule in (1, 2)])
    out = ru.evaluate_rules(
        pairs, [(1, "select cast(v as bigint) from vals where vals.cust_id = [CUSTID]"),
                (2, "select 6 from vals where vals.cust_id = [CUSTID]")],
        {"vals": values}, isolate=True)
    assert list(out.failed_rules) == [1]
    assert rows(out.answers, "list_id", "suc_rule_id", "value", "success") == [
        (11, 1, -1, 0), (11, 2, 6, 1), (12, 1, -1, 0), (12, 2, 6, 1)]


def test_null_binding_matches_only_itself(make, rows):
    pairs = make(PAIR, (1, None, 0, 1, 7, 1, 2, 1), (2, 5, 0, 1, 7, 1, 2, 1))
    out = ru.evaluate_rules(pairs, [(1, "select max(v) from vals where vals.cust_id = [CUSTID]")],
                            {"vals": make("cust_id bigint, v bigint", (5, 50))})
    assert rows(out.answers, "list_id", "hit", "value") == [(1, 1, None), (2, 1, 50)]


def test_no_rules(make):
    pairs = make(PAIR)
    assert ru.evaluate_rules(pairs, [], {}).answers.count() == 0


def test_reduce_rule_rows(make, rows):
    raw = make("list_id bigint, suc_rule_id int, value string", (1, 1, "7"), (1, 1, "10"),
               (2, 1, None), (2, 1, "-999999999"), (3, 1, "-999999999"), (4, 1, "void"))
    assert rows(ru.reduce_rule_rows(raw)) == [
        (1, 1, 7, 1, 1), (2, 1, None, 1, 1), (3, 1, None, 0, 0), (4, 1, None, 0, 0)]


def test_set_based_equals_a_loop_over_orders(spark, rows):
    """The reference way - one query per order and rule - on fifty orders."""
    r = Roles(spark, "/root/testdata/sf0.001")
    rules = _rules(r)
    candidates = _candidates(r, "receive").orderBy("list_id").limit(50)
    asked = stage(ru.rule_pairs(candidates, rules), "asked")
    tables = _rule_tables(r)
    out = ru.evaluate_rules(asked, ru.rule_texts(rules), tables).answers
    purchases = [row.asDict() for row in tables["customer_order_syn"].collect()]
    brand = {row.p_partkey: row.p_brand for row in tables["part"].collect()}
    tests = {1: lambda p: p["status_cd"] == 300000 and p["offer_id"] % 7 == 0,
             2: lambda p: p["amount"] > 95000, 3: lambda p: p["offer_id"] % 50 == 1,
             4: lambda p: brand.get(p["offer_id"]) == "Brand#7"}
    assert set(tests) == set(RULES)
    expected = []
    for pair in asked.collect():
        found = [p["order_id"] for p in purchases if p["cust_id"] == pair.cust_id
                 and p["latn_id"] == pair.area and tests[pair.suc_rule_id](p)]
        if pair.suc_rule_id == 3:
            answer = (1, max(found) if found else None, 1)
        else:
            answer = (1, min(found), 1) if found else (0, None, 0)
        expected.append((pair.list_id, pair.suc_rule_id, *answer))
    assert expected and rows(out, "list_id", "suc_rule_id", "hit", "value", "success") == sorted(
        expected, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


ORDER = ("initiative_order_id bigint, cust_id bigint, prod_inst_id bigint, campaign_id bigint, "
         "latn_id int, shard_id int, channel_id int, state string")
EXEC = ("initiative_order_id bigint, status_cd int, latn_id int, shard_id int, is_success int, "
        "dept_id bigint, curr_user_id bigint, last_opt_date timestamp_ntz")
SYN = "cust_id bigint, latn_id int, status_cd int, status_date timestamp_ntz"


@pytest.mark.parametrize("mode, expected", [
    ("receive", [(1, 1), (2, 1)]), ("area", [(5, 1)]), ("province", [(6, 1)])])
def test_candidates(make, rows, mode, expected):
    orders = make(ORDER, (1, 50, 0, 7, 1, 1, 3, "10A"),
                  (2, 50, 0, 7, 1, 1, 3, "10X"),        # the order state does not matter
                  (3, 50, 0, 7, 1, 1, 3, "10A"),        # already successful
                  (4, 51, 0, 7, 1, 1, 3, "10A"),        # purchase outside the window
                  (5, 50, 0, 7, 1, 1, 6, "10A"), (6, 50, 0, 7, 1, 999, 6, "10A"),
                  (7, 50, 0, 7, 2, 2, 3, "10A"),        # other area
                  (8, 50, 0, 7, 2, 999, 6, "10A"))
    states = make(EXEC, *[(i, 1100, 1, 999 if i in (6, 8) else 2 if i == 7 else 1,
                           1 if i == 3 else None if i == 2 else 0, None, None, None)
                          for i in range(1, 9)])
    bought = make(SYN, (50, 1, 300000, datetime(2024, 5, 9)),
                  (50, 1, 300000, datetime(2024, 5, 9, 1)),
                  (51, 1, 300000, datetime(2024, 5, 10)), (51, 1, 100000, datetime(2024, 5, 9)))
    out = ru.success_candidates(orders_with_state(orders, states), bought, "2024-05-10 12:00:00", mode=mode)
    assert rows(out, "list_id", "area") == expected


def test_skip_logged(make, rows):
    pairs = make("list_id bigint, suc_rule_id int", (1, 1), (1, 2), (2, 1), (3, 1))
    detail = make("list_id bigint, is_success int", (1, 1), (2, 0))
    log = make("list_id bigint, suc_rule_id int", (1, 1), (1, 1), (2, 1), (3, 1))
    # order 2 was not successful and order 3 is unknown: their log rows do not count
    assert rows(ru.skip_logged(pairs, detail, log), "list_id", "suc_rule_id",
                "old_is_success") == [(1, 2, 1), (2, 1, 0), (3, 1, 0)]


def test_whole_numbers_in_any_notation_are_ids(make, rows):
    raw = make("list_id bigint, suc_rule_id int, value string", (1, 1, "12.00"), (1, 1, "13"),
               (2, 1, "1.2E3"), (3, 1, "12.5"), (4, 1, "-999999999.0"), (5, 1, "x"))
    out = ru.reduce_rule_rows(raw)
    assert rows(out, "list_id", "value", "hit") == [
        (1, 12, 1), (2, 1200, 1), (3, None, 0), (4, None, 0), (5, None, 0)]


def test_waves_ask_only_unfinished_orders(make, rows, monkeypatch):
    chance = random.Random(3)
    values = make("cust_id bigint, rule int, v bigint",
                  *[(c, r, c * 10 + r) for c in range(30) for r in range(1, 8)
                    if chance.random() < 0.3])
    pairs = make(PAIR + ", rule_name string, report_column string",
                 *[(100 + c, c, 0, 1, main, r, 2, (r * 3) % 7 if r < 7 else None, f"r{r}", "col_1")
                   for c in range(30) for main in (1, 2) for r in range(1, 8) if (c + r + main) % 4])
    texts = [(r, f"select v from vals where vals.cust_id = [CUSTID] and rule = {r}")
             for r in range(1, 8)]
    asked = []
    ask = ru.evaluate_rules
    monkeypatch.setattr(ru, "evaluate_rules", lambda wave, *rest, **more: (
        asked.append(rows(wave.select("list_id", "main_campaign_id", "suc_rule_id"))),
        ask(wave, *rest, **more))[1])
    whole = ask(pairs, texts, {"vals": values})
    waves = ru.evaluate_in_waves(pairs, texts, {"vals": values})
    assert rows(first_success(waves.successes())) == rows(first_success(whole.successes()))
    won = {r[0] for r in rows(whole.successes(), "list_id")}
    per_order = [r[0] for r in rows(pairs, "list_id")]
    assert len(asked) <= 4 and sum(map(len, asked)) < len(per_order)
    finished = set()
    for wave in asked:
        assert not finished & {r[0] for r in wave}
        finished |= {r[0] for r in rows(whole.successes().join(
            make("list_id bigint, main_campaign_id bigint, suc_rule_id int", *wave),
            ["list_id", "main_campaign_id", "suc_rule_id"]), "list_id")}
    assert finished == won
    # an order without success is asked all its rules
    lost = {i for i in per_order if i not in won}
    assert sorted(r[0] for wave in asked for r in wave if r[0] in lost) == sorted(
        i for i in per_order if i in lost)


def test_no_pairs_in_waves(make):
    assert ru.evaluate_in_waves(make(PAIR), [(1, "select 1")], {}).answers.count() == 0

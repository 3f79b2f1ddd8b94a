"""Rules as users write them: ranges, subqueries, many on one table, and what fails in them."""

import re

import pytest
from pyspark.sql import functions as F

from orderflow.functions.numbers import to_bigint, whole_sql
from orderflow.operators import rule_shapes as sh
from orderflow.operators import rules as ru
from tests.plans import plan

PAIR = ("list_id bigint, cust_id bigint, prod_inst_id bigint, area int, "
        "main_campaign_id bigint, suc_rule_id int, rel_id bigint, seq_no int")
PRODUCTS = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture
def tables(make):
    bought = make("cust_id bigint, latn_id int, order_id bigint, amount double",
                  *[(i % 7, i % 3, i * 5, float(i)) for i in range(120)], (None, None, None, None))
    offers = make("offer bigint, latn_id int, kind string",
                  *[(i * 10, i % 3, "AB"[i % 2]) for i in range(60)])
    return {"bought": bought, "offers": offers}


@pytest.fixture
def pairs(make):
    def of(*rules):
        return make(PAIR, *[(100 + i, i % 8, i * 23 - 30, i % 3, 1, rule, 2, 1)
                            for i in range(16) for rule in rules],
                    *[(900, None, None, None, 1, rule, 2, 1) for rule in rules])
    return of


def loop(pairs, tables, texts):
    """The reference way: every order's values written into the text of the rule."""
    spark = pairs.sparkSession
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    out = []
    for row in pairs.collect():
        text = texts[row.suc_rule_id]
        for mark, column in ru.PLACEHOLDERS.items():
            value = row[column]
            text = text.replace(f"[{mark}]", "CAST(NULL AS BIGINT)" if value is None else str(value))
        found = [r[0] for r in spark.sql(text).collect()]
        numbers = [int(v) for v in found if v is not None]
        value = min(numbers) if numbers else None
        out.append((row.list_id, row.suc_rule_id, int(bool(found)), value, int(bool(found))))
    return sorted(out, key=str)


RULES = {
    "band": "select b.order_id from bought b where b.order_id between [PRODINSTID] - 7 and "
            "[PRODINSTID] + 12",
    "open band": "select b.order_id as x from bought b where b.order_id > [PRODINSTID] and "
                 "[PRODINSTID] + 40 > b.order_id and b.amount % 2 = 0",
    "band of a decimal": "select b.order_id from bought b where b.amount >= [PRODINSTID] / 7.0 "
                         "and b.amount < [PRODINSTID] / 7.0 + 1.5 and b.latn_id <> [LATN_ID]",
    "empty band": "select b.order_id from bought b where b.order_id >= [PRODINSTID] and "
                  "b.order_id <= [PRODINSTID] - 1",
    "two bounds": "select b.order_id from bought b where b.order_id >= [PRODINSTID] and "
                  "b.order_id >= [CUSTID] * 20 and b.order_id <= [PRODINSTID] + 300",
    "range and key": "select b.order_id from bought b where b.cust_id = [CUSTID] and "
                     "b.order_id > [PRODINSTID]",
    "unequal": "select max(b.order_id) from bought b where b.cust_id = [CUSTID] and "
               "b.latn_id <> [LATN_ID] having count(*) > 0",
    "exists": "select b.order_id from bought b where b.cust_id = [CUSTID] and exists (select 1 "
              "from offers o where o.offer = b.order_id and o.latn_id = [LATN_ID])",
    "not exists": "select b.order_id from bought b where b.cust_id = [CUSTID] and not exists "
                  "(select 1 from offers o where o.offer = b.order_id and o.latn_id = [LATN_ID])",
    "in": "select b.order_id from bought b where b.latn_id = [LATN_ID] and b.order_id in "
          "(select o.offer from offers o where o.kind = 'A' and o.latn_id = [CUSTID] % 3)",
    "scalar": "select b.order_id from bought b where b.cust_id = [CUSTID] and b.order_id > "
              "(select avg(o.offer) from offers o where o.latn_id = [LATN_ID])",
    "derived": "select s.order_id from (select * from bought where bought.cust_id = [CUSTID]) s "
               "where s.amount > 30",
    "union": "select b.order_id from bought b where b.cust_id = [CUSTID] and b.amount > 90 "
             "union all select o.offer from offers o where o.latn_id in "
             "(select x.latn_id from bought x where x.order_id = [PRODINSTID] + 30)",
    "own c": "select c.order_id from bought c where c.cust_id = [CUSTID] and c.amount < 50",
}
#: Between these subqueries' FROM and the order there is no equality to join by.
BY_PRODUCT = {"union"}
DEEP = ("select b.order_id from bought b where b.cust_id = [CUSTID] and exists (select 1 from "
        "offers o where o.offer = b.order_id and exists (select 1 from offers p where "
        "p.kind = o.kind and p.offer < [PRODINSTID]))")


def answers(out):
    return sorted([tuple(r) for r in out.answers.select(
        "list_id", "suc_rule_id", "hit", "value", "success").collect()], key=str)


@pytest.mark.parametrize("name", RULES)
def test_like_a_loop_over_orders(pairs, tables, name):
    asked = pairs(1)
    out = ru.evaluate_rules(asked, [(1, RULES[name])], tables)
    assert out.failed_rules == {}
    assert name in BY_PRODUCT or not any(p in plan(out.answers) for p in PRODUCTS)
    assert answers(out) == loop(asked, tables, {1: RULES[name]})


def test_subquery_in_a_subquery(pairs, tables):
    asked = pairs(1)
    out = ru.evaluate_rules(asked, [(1, DEEP)], tables)
    assert answers(out) == loop(asked, tables, {1: DEEP})


def many(count):
    return {i: "select b.order_id from bought b where b.cust_id = [CUSTID] and "
               f"b.latn_id = [LATN_ID] and b.order_id % {count} = {i - 1}"
            for i in range(1, count + 1)}


def test_rules_on_one_table_share_its_scan(spark, pairs, tables, tmp_path):
    stored = {}
    for name, table in tables.items():
        table.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    texts = many(50)
    texts[51] = RULES["own c"]
    asked = pairs(*texts)
    out = ru.evaluate_rules(asked, sorted(texts.items()), stored)
    # the pairs are no files, and no rule reads the other table
    scans = [line for line in plan(out.answers).splitlines() if "FileScan" in line]
    assert len(scans) == 2  # one for fifty rules, one for the other kind
    alone = ru.evaluate_rules(asked, sorted(texts.items()), stored, share=False)
    assert answers(out) == answers(alone)


def test_shared_rules_like_a_loop(pairs, tables):
    texts = many(4)
    asked = pairs(*texts)
    assert answers(ru.evaluate_rules(asked, sorted(texts.items()), tables)) == loop(
        asked, tables, texts)


def test_rule_of_a_family_that_does_not_compile(pairs, tables):
    texts = many(3)
    texts[2] = texts[2].replace("order_id %", "nothing %")
    out = ru.evaluate_rules(pairs(*texts), sorted(texts.items()), tables)
    assert list(out.failed_rules) == [2]
    assert {r.value for r in out.answers.where("suc_rule_id = 2").collect()} == {-1}
    assert out.answers.where("suc_rule_id <> 2 and success = 1").count() > 0


FAILING = ("select 1000 div (b.cust_id - 3) from bought b where b.cust_id = [CUSTID] and "
           "b.latn_id = [LATN_ID]")


def test_a_rule_fails_only_for_the_orders_it_cannot_answer(pairs, tables, rows):
    texts = {**many(2), 3: FAILING}
    asked = pairs(*texts)
    out = ru.evaluate_rules(asked, sorted(texts.items()), tables, isolate="orders")
    assert out.failed_rules == {}
    failing = sorted(r[0] for r in asked.where("suc_rule_id = 3 and cust_id = 3")
                     .select("list_id").collect())
    assert failing and [r[0] for r in rows(out.errors, "order_id")] == failing
    message = out.errors.head().errormsg
    assert message.startswith("rule 3: [DIVIDE_BY_ZERO]") and len(message) > 200
    got = {r.list_id: (r.value, r.success) for r in out.answers.where("suc_rule_id = 3").collect()}
    assert {got[i] for i in failing} == {(-1, 0)}
    assert got[101] == (1000 // (1 - 3), 1) or got[101] == (-500, 1)
    others = ru.evaluate_rules(asked.where("suc_rule_id < 3"), sorted(many(2).items()), tables)
    assert [a for a in answers(out) if a[1] < 3] == answers(others)


def test_orders_that_are_not_told_apart_fail_together(pairs, tables, monkeypatch):
    monkeypatch.setattr(ru, "PROBES", 1)
    asked = pairs(3)
    out = ru.evaluate_rules(asked, [(3, FAILING)], tables, isolate="orders")
    failed = {r[0] for r in out.errors.select("order_id").collect()}
    mine = {r[0] for r in asked.where("cust_id = 3").select("list_id").collect()}
    assert mine <= failed < {r[0] for r in asked.select("list_id").collect()}


def test_rule_that_fails_for_every_order(pairs, tables):
    out = ru.evaluate_rules(pairs(1), [(1, "select cast(o.kind as int) from offers o")], tables,
                            isolate="orders")
    assert out.errors.select("order_id").distinct().count() == 17
    assert {r.value for r in out.answers.collect()} == {-1}


def one_by_one(asked, tables, texts):
    """The answers of :func:`loop` for the orders that it doesn't fail for, and the other orders."""
    answered, failing = [], []
    for row in asked.collect():
        try:
            answered += loop(asked.where(F.col("list_id") == row.list_id), tables, texts)
        except ru._RULE_ERRORS:
            failing.append(row.list_id)
    return sorted(answered, key=str), sorted(failing)


FAILING_SHAPES = {
    "aggregate": "select max(1000 div (bought.cust_id - 3)) from bought where [CUSTID] = "
                 "bought.cust_id and bought.amount < 90",
    "outer join": "select 1000 div (b.cust_id - 3) from offers o left join bought b on b.order_id "
                  "= o.offer where b.cust_id + 0 = [CUSTID] and o.latn_id = [LATN_ID]",
    "table twice": "select 1000 div (b.cust_id - 3) from bought b join bought d on d.order_id = "
                   "b.order_id where b.cust_id = [CUSTID] and d.latn_id = [LATN_ID]",
}


@pytest.mark.parametrize("name", FAILING_SHAPES)
def test_probes_find_the_orders_that_fail_alone(spark, pairs, tables, rows, name):
    asked, text = pairs(3), FAILING_SHAPES[name]
    out = ru.evaluate_rules(asked, [(3, text)], tables, isolate="orders")
    assert spark.table("bought").count() == tables["bought"].count()
    answered, failing = one_by_one(asked, tables, {3: text})
    assert failing and [r[0] for r in rows(out.errors, "order_id")] == failing
    assert [a for a in answers(out) if a[0] not in failing] == answered


def test_probes_read_their_own_rows_only(pairs, tables, monkeypatch):
    """No probe reads the whole table, and the parts of a part read only that part's rows."""
    read, kept, stage = [], [], ru.stage

    def noted(df, name, *by):
        out = stage(df, name, *by)
        if name == "part":
            read.extend(df.inputFiles())
        if name == "own_rows":
            kept.append({r[0] for r in out.select("cust_id").distinct().collect()})
        return out

    monkeypatch.setattr(ru, "stage", noted)
    asked = pairs(3).where("cust_id < 6")
    ru.evaluate_rules(asked, [(3, FAILING)], tables, isolate="orders")
    assert read and not any("/bought/" in file for file in read)
    assert kept[0] == set(range(6)) and all(3 in k and k <= kept[0] for k in kept)


def test_condition_on_a_table_that_fails_for_every_order(pairs, tables):
    """For all with a customer: without one, no row of the table is looked at."""
    out = ru.evaluate_rules(pairs(1), [(1, "select b.order_id from bought b where b.cust_id = "
                                           "[CUSTID] and 1000 div (b.order_id - 15) < 900")],
                            tables, isolate="orders")
    assert out.errors.select("order_id").distinct().count() == 16


def test_relations(spark):
    assert sh.relations(spark, "t a join s.u on a.x = u.x left join w") == [
        ("t", "a"), ("s.u", "s.u"), ("w", "w")]
    for source in ("(select 1) t", "t a join (select 1) u", "t as a (x, y)",
                   "t tablesample (3 rows)", "t lateral view explode(t.x) y"):
        assert sh.relations(spark, source) == []


WHOLE = [("12", 12), ("12.00", 12), (" 12 ", 12), ("+7", 7), ("1.2E3", 1200), ("1.25E1", None),
         ("1200e-2", 12), ("5.", 5), ("-.0", 0), (".5", None), ("12.0000001", None),
         ("-0.9999999", None), ("0.0000004", None), ("12.0000000000000000000001", None),
         ("12.0000000000000000000000", 12), ("1E-20", None), ("9223372036854775808", None),
         ("9223372036854775807", 9223372036854775807), ("1e25", None), ("NaN", None), ("", None),
         ("x", None), (None, None)]


def test_whole_numbers_are_not_rounded(make):
    df = make("v string", *[(v,) for v, _ in WHOLE])
    got = df.select(to_bigint("v"), to_bigint(F.col("v")), F.expr(whole_sql("v"))).collect()
    assert [tuple(r) for r in got] == [(n, n, n) for _, n in WHOLE]


def test_shape(spark):
    c = sh.ASKED
    s = sh.shape(spark, f"select o.x as y from t o where ({c}.cust_id = o.a) and o.b >= {c}.area "
                        f"and (o.d > 3 or o.e = 1) and o.f in ({c}.rel_id, 2)")
    assert s == sh.Shape("o.x", "t o", (("cust_id", "o.a"),), (("o.b", ">=", f"{c}.area"),),
                         ("o.d > 3 or o.e = 1",), (f"o.f in ({c}.rel_id, 2)",))
    for text in ("select 1", "select distinct a from t where b = 1", "select a, b from t",
                 "select a from t where b = 1 order by a limit 1",
                 "select a from t where exists (select 1 from u)"):
        assert sh.shape(spark, text) is None


def test_tables_are_computed_once_for_all_probes(pairs, tables, monkeypatch):
    """Looking for the orders that a rule fails for, the probes read staged tables."""
    staged, plans, stage = [], [], ru.stage
    monkeypatch.setattr(ru, "stage", lambda df, name, *by: staged.append(name) or (
        plans.append(df._jdf.queryExecution().analyzed().toString()) if name == "part" else None)
        or stage(df, name, *by))
    ru.evaluate_rules(pairs(3), [(3, FAILING)], tables, isolate="orders")
    read = [name for name in tables if re.search(rf"\b{name}\b", FAILING)]
    assert read and [staged.count(name) for name in read] == [1] * len(read)
    assert plans and all("parquet" in plan for plan in plans)

"""Configurable success rules, evaluated set-based: a few queries for all orders and rules.

A rule is Spark SQL returning one column. Placeholders stand for the order it is asked about:
``[CUSTID] [PRODINSTID] [CAMPAIGNID] [SUCRULEID] [RELID] [LATN_ID]``, in any letter case. They may
stand anywhere in the text, in comparisons of any kind and in subqueries.
"""

from __future__ import annotations

import re
from collections import defaultdict, deque
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.errors import (AnalysisException, ArithmeticException,
                            ArrayIndexOutOfBoundsException, DateTimeException,
                            IllegalArgumentException, NumberFormatException, ParseException,
                            PySparkException, SparkRuntimeException)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.functions.clock import AsOf, day_window
from orderflow.functions.numbers import to_bigint, whole_sql
from orderflow.operators.campaigns import PROVINCE_AREA, TELEPHONE
from orderflow.operators.lookups import only_keys
from orderflow.operators.quality import error_log
from orderflow.operators.rule_shapes import (ASKED, BOUND, PLACEHOLDERS, Shape, blocks,
                                             relations, seated, shape)
from orderflow.session import stage, together

# Fixed values.
NO_ROW = "-999999999"
FAILED = -1
DONE = 300000

# How the rows of one rule answer become one value: NULLs, unusable ones, and the smallest whole
# number that is not the no-row mark. ``id``: the whole number of ``v``, made once per row.
_ID = f"{whole_sql('v')} AS id"
_REDUCE = f"""count_if(v IS NULL) AS nulls, count(v) - count(id) AS bad,
       min(id) FILTER (WHERE id <> {NO_ROW}) AS value"""
#: What is asked about a rule's orders, when an order's run-time failure is looked for.
PROBES = 400


@dataclass(frozen=True)
class Evaluation:
    """``answers``: every pair with hit, value and success; ``errors``: error-log rows."""

    answers: DataFrame
    errors: DataFrame
    failed_rules: dict[int, str] = field(default_factory=dict)

    def successes(self) -> DataFrame:
        return self.answers.where(F.col("success") == 1)


def success_candidates(held: DataFrame, customer_orders: DataFrame, as_of: AsOf, *, mode: str,
                       days: int = 1) -> DataFrame:
    """Orders whose customer completed a purchase in the window, in the order's area.

    ``held``: output of orders_with_state. ``receive``: non-telephone orders not yet successful.
    ``area``: telephone orders of ordinary areas. ``province``: telephone orders kept in area
    999, matched on their own area. The order state does not matter.
    """
    telephone = F.col("channel_id") == TELEPHONE
    if mode == "receive":
        chosen = held.where(~telephone & (F.coalesce("is_success", F.lit(0)) == 0))
        area = F.col("shard_id")
    elif mode == "area":
        chosen = held.where(telephone & (F.col("shard_id") != PROVINCE_AREA))
        area = F.col("shard_id")
    elif mode == "province":
        chosen = held.where(telephone & (F.col("shard_id") == PROVINCE_AREA))
        area = F.col("latn_id")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    # one row per customer before the exchange, however many purchases a customer has
    buyers = (day_window(customer_orders.where(F.col("status_cd") == DONE), "status_date",
                         as_of, days)
              .select("cust_id", F.col("latn_id").alias("area")).distinct())
    return (chosen.withColumn("area", area).join(buyers, ["cust_id", "area"], "left_semi")
            .select(F.col("initiative_order_id").alias("list_id"), "campaign_id", "shard_id",
                    "area", "status_cd", "channel_id", "prod_inst_id", "cust_id"))


def rule_pairs(candidates: DataFrame, rules: DataFrame) -> DataFrame:
    """Every candidate with the rules of its campaign. ``rules``: output of success_rules."""
    ranked = rules.select("main_campaign_id", F.col("sub_campaign_id").alias("campaign_id"),
                          "suc_rule_id", "rel_id", "rule_name", "report_column", "seq_no")
    return candidates.join(ranked, "campaign_id")


def skip_logged(pairs: DataFrame, detail: DataFrame, log: DataFrame) -> DataFrame:
    """Drop pairs already logged for an order the detail knew as successful.

    Adds ``old_is_success``, the detail's flag at the start (0 when the order is not there). The
    pairs are staged, and of detail and log only their orders are aggregated.
    """
    pairs = stage(pairs, "candidate_pairs")
    detail, log = (only_keys(t.select("list_id", c), "list_id", pairs, "list_id")
                   for t, c in ((detail, "is_success"), (log, "suc_rule_id")))
    flags = detail.groupBy("list_id").agg(F.max("is_success").alias("_flag"))
    logged = log.select("list_id", "suc_rule_id").distinct().withColumn("_logged", F.lit(1))
    known = (pairs.join(flags, "list_id", "left")
             .withColumn("old_is_success", F.coalesce("_flag", F.lit(0)))
             .join(logged, ["list_id", "suc_rule_id"], "left"))
    done = (F.col("old_is_success") == 1) & F.col("_logged").isNotNull()
    return known.where(~done).drop("_flag", "_logged")


def rule_texts(rules: DataFrame) -> list[tuple[int, str]]:
    """The rule list, the only data the driver collects: one row per configured rule."""
    rows = (rules.select("suc_rule_id", "sql_text_order").distinct()
            .orderBy("suc_rule_id").collect())
    return [(row[0], row[1]) for row in rows]


def bind(text: str, relation: str = "c") -> tuple[str, list[str]]:
    """Rule text with placeholders turned into columns of a relation, and the columns it uses.

    Only placeholders change; literals keep their case. Unknown ones stay and fail to parse.
    """
    used: list[str] = []

    def column(match: re.Match) -> str:
        name = PLACEHOLDERS.get(match.group(1).upper())
        if name is None:
            return match.group(0)
        if name not in used:
            used.append(name)
        return f"{relation}.{name}"

    return re.sub(r"\[(\w+)\]", column, text), used


# ---- ways to ask --------------------------------------------------------------------------

def _laterally(sql: str, pairs: DataFrame) -> DataFrame:
    """Answers of a text with one column ``v``, whose placeholders are the asked order's columns.

    The rule's rows are aggregated inside the lateral subquery, so Spark groups them by the
    values the placeholders are compared with, combines them map-side, and joins at most one row
    to an order: a customer with a third of all purchases neither fills one task nor multiplies
    that customer's orders. The constant GROUP BY makes an empty answer no row instead of a row
    of zeros, which spares Spark a second join.
    """
    return pairs.sparkSession.sql(
        f"SELECT {ASKED}.*, q.* FROM {{pairs}} {ASKED} LEFT JOIN LATERAL (SELECT {_REDUCE} FROM "
        f"(SELECT v, {_ID} FROM (SELECT CAST(r.v AS STRING) AS v FROM ({sql}) AS r(v))) "
        "GROUP BY true) q", pairs=pairs)


def _one_by_one(sql: str) -> Callable[[DataFrame], DataFrame]:
    return partial(_laterally, sql)


def _shared(rules: list[tuple[int, Shape]]) -> Callable[[DataFrame], DataFrame]:
    """Rules on the same FROM with the same equalities, in one pass over it.

    Every row of the FROM becomes one row per rule whose other conditions it meets; the rule is
    one more column that the answers are grouped by. So there is one scan and one exchange,
    however many rules there are.
    """
    first = rules[0][1]
    tests = [" AND ".join(f"({c})" for c in s.local) or "true" for _, s in rules]
    marks = ", ".join(
        f"CASE WHEN {test} THEN named_struct('rule', {rule}, 'v', CAST({s.select} AS STRING)) END"
        for (rule, s), test in zip(rules, tests, strict=True))
    keys = ", ".join(f"{own} AS k{i}" for i, (_, own) in enumerate(first.keys))
    met = " AND ".join(f"x.k{i} = {ASKED}.{name}" for i, (name, _) in enumerate(first.keys))
    return partial(_laterally, (
        f"SELECT x.m.v FROM (SELECT {keys}, explode(array_compact(array({marks}))) AS m "
        f"FROM {first.source} WHERE {' OR '.join(f'({t})' for t in tests)}) x "
        f"WHERE {met} AND x.m.rule = {ASKED}.suc_rule_id"))


def _banded(used: list[str], s: Shape, x: str) -> Callable[[DataFrame], DataFrame]:
    """A rule without equalities that bounds ``x`` from both sides.

    Both sides are cut into bins and meet where the bins are equal; the rule's own comparisons
    decide then. A band of n whole numbers lies in at most two bins of the smallest power of four
    from n on, so bins suit each band's own width, a wide band does not become many rows, and the
    rule's FROM is read once per power that occurs. Bands are told apart by value: orders that
    ask the same are asked once.
    """
    names, band = ", ".join(used), "band_of_order"
    low, high = ([bound for own, sign, bound in s.ranges if own == x and sign[0] == c]
                 for c in "><")
    compared = [f"{own} {sign} {bound}" for own, sign, bound in s.ranges]
    where = " AND ".join(f"({BOUND.sub(rf'{band}.\1', c)})"
                         for c in (*s.local, *compared, *s.others))

    def outermost(function: str, bounds: list[str]) -> str:
        return bounds[0] if len(bounds) == 1 else f"{function}({', '.join(bounds)})"

    def ask(pairs: DataFrame) -> DataFrame:
        spark = pairs.sparkSession
        bands = spark.sql(
            f"SELECT DISTINCT {names}, CAST(floor({outermost('greatest', low)}) AS BIGINT) AS low, "
            f"CAST(floor({outermost('least', high)}) AS BIGINT) AS high FROM {{pairs}} {ASKED}",
            pairs=pairs).where("low <= high")
        # a rounded power is only less fitting: every bin from low to high is taken
        power = F.ceil(F.log2(F.col("high") - F.col("low") + 1) / 2).cast("int")
        bands = bands.withColumn("power", power).withColumn("bin", F.explode(F.expr(
            "sequence(shiftright(low, 2 * power), shiftright(high, 2 * power))")))
        bands = stage(bands.drop("low", "high"), "bands")
        powers = [r[0] for r in bands.select("power").distinct().collect()]  # at most 32
        rows = [spark.sql(
            f"SELECT {', '.join(f'{band}.{c}' for c in used)}, CAST({s.select} AS STRING) AS v "
            f"FROM {s.source} CROSS JOIN {{bands}} {band} WHERE {band}.power = {p} "
            f"AND {band}.bin = shiftright(CAST(floor({x}) AS BIGINT), {2 * p}) AND {where}",
            bands=bands) for p in powers or [0]]
        found = spark.sql(f"SELECT {names}, {_REDUCE} FROM (SELECT *, {_ID} FROM {{rows}}) "
                          f"GROUP BY {names}", rows=reduce(DataFrame.union, rows))
        return pairs.join(found, used, "left").select(*pairs.columns, "nulls", "bad", "value")

    return ask


def _product(sql: str, pairs: DataFrame) -> bool | None:
    """Whether Spark plans a text as a product of all orders and rows; None: not at all."""
    try:
        steps = _laterally(sql, pairs)._jdf.queryExecution().executedPlan().toString()
    except (AnalysisException, ParseException):
        return None
    return "CartesianProduct" in steps or "BroadcastNestedLoopJoin" in steps


def _by_rows(spark: SparkSession, s: Shape) -> bool:
    """Whether the rule gives one value per row of its FROM, without placeholders' conditions."""
    where = "".join(f" AND ({c})" for c in s.local)
    try:
        plan = spark.sql(f"SELECT {s.select} FROM {s.source} WHERE true{where}"
                         )._jdf.queryExecution().analyzed()
    except (AnalysisException, ParseException):
        return False
    return plan.nodeName() == "Project" and plan.children().head().nodeName() == "Filter"


@dataclass(frozen=True)
class Question:
    """How some rules are asked: from (order, rule) pairs to their answers."""

    rules: tuple[int, ...]
    ask: Callable[[DataFrame], DataFrame]


def questions(pairs: DataFrame, texts: list[tuple[int, str]], share: bool = True) -> list[Question]:
    """The queries for all rules.

    Rules that compare placeholders by equality only, on the same FROM and columns, are asked
    together (``share``). A placeholder in a subquery, or in another comparison beside an
    equality, becomes a column of the FROM's first relation, so that Spark unnests it and joins by
    the equality. A rule whose only comparisons with placeholders bound an expression from both
    sides is joined by bins. Any other text is asked as it is.
    """
    spark = pairs.sparkSession
    families: dict[tuple, list[tuple[int, Shape]]] = defaultdict(list)
    out: list[Question] = []
    for rule, text in texts:
        sql, used = bind(text, ASKED)
        ask = _one_by_one(sql)
        try:
            found = blocks(spark, sql) if used else []
            s = shape(spark, sql) if found else None
        except ParseException:
            found, s = [], None
        if s is not None and not s.ranges and not s.others:
            if share and s.keys and _by_rows(spark, s):
                families[s.source, tuple(sorted(s.keys))].append((rule, s))
                continue
        elif s is None or s.keys:
            other = seated(found, sql, used)
            if other != sql and _product(sql, pairs) is not False and (
                    _product(other, pairs) is not None):
                ask = _one_by_one(other)
        else:
            banded = next((own for own, _, _ in s.ranges if {">", "<"} <= {
                sign[0] for x, sign, _ in s.ranges if x == own}), None)
            if banded is not None and _by_rows(spark, s):
                ask = _banded(used, s, banded)
        out.append(Question((rule,), ask))
    for family in families.values():
        alone = dict(texts)[family[0][0]]
        ask = (_shared([(rule, Shape(s.select, s.source, tuple(sorted(s.keys)), (), s.local, ()))
                        for rule, s in family]) if len(family) > 1
               else _one_by_one(bind(alone, ASKED)[0]))
        out.append(Question(tuple(rule for rule, _ in family), ask))
    return sorted(out, key=lambda q: q.rules)


def with_success(answers: DataFrame, null_is_success: bool = True) -> DataFrame:
    """Add ``hit`` (a usable row came back) and ``success``; drops the helper counts."""
    hit = (F.coalesce("nulls", F.lit(0)) > 0) | F.col("value").isNotNull()
    won = hit & F.coalesce(F.col("value") != FAILED, F.lit(null_is_success))
    return (answers.withColumn("hit", hit.cast("int")).withColumn("success", won.cast("int"))
            .drop("nulls", "bad"))


def _broken(pairs: DataFrame) -> DataFrame:
    """Answers of a rule that cannot run: failed for every order."""
    return (pairs.withColumn("nulls", F.lit(0).cast("bigint"))
            .withColumn("bad", F.lit(0).cast("bigint"))
            .withColumn("value", F.lit(FAILED).cast("bigint")))


def _text(error: PySparkException) -> str:
    return str(error).strip() or type(error).__name__


# What a rule text can get wrong; anything else is the cluster's failure and is not swallowed.
_RULE_ERRORS = (AnalysisException, ParseException, ArithmeticException, NumberFormatException,
                DateTimeException, ArrayIndexOutOfBoundsException, IllegalArgumentException,
                SparkRuntimeException)


@dataclass
class _Failures:
    """What went wrong: rules that failed for all orders, and orders that a rule failed for."""

    rules: dict[int, str] = field(default_factory=dict)
    orders: list[DataFrame] = field(default_factory=list)


def _own_rows(pairs: DataFrame, text: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Those tables of a rule that its equalities cut to rows of the pairs' values, cut and staged.

    No other row can meet the rule's WHERE. Conditions on a table alone are met by all its rows
    first, so when one fails, it still fails for all orders: the table is left as it is then.
    """
    spark = pairs.sparkSession
    try:
        s = shape(spark, bind(text, ASKED)[0])
        named = relations(spark, s.source) if s else []
    except ParseException:
        return {}
    names = [name.lower() for name, _ in named]
    out: dict[str, DataFrame] = {}

    def own(expression: str, rows: DataFrame, alias: str) -> bool:
        try:
            spark.sql(f"SELECT {expression} FROM {{rows}} {alias}", rows=rows)
        except (AnalysisException, ParseException):
            return False
        return True

    for name, rows in tables.items():
        if names.count(name.lower()) != 1:
            continue
        alias = named[names.index(name.lower())][1]
        keys = [key for key in s.keys if own(key[1], rows, alias)]
        if not keys:
            continue
        asked = pairs.select(*[F.col(c).alias(f"asked_{i}") for i, (c, _) in enumerate(keys)])
        met = " AND ".join(f"{x} = {ASKED}.asked_{i}" for i, (_, x) in enumerate(keys))
        where = " AND ".join(f"({c})" for c in s.local if own(c, rows, alias)) or "true"
        try:
            out[name] = stage(spark.sql(
                f"SELECT * FROM {{rows}} {alias} LEFT SEMI JOIN {{asked}} {ASKED} ON {met} "
                f"WHERE {where}", rows=rows, asked=asked.distinct()), "own_rows")
        except _RULE_ERRORS:
            pass
    return out


def _apart(pairs: DataFrame, question: Question, text: str, tables: Mapping[str, DataFrame],
           failures: _Failures) -> DataFrame:
    """Answers of a rule that fails while running, without the orders it fails for.

    The values that the placeholders stand for are cut into parts by a hash, the failing parts
    again, until a part has one value; the orders with that value have failed, all others keep
    their answers. A part that is cut again is staged with its own rows of the rule's tables, so
    the parts of a part read these and not the tables. After ``PROBES`` parts, what still fails
    has failed as it is. A condition on the rule's tables alone is evaluated before any order is
    looked at, so when it fails, it fails for all orders.
    """
    spark = pairs.sparkSession
    rule, = question.rules
    try:
        return stage(question.ask(pairs), "answers")
    except _RULE_ERRORS as error:
        failed = _text(error)
    used = bind(text, ASKED)[1]
    place = F.xxhash64(*(used or [F.lit(0)]))
    good: list[DataFrame] = []
    parts, probes = deque([(1, 0, pairs, _named(tables, [text]))]), 0

    def probe(held: DataFrame, count: int, number: int) -> tuple:
        part = held.where(F.pmod(place, F.lit(count)) == number)
        try:
            return count, number, part, 0, stage(question.ask(part), "part"), None
        except _RULE_ERRORS as error:
            values = part.select(*used, F.lit(0).alias("any")).distinct().take(2)
            return count, number, part, len(values), None, _text(error)

    try:
        while parts:
            count, number, held, rows = parts.popleft()
            held = stage(held, "suspects")
            rows = {**rows, **_own_rows(held, text, rows)}
            for name, table in rows.items():
                table.createOrReplaceTempView(name)
            probes += 8
            for found in together(spark, *[partial(probe, held, 8 * count, number + i * count)
                                           for i in range(8)]):
                wider, rest, part, values, answers, error = found
                if answers is not None:
                    good.append(answers)
                elif values > 1 and probes < PROBES and wider < 1 << 57:
                    parts.append((wider, rest, part, rows))
                else:
                    good.append(_broken(part))
                    failures.orders.append(error_log(
                        part.select("list_id").distinct(), "evaluate_rules", "list_id",
                        F.lit(f"rule {rule}: {error or failed}"), F.lit("-1")))
    finally:
        for name, table in _named(tables, [text]).items():
            table.createOrReplaceTempView(name)
    return reduce(DataFrame.unionByName, good)


def _each(question: Question, texts: dict[int, str]) -> list[Question]:
    """The rules of a shared question, each by itself."""
    return [Question((rule,), _one_by_one(bind(texts[rule], ASKED)[0]))
            for rule in question.rules]


def _settled(pairs: DataFrame, question: Question, texts: dict[int, str],
             tables: Mapping[str, DataFrame] | None, failures: _Failures) -> DataFrame:
    """Staged answers of a question whose rules may fail while running.

    Given ``tables``, the orders that a rule fails for are looked for.
    """
    mine = pairs.where(F.col("suc_rule_id").isin(*question.rules))
    try:
        return stage(question.ask(mine), "answers")
    except _RULE_ERRORS as error:
        text = _text(error)
    if len(question.rules) > 1:
        return reduce(DataFrame.unionByName, [
            _settled(pairs, one, texts, tables, failures) for one in _each(question, texts)])
    if tables is not None:
        sql, used = bind(texts[question.rules[0]], ASKED)
        if used:  # joined to the orders first, a rule's values are made for their rows only
            other = seated(blocks(pairs.sparkSession, sql), sql, used)
            if _product(other, mine) is not None:
                question = Question(question.rules, _one_by_one(other))
        return _apart(mine, question, texts[question.rules[0]], tables, failures)
    failures.rules[question.rules[0]] = text
    return _broken(mine)


def _named(tables: Mapping[str, DataFrame], texts: list[str]) -> dict[str, DataFrame]:
    """The tables that a text names."""
    return {name: table for name, table in tables.items() if any(
        re.search(rf"\b{re.escape(name)}\b", text, re.IGNORECASE) for text in texts)}


def _read_once(tables: Mapping[str, DataFrame], texts: list[str]) -> dict[str, DataFrame]:
    """Stage the tables that the texts name, which every probe would compute again."""
    out = _named(tables, texts)
    for name, table in out.items():
        try:
            out[name] = stage(table, name)
            out[name].createOrReplaceTempView(name)
        except _RULE_ERRORS:  # of the table itself: the rules that read it fail by it
            pass
    return out


def evaluate_rules(pairs: DataFrame, texts: list[tuple[int, str]],
                   tables: Mapping[str, DataFrame], *, null_is_success: bool = True,
                   isolate: bool | str = False, share: bool = True) -> Evaluation:
    """Evaluate every (order, rule) pair.

    ``pairs`` needs list_id, suc_rule_id, seq_no and the placeholder columns; a rule reads its own
    rows, so pass a table staged by suc_rule_id. ``tables`` that a text names become temporary
    views. A rule Spark cannot compile fails for all its orders and is named in ``failed_rules``.
    With ``isolate`` the answers are staged, and the same goes for a rule that fails while
    running; with ``isolate="orders"`` such a rule fails only for the orders it cannot be
    evaluated for, which are named in ``errors``. Only then are rules run apart to find out. A
    result that is not a whole number is logged and does not count. ``share=False`` asks each
    rule by itself.
    """
    spark = pairs.sparkSession
    for name, table in _named(tables, [text for _, text in texts]).items():
        table.createOrReplaceTempView(name)
    parts: list[DataFrame] = []
    failures = _Failures()
    waiting, asked = deque(questions(pairs, texts, share)), []
    while waiting:
        question = waiting.popleft()
        mine = pairs.where(F.col("suc_rule_id").isin(*question.rules))
        try:
            parts.append(question.ask(mine))
        except _RULE_ERRORS as error:
            if len(question.rules) > 1:
                waiting.extend(_each(question, dict(texts)))
                continue
            failures.rules[question.rules[0]] = _text(error)
            parts.append(_broken(mine))
        asked.append(question)
    raw = reduce(DataFrame.unionByName, parts, _broken(pairs.where(F.lit(False))))
    if isolate:
        try:
            raw = stage(raw, "answers")
        except _RULE_ERRORS:
            read = (_read_once(tables, [text for _, text in texts]) if isolate == "orders"
                    else None)
            raw = reduce(DataFrame.unionByName, [
                part if failures.rules.keys() & set(question.rules)
                else _settled(pairs, question, dict(texts), read, failures)
                for question, part in zip(asked, parts, strict=True)])
    errors = error_log(
        raw.where(F.col("bad") > 0), "evaluate_rules", "list_id",
        F.concat(F.lit("rule "), F.col("suc_rule_id").cast("string"), F.lit(": "),
                 F.col("bad").cast("string"), F.lit(" results are not numbers")),
        F.lit("-6502"))
    return Evaluation(with_success(raw, null_is_success),
                      reduce(DataFrame.unionByName, failures.orders, errors), failures.rules)


def evaluate_in_waves(pairs: DataFrame, texts: list[tuple[int, str]],
                      tables: Mapping[str, DataFrame], **options) -> Evaluation:
    """Evaluate rules in their order, and an order's later rules only while it has no success.

    A wave takes the next rules of every unfinished order, one in the first wave, then twice as
    many as before. So the first success is the one that :func:`evaluate_rules` finds, the number
    of waves grows with the logarithm of the rules per order, and an order is asked at most twice
    as often as needed. ``answers`` has the pairs that were asked; later rules are not looked at,
    so they log no errors either. Options as for :func:`evaluate_rules`, which runs every wave.
    """
    place = Window.partitionBy("list_id").orderBy(
        "main_campaign_id", F.asc_nulls_last("seq_no"), "suc_rule_id")
    placed = stage(pairs.withColumn("_place", F.row_number().over(place)), "placed_pairs")
    last = placed.agg(F.max("_place")).head()[0] or 0
    waves: list[Evaluation] = []
    finished: DataFrame | None = None
    first, width = 1, 1
    while first <= last or not waves:
        wave = placed.where(F.col("_place").between(first, first + width - 1)).drop("_place")
        if finished is not None:
            wave = wave.join(finished, "list_id", "left_anti")
        asked = stage(wave.select(pairs.columns), "wave", "suc_rule_id")
        present = {r[0] for r in asked.select("suc_rule_id").distinct().collect()}  # some rules
        done = evaluate_rules(asked, [t for t in texts if t[0] in present], tables, **options)
        done = Evaluation(stage(done.answers, "wave_answers"), done.errors, done.failed_rules)
        waves.append(done)
        won = done.successes().select("list_id").distinct()
        finished = stage(won if finished is None else finished.union(won), "finished")
        first, width = first + width, 2 * width
    failed = reduce(lambda a, b: a | b, (w.failed_rules for w in waves), {})
    return Evaluation(reduce(DataFrame.unionByName, [w.answers for w in waves]),
                      reduce(DataFrame.unionByName, [w.errors for w in waves]), failed)


def reduce_rule_rows(raw: DataFrame, null_is_success: bool = True) -> DataFrame:
    """First usable value per (list_id, suc_rule_id) of stored rule rows with text ``value``.

    The smallest number other than the no-row mark; only NULLs give a hit without a value.
    """
    rows = raw.withColumnRenamed("value", "v").withColumn("id", to_bigint("v"))
    return with_success(rows.groupBy("list_id", "suc_rule_id").agg(
        F.count_if(F.col("v").isNull()).alias("nulls"),
        F.count_if(F.col("v").isNotNull() & F.col("id").isNull()).alias("bad"),
        F.min(F.when(F.col("id") != int(NO_ROW), F.col("id"))).alias("value")),
        null_is_success)

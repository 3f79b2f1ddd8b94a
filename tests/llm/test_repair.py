"""Conversation repair against brute force, and its handling of odd rows."""

import hashlib
import itertools
import random
import re
import time
import zlib

import pytest

from orderflow.llm import repair
from orderflow.llm.common import prepare

DDL = "conv_id long, turn long, role string, text string, conv string, position int, place int"
EMPTY = hashlib.sha256(b"").hexdigest()
GRAMMAR = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """(cost, audit) of the cheapest repair, by trying everything with up to two inserts a gap."""
    best = None
    edits = [[("D", "", 2)] + ([] if fault in ("blank", "duplicate") else
                               [("K", r, 5 * (fault == "truncated"))]
                               + [("R", x, 1 + 5 * (fault == "truncated")) for x in "ua"])
             for r, fault in rows]
    for chosen in itertools.product(*edits):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            cost = sum(c for _, _, c in chosen) + 5 * sum(gaps)
            audit = "I" * gaps[0] + "".join(
                e[0] + "I" * g for e, g in zip(chosen, gaps[1:], strict=True))
            if best is not None and (cost, audit) >= best:
                continue
            marks = "?" * gaps[0] + "".join(
                e[1] + "?" * g for e, g in zip(chosen, gaps[1:], strict=True))
            system = marks.startswith("s")
            filled = "".join("ua"[(i - system) % 2] if m == "?" else m
                             for i, m in enumerate(marks))
            if GRAMMAR.fullmatch(filled):
                best = (cost, audit)
    return best


def price(audit, rows):
    cost, left = 0, iter(rows)
    for action in audit:
        if action == "I":
            cost += 5
            continue
        _, fault = next(left)
        cost += {"K": 0, "R": 1, "D": 2}[action] + 5 * (fault == "truncated" and action != "D")
    return cost


def test_cheapest_against_brute_force():
    rng = random.Random(5)
    for _ in range(120):
        rows = [(rng.choice("ssuuuaaax"), rng.choice(["", "", "", "blank", "duplicate", "truncated"]))
                for _ in range(rng.randint(0, 4))]
        audit = repair.cheapest(iter(rows))
        assert (price(audit, rows), audit) == brute(rows), rows


def test_parses_merge_on_the_stack():
    start = repair._node(0, None)
    pairs = repair.advance(repair.advance(start, "u"), "a")
    longer = repair.advance(repair.advance(pairs, "u"), "a")
    with_system = repair.advance(repair.advance(repair.advance(start, "s"), "u"), "a")
    assert pairs is longer is with_system and pairs.under is start
    assert repair.advance(start, "a") is None and repair.advance(start, "x") is None


def test_long_conversation_is_read_once():
    rows = [("ua"[i % 2], "truncated" if i % 7 == 0 else "") for i in range(200_000)]
    start = time.perf_counter()
    audit = repair.cheapest(iter(rows))
    assert time.perf_counter() - start < 20
    assert len(audit.replace("I", "")) == len(rows)


@pytest.fixture(scope="module")
def results(spark):
    prepare(spark)
    extra = ("x", 1, 2)
    rows = [
        # ids and turns that the damage leaves alone are not needed: faults are tested directly
        (1, 0, "system", "Be kind.", *extra), (1, 1, "user", "Hello there.", *extra),
        (1, 2, "assistant", "Hi!", *extra),
        (2, None, "user", "A question?", *extra), (2, 0, "user", "A question?", *extra),
        (2, 4, "assistant", "No end", *extra), (2, 4, "assistant", "An end.", *extra),
        (3, 0, None, None, *extra), (3, 1, "tool", "\t\x0b\n", *extra),
        (None, 5, "user", "Who?", *extra), (None, 5, "user", "Who?", *extra),
        (None, 6, "bot", "Me.", *extra),
        (4, 0, "user", "x" * 300_000 + ".", *extra)]
    df = spark.createDataFrame(rows, DDL)
    repaired = repair.repair(df)
    return df, repaired, {r.conv_id: r for r in repair.digests(df, repaired).collect()}


def sha(*rows):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows).encode()).hexdigest()


def test_defined_results(results):
    _, _, got = results
    assert set(got) == {1, 2, 3, 4, None}
    assert got[1][1:] == (0, 0, 0, 0, 0, 0, "KKK", sha(
        ("system", "Be kind."), ("user", "Hello there."), ("assistant", "Hi!")))
    # null turn first; its copy is the duplicate; the truncated row of turn 4 comes second
    assert got[2][1:] == (3, 0, 1, 1, 2, 4, "KDKD", sha(
        ("user", "A question?"), ("assistant", "An end.")))
    assert got[3][1:] == (0, 2, 0, 0, 1, 4, "DD", EMPTY)
    assert got[None][1:] == (0, 0, 1, 0, 2, 3, "KDR", sha(("user", "Who?"), ("assistant", "Me.")))
    assert got[4][1:] == (0, 0, 0, 0, 0, 2, "D", EMPTY)


def test_repaired_rows(results):
    _, repaired, _ = results
    rows = repaired.where("conv = 2 and not no_conv").orderBy("place").collect()
    assert [(r.action, r.new_role, r.new_text, r.cost, r.fault) for r in rows] == [
        ("K", "user", "A question?", 0, ""), ("D", None, None, 2, "duplicate"),
        ("K", "assistant", "An end.", 0, ""), ("D", None, None, 2, "truncated")]


def test_empty_table(results):
    df, _, _ = results
    none = df.limit(0)
    assert repair.digests(none, repair.repair(none)).collect() == []
    assert repair.digests(none, repair.repair(repair.damage(none))).collect() == []


def test_conversation_that_lost_all_rows(spark):
    key = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(key, 0, "user", "Gone.")],
                               "conv_id long, turn long, role string, text string")
    rows = repair.digests(df, repair.repair(repair.damage(df))).collect()
    assert [tuple(r) for r in rows] == [(key, 0, 0, 0, 0, 0, 0, "", EMPTY)]


def test_damage(spark):
    df = spark.createDataFrame(
        [(i, t, "assistant", "a. b! c?") for i in range(8) for t in range(20)]
        + [(None, None, None, None)], "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, repair.damage(df).collect()), key=str)
    want = []
    for i, t, role, text in [tuple(r) for r in df.collect()]:
        kind = zlib.crc32(f"{' ' if i is None else i}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        row = (i, t, "user" if kind == 4 else role,
               {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text))
        want += [row] * {0: 0, 3: 2}.get(kind, 1)
    assert got == sorted(want, key=str)

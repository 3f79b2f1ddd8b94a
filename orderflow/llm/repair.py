"""Repair of conversations by generalised LR parsing with weighted edits.

A conversation's role initials should read ``(s?(ua)+)?``. They are parsed by an LR automaton
whose rows may also be deleted, given another role, or preceded by inserted empty ones. All
parses run side by side on a graph-structured stack: the tops share the nodes under them, and
equal stacks merge into the one with the smallest (cost, audit).
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Costs of the edits, and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}

# The LR automaton of the grammar
#   C -> empty | D        D -> P | s P | D P        P -> u a
# States: 0 nothing yet, 2 pairs, 3 a system row, 5 a user row that waits for its answer; the
# other states only reduce.
_SHIFT = {(0, "s"): 3, (0, "u"): 5, (2, "u"): 5, (3, "u"): 5, (5, "a"): 8}
_REDUCE = {4: ("D", 1), 6: ("D", 2), 8: ("P", 2), 9: ("D", 2)}
_GOTO = {(0, "D"): 2, (0, "P"): 4, (2, "P"): 6, (3, "P"): 9}
_ACCEPT = {0, 2}
#: A parse that costs so much more than the cheapest one of the same rows can't win: at most two
#: inserts and a delete lead from the cheapest one's state to what any other one accepts.
_MARGIN = 2 * INSERT + DELETE

_BLANKS = " \t\n\x0b\x0c\r"


class Node(NamedTuple):
    """A stack: its top state and the node under it, shared by all stacks that stand on it."""

    state: int
    under: Node | None


_nodes: dict[tuple[int, Node | None], Node] = {}


def _node(state: int, under: Node | None) -> Node:
    return _nodes.setdefault((state, under), Node(state, under))


@lru_cache(maxsize=None)
def advance(node: Node, symbol: str) -> Node | None:
    """The stack after reading a role initial, with all reductions done; None: no such parse."""
    state = _SHIFT.get((node.state, symbol))
    if state is None:
        return None
    node = _node(state, node)
    while node.state in _REDUCE:
        symbol, size = _REDUCE[node.state]
        for _ in range(size):
            node = node.under
        node = _node(_GOTO[node.state, symbol], node)
    return node


class Step(NamedTuple):
    """A way on from one of the parses: the new stack, the added cost, where from, its edits."""

    node: Node
    cost: int
    parent: int
    edits: str


def _inserted(node: Node) -> Iterator[tuple[Node, int, str]]:
    """The stack itself, then those after inserting rows, as far as they lead to new ones."""
    seen, cost, edits = set(), 0, ""
    while node not in seen:
        seen.add(node)
        yield node, cost, edits
        # every state expects at most one of both roles
        node = next(filter(None, (advance(node, r) for r in ROLES)), node)
        cost, edits = cost + INSERT, edits + "I"


@lru_cache(maxsize=1 << 16)
def one_row(parses: tuple[tuple[Node, int], ...], initial: str, fault: str) -> tuple[Step, ...]:
    """All parses one row further, merged, in the order of their audits.

    ``parses`` are stacks and costs in the order of their audits, which never are beginnings of
    one another, because all hold the same rows and end with an edit of the last one. So an audit
    is compared by its parent's place and what follows. Costs are relative, so few different
    calls occur.
    """
    extra = TRUNCATED if fault == "truncated" else 0
    best: dict[Node, Step] = {}

    def offer(node: Node | None, cost: int, parent: int, edits: str) -> None:
        if node is not None:
            new = Step(node, cost, parent, edits)
            old = best.get(node)
            if old is None or new[1:] < old[1:]:
                best[node] = new

    for parent, (start, before) in enumerate(parses):
        for node, cost, edits in _inserted(start):
            cost += before
            offer(node, cost + DELETE, parent, edits + "D")
            if fault not in ("blank", "duplicate"):
                offer(advance(node, initial), cost + KEEP + extra, parent, edits + "K")
                for role in ROLES:
                    offer(advance(node, role), cost + REROLE + extra, parent, edits + "R")
    least = min(s.cost for s in best.values())
    return tuple(sorted((s for s in best.values() if s.cost <= least + _MARGIN),
                        key=lambda s: s[2:]))


def _ending(parses: tuple[tuple[Node, int], ...]) -> Step:
    """The cheapest way to a finished conversation."""
    return min((Step(node, cost + before, parent, edits)
                for parent, (start, before) in enumerate(parses)
                for node, cost, edits in _inserted(start) if node.state in _ACCEPT),
               key=lambda s: s[1:])


#: Edits of a parse that are held in one string before it is hung on the chain of earlier ones.
_LINK = 1024


def cheapest(rows: Iterator[tuple[str, str]]) -> str:
    """The audit of the cheapest repair of (role initial, fault) rows, ties the smallest one.

    Rows are read once; what is held are the edits of the few parses that can still win.
    """
    parses: tuple[tuple[Node, int], ...] = ((_node(0, None), 0),)
    audits: list[tuple[tuple | None, str]] = [(None, "")]

    def longer(parent: int, edits: str) -> tuple[tuple | None, str]:
        chain, text = audits[parent]
        return ((chain, text), edits) if len(text) > _LINK else (chain, text + edits)

    for initial, fault in rows:
        steps = one_row(parses, initial, fault)
        audits = [longer(s.parent, s.edits) for s in steps]
        least = min(s.cost for s in steps)
        parses = tuple((s.node, s.cost - least) for s in steps)
    end = _ending(parses)
    chain, text = longer(end.parent, end.edits)
    parts = [text]
    while chain is not None:
        chain, text = chain
        parts.append(text)
    return "".join(reversed(parts))


# ---- tables ------------------------------------------------------------------------------

# Conversations may lack an id, so they are known by two columns without nulls.
_CONV = ["no_conv", "conv"]
_EDITS = ("no_conv boolean, conv long, place long, position long, action string, "
          "new_role string")
_EDIT_SCHEMA = pa.schema([
    ("no_conv", pa.bool_()), ("conv", pa.int64()), ("place", pa.int64()),
    ("position", pa.int64()), ("action", pa.string()), ("new_role", pa.string())])


def _known(df: DataFrame) -> DataFrame:
    conv = F.col("conv_id").cast("long")
    return df.withColumns({"no_conv": conv.isNull(), "conv": F.coalesce(conv, F.lit(0))})


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, 5000)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*some), schema, strict=True)],
            schema=schema)


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of all conversations whose rows stream in: no_conv, conv, initial, fault."""
    def rows() -> Iterator[tuple]:
        for key, group in itertools.groupby(_values(batches), key=lambda r: r[:2]):
            node, position = _node(0, None), itertools.count(1)
            initials: list[str] = []
            audit = cheapest(_noted(group, initials))
            for place, action in enumerate(audit):
                at = None if action == "I" else next(position)
                role = None
                if action in "RI":
                    role = next(r for r in ROLES if advance(node, r))
                    node = advance(node, role)
                elif action == "K":
                    node = advance(node, initials[at - 1])
                yield (*key, place, at, action, ROLES.get(role))

    return _in_batches(rows(), _EDIT_SCHEMA)


def _noted(group: Iterator[tuple], initials: list[str]) -> Iterator[tuple[str, str]]:
    for _, _, initial, fault in group:
        initials.append(initial)
        yield initial, fault


def faults(conversations: DataFrame) -> DataFrame:
    """The rows in their conversations' order, with what is wrong with each.

    Adds no_conv and conv (the conversation), position (from 1), initial and last_initial (of the
    row's and the preceding row's role), new_turn (the turn is not the preceding row's) and
    fault, the first that applies: ``blank`` (only blanks), ``duplicate`` (an earlier row has
    this role and text), ``truncated`` (the last visible character is none of ``.!?``), or empty.
    """
    rows = _known(conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")))
    rows = rows.repartition("conv")
    turn = F.asc_nulls_first("turn")
    seen = F.row_number().over(Window.partitionBy(*_CONV, "role", "text").orderBy(turn)) > 1
    ordered = Window.partitionBy(*_CONV).orderBy(turn, "role", "text", "seen")
    shown = F.rtrim("text", F.lit(_BLANKS))
    fault = (F.when(shown == "", "blank").when(F.col("seen"), "duplicate")
             .when(~F.right(shown, F.lit(1)).isin(*".!?"), "truncated").otherwise(""))
    return (rows.withColumn("seen", seen).withColumns({
        "position": F.row_number().over(ordered).cast("long"),
        "initial": F.left("role", F.lit(1)),
        "last_initial": F.lag(F.left("role", F.lit(1))).over(ordered),
        "new_turn": F.col("turn").isNotNull()
        & ~F.equal_null(F.lag("turn").over(ordered), F.col("turn")),
        "fault": fault}).drop("seen"))


def repair(conversations: DataFrame) -> DataFrame:
    """The cheapest edits that make all conversations read ``(s?(ua)+)?`` by role initials.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are
    ignored. A conversation's rows are ordered by turn (null first), then role and text; a null
    role or text is one blank; rows without an id form one conversation. Keeping a row costs 0,
    giving it the role user or assistant 1, deleting it 2, inserting an empty row of those roles 5;
    a truncated row that is not deleted costs 5 more, blank rows and duplicates must be deleted
    (see :func:`faults`). Of equal costs the smallest audit wins.

    Returns one row per edit: no_conv and conv (the conversation), place (from 0), action (K, R,
    D or I), new_role and new_text (of the repaired row; null when deleted), cost, and the columns
    of :func:`faults` for the row it treats (null for an inserted one). Very long texts are
    never read by Python. An empty table gives no rows.

    Rows are dealt by conversation and sorted on disk; a parse is sequential, so a conversation's
    role initials stream through one task, which keeps some bytes per row.
    """
    # the join reads the rows as they were dealt for the parse
    conversations.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    rows = faults(conversations)
    edits = rows.select(*_CONV, "position", "initial", "fault").sortWithinPartitions(
        *_CONV, "position").select(*_CONV, "initial", "fault").mapInArrow(_edits, _EDITS)
    kept = F.col("action").isin("K", "R")
    extra = F.when(kept & (F.col("fault") == "truncated"), TRUNCATED).otherwise(0)
    cost = (F.when(F.col("action") == "R", REROLE).when(F.col("action") == "D", DELETE)
            .when(F.col("action") == "I", INSERT).otherwise(KEEP) + extra)
    return edits.join(rows, [*_CONV, "position"], "left").withColumns({
        "new_role": F.coalesce("new_role", F.when(F.col("action") == "K", F.col("role"))),
        "new_text": F.when(kept, F.col("text")).when(F.col("action") == "I", F.lit("")),
        "cost": cost.cast("long")})


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, for measuring a repair: conv_id, turn, role, text.

    The remainder by 20 of the CRC-32 of ``conv_id:turn`` decides: 0 drops the row, 1 empties its
    text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes the role user. Nulls count as one
    blank; a null turn and a null id stay null.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(shown("conv_id"), F.lit(":"), shown("turn"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        shown("role").alias("role"), shown("text").alias("text"),
        F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("kind")).where("kind <> 0")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("copy", F.explode(copies)).select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"))


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_DIGESTS = ("no_conv boolean, conv long, " + ", ".join(f"{c} long" for c in _COUNTS)
            + ", audit string, repaired_sha256 string")
_DIGEST_SCHEMA = pa.schema([
    ("no_conv", pa.bool_()), ("conv", pa.int64()), *((c, pa.int64()) for c in _COUNTS),
    ("audit", pa.string()), ("repaired_sha256", pa.string())])
_LEGAL = ("su", "ua", "au")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for key, group in itertools.groupby(_values(batches), key=lambda r: r[:2]):
            digest, audit = hashlib.sha256(), []
            blank = duplicate = truncated = illegal = cost = turns = 0
            low = high = None
            joint = ""
            for _, _, action, role, text, price, fault, turn, new_turn, last, now in group:
                audit.append(action)
                cost += price
                blank += fault == "blank"
                duplicate += fault == "duplicate"
                truncated += fault == "truncated"
                illegal += last is not None and last + now not in _LEGAL
                if turn is not None:
                    low = turn if low is None else min(low, turn)
                    high = turn if high is None else max(high, turn)
                    turns += new_turn
                if role is not None:
                    digest.update(f"{joint}{role}:{text}".encode())
                    joint = "\n"
            gaps = 0 if low is None else high - low + 1 - turns
            yield (*key, gaps, blank, duplicate, truncated, illegal, cost, "".join(audit),
                   digest.hexdigest())

    return _in_batches(rows(), _DIGEST_SCHEMA)


def digests(conversations: DataFrame, repaired: DataFrame) -> DataFrame:
    """What :func:`repair` did, one row per conversation of ``conversations``.

    conv_id, gaps (missing turns between the first and the last one; null turns are ignored),
    blank, duplicate and truncated rows, illegal (neighbouring role initials other than su, ua,
    au), cost, audit (the edits' initials in order), repaired_sha256 (of ``role:text`` of the
    repaired rows, joined by line ends). A conversation without rows in ``repaired`` has zeros,
    an empty audit and the digest of nothing.
    """
    streamed = (repaired.repartition("conv").sortWithinPartitions(*_CONV, "place").select(
        *_CONV, "action", "new_role", "new_text", "cost", "fault", "turn", "new_turn",
        "last_initial", "initial").mapInArrow(_digests, _DIGESTS))
    every = _known(conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct())
    empty = hashlib.sha256(b"").hexdigest()
    return every.join(streamed, _CONV, "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))

"""Chat formatting by incremental rendering of a black-box template."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import stage

#: Turns that are rendered together where the template is declared concatenative.
BLOCK_TURNS = 16

#: A turn as a template sees it: role and text.
Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]

#: Private-use characters that stand for a text while its place is looked for.
PROBE = "\ue0a1\uf8fe\ue0a1"

_OPEN, _CLOSE = "<turn ", "</turn>\n"
_TURN = re.compile(r"<turn ([^<>\n]*)>\n([^<]*)\n</turn>\n")


def escape(text: str) -> str:
    """``text`` without any ``<``, so that no control string can stand in it."""
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescape(text: str) -> str:
    """The text that :func:`escape` was given."""
    return re.sub(r"\\(.)", lambda m: "<" if m[1] == "l" else m[1], text)


def _escape_role(role: str) -> str:
    return escape(role).replace(">", "\\g").replace("\n", "\\n")


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"l": "<", "g": ">", "n": "\n"}.get(m[1], m[1]), role)


def marked_turns(turns: Sequence[Turn]) -> str:
    """The library's template: a marker line with the role, the escaped text, an end marker."""
    return "".join(f"{_OPEN}{_escape_role(role)}>\n{escape(text)}\n{_CLOSE}"
                   for role, text in turns)


#: Declares that a template's output for some turns is its outputs for each of them end to end.
marked_turns.concatenative = True


def read_marked(formatted: str) -> Iterator[Turn]:
    """Roles and texts of what :func:`marked_turns` made; ValueError for anything else."""
    at = 0
    while at < len(formatted):
        match = _TURN.match(formatted, at)
        if match is None:
            raise ValueError(f"no turn at {at}")
        yield _unescape_role(match[1]), unescape(match[2])
        at = match.end()


@dataclass
class Located:
    """A turn's place in the rendered text, and the place of its own text where it is found."""

    start: int
    end: int
    text_start: int | None
    text_end: int | None
    rewritten: bool = False


def locate(template: Template, turns: Sequence[Turn],
           escaped: Callable[[str], str] = escape) -> tuple[str, list[Located]]:
    """Render successive prefixes and find each turn in what the last output lacked.

    The template is a black box: its output for k turns is compared with that for k - 1. Where
    the earlier output is a beginning of the later one, the turn is what follows. Otherwise the
    template has rewritten history: the turn begins behind the longest common beginning, and the
    turns that reach beyond it are marked as rewritten and lose their place.
    """
    before, found = template(turns[:0]), []
    for k, (_, text) in enumerate(turns):
        after = template(turns[:k + 1])
        start = len(before)
        if not after.startswith(before):
            start = _common(before, after)
            for one in found:
                if one.end > start:
                    one.rewritten, one.text_start, one.text_end = True, None, None
        # a text that no other holds, in this one's place, shows where it begins
        at = template([*turns[:k], (turns[k][0], PROBE)]).rfind(PROBE)
        end = at + len(escaped(text))
        inside = (at, end) if at >= start and after[at:end] == escaped(text) else (None, None)
        found.append(Located(start, len(after), *inside))
        before = after
    return before, found


def _common(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


FORMATTED = ("conv_id long, place long, formatted string, roles array<string>, "
             "starts array<int>, ends array<int>, rewritten array<boolean>")
_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("place", pa.int64()), ("formatted", pa.string()),
    ("roles", pa.list_(pa.string())), ("starts", pa.list_(pa.int32())),
    ("ends", pa.list_(pa.int32())), ("rewritten", pa.list_(pa.bool_()))])


def _sorted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _emit(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in some], f.type) for i, f in enumerate(schema)], schema=schema)


def render(conversations: DataFrame, template: Template = marked_turns,
           escaped: Callable[[str], str] = escape) -> DataFrame:
    """Formatted blocks of all conversations, in the shared folder.

    One row per block: conv_id, place (the order of a conversation's blocks), formatted, and per
    turn its role, where its text lies in ``formatted`` (null where history was rewritten) and
    whether it was.

    A template is a black box whose output may depend on all turns of a conversation. Each
    conversation is then one block, whose true prefixes are rendered in one ordered stream in one
    task; the time grows with the square of its turns and its text is held in memory.

    A template with a true attribute ``concatenative`` renders each turn the same wherever it
    stands, with nothing before, between or behind the turns. Its rows are dealt by ranges of the
    whole order, so a conversation with a third of all turns spans many tasks, in blocks of up to
    ``BLOCK_TURNS`` turns, whose borders then make no difference to the text.
    """
    split = getattr(template, "concatenative", False)
    order = ["conv_id", "turn", "role", "text"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = itertools.count(TaskContext.get().partitionId() << 40)

        def rows() -> Iterator[tuple]:
            for conv, group in itertools.groupby(_sorted_rows(batches), key=lambda r: r[0]):
                size = BLOCK_TURNS if split else None
                while turns := [(r[2], r[3]) for r in itertools.islice(group, size)]:
                    formatted, found = locate(template, turns, escaped)
                    yield (conv, next(place), formatted, [t[0] for t in turns],
                           [x.text_start for x in found], [x.text_end for x in found],
                           [x.rewritten for x in found])

        yield from _emit(rows(), _ARROW, 500 if split else 50)

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(*order) if split else rows.repartition("conv_id")
    return stage(dealt.sortWithinPartitions(*order).mapInArrow(blocks, FORMATTED), "formatted")


READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_rewritten long")
_READ = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ("n_rewritten", pa.int64())])


def read_back(formatted: DataFrame,
              read: Callable[[str], Iterator[Turn]] = read_marked,
              unescaped: Callable[[str], str] = unescape, learn: str = "assistant") -> DataFrame:
    """Digests of what the formatted blocks hold, one row per conversation.

    Turns are read from the formatted text alone; the loss mask is the located texts of the turns
    whose role is ``learn``. A digest of a conversation is sequential, so its blocks stream
    through one task in order, sorted on disk and one block in memory.
    """
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for conv, group in itertools.groupby(_sorted_rows(batches), key=lambda r: r[0]):
                turns, loss = hashlib.sha256(), hashlib.sha256()
                n = loss_chars = chars = rewritten = 0
                for _, _, text, roles, starts, ends, changed in group:
                    chars += len(text)
                    rewritten += sum(changed)
                    for role, words in read(text):
                        turns.update(f"{role}\n{words}\n".encode())
                        n += 1
                    for role, start, end in zip(roles, starts, ends, strict=True):
                        if role == learn and start is not None:
                            words = unescaped(text[start:end])
                            loss_chars += len(words)
                            loss.update(words.encode())
                yield (conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, rewritten)

        yield from _emit(rows(), _READ, 2000)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(digests, READ)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Format all conversations, then read the formatted text back.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are
    ignored. Returns one row per conversation: conv_id, n_turns, turns_sha256 (of role, line end,
    text, line end per turn), loss_chars and loss_sha256 (of the assistants' texts),
    formatted_chars, n_rewritten (0 for the library's template). Turns are ordered by turn, those
    of equal turns by role and text, a null turn first; repeated rows are repeated turns. Null
    roles and texts are empty; rows without a conversation id form one conversation. An empty
    table gives no rows.
    """
    return read_back(render(conversations))

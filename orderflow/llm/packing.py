"""Packing token sequences: non-negative least squares over the length histogram.

The window's fillings by up to three lengths are enumerated, their repeat counts solved against
the histogram of lengths, rounded down, and what remains is packed greedily. Both steps work on
the histogram, which has at most as many entries as the window has tokens, so the driver's part
does not grow with the documents. The pieces are placed where they lie: a piece's rank among the
pieces of its length decides its sequence and offset.
"""

from __future__ import annotations

import bisect
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.bpe import normalized, split_pieces
from orderflow.llm.common import stage, worker_memory

#: Words whose ids a Python worker remembers: half as many new ones, and those used before them.
REMEMBERED = 400_000
#: Characters of texts that are split at a time.
TOGETHER = 1 << 19
#: Bins of lengths are this part of the length wide; solver rounds.
BIN_PART, ROUNDS = 64, 400

PIECE = ("doc_id long, doc_tokens long, start long, length int, ids_crc32 long, task int, "
         "nth long")


class Encoder:
    """Token ids of whole texts as unsigned 32-bit little-endian bytes; ids by word remembered.

    The vocabulary splits a text into pieces before merging and never merges across them, and a
    piece's last token, and no other, ends a word. So the new pieces of many texts are encoded
    together and cut apart at those tokens. A full memory becomes the ``older`` one, from which
    the pieces that come again are taken back.
    """

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.library = Tokenizer.from_file(vocabulary)
        tokens = self.library.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        self.ends[[i for t, i in tokens.items() if t.endswith("</w>")]] = True
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")

    def _direct(self, text: str) -> bytes:
        # without the places of the tokens
        encoded, = self.library.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoded.ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        found = self._direct(" ".join(words))
        cuts = (4 * (np.flatnonzero(self.ends[np.frombuffer(found, "<u4")]) + 1)).tolist()
        if len(cuts) == len(words):
            pieces = map(found.__getitem__, map(slice, [0, *cuts[:-1]], cuts))
            self.ids.update(zip(words, pieces, strict=True))
        else:
            for word in words:
                self.ids[word] = self._direct(word)

    def _split(self, text: str) -> list[str] | None:
        """The pieces of a text, None if only the library can tell them."""
        if "<|" in text and self.special.search(text):
            return None
        text = normalized(text)
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            return None
        return split_pieces(text)

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        split = [self._split(text) for text in texts]
        every = set().union(*(words for words in split if words is not None))
        new = every.difference(self.ids)
        if len(self.ids) + len(new) > REMEMBERED // 2:
            self.older, self.ids = self.ids, {}
            new = every
        again = [word for word in new if word in self.older]
        self.ids.update(zip(again, map(self.older.__getitem__, again), strict=True))
        if new := list(new.difference(again)):
            self._learn(new)
        for text, words in zip(texts, split, strict=True):
            yield self._direct(text) if words is None else b"".join(map(self.ids.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as the library gives them, without added special tokens."""
        return next(self._encode([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """As :meth:`encode`, of each text in turn."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > TOGETHER:
                yield from self._encode(group)
                group, size = [], 0
        yield from self._encode(group)


def pieces(docs: DataFrame, vocabulary: str, window: int, end_id: int) -> DataFrame:
    """Each document's tokens cut into full windows and a rest, one row per piece.

    A piece's rank ``nth`` counts the pieces of its length within its task, so no piece has to
    be sorted or counted with others of a frequent length.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_memory(f"encoder {vocabulary}", lambda: Encoder(vocabulary))
        task = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            texts = encoder.encode_all(text.as_py() or "" for text in batch.column(1))
            for doc, encoded in zip(batch.column(0).to_pylist(), texts, strict=True):
                ids = memoryview(encoded + end)
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                    for column, x in zip(out, (doc, total, start, length, crc,
                                               int(seen[length])), strict=True):
                        column.append(x)
                    seen[length] += 1
            n = len(out[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.int64()), pa.array(out[3], pa.int32()),
                 pa.array(out[4], pa.int64()), pa.array([task] * n, pa.int32()),
                 pa.array(out[5], pa.int64())],
                names=["doc_id", "doc_tokens", "start", "length", "ids_crc32", "task", "nth"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(cut, PIECE)


def bins(window: int) -> np.ndarray:
    """Upper ends of the length bins, each a small part of its length wide."""
    ends, x = [], 0
    while x < window:
        x = min(window, x + max(1, x // BIN_PART))
        ends.append(x)
    return np.array(ends)


def fillings(ends: np.ndarray) -> np.ndarray:
    """Up to three bins whose lengths fill the window nearly; unused places are -1."""
    window = int(ends[-1])
    slack = window // BIN_PART
    rows = [(len(ends) - 1, -1, -1)]
    for i, u in enumerate(ends[:-1].tolist()):
        j = min(i, bisect.bisect_right(ends, window - u) - 1)
        if j >= 0 and u + ends[j] >= window - slack:
            rows.append((i, j, -1))
        for j in range(min(i, bisect.bisect_right(ends, window - u) - 1) + 1):
            k = bisect.bisect_right(ends, window - u - int(ends[j])) - 1
            if 0 <= k <= j and u + ends[j] + ends[k] >= window - slack:
                rows.append((i, j, k))
    return np.array(rows)


def solve(columns: np.ndarray, want: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 that minimise sum(weight * (A x - want) ** 2).

    A has a one for each bin that a column of ``columns`` names. Accelerated projected gradient
    with a step from the largest row and column sums.
    """
    used = columns >= 0
    flat = np.where(used, columns, len(want))
    scale = max(float(want.max(initial=0)), 1.0)
    target = want / scale

    def times(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(flat[:, k], x, len(want) + 1)[:-1] for k in range(flat.shape[1]))

    def back(r: np.ndarray) -> np.ndarray:
        padded = np.append(r, 0.0)
        return padded[flat].sum(axis=1)

    vector = np.ones(len(columns))
    norm = 1.0
    for _ in range(20):  # the largest eigenvalue of A' W A
        vector = back(weight * times(vector))
        norm = float(np.linalg.norm(vector)) or 1.0
        vector /= norm
    step = 1 / (1.05 * norm)
    x = y = np.zeros(len(columns))
    momentum = 1.0
    for _ in range(ROUNDS):
        new = np.maximum(0, y - step * back(weight * (times(y) - target)))
        after = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        y = new + (momentum - 1) / after * (new - x)
        x, momentum = new, after
    return x * scale


class Plan:
    """Where the piece of a length and rank goes; built from the histogram alone."""

    def __init__(self, histogram: np.ndarray, window: int) -> None:
        """``histogram[l]`` counts the pieces of length l; index 0 is unused."""
        self.window = window
        ends = self.ends = bins(window)
        self.bin_of = np.searchsorted(ends, np.arange(window + 1))
        self.count = histogram.astype(np.int64)
        # pieces of longer lengths in the same bin, by length
        self.before = np.zeros(window + 1, np.int64)
        for length in range(window - 1, 0, -1):
            if self.bin_of[length] == self.bin_of[length + 1]:
                self.before[length] = self.before[length + 1] + self.count[length + 1]
        self.sequences = 0
        self._shallow()
        self._greedy()

    def _shallow(self) -> None:
        n = len(self.ends)
        free = np.bincount(self.bin_of[1:], self.count[1:], n).astype(np.int64)
        columns = fillings(self.ends)
        x = solve(columns, free.astype(float), (self.ends / self.window) ** 2)
        self.taken = np.zeros(n, np.int64)
        slots = []  # bin, first position, sequence of it, count, slots before it in the filling
        for c in np.argsort(-x, kind="stable"):
            used = [int(b) for b in columns[c] if b >= 0]
            times = int(x[c] + 1e-6)
            if times <= 0:
                break
            for b in set(used):
                times = min(times, int(free[b]) // used.count(b))
            if times <= 0:
                continue
            earlier: list[tuple[int, int]] = []
            for b in used:
                slots.append((b, int(self.taken[b]), self.sequences, times, tuple(earlier)))
                earlier.append((b, int(self.taken[b])))
                self.taken[b] += times
                free[b] -= times
            self.sequences += times
        self.slots = sorted(slots)
        self.slot_key = np.array([(s[0] << 44) + s[1] for s in self.slots], np.int64)
        self.slot_base = np.array([s[2] - s[1] for s in self.slots], np.int64)
        self.slot_first = np.array([s[1] for s in self.slots], np.int64)

    def _greedy(self) -> None:
        used = np.clip(self.taken[self.bin_of] - self.before, 0, self.count)
        self.rest = used
        left = self.count - used
        groups: dict[int, list] = {}  # space -> [packs, [(length, times)]]
        spaces: list[int] = []

        def put(space: int, packs: int, made: list) -> None:
            if space not in groups:
                bisect.insort(spaces, space)
                groups[space] = []
            groups[space].append((packs, made))

        for length in range(self.window, 0, -1):
            n = int(left[length])
            while n:
                at = bisect.bisect_left(spaces, length)
                if at < len(spaces):
                    space = spaces[at]
                    packs, made = groups[space].pop()
                    if not groups[space]:
                        del groups[space]
                        spaces.pop(at)
                else:
                    space, made = self.window, []
                    packs = max(1, n // (space // length))
                each = min(space // length, max(1, n // packs))
                filled = min(packs, n // each)
                put(space - each * length, filled, [*made, (length, each)])
                if filled < packs:
                    put(space, packs - filled, made)
                n -= each * filled
        rows = []
        taken = np.zeros(self.window + 1, np.int64)
        for space in spaces:
            for packs, made in groups[space]:
                offset = 0
                for length, each in made:
                    rows.append((length, int(taken[length]), self.sequences, each, offset))
                    taken[length] += packs * each
                    offset += length * each
                self.sequences += packs
        rows.sort()
        self.rest_key = np.array([(r[0] << 44) + r[1] for r in rows], np.int64)
        self.rest_rows = np.array([r[1:] for r in rows], np.int64).reshape(-1, 4)

    def _length_at(self, b: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Length of the piece at a position of a bin, whose pieces lie longest first."""
        out = np.zeros(len(b), np.int64)
        for one in np.unique(b):
            lengths = np.flatnonzero(self.bin_of[1:] == one)[::-1] + 1
            ends = np.cumsum(self.count[lengths])
            mine = b == one
            out[mine] = lengths[np.searchsorted(ends, position[mine], side="right")]
        return out

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by length and rank among the pieces of that length."""
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        b = self.bin_of[length]
        position = self.before[length] + rank
        shallow = position < self.taken[b]
        if shallow.any():
            at = np.searchsorted(self.slot_key, (b[shallow] << 44) + position[shallow],
                                 side="right") - 1
            sequence[shallow] = self.slot_base[at] + position[shallow]
            q = position[shallow] - self.slot_first[at]
            add = np.zeros(len(at), np.int64)
            for slot in np.unique(at):
                mine = at == slot
                for other, first in self.slots[slot][4]:
                    add[mine] += self._length_at(np.full(mine.sum(), other), first + q[mine])
            offset[shallow] = add
        if (~shallow).any():
            rest, r = length[~shallow], (rank - self.rest[length])[~shallow]
            at = np.searchsorted(self.rest_key, (rest << 44) + r, side="right") - 1
            first, base, each, before = self.rest_rows[at].T
            sequence[~shallow] = base + (r - first) // each
            offset[~shallow] = before + (r - first) % each * rest
        return sequence, offset


def pack(docs: DataFrame, vocabulary: str, window: int = 4096, end_id: int = 2) -> DataFrame:
    """Pack the tokens of all documents into sequences of at most ``window`` tokens.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A text's ids are the
    library's, then ``end_id``; a null text is empty, so it has that one id. Documents longer
    than the window are cut into full windows and a rest. Returns one row per piece: doc_id,
    start, length, ids_crc32 (of the ids as unsigned little-endian 32-bit integers), doc_tokens,
    sequence_id, offset. Null and repeated ids keep their rows; an empty table gives no rows.

    The pieces, without texts or ids, are written to the shared folder; ranks are a task's own
    count plus a running sum over tasks of small rows. Equal lengths are never gathered.
    """
    spark = docs.sparkSession
    cut = stage(pieces(docs, vocabulary, window, end_id), "pieces")
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # <= window rows
    histogram = np.zeros(window + 1, np.int64)
    for row in lengths:
        histogram[row["length"]] = row["n"]
    plan = spark.sparkContext.broadcast(Plan(histogram, window))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = cut.join(
        counts.select("task", "length",
                      F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip")),
        ["task", "length"]).withColumn("nth", F.col("nth") + F.col("skip")).drop("task", "skip")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.value.place(
                batch.column("length").to_numpy().astype(np.int64),
                batch.column("nth").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence),
                                              pa.array(offset)],
                                             names=[*kept, "sequence_id", "offset"])

    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    out = ranked.select(*kept, "nth").mapInArrow(
        place, "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, "
               "sequence_id long, offset long")
    return out.withColumn("length", F.col("length").cast("long"))

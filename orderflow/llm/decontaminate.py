"""Benchmark decontamination over a distributed positional inverted index.

The training texts become index segments: each holds its documents' terms and, by term, the
positions of every word. A segment's posting lists are bounded by the segment's size, so a word
or passage that a third of the corpus shares makes no long list anywhere. The benchmark's windows
are a stated query set that goes to the segments in blocks of bounded size. For a window the
lists are intersected from its rarest term on, each shifted by the term's offset.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import (
    ROW_KEY, WORDS, fresh_path, hexed_ids, keyed, stage, worker_memory,
)

#: Words of a segment (one longer document makes a longer one) and windows of a query block.
SEGMENT_WORDS, BLOCK_WINDOWS = 100_000, 200_000
#: Candidates that are intersected at a time (one window's may be more).
CANDIDATES = 100_000

SEGMENT = ("segment long, row_file array<long>, row_index array<long>, doc_ids array<long>, "
           "starts array<int>, n_words array<int>, terms binary, counts binary, positions binary")
MATCH = ("segment long, ordinal int, item_id string, first int, last int, exact boolean")


def words(text: bytes | None) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, A to Z in lower case."""
    return (text or b"").translate(WORDS).split()


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def build_index(docs: DataFrame, gap: int = 64) -> DataFrame:
    """Postings of every word of every text, as a table in the shared folder.

    One row per segment: its documents (row key, id, first position, words), its terms joined by
    blanks, the postings per term and the positions in the order of the terms. ``gap`` free
    positions lie between documents, so no window of up to that many words matches across them.
    """
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("index", dict)
        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        ids: list[np.ndarray] = []
        vocabulary, at = _Vocabulary(), 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held, ids, vocabulary, at
            starts = np.array([h[3] for h in held], np.int32)
            sizes = np.array([h[4] for h in held], np.int32)
            every = np.concatenate([*ids, np.zeros(0, np.int32)])
            place = np.arange(len(every), dtype=np.int32) + np.repeat(
                starts - np.cumsum(sizes, dtype=np.int32) + sizes, sizes)
            order = np.argsort(every, kind="stable")
            row = [(task << 32) + number, [h[0] for h in held], [h[1] for h in held],
                   [h[2] for h in held], starts.tolist(), sizes.tolist(), b" ".join(vocabulary),
                   np.bincount(every, minlength=len(vocabulary)).astype("<i4").tobytes(),
                   place[order].astype("<i4").tobytes()]
            number += 1
            held, ids, vocabulary, at = [], [], _Vocabulary(), 0
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 3, *[pa.list_(pa.int32())] * 2,
                     *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, kinds, strict=True)],
                names=[f.split()[0] for f in SEGMENT.split(", ")])

        for batch in batches:
            texts = batch.column(3).cast(pa.large_binary())
            for f, r, d, text in zip(*(batch.column(i).to_pylist() for i in range(3)), texts,
                                     strict=True):
                found = words(text.as_py())
                ids.append(np.fromiter(map(vocabulary.__getitem__, found), np.int32, len(found)))
                held.append((f, r, d, at, len(found)))
                at += len(found) + gap
                if at >= SEGMENT_WORDS:
                    yield flush()
        if held:
            yield flush()

    rows = keyed(docs).select(*ROW_KEY, F.col("doc_id").cast("long"),
                              F.col("text").cast("string"))
    # a page per segment: Parquet would otherwise hold a hundred of these long values at once
    path = fresh_path(docs.sparkSession, "index")
    (rows.mapInArrow(segments, SEGMENT).write.option("parquet.page.size.row.check.min", 1)
     .option("parquet.page.row.count.limit", 1).option("parquet.enable.dictionary", "false")
     .parquet(path))
    return docs.sparkSession.read.schema(SEGMENT).parquet(path)


def windows(text: bytes | None, length: int) -> Iterator[tuple[bytes, ...]]:
    """Runs of ``length`` consecutive words; a shorter text is one run, an empty none."""
    found = words(text)
    if 0 < len(found) < length:
        yield tuple(found)
    yield from zip(*(found[i:] for i in range(length)), strict=False)


class Block:
    """Windows of the query set: their items, terms and lengths."""

    def __init__(self, items: list[str | None], found: list[tuple[bytes, ...]]) -> None:
        terms = _Vocabulary()
        width = max(map(len, found), default=1)
        self.rows = np.full((len(found), width), -1, np.int32)
        for i, window in enumerate(found):
            self.rows[i, :len(window)] = [terms[w] for w in window]
        self.lengths = np.array([len(w) for w in found], np.int32)
        self.terms = list(terms)
        self.items = items


def query_windows(benchmark: DataFrame, length: int) -> DataFrame:
    """The benchmark's distinct windows as a staged table: item_id, phrase, block.

    A phrase is a window's words joined by blanks. Blocks are dealt by hash, so each has about
    ``BLOCK_WINDOWS`` windows, and one item's windows may be in many.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for item, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                found = windows(text.as_py(), length)
                while some := [b" ".join(w) for w in itertools.islice(found, 10_000)]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(some), pa.string()), pa.array(some, pa.binary())],
                        names=["item_id", "phrase"])

    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    every = stage(rows.mapInArrow(cut, "item_id string, phrase binary").distinct(), "windows")
    count = max(1, -(-every.count() // BLOCK_WINDOWS))
    block = F.pmod(F.xxhash64("phrase", "item_id"), F.lit(count)).cast("int").alias("block")
    return stage(every.select("item_id", "phrase", block), "window_blocks", "block")


def blocks(benchmark: DataFrame, length: int) -> Iterator[Block]:
    """The benchmark's windows, one block at a time."""
    found = query_windows(benchmark, length)
    numbers = found.agg(F.max("block")).first()[0]
    for number in range(0 if numbers is None else numbers + 1):
        rows = found.where(F.col("block") == number).select("item_id", "phrase").toArrow()
        yield Block(rows.column("item_id").to_pylist(),
                    [tuple(p.split(b" ")) for p in rows.column("phrase").to_pylist()])


def occurrences(block: Block, terms: list[bytes], counts: np.ndarray, positions: np.ndarray,
                slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that occur in a segment: number, start, exact or near.

    The candidates of a window are its rarest term's positions less the term's offset, with
    ``slop`` also those up to so many words off; the first term stands at each that stays. Each
    further term, in the order of rarity, keeps the candidates at which its shifted list has a
    position no more than ``slop`` away.
    """
    none = np.zeros(0, np.int64)
    where = dict(zip(terms, range(len(terms)), strict=True))
    local = np.array([where.get(t, -1) for t in block.terms] + [-1], np.int64)
    rows = local[block.rows]
    used = block.rows >= 0
    alive = np.flatnonzero(((rows >= 0) | ~used).all(axis=1))
    if not len(alive):
        return none, none, none.astype(bool)
    rows, used = rows[alive], used[alive]
    size = np.where(used, counts[np.maximum(rows, 0)], np.iinfo(np.int64).max)
    order = np.argsort(size, axis=1, kind="stable")
    ends = np.cumsum(counts)
    keys = (np.repeat(np.arange(len(counts), dtype=np.int64), counts) << 32) + positions
    rarest = rows[np.arange(len(rows)), order[:, 0]]
    part = np.cumsum(counts[rarest]) // CANDIDATES
    found = [_intersect(np.flatnonzero(part == x), rows, used, order, rarest, counts, ends,
                        positions, keys, slop) for x in np.unique(part)]
    window, start, exact = (np.concatenate(x) for x in zip(*found, strict=True))
    return alive[window], start, exact


def _intersect(windows: np.ndarray, rows: np.ndarray, used: np.ndarray, order: np.ndarray,
               rarest: np.ndarray, counts: np.ndarray, ends: np.ndarray, positions: np.ndarray,
               keys: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    many = counts[rarest[windows]]
    window = np.repeat(windows, many)
    inside = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many)
    start = positions[np.repeat(ends[rarest[windows]] - many, many) + inside] - order[window, 0]
    far = np.zeros(len(window), np.int64)
    if slop and len(window):
        # the rarest term may be off its place, the first one gives the start
        shift = np.arange(-slop, slop + 1)
        want = (rows[window, 0] << 32)[:, None] + start[:, None] + shift
        held = keys[np.minimum(np.searchsorted(keys, want), len(keys) - 1)] == want
        picked, off = np.nonzero(held)
        window, start = window[picked], start[picked] + shift[off]
        far = np.abs(shift[off])
    for k in range(1, rows.shape[1]):
        column = order[window, k]
        checked = used[window, column]
        want = (rows[window, column] << 32) + start + column
        at = np.minimum(np.searchsorted(keys, want - slop), len(keys) - 1)
        exact_at = np.minimum(np.searchsorted(keys, want), len(keys) - 1) if slop else at
        off = np.abs(keys[at] - want)
        off = np.where(keys[exact_at] == want, 0, np.maximum(off, 1 if slop else 0))
        keep = ~checked | (off <= slop)
        far = np.maximum(far, np.where(checked, off, 0))[keep]
        window, start = window[keep], start[keep]
        if not len(window):
            break
    return window, start, far == 0


def search(index: DataFrame, benchmark: DataFrame, length: int = 10, slop: int = 2) -> DataFrame:
    """Passages of documents that the benchmark's windows match.

    Returns segment, ordinal (the document's place in its segment), item_id, first and last
    (positions of the first and last word), exact. Overlapping and touching occurrences of one
    item's windows are one passage. Near matches (``exact`` false) have every further term of a
    window at its offset from the first term, give or take ``slop`` words. Items with an equal id
    count as one; an item without an id still matches. Each block is broadcast, is about
    ``BLOCK_WINDOWS`` windows long and reads the index once.
    """
    spark = index.sparkSession
    found = spark.createDataFrame([], MATCH)
    for block in blocks(benchmark, length):
        sent = spark.sparkContext.broadcast(block)
        found = found.union(stage(_search_block(index, sent, slop), "matches"))
        sent.unpersist()
    return found


def _search_block(index: DataFrame, sent, slop: int) -> DataFrame:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        names: dict = {}
        item_of = np.array([names.setdefault(i, len(names)) for i in block.items], np.int64)
        items = list(names)
        for batch in batches:
            for i in range(batch.num_rows):
                segment, starts, sizes, terms, counts, positions = (
                    batch.column(k)[i].as_py() for k in range(6))
                starts, sizes = np.array(starts, np.int64), np.array(sizes, np.int64)
                window, at, exact = occurrences(
                    block, terms.split(b" ") if terms else [],
                    np.frombuffer(counts, "<i4").astype(np.int64),
                    np.frombuffer(positions, "<i4").astype(np.int64), slop)
                doc = np.searchsorted(starts, at, side="right") - 1
                first = at - starts[doc]
                last = np.minimum(first + block.lengths[window], sizes[doc]) - 1
                out = _passages(doc, item_of[window], first, last, exact)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(out[0]), segment), pa.int64()),
                     pa.array(out[0], pa.int32()),
                     pa.array([items[x] for x in out[1]], pa.string()),
                     pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32()),
                     pa.array(out[4])],
                    names=["segment", "ordinal", "item_id", "first", "last", "exact"])

    return index.select("segment", "starts", "n_words", "terms", "counts", "positions").mapInArrow(
        look, MATCH)


def _passages(doc: np.ndarray, item: np.ndarray, first: np.ndarray, last: np.ndarray,
              exact: np.ndarray) -> list[np.ndarray]:
    """Occurrences joined where they overlap or touch, per document, item and exactness."""
    if not len(doc):
        return [doc, item, first, last, exact]
    order = np.lexsort((last, first, exact, item, doc))
    doc, item, first, last, exact = (x[order] for x in (doc, item, first, last, exact))
    new_key = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
                    | (exact[1:] != exact[:-1])]
    key = np.cumsum(new_key) - 1
    wide = np.int64(1) << 33
    reach = np.maximum.accumulate(last + key * wide) - key * wide
    new = new_key.copy()
    new[1:] |= first[1:] > reach[:-1] + 1
    begin = np.flatnonzero(new)
    return [doc[begin], item[begin], first[begin],
            np.maximum.reduceat(last, begin), exact[begin]]


def covered(passages) -> object:
    """Words in the union of ``passages``, an array of structs that begin with first and last."""
    joined = F.aggregate(
        F.array_sort(passages),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("end")),
        lambda a, p: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"),
                                 p["last"] - F.greatest(a["end"], p["first"] - 1))).alias("n"),
            F.greatest(a["end"], p["last"].cast("long")).alias("end")))
    return joined["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = 10, slop: int = 2
                  ) -> DataFrame:
    """Which words of each document lie in a passage that the benchmark also has.

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` has ``item_id`` and ``text``; other
    columns are ignored. Returns one row per document row: the row key, doc_id, n_words, n_hit
    (words inside any exact occurrence of a window), n_items (items with one), items_sha256,
    contaminated, n_near_items (items that only match nearly). Null and blank texts have no words
    and no hits. Null and repeated ids keep their rows. Without benchmark windows nothing is
    hit; without documents there are no rows.

    Posting lists meet the windows inside a segment, so nothing is shuffled but one small row
    per matching document and item.
    """
    index = build_index(docs, gap=length + 2 * slop)
    found = search(index, benchmark, length, slop)
    hits = found.groupBy("segment", "ordinal").agg(
        F.collect_list(F.when(F.col("exact"), F.struct("first", "last"))).alias("spans"),
        F.collect_set(F.when(F.col("exact"), F.col("item_id"))).alias("items"),
        F.collect_set("item_id").alias("all_items"))
    listed = index.select("segment", F.posexplode(F.arrays_zip(
        "row_file", "row_index", "doc_ids", "n_words")).alias("ordinal", "d"))
    none = F.array().cast("array<string>")
    items = F.coalesce("items", none)
    out = listed.join(hits, ["segment", "ordinal"], "left")
    return out.select(
        F.col("d.row_file").alias(ROW_KEY[0]), F.col("d.row_index").alias(ROW_KEY[1]),
        F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").cast("long").alias("n_words"),
        F.coalesce(covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), hexed_ids(items).alias("items_sha256"),
        F.coalesce(F.size("spans") > 0, F.lit(False)).alias("contaminated"),
        (F.size(F.coalesce("all_items", none)) - F.size(items)).cast("long")
        .alias("n_near_items"))


def clean(docs: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """The rows of ``docs`` without any exact benchmark passage, with the columns they came with.

    Rows without a text or words are kept.
    """
    rows = keyed(docs)
    bad = contamination(rows, benchmark, length, slop=0).where("contaminated").select(*ROW_KEY)
    return rows.join(bad, ROW_KEY, "left_anti").drop(*ROW_KEY)

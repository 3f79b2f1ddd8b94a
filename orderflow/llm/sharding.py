"""Sharding by a hierarchical weighted hash tree: regions, racks and places for shards.

A row descends the tree by weighted hash draws: at a node every child draws a number from the
row's id, scaled by the room below it, and the smallest wins. A place takes the row with the
probability that its shard's weight has in the place's room; a row that is turned away draws again
from the root. Room never changes, so a shard that joins or gains weight moves rows only into its
own place, and one that leaves or loses weight only out of it. (Draws scaled by the sums of the
shards' weights would also move rows to older shards of a region that has grown.)
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import ROW_KEY, keyed, prepare, stage
from orderflow.llm.ranks import ranked

#: Places of the tree that the query uses: regions, racks of a region, places of a rack.
ROOM = (4, 2, 4)

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX = ((30, np.uint64(0xBF58476D1CE4E5B9)), (27, np.uint64(0x94D049BB133111EB)))


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the 64-bit number."""
    for shift, factor in _MIX:
        x = (x ^ (x >> np.uint64(shift))) * factor
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Tree:
    """Room for shards: per region, per rack, the room of each place; and the shards' weights.

    Shard i stands in the i-th place of this order; places behind the last shard are free. A
    weight is at most its place's room.
    """

    room: tuple[tuple[tuple[float, ...], ...], ...]
    weights: tuple[float, ...]

    def __post_init__(self) -> None:
        places = [place for region in self.room for rack in region for place in rack]
        if len(self.weights) > len(places):
            raise ValueError(f"{len(self.weights)} shards, but room for {len(places)}")
        if not all(0 <= w <= r for w, r in zip(self.weights, places)) or not any(self.weights):
            raise ValueError("weights are from 0 to their place's room, and one is not 0")

    @staticmethod
    def of(shards: int, room: Sequence[int] = ROOM) -> Tree:
        """``shards`` shards of weight 1 in a tree of so many regions, racks and places."""
        regions, racks, places = room
        return Tree((((1.0,) * places,) * racks,) * regions, (1.0,) * shards)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per node its children (-1: none) and room; per node its shard (-1: none) and weight.

        Node 0 is the root; regions, racks and places follow, each level in its order.
        """
        racks = [rack for region in self.room for rack in region]
        places = [place for rack in racks for place in rack]
        room = [0.0, *(sum(map(sum, region)) for region in self.room), *map(sum, racks), *places]
        sizes = [len(self.room), *map(len, self.room), *map(len, racks)]
        children = np.full((len(room), max(sizes)), -1)
        first = 1
        for node, size in enumerate(sizes):
            children[node, :size] = range(first, first + size)
            first += size
        shard, weight = np.full(len(room), -1), np.zeros(len(room))
        start = len(room) - len(places)
        shard[start:start + len(self.weights)] = range(len(self.weights))
        weight[start:start + len(self.weights)] = self.weights
        return children, np.array(room), shard, weight


def placed(ids: np.ndarray, tree: Tree) -> np.ndarray:
    """The shard of each id (signed 64-bit)."""
    children, room, shard, weight = tree.arrays()
    nodes = len(room)
    base = mixed(ids.astype(np.int64).view(np.uint64))
    out = np.full(len(ids), -1, np.int32)
    pending = np.arange(len(ids))
    attempt = 0

    def drawn(rows: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Uniform in (0, 1], one per row, for the given number of a draw."""
        count = (number + attempt * 2 * nodes).astype(np.uint64)
        bits = mixed(base[rows] + count * _GOLDEN) >> np.uint64(11)
        return (bits.astype(np.float64) + 1) / 2 ** 53

    while len(pending):
        node = np.zeros(len(pending), np.int64)
        for _ in range(3):
            best = np.full(len(pending), np.inf)
            chosen = node
            for child in children[node].T:
                real = (child >= 0) & (room[child] > 0)
                score = np.where(real, -np.log(drawn(pending, child))
                                 / np.where(real, room[child], 1), np.inf)
                chosen = np.where(score < best, child, chosen)
                best = np.minimum(score, best)
            node = chosen
        taken = drawn(pending, node + nodes) * room[node] <= weight[node]
        out[pending[taken]] = shard[node[taken]]
        pending = pending[~taken]
        attempt += 1
    return out


def shard_of(tree: Tree, doc_id: Column) -> Column:
    """The shard that an id and the tree decide; rows without an id are placed like id -1."""
    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(placed(ids.to_numpy(), tree))

    return place(F.coalesce(doc_id.cast("long"), F.lit(-1)))


def assign(docs: DataFrame, tree: Tree, grown: Tree) -> DataFrame:
    """The shard and slot of every document, and its shard in the ``grown`` tree.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Returns one row per input
    row: doc_id, size (UTF-8 bytes of the text and one; null has none), text_crc32 (unsigned, of
    the text's UTF-8), law (``key``: the id and the tree decide, nothing else), shard, slot (from
    0 without gaps in each shard, ascending by id, null first) and grown_shard. Equal ids, and all
    rows without one, share a shard, as the law demands. An empty table gives no rows.

    A row's shard needs no other row. Slots are counted over ranges of (shard, id), so no shard
    is gathered in one task; texts are read once and never shuffled.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    rows = stage(keyed(docs).select(
        *ROW_KEY, doc_id.alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(tree, doc_id).alias("shard"), shard_of(grown, doc_id).alias("grown_shard")),
        "placed")
    return ranked(rows, ["shard"], ["doc_id", "text_crc32", "size", *ROW_KEY]).select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("rank").alias("slot"),
        "grown_shard")


def write_shards(docs: DataFrame, path: str, tree: Tree) -> None:
    """Write the rows of ``docs``, all columns, to ``path``, one folder ``shard=i`` per shard.

    A column ``shard`` is replaced. The rebalance hint cuts a large shard into several tasks.
    """
    prepare(docs.sparkSession)
    (docs.withColumn("shard", shard_of(tree, F.col("doc_id"))).hint("rebalance", "shard")
     .write.partitionBy("shard").parquet(path))

"""The hash tree against a plain descent, its law, and the rows it deals."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from orderflow.llm import sharding
from orderflow.llm.common import prepare
from orderflow.llm.sharding import Tree, placed

IDS = np.arange(-50, 20_000)
WORD = 1 << 64


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % WORD
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) % WORD
    return x ^ (x >> 31)


def plain(doc_id, tree):
    """One id's descent, node by node."""
    nodes, below = [None], {}
    level = [(0, tree.room)]
    for _ in range(3):
        following = []
        for number, children in level:
            below[number] = []
            for child in children:
                below[number].append(len(nodes))
                following.append((len(nodes), child))
                nodes.append(child)
        level = following
    first = len(nodes) - len(level)

    def room(number):
        def total(x):
            return sum(map(total, x)) if isinstance(x, tuple) else x
        return total(nodes[number])

    def drawn(number):
        bits = mix((mix(doc_id % WORD) + number * 0x9E3779B97F4A7C15) % WORD)
        return ((bits >> 11) + 1) / 2 ** 53

    attempt = 0
    while True:
        at = 0
        for _ in range(3):
            at = min((n for n in below[at] if room(n)), key=lambda n: -math.log(
                drawn(n + attempt * 2 * len(nodes))) / room(n))
        shard = at - first
        weight = tree.weights[shard] if shard < len(tree.weights) else 0
        if drawn(at + len(nodes) + attempt * 2 * len(nodes)) * room(at) <= weight:
            return shard
        attempt += 1


UNEVEN = Tree((((3.0, 1.0), (2.0,)), ((0.0, 4.0), (1.0, 1.0, 1.0))),
              (2.0, 1.0, 2.0, 0.0, 1.0, 0.0, 0.5))


@pytest.mark.parametrize("tree", [Tree.of(16), Tree.of(17), Tree.of(1, (1, 1, 3)), UNEVEN])
def test_against_a_plain_descent(tree):
    ids = IDS[:400]
    assert placed(ids, tree).tolist() == [plain(int(i), tree) for i in ids]


def test_one_more_shard_takes_rows_only_into_itself():
    before = placed(IDS, Tree.of(1))
    for n in range(2, 33):
        after = placed(IDS, Tree.of(n))
        moved = after != before
        assert set(after[moved]) == {n - 1}
        assert abs(moved.mean() - 1 / n) < 0.02
        before = after


def test_weights_decide_the_parts_and_what_moves():
    total = sum(UNEVEN.weights)
    parts = Counter(placed(IDS, UNEVEN).tolist())
    for shard, weight in enumerate(UNEVEN.weights):
        assert abs(parts[shard] / len(IDS) - weight / total) < 0.02
    heavier = Tree(UNEVEN.room, (2.0, 1.0, 2.0, 0.0, 3.0, 0.0, 0.5))
    lighter = Tree(UNEVEN.room, (2.0, 1.0, 2.0, 0.0, 0.2, 0.0, 0.5))
    now = placed(IDS, UNEVEN)
    more, less = placed(IDS, heavier), placed(IDS, lighter)
    assert set(more[more != now]) == {4} and set(now[less != now]) == {4}


def test_refused_trees():
    for shards in (0, 33):
        with pytest.raises(ValueError):
            Tree.of(shards)
    with pytest.raises(ValueError):
        Tree((((1.0,),),), (2.0,))


DDL = "doc_id long, text string, size string, shard string, `rank` int, law int, group_rows int"
TEXTS = [(1, "a"), (1, "a"), (2, None), (3, ""), (None, "x" * 300_000), (None, None),
         (-9, "été"), (1 << 62, "b")]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    rows = TEXTS + [(i, f"t{i % 5}") for i in range(10, 900)]
    return spark.createDataFrame([(i, t, "s", "s", 1, 2, 3) for i, t in rows], DDL).repartition(6)


def test_assigned_rows(docs):
    rows = sharding.assign(docs, Tree.of(16), Tree.of(17)).collect()
    want = Counter()
    for r in docs.collect():
        key = -1 if r.doc_id is None else r.doc_id
        data = (r.text or "").encode()
        want[r.doc_id, len(data) + 1, zlib.crc32(data), "key", plain(key, Tree.of(16)),
             plain(key, Tree.of(17))] += 1
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard)
                   for r in rows) == want
    for shard in {r.shard for r in rows}:
        mine = sorted((r for r in rows if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        ids = [(r.doc_id is not None, r.doc_id or 0) for r in mine]
        assert ids == sorted(ids)


def test_no_rows(docs):
    assert sharding.assign(docs.limit(0), Tree.of(16), Tree.of(17)).collect() == []


def test_written_shards(docs, spark, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, Tree.of(16))
    back = spark.read.parquet(path)
    assert back.count() == docs.count() and set(back.columns) == set(docs.columns)
    one = back.where("doc_id = -9").collect()
    assert [(r.text, r.shard) for r in one] == [("été", plain(-9, Tree.of(16)))]

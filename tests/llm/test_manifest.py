"""The Merkle manifest against a plain tree, over several rounds of blocks and odd rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from orderflow.llm import manifest, ranks
from orderflow.llm.common import prepare

DDL = ("doc_id long, source string, lang string, n_chars long, text string, rank long, "
       "group_rows int, path string, block int, digest string, nodes int, `all` string")
EXTRA = (1, 2, "p", 3, "d", 4, "a")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([H(*last[i:i + 3]) for i in range(0, len(last), 3)])
    return out


def siblings(tree, i):
    for level in tree[:-1]:
        run = i - i % 3
        yield level[run:i], level[i + 1:run + 3]
        i //= 3


def plain(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        mine = sorted((r for r in rows if r[1] == source),
                      key=lambda r: (r[0] is not None, r[0] or 0, H(*map(enc, r))))
        trees[source] = mine, levels([H(*map(enc, r)) for r in mine])
    top = levels([trees[s][1][-1][0] for s in sources])
    for at, source in enumerate(sources):
        mine, tree = trees[source]
        for i, row in enumerate(mine):
            path = [*siblings(tree, i), *siblings(top, at)]
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h = H(*map(enc, (*row[:4], text)))
            for before, after in path:
                h = H(*before, h, *after)
            root = top[-1][0]
            yield (row[0], tree[0][i], tree[-1][0], root, H(*(x for p in path for y in p for x in y)),
                   h, h == root)


def run(spark, rows):
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], DDL).repartition(5)
    got = manifest.manifest(df, manifest.without_line_ends(F.col("doc_id"), F.col("text")))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                           "verified"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    prepare(spark)


def test_against_a_plain_tree(spark):
    rows = [(i, "big", "en", i, f"line {i}\nand é") for i in range(6_700)]  # three rounds
    rows += [(i, "middle", None, None, "x" if i % 3 else "a\n\n") for i in range(82)]
    rows += [(i, f"s{i:03}", "de", 1, "ends\n") for i in range(100)]  # the sources need two rounds
    rows += [(i, None, "fr", 2, None) for i in range(5)]
    rows += [(None, "", None, None, ""), (None, "", None, None, "\n"), (7, "", "", 0, "a" * 300_000)]
    rows += [(9, "é", None, None, "same")] * 4 + [(9, "é", None, None, "other\n")]
    got = run(spark, rows)
    assert got == sorted(plain(rows), key=str)
    altered = [r for r in got if not r[6]]
    assert 0 < len(altered) < len(got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 81])
def test_small_sources(spark, n):
    rows = [(i, "one", "en", 3, f"t{i}\n") for i in range(n)]
    assert run(spark, rows) == sorted(plain(rows), key=str)


def test_unaltered_rows_verify(spark):
    df = spark.range(300).selectExpr("id AS doc_id", "'s' AS source", "'l' AS lang", "id AS n_chars",
                                     "concat('t\n', id) AS text")
    rows = manifest.manifest(df).collect()
    assert len(rows) == 300 and all(r.verified for r in rows)


def test_no_rows(spark):
    assert run(spark, []) == []


def test_ranks_over_many_tasks(spark):
    df = spark.range(0, 5_000, 1, 13).selectExpr("id % 2 = 0 AS g", "5000 - id AS v", "'x' AS rank")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = ranks.ranked(df, ["g"], ["v"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for g in (True, False):
        mine = sorted((r for r in rows if r.g == g), key=lambda r: r.v)
        assert [r["rank"] for r in mine] == list(range(2_500))
        assert {r.group_rows for r in mine} == {2_500}

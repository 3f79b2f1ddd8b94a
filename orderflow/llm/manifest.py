"""A Merkle manifest of a dataset: levels kept as concatenated strings, hashed by SQL.

Every node is the SHA-256 of up to ``RUN`` neighbouring digests of the level below, concatenated
as hex. An aligned block of ``RUN ** LEVELS`` nodes keeps each of its levels as one string, so a
parent is the digest of a substring and a node's siblings are the substrings beside it. The
blocks' roots are the nodes of the next round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import ROW_KEY, keyed, stage
from orderflow.llm.ranks import ranked

#: Nodes under one parent, hex digits of a digest, levels of a block.
RUN, HEX, LEVELS = 3, 64, 4
BLOCK = RUN ** LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A source may be null, so it is known by two columns without nulls; null comes first.
_SOURCE = ["has_source", "source_key"]


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: list[Column]) -> Column:
    """A row's digest: that of its encoded fields, one after the other."""
    return F.sha2(F.concat(*map(encoded, fields)), 256)


def _parents(level: Column) -> Column:
    """The next level of a block, from the string of a level."""
    width = RUN * HEX
    starts = F.sequence(F.lit(0), F.ceil(F.length(level) / width).cast("int") - 1)
    return F.array_join(F.transform(
        starts, lambda i: F.sha2(F.substring(level, i * width + 1, F.lit(width)), 256)), "")


def _siblings(level: Column, place: Column) -> Column:
    """What stands beside a node in its run: the digests to its left and to its right."""
    start = place - place % RUN
    return F.struct(
        F.substring(level, start * HEX + 1, (place - start) * HEX).alias("left"),
        F.substring(level, (place + 1) * HEX + 1, (start + RUN - 1 - place) * HEX).alias("right"))


def _folded(digest: Column, path: Column) -> Column:
    """The root that a digest leads to along a path of siblings."""
    return F.aggregate(path, digest, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def _blocks(nodes: DataFrame, group: list[str], kept: list[str]) -> DataFrame:
    """Blocks of ranked nodes with their members, the strings of their levels, and their root.

    A level is reduced as long as the whole group has several nodes on it, so the last block of a
    group climbs as high as the others, also where it has a single node left.
    """
    member = F.struct((F.col("rank") % BLOCK).cast("int").alias("place"), "digest", *kept)
    blocks = nodes.groupBy(*group, (F.floor(F.col("rank") / BLOCK)).alias("block")).agg(
        F.max("group_rows").alias("nodes"), F.array_sort(F.collect_list(member)).alias("members"))
    blocks = blocks.withColumn(
        "level0", F.array_join(F.transform("members", lambda m: m["digest"]), ""))
    for k in range(LEVELS):
        blocks = blocks.withColumn(f"level{k + 1}", F.when(
            F.col("nodes") > RUN ** k, _parents(F.col(f"level{k}"))))
    top = F.coalesce(*[F.col(f"level{k}") for k in range(LEVELS, -1, -1)])
    return stage(blocks.withColumn("top", top), "blocks")


def _own_path(place: Column) -> Column:
    """A member's siblings on the levels of its block that are reduced."""
    steps, at = [], place
    for k in range(LEVELS):
        steps.append(F.when(F.col("nodes") > RUN ** k, _siblings(F.col(f"level{k}"), at)))
        at = F.floor(at / RUN).cast("int")
    return F.array_compact(F.array(*steps))


def _climbed(nodes: DataFrame, group: list[str], kept: list[str]) -> DataFrame:
    """Blocks of ranked nodes with ``path``, the siblings from their root up to the group's root,
    and ``root``."""
    blocks = _blocks(nodes, group, kept)
    if blocks.where("block > 0").isEmpty():
        none = F.array().cast("array<struct<left: string, right: string>>")
        return blocks.withColumns({"path": none, "root": F.col("top")})
    # the roots of a group's blocks are ranked by their blocks
    tops = blocks.select(*group, F.col("block").alias("rank"), F.col("top").alias("digest"),
                         F.ceil(F.col("nodes") / BLOCK).alias("group_rows"))
    upper = _climbed(tops, group, []).select(
        *group, "block", "path", "root", F.explode("members").alias("m"), "nodes",
        *[f"level{k}" for k in range(LEVELS)]).select(
        *group, (F.col("block") * BLOCK + F.col("m.place")).alias("block"),
        F.concat(_own_path(F.col("m.place")), "path").alias("path"), "root")
    return blocks.join(stage(upper, "paths"), [*group, "block"])


def tree(leaves: DataFrame, group: list[str], kept: list[str]) -> DataFrame:
    """The tree of each group of ranked ``leaves`` (group, rank, group_rows, digest and ``kept``).

    Returns the leaves' blocks: the group, members (structs of place, digest and ``kept``),
    the strings of their levels, path (from the block's root upwards) and the group's root.
    A group's blocks are dealt like any rows; a round has a ``BLOCK``-th of the rows of the one
    before, and is written to the shared folder.
    """
    return _climbed(leaves, group, kept)


def manifest(docs: DataFrame, changed_text: Column | None = None) -> DataFrame:
    """Leaves, roots and inclusion proofs of all rows, and what altered rows lead to.

    ``docs`` has ``doc_id``, ``source``, ``lang``, ``n_chars`` and ``text``; other columns are
    ignored. A row's leaf is the digest of these five (see :func:`encoded`). The leaves of a
    source ascend by doc_id (null first; equal ids by leaf); while several nodes remain, every
    ``RUN`` neighbours become their digest, the last ones also where they are fewer. The roots of
    the sources, null first, then in the order of their UTF-8 bytes, lead to the root likewise.

    ``changed_text`` is the text that a row is checked with later (default: its own). Returns one
    row per input row: doc_id, leaf, subroot, root, proof_sha256 (of the siblings' digests, level
    by level up to the root), folded_root (which the later row's leaf and the original siblings
    lead to) and verified. Repeated rows have a leaf each. An empty table gives no rows.

    Leaves are ranked by ranges and meet in blocks of a fixed size, so a source with any part of
    the rows spreads over all tasks; only digests are shuffled. The path above a block is joined
    to the block, not to its rows.
    """
    fields = [F.col(c) for c in FIELDS]
    text = F.col("text").cast("string")
    later = text if changed_text is None else changed_text
    differs = ~F.equal_null(later, text)
    rows = stage(keyed(docs).select(
        *ROW_KEY, F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").isNotNull().alias("has_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source_key"),
        leaf(fields).alias("digest"),
        F.when(differs, leaf([*fields[:-1], later])).alias("later")), "leaves")
    leaves = ranked(rows, _SOURCE, ["doc_id", "digest", *ROW_KEY])
    blocks = tree(leaves.drop(*ROW_KEY), _SOURCE, ["doc_id", "later"])
    subroots = blocks.where("block = 0").select(
        *_SOURCE, F.col("root").alias("digest"), F.lit(0).alias("all"))
    top = tree(ranked(subroots, ["all"], _SOURCE), ["all"], _SOURCE)
    sources = stage(top.select(
        F.explode("members").alias("m"), "path", "nodes", F.col("root").alias("all_root"),
        *[f"level{k}" for k in range(LEVELS)]).select(
        *[F.col(f"m.{c}").alias(c) for c in _SOURCE], "all_root",
        F.concat(_own_path(F.col("m.place")), "path").alias("source_path")), "source_paths")
    joined = blocks.join(sources, _SOURCE)

    def with_path(member: Column) -> Column:
        path = F.concat(_own_path(member["place"]), F.col("path"), F.col("source_path"))
        return F.struct(member.alias("m"), path.alias("path"))

    def proved(found: Column) -> Column:
        member, path = found["m"], found["path"]
        segments = F.transform(path, lambda p: F.concat(p["left"], p["right"]))
        return F.struct(
            member["doc_id"].alias("doc_id"), member["digest"].alias("leaf"),
            F.sha2(F.array_join(segments, ""), 256).alias("proof_sha256"),
            _folded(F.coalesce(member["later"], member["digest"]), path).alias("folded_root"))

    # a member's siblings are cut out once and used twice
    rows = F.transform(F.transform("members", with_path), proved)
    return (joined.select(F.explode(rows).alias("p"), "root", "all_root")
            .select("p.doc_id", "p.leaf", F.col("root").alias("subroot"),
                    F.col("all_root").alias("root"), "p.proof_sha256", "p.folded_root",
                    (F.col("p.folded_root") == F.col("all_root")).alias("verified")))


def without_line_ends(doc_id: Column, text: Column) -> Column:
    """The text without its line ends where 2 divides the CRC-32 of the decimal id."""
    chosen = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(chosen, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)

"""Exact Jaccard join of word shingles by a token-group matrix.

Similar texts form groups of bounded size; for each group the union of its members' tokens is
stored. A text can only be linked with a member if the union holds enough of its tokens, so only
such groups are opened and their members compared. Candidate groups come from the rarest tokens:
two linked sets share one of the first ``n - ceil(t n) + 1`` tokens of either set in any global
order, and so do a set and the union of a group's first tokens.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import LOWER, ROW_KEY, components, keyed, stage, worker_memory

#: Words remembered per Python worker; counters of the frequency sketch (powers of two).
REMEMBERED, SKETCH_BITS = 120_000, 20
#: Shingles of a group, and of the queries that one task opens it for.
GROUP_SHINGLES, QUERY_SHINGLES = 100_000, 4_000_000
#: Sets with an equal home from which on they are one group.
GROUP_SETS = 8
#: Bits of the maps that tell a scan which rows are wanted.
MARK_BITS = 1 << 24

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT, _FINAL = np.uint64(31), np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = xxhash.xxh3_64_intdigest(word)
        return n



def shingle_hashes(text: bytes | None, size: int) -> np.ndarray:
    """64-bit hashes of a text's runs of ``size`` words, repeated ones too.

    Words are separated by ASCII white space, A to Z in lower case. A text of fewer words, but
    not none, is one shingle.
    """
    found = (text or b"").translate(LOWER).split()
    hashes = worker_memory("words", _Words)
    if len(hashes) > REMEMBERED:
        hashes.clear()
    words = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    if not len(words):
        return words
    runs = max(1, len(words) - size + 1)
    out = np.full(runs, np.uint64(min(size, len(words))))
    for k in range(min(size, len(words))):
        out = out * _MIX + words[k:k + runs]
    out ^= out >> _SHIFT
    out *= _FINAL
    return out ^ (out >> _SHIFT)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes | None]:
    for text in batch.column(column).cast(pa.large_binary()):
        yield text.as_py()


def frequency_sketch(docs: DataFrame, size: int) -> np.ndarray:
    """About how often the shingles of each of 2 ** SKETCH_BITS hash classes occur.

    Only classes that stand out in some task are reported, so the result is 0 for rare shingles.
    It decides nothing but the global order of the tokens, and any order gives the same links.
    """
    shift = np.uint64(64 - SKETCH_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        held, many = [], 0
        for batch in batches:
            for text in _texts(batch, 0):
                held.append((shingle_hashes(text, size) >> shift).astype(np.int64))
                many += len(held[-1])
                if many > 1 << 19:
                    total += np.bincount(np.concatenate(held), minlength=len(total))
                    held, many = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        mean = total.mean()
        out = np.flatnonzero(total >= max(2, mean + 6 * mean ** 0.5))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(total[out])],
                                         names=["class", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(count, "class long, n long")
    summed = rows.groupBy("class").agg(F.sum("n").alias("n")).toArrow()
    sketch = np.zeros(1 << SKETCH_BITS, np.int32)
    sketch[summed.column("class").to_numpy()] = np.minimum(summed.column("n").to_numpy(),
                                                           np.iinfo(np.int32).max)
    return sketch


SIGNED = (f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, doc_id long, n int, print binary, home long, "
          "prefix array<long>")


def signatures(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Each row's set size, set digest, home and rarest tokens, in the shared folder.

    The home, by which sets are grouped, is the smallest hash in the rarer half of the tokens:
    sets that share a frequent passage and little else have different homes.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequency_sketch(docs, size))
    shift = np.uint64(64 - SKETCH_BITS)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = sent.value
        for batch in batches:
            sizes, prints, homes, prefixes, lengths = [], [], [], [], [0]
            for text in _texts(batch, 3):
                tokens = np.unique(shingle_hashes(text, size))
                n = len(tokens)
                sizes.append(n)
                prints.append(xxhash.xxh3_128_digest(tokens.tobytes()) if n else None)
                keep = n - -(-percent * n // 100) + 1 if n else 0
                often = sketch[(tokens >> shift).astype(np.int64)]
                if often.any():
                    tokens = tokens[np.argsort(often, kind="stable")]
                homes.append(int(tokens[:n // 2 + 1].min().view(np.int64)) if n else None)
                prefixes.append(tokens[:keep].view(np.int64))
                lengths.append(lengths[-1] + keep)
            flat = np.concatenate([*prefixes, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes, pa.int32()), pa.array(prints, pa.binary()),
                 pa.array(homes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat))],
                names=[f.split()[0] for f in SIGNED.split(", ")])

    rows = docs.select(*ROW_KEY, F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stage(rows.mapInArrow(sign, SIGNED), "signatures")


def token_groups(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct sets, one row each without its tokens, in groups of bounded size.

    Sets with an equal home are one group, from ``GROUP_SETS`` sets on; a large one is split.
    Other sets are groups of their own. Copies of a set are counted before they are shuffled, and
    their tokens stay where they are. Beside the sets, the shared homes and the number of their
    parts.
    """
    sets = rows.where("n > 0").groupBy("print").agg(
        F.min(F.struct(*ROW_KEY, "n", "home")).alias("s"))
    sets = stage(sets.select("print", "s.*"), "distinct_sets")
    sizes = sets.groupBy("home").agg(F.sum("n").alias("all"), F.count("*").alias("sets"))
    homes = stage(sizes.where(F.col("sets") >= GROUP_SETS).select(
        "home", F.ceil(F.col("all") / GROUP_SHINGLES).alias("parts")), "shared_homes")
    return stage(grouped(sets, homes), "sets"), homes


def grouped(rows: DataFrame, homes: DataFrame) -> DataFrame:
    """``rows`` with their group, whether it is ``shared`` by sets and its home ``split``."""
    part = F.pmod(F.xxhash64("print"), F.col("parts"))
    group = F.when(F.col("parts").isNull(), F.xxhash64("home", "print")).otherwise(
        F.xxhash64("home", part))
    return rows.join(homes, "home", "left").select(
        *[rows[c] for c in rows.columns], group.alias("group"),
        F.col("parts").isNotNull().alias("shared"),
        F.coalesce(F.col("parts") > 1, F.lit(False)).alias("split"))


def marks(df: DataFrame, *columns: str) -> np.ndarray:
    """A bit map of fixed size with a bit set for the hash of each row's ``columns``."""
    bits = np.zeros(MARK_BITS // 8, np.uint8)
    words = (df.select(spot(*columns).alias("spot")).distinct()
             .groupBy((F.col("spot") / 64).cast("long").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(spot % 64 as int)))").alias("bits"))
             .toArrow())  # at most MARK_BITS / 64 rows
    bits.view(np.int64)[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bits


def spot(*columns: str) -> Column:
    """The place of a row's bit in a map of :func:`marks`."""
    return F.pmod(F.xxhash64(*columns), F.lit(MARK_BITS))


def marked(bits: np.ndarray, spots: pa.Array) -> np.ndarray:
    """Whether the bits at ``spots`` are set."""
    at = spots.to_numpy()
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def candidate_groups(rows: DataFrame, sets: DataFrame, homes: DataFrame, percent: int
                     ) -> DataFrame:
    """Pairs of groups (``home_group`` < ``query_group``) whose members might be linked.

    The matrix has a row per token and group whose members' prefixes hold it, with their least
    and greatest set size and the most tokens that follow it in a member. Three bounds hold for
    linked sets of sizes x <= y, which share p (x + y) / (1 + p) tokens:

    * what precedes a shared token in either set, itself and what follows it in either set are at
      least as many;
    * so are the m tokens that the prefixes share and what follows the last of these in either;
    * m > p (x + y) / (1 + p) - p y, as else m and what follows the shorter prefix are too few.
      That grows with x and falls with y, and a group's union shares at least what a member
      shares: for groups this bound is taken at the least x and the greatest y.
    """
    sent = rows.sparkSession.sparkContext.broadcast(marks(sets, *ROW_KEY))

    def first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(marked(sent.value, batch.column("spot"))))
            yield pa.RecordBatch.from_arrays(batch.columns[:4],
                                             names=["print", "n", "home", "prefix"])

    # a copy that the bit map lets through by chance adds to a count, and never removes a pair
    kept = rows.where("n > 0").select(
        "print", "n", "home", "prefix", spot(*ROW_KEY).alias("spot")).mapInArrow(
            first_copies, "print binary, n int, home long, prefix array<long>")
    cells = grouped(kept, homes).select(
        F.posexplode("prefix").alias("place", "token"), "group", "n", "shared").withColumn(
            "rest", F.col("n") - F.col("place") - 1)
    alone = cells.where(~F.col("shared")).select(
        "token", "group", F.col("n").alias("low"), F.col("n").alias("high"), "rest", "shared")
    union = cells.where("shared").groupBy("token", "group").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("rest"),
        F.lit(True).alias("shared"))
    matrix = alone.union(union)
    a, b = matrix.alias("a"), matrix.alias("b")
    p = percent / 100
    near = ((F.col("a.high") * 100 >= F.col("b.low") * percent)
            & (F.col("b.high") * 100 >= F.col("a.low") * percent))
    sets_only = ~F.col("a.shared") & ~F.col("b.shared")
    rest = F.least("a.rest", "b.rest")
    enough = p / (1 + p) * (F.col("a.low") + F.col("b.low")) - 1e-6
    before = F.least(F.col("a.low") - F.col("a.rest"), F.col("b.low") - F.col("b.rest"))

    def least(low: Column, high: Column) -> Column:
        high = F.least(high.cast("double"), low / p)
        return p * (low + high) / (1 + p) - p * F.greatest(low.cast("double"), high)

    # sizes differ between a group's tokens, so the widest range of them counts
    pairs = (a.join(b, (F.col("a.token") == F.col("b.token"))
                    & (F.col("a.group") < F.col("b.group")) & near
                    & (~sets_only | (before + rest >= enough)))
             .groupBy(F.col("a.group").alias("home_group"), F.col("b.group").alias("query_group"))
             .agg(F.count("*").alias("m"), F.min("a.low").alias("al"), F.max("a.high").alias("ah"),
                  F.min("b.low").alias("bl"), F.max("b.high").alias("bh"),
                  F.min(rest).alias("rest"), F.first(enough).alias("enough"),
                  F.first(sets_only).alias("sets_only")))
    return pairs.where(F.when(F.col("sets_only"), F.col("m") + F.col("rest") >= F.col("enough"))
                       .otherwise(True)
                       & (F.col("m") > F.least(least(F.col("al"), F.col("bh")),
                                               least(F.col("bl"), F.col("ah"))) - 1e-6)
                       ).select("home_group", "query_group")


def full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Tokens of the wanted rows' sets, and by chance of a few others: row key and ``tokens``.

    A bit map of fixed size lets the scan pass over most rows that are not wanted.
    """
    sent = docs.sparkSession.sparkContext.broadcast(marks(wanted, *ROW_KEY))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(marked(sent.value, batch.column(3))))
            tokens = [np.unique(shingle_hashes(t, size)).tobytes() for t in _texts(batch, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tokens, pa.binary())],
                names=[*ROW_KEY, "tokens"])

    rows = docs.select(*ROW_KEY, F.col("text").cast("string"), spot(*ROW_KEY).alias("spot"))
    return rows.mapInArrow(read, f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, tokens binary")


class Group:
    """An open group: its members' tokens as lists of members by token."""

    def __init__(self, prints: list[bytes], labels: list, sets: list[np.ndarray]) -> None:
        self.prints, self.labels = prints, labels
        self.sizes = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate([*sets, np.zeros(0, np.uint64)])
        order = np.argsort(every, kind="stable")
        self.members = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.union, self.first, self.many = np.unique(every[order], return_index=True,
                                                      return_counts=True)

    def linked(self, tokens: np.ndarray, percent: int) -> np.ndarray:
        """Members whose Jaccard similarity with a set reaches the threshold."""
        at = np.searchsorted(self.union, tokens)
        at[at == len(self.union)] = 0
        at = at[self.union[at] == tokens]
        if 100 * len(at) < percent * len(tokens):
            return np.zeros(0, np.int64)  # the union bounds the overlap with any member
        many = self.many[at]
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        shared = np.bincount(self.members[np.repeat(self.first[at], many) + inside],
                             minlength=len(self.sizes))
        return np.flatnonzero(100 * shared >= percent * (self.sizes + len(tokens) - shared))


EDGE = "a binary, b binary"
#: What a set is in an opened group.
MEMBER, BOTH, QUERY = 0, 1, 2


def open_groups(docs: DataFrame, own: DataFrame, pairs: DataFrame, sets: DataFrame, size: int,
                percent: int) -> DataFrame:
    """Links between members of the ``own`` groups and of the paired ones, as few as connect
    what is linked, in the shared folder.

    ``own`` has ``group``, ``pairs`` home_group and query_group, ``sets`` group, print, n, label
    and the row key. Where the sets go is worked out without their tokens; then the tokens are
    taken from the texts and sent there once. A task holds one group's members and streams the
    queries; a group with many queries is opened by several tasks. Sets with an equal label are
    known to be connected and not compared.
    """
    loads = sets.groupBy("group").agg(F.sum("n").alias("load"))
    asked = (pairs.join(loads.withColumnRenamed("group", "query_group"), "query_group")
             .groupBy(F.col("home_group").alias("group"))
             .agg(F.ceil(F.sum("load") / QUERY_SHINGLES).alias("chunks")))
    every = asked.join(own.select("group", F.lit(True).alias("own")), "group", "full").select(
        "group", F.coalesce("chunks", F.lit(1)).cast("long").alias("chunks"),
        F.coalesce("own", F.lit(False)).alias("own"))
    every = stage(every, "opened_groups")
    columns = ["print", "label", *ROW_KEY]
    chunk = F.pmod(F.xxhash64("print"), F.col("chunks"))
    homes = (sets.join(every, "group")
             .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                       F.col("chunks") - 1)))
             .select(F.col("group").alias("home_group"), "chunk",
                     F.when(F.col("own") & (F.col("chunk") == chunk), BOTH).otherwise(MEMBER)
                     .alias("role"), *columns))
    queries = (pairs.join(sets, pairs["query_group"] == sets["group"]).drop("group")
               .join(every.select(F.col("group").alias("home_group"), "chunks"), "home_group")
               .select("home_group", chunk.alias("chunk"), F.lit(QUERY).alias("role"), *columns))
    routes = stage(homes.union(queries), "routes")
    key = ["home_group", "chunk"]

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = itertools.chain.from_iterable(
            zip(*(c.to_pylist() for c in b.columns), strict=True) for b in batches)
        for _, group in itertools.groupby(rows, key=lambda r: r[:2]):
            found = list(_open(group, percent))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[i] for f in found], pa.binary()) for i in range(2)],
                    names=["a", "b"])

    # routes grow with the texts, so they are never broadcast and the plan is the same at any size
    sent = full_sets(docs, routes, size).join(routes.hint("merge"), ROW_KEY).drop(*ROW_KEY)
    sent = sent.select(*key, "role", "print", "label", "tokens")
    together = sent.repartition(*key).sortWithinPartitions(*key, "role", "print")
    return stage(together.mapInArrow(links, EDGE), "links")


def _open(rows: Iterator[tuple], percent: int) -> Iterator[tuple[bytes, bytes]]:
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    prints, labels, sets, both = [], [], [], []
    first_query = None
    for _, _, role, print_, label, tokens in rows:
        if role == QUERY:
            first_query = (print_, label, np.frombuffer(tokens, np.uint64))
            break
        if role == BOTH:
            both.append(len(prints))
        prints.append(print_)
        labels.append(label)
        sets.append(np.frombuffer(tokens, np.uint64))
    group, same = Group(prints, labels, sets), set(labels)
    asked = itertools.chain(
        ((prints[i], labels[i], sets[i]) for i in both), [first_query] if first_query else [],
        ((r[3], r[4], np.frombuffer(r[5], np.uint64)) for r in rows))
    for print_, label, tokens in asked:
        if label is not None and same == {label}:
            continue
        for m in group.linked(tokens, percent).tolist():
            other = prints[m]
            if other != print_ and (a := find(other)) != (b := find(print_)):
                root[a] = b
                yield other, print_


def links(docs: DataFrame, size: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows of ``docs`` (keyed), and links that connect their distinct sets.

    First the groups of split homes are opened for their own members and for one set of the home;
    that is linear in the copies of a much-copied text and connects most of them. Then all groups
    are opened for their own members and for their candidates, but those whose members are all
    connected already are not opened for each other.
    """
    rows = signatures(docs, size, percent)
    sets, homes = token_groups(rows)
    pairs = stage(candidate_groups(rows, sets, homes, percent), "group_pairs")
    slim = ["group", "print", "n", *ROW_KEY]
    split = sets.where("split").withColumn("label", F.lit(None).cast("binary"))
    # the head of a split home is a query to all its groups, under a group of its own
    head_group = F.xxhash64("home", F.lit(-1))
    heads = split.groupBy("home").agg(
        F.min(F.struct("print", "n", *ROW_KEY)).alias("s")).select(
            head_group.alias("group"), "s.*", F.lit(None).cast("binary").alias("label"))
    to_heads = split.select(F.col("group").alias("home_group"),
                            head_group.alias("query_group")).distinct()
    near = open_groups(docs, split.select("group").distinct(), to_heads,
                       split.select(*slim, "label").union(heads.select(*slim, "label")), size,
                       percent)

    label = components(near).select(F.col("node").alias("print"), F.col("root").alias("label"))
    own = sets.where("shared and not split").select("group").distinct()
    of_pairs = (pairs.select(F.col("home_group").alias("group"))
                .union(pairs.select("query_group")).union(own))
    labelled = stage(sets.join(of_pairs.distinct(), "group", "left_semi").select(*slim)
                     .join(label, "print", "left").select(*slim, "label"), "labelled")
    pure = labelled.groupBy("group").agg(
        F.when((F.min("label") == F.max("label")) & (F.count("label") == F.count("*")),
               F.min("label")).alias("only"))
    pure = pure.join(labelled.groupBy("group").agg(F.sum("n").alias("load")), "group")

    def side(pair: str, group: str) -> DataFrame:
        return pure.select(F.col("group").alias(pair), F.struct("load", "group", "only")
                           .alias(group))

    # the smaller group's members are sent to the larger one
    left = (pairs.join(side("home_group", "a"), "home_group")
            .join(side("query_group", "b"), "query_group")
            .where("a.only is null or b.only is null or a.only <> b.only")
            .select(F.greatest("a", "b")["group"].alias("home_group"),
                    F.least("a", "b")["group"].alias("query_group")))
    far = open_groups(docs, own, stage(left, "left_pairs"), labelled, size, percent)
    return rows, near.union(far)


def similar_documents(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """The component of each document under links of at least ``percent`` percent similarity.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A document's set holds its
    distinct shingles of ``size`` words (white space separates words, A to Z are in lower case);
    a text of fewer words is one shingle, a null or blank text has none and is linked with
    nothing. Returns one row per input row: the row key, doc_id, n_shingles, component_id (the
    smallest id reachable by links, null if there is none), first (whether the row is the first
    of its component by id, no id last, then by its place). Equal sets are compared once, whatever
    the number of their copies. Shingles are told apart by 64-bit hashes. An empty table gives no
    rows.
    """
    docs = keyed(docs)
    rows, found = links(docs, size, percent)
    slim = rows.select(*ROW_KEY, "doc_id", F.col("n").cast("long").alias("n_shingles"), "print")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW_KEY)
    least = slim.where("print is not null").groupBy("print").agg(F.min(order).alias("least"))
    member = components(found).select(F.col("node").alias("print"), "root")
    least = stage(least.join(member, "print", "left")
                  .withColumn("root", F.coalesce("root", "print")), "sets_of_components")
    heads = least.groupBy("root").agg(F.min("least").alias("head"))
    of = least.select("print", "root").join(heads, "root").select("print", "head")
    out = slim.join(of, "print", "left")
    key = F.struct(*ROW_KEY)
    return out.select(
        *ROW_KEY, "doc_id", "n_shingles",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id"))
        .alias("component_id"),
        (F.col("head").isNull() | (F.struct(*[F.col(f"head.{c}") for c in ROW_KEY]) == key))
        .alias("first"))


def one_per_group(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """The first row of each component, with the columns it came with; texts without words stay."""
    rows = keyed(docs)
    gone = stage(similar_documents(rows, size, percent).where(~F.col("first")).select(*ROW_KEY),
                 "gone")
    return rows.join(gone, ROW_KEY, "left_anti").drop(*ROW_KEY)

"""Secret scan with corpus-wide ownership of each candidate, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.common import ROW_KEY, keyed, stage

#: The patterns of the kinds, in the order of the kinds. A hex or access run that is
#: too short cannot hide a longer one, so their least lengths stand in the pattern.
ASSIGN = ("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
          "[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
          "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
VENDOR = ("gh[opsur]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|"
          "[ps]k_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35,}")
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "vendor": VENDOR}
BASE = ("assign", "access", "hex")
KINDS = [*PATTERNS, "live"]

#: A value that more owners than this show is an example, not a secret.
MOST_OWNERS = 2
#: So is one that more different texts show, whoever owns them.
MOST_TEXTS = 100
#: Owners decide from so many different texts on: 1 counts the owners of copies of a single text.
LEAST_TEXTS = 1

SHOWN = "array<struct<start:bigint,kind:int,end:bigint,owners:bigint,texts:bigint>>"


def _parts(text: Column) -> Column:
    """For each kind that occurs: the text between its matches, and the matches."""
    def cut(number: int, pattern: str) -> Column:
        both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
        parts = F.transform(both, lambda x: F.struct(
            F.lit(number).alias("kind"), F.length(x["gap"]).alias("gap"),
            x["match"].alias("match")))
        return F.when(text.rlike(pattern), parts).otherwise(
            F.array().cast("array<struct<kind:int,gap:int,match:string>>"))

    return F.concat(*[cut(i, p) for i, p in enumerate(PATTERNS.values())])


def candidates(docs: DataFrame) -> DataFrame:
    """Every match of every kind that passes its length: row key, owner, kind, span and value.

    A match begins where the texts and matches before it in its kind end, a running sum over the
    matches of one kind in one text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = keyed(docs).select(*ROW_KEY, F.coalesce(F.col("source").cast("string"), F.lit(""))
                              .alias("owner"), text.alias("text"))
    cut = stage(rows.select(*ROW_KEY, "owner", F.xxhash64("text").alias("repository"),
                            F.posexplode(_parts(F.col("text"))).alias("nth", "part"))
                .select(*ROW_KEY, "owner", "repository", "nth", "part.*"), "parts")
    order = Window.partitionBy(*ROW_KEY, "kind").orderBy("nth")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    start = F.sum("gap").over(order) + F.coalesce(F.sum(F.length("match")).over(before),
                                                  F.lit(0))
    value = F.when(F.col("kind") == 0, F.regexp_extract("match", ASSIGN, 2)).otherwise(
        F.col("match"))
    return (cut.withColumn("start", start).where(F.col("match").isNotNull())
            .withColumn("end", F.col("start") + F.length("match")).withColumn("value", value)
            .where((F.col("kind") != 0) | (F.length("value") >= 8)).drop("nth", "gap", "match"))


def ownership(found: DataFrame) -> DataFrame:
    """Owners and different texts of each value in the whole corpus, by the value's digest.

    Copies within an owner, or of a text, are counted first, so a value that is in a third of all
    rows is small before it is shuffled by its digest alone. A text's copies count once, in
    whichever owners they are.
    """
    def distinct(what: str, count: str) -> DataFrame:
        return found.groupBy("digest", what).agg(F.count("*").alias("n")).groupBy("digest").agg(
            F.count("*").alias(count))

    return distinct("owner", "owners").join(distinct("repository", "texts"), "digest")


def looks_random(value: Column) -> Column:
    """Letters and digits mixed, at least eight different characters."""
    return (value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= 8))


def scan(docs: DataFrame, most_owners: int = MOST_OWNERS, most_texts: int = MOST_TEXTS,
         least_texts: int = LEAST_TEXTS) -> DataFrame:
    """Secrets of every whole text, with the owner-specific ones marked.

    ``docs`` has ``doc_id``, ``text`` and ``source`` (the owner); other columns are ignored.
    Returns one row per input row: doc_id, n_assign, n_access, n_hex, base_sha256 (of
    kind:start:end of these three kinds), spans (these, the vendors' formats, and ``live`` for
    the value of a candidate that looks random and is no example), n_vendor, n_live, n_example
    (candidates that are examples) and shown (kind, start, end, owners and texts of each
    candidate). A value is an example when more than ``most_texts`` different texts of the whole
    corpus show it, or when more than ``most_owners`` owners do and at least ``least_texts``
    different texts; with 2, a text that is merely copied between owners keeps its live values.
    Spans are in code points, ordered by start and kind. A null text is empty, a null source one
    more owner; null and repeated ids keep their rows. Texts without candidates have counts 0, an
    empty ``spans`` and the digest of the empty string.

    Texts are read once and not shuffled; candidates are a few rows per text that has any.
    """
    docs = keyed(docs)
    rows = docs.select(*ROW_KEY, F.col("doc_id").cast("long").alias("doc_id"))
    found = stage(candidates(docs).withColumn("digest", F.sha2("value", 256)), "candidates")
    owned = found.join(stage(ownership(found), "ownership"), "digest")
    owned = owned.withColumn("example", (F.col("texts") > most_texts) | (
        (F.col("owners") > most_owners) & (F.col("texts") >= least_texts)))
    live = owned.where(~F.col("example") & looks_random(F.col("value"))).select(
        *ROW_KEY, F.lit(KINDS.index("live")).alias("kind"),
        (F.col("end") - F.length("value")).alias("start"), "end", "example", "owners",
        "texts").distinct()
    every = owned.select(*ROW_KEY, "kind", "start", "end", "example", "owners", "texts").union(
        live)

    def written(spans: Column) -> Column:
        text = F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1),
            s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(text, ",")

    def number(kind: str) -> Column:
        return F.count_if(F.col("kind") == KINDS.index(kind)).alias(f"n_{kind}")

    spans = every.groupBy(*ROW_KEY).agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"),
        *map(number, KINDS), F.count_if("example").alias("n_example"),
        F.array_sort(F.collect_list(F.when(F.col("kind") < len(PATTERNS), F.struct(
            "start", "kind", "end", "owners", "texts")))).alias("shown"))
    out = rows.join(spans, ROW_KEY, "left")
    listed = F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    base = F.filter(listed, lambda s: s["kind"] < len(BASE))
    counts = [F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in KINDS]
    return out.select(
        "doc_id", *counts[:len(BASE)], F.sha2(written(base), 256).alias("base_sha256"),
        written(listed).alias("spans"), *counts[len(BASE):],
        F.coalesce("n_example", F.lit(0)).alias("n_example"),
        F.transform(
            F.coalesce("shown", F.array().cast(SHOWN)), lambda s: F.struct(
                F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"),
                s["start"].alias("start"), s["end"].alias("end"), s["owners"].alias("owners"),
                s["texts"].alias("texts"))).alias("shown"))

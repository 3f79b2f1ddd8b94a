"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What the models read of a text: a to z for letters in either case, a blank for every other ASCII
#: byte, and the non-ASCII bytes as they are. Numbers, keys and capitals say nothing of a language.
FOLDED = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256)], np.uint8)
ORDER = 3
#: Blanks stand before a text.
BEFORE = 0x202020
#: Bytes scored at a time.
CHUNK = 1 << 20
#: What a text may cost per byte in its language: as much as this share of the rows learned from
#: in any language, and in any case five of a byte's eight bits. It is rejected when the whole text
#: costs so many bits more than that, which a few short words never do.
LIMIT_SHARE = 0.999
LIMIT_BITS = 5.0
LIMIT_EVIDENCE = 64
#: Different runs of four bytes that a task holds before it passes their counts on, and as many as
#: it passes on at a time.
HELD, EMITTED = 1 << 20, 1 << 16
#: Most bytes of a model's table. The rarest contexts stay out of a table that would be larger.
TABLE_BYTES = 128 << 20


def contexts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The three bytes before each position as one number, the nearest in its lowest byte."""
    wide = data.astype(np.int32)
    out = np.zeros(len(wide), np.int32)
    for back in range(1, ORDER + 1):
        out[back:] |= wide[:-back] << 8 * (back - 1)
    ends = np.append(starts[1:], len(wide))
    for place in range(min(ORDER, len(wide))):
        at = (starts + place)[starts + place < ends]
        own = (1 << 8 * place) - 1
        out[at] = (out[at] & own) | (BEFORE & ~own)
    return out


def coded(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each folded byte with the three before it as one number, the byte itself lowest."""
    data = FOLDED[data]
    return contexts(data, starts).astype(np.int64) << 8 | data


class Model:
    """Frozen context trees of several languages, compiled into one table of code lengths.

    A context of order k codes a byte that it has seen n times among N with n / (N + U), where U
    counts its distinct bytes; the escape U / (N + U) goes to the order below, over the bytes not
    seen here. Below order 0 all 256 bytes are equally likely. ``bits`` holds the resulting exact
    code lengths of each folded byte in each language after each known context.

    Bytes that nobody learned cost the same everywhere and are in no known context, so they share
    symbol 0 (``symbol``, ``alike`` bytes) and tables grow with the bytes in use. ``slot`` leads
    from the two bytes before to their known context, ``node`` from there and the third to the
    longest one.
    """

    def __init__(self, languages: list[str], grams: list[tuple[np.ndarray, np.ndarray]],
                 least: int) -> None:
        """``grams``: per language the numbers of :func:`coded` and their counts."""
        self.languages = languages
        every = np.concatenate([np.zeros(0, np.int64), *(codes for codes, _ in grams)])
        many = np.concatenate([np.zeros(0, np.int64), *(counts for _, counts in grams)])
        used = np.unique(np.concatenate([[BEFORE & 255], *(every >> 8 * k & 255
                                                           for k in range(ORDER + 1))]))
        self.symbol = np.zeros(256, np.int32)
        self.symbol[used] = np.arange(1, len(used) + 1)
        self.size, self.alike = len(used) + 1, 256 - len(used)
        seen = [(np.zeros(1, np.int64), np.full(1, np.inf))]
        for k in range(1, ORDER + 1):
            found, place = np.unique(every >> 8 & (1 << 8 * k) - 1, return_inverse=True)
            total = np.bincount(place, many, len(found))
            seen.append((found, total if k > 1 else np.full(len(found), np.inf)))
        room = TABLE_BYTES // (4 * self.size * max(len(languages), 1))
        totals = np.concatenate([total for _, total in seen])
        if np.count_nonzero(totals >= least) > room:
            # more than the first that has no room
            least = np.partition(totals, -room - 1)[-room - 1] + 1
        nodes = [found[total >= least] for found, total in seen]
        first = np.cumsum([0, *map(len, nodes)])
        self._index(nodes, first)
        table = np.zeros((first[-1], self.size, len(languages)), np.float32)
        for language, (codes, counts) in enumerate(grams):
            rows = np.full((1, self.size), 1 / 256)
            for k in range(ORDER + 1):
                short = codes & (1 << 8 * (k + 1)) - 1
                where = np.searchsorted(nodes[k], short >> 8)
                seen = np.zeros((len(nodes[k]), self.size))
                ok = where < len(nodes[k])
                ok[ok] = nodes[k][where[ok]] == (short >> 8)[ok]
                np.add.at(seen, (where[ok], self.symbol[short & 255][ok]), counts[ok])
                # the context's suffix is the longest known one of a lower order
                lower = rows[self._suffix(nodes[k], k, nodes, first)] if k else rows
                mixed = self._blend(seen, lower)
                rows = np.concatenate([rows, mixed]) if k else mixed
            table[:, :, language] = -np.log2(rows)
        self.bits = table.reshape(len(table) * self.size, len(languages))

    def _index(self, nodes: list[np.ndarray], first: np.ndarray) -> None:
        size, pairs, triples = self.size, nodes[2], nodes[3]
        one = np.zeros(size, np.int32)
        one[self.symbol[nodes[1]]] = first[1] + np.arange(len(nodes[1]))
        # a slot for each nearest byte alone, then one for each known pair
        self.slot = np.tile(np.arange(size, dtype=np.int32), size)
        self.slot[self.symbol[pairs >> 8] * size + self.symbol[pairs & 255]] = (
            size + np.arange(len(pairs)))
        self.node = np.repeat(np.concatenate(
            [one, (first[2] + np.arange(len(pairs))).astype(np.int32)]), size)
        at = size + np.searchsorted(pairs, triples & 0xFFFF)
        self.node[at * size + self.symbol[triples >> 16]] = first[3] + np.arange(len(triples))

    @staticmethod
    def _suffix(codes: np.ndarray, k: int, nodes: list[np.ndarray], first: np.ndarray
                ) -> np.ndarray:
        out = np.zeros(len(codes), np.int64)
        for j in range(1, k):
            short = codes & (1 << 8 * j) - 1
            at = np.minimum(np.searchsorted(nodes[j], short), max(len(nodes[j]) - 1, 0))
            hit = nodes[j][at] == short if len(nodes[j]) else np.zeros(len(codes), bool)
            out = np.where(hit, first[j] + at, out)
        return out

    def _blend(self, seen: np.ndarray, lower: np.ndarray) -> np.ndarray:
        total, kinds = seen.sum(axis=1, keepdims=True), (seen > 0).sum(axis=1, keepdims=True)
        unseen = np.where(seen > 0, 0, lower)
        rest = unseen.sum(axis=1, keepdims=True) + (self.alike - 1) * unseen[:, :1]
        escape = np.where(rest > 0, kinds, 0)
        under = np.where(total > 0, total + escape, 1)
        share = np.where(total > 0, escape / under, 1)
        return seen / under + share * unseen / np.where(rest > 0, rest, 1)

    def code_lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits per text and language; ``starts`` are the first bytes of non-empty texts."""
        out = np.zeros((len(starts), len(self.languages)))
        if not len(starts):
            return out
        for begin in range(0, len(data), CHUNK):
            end = min(len(data), begin + CHUNK)
            early = max(0, begin - ORDER)
            text = FOLDED[data[early:end]]
            here = starts[(starts >= early) & (starts < end)] - early
            after = contexts(text, here)[begin - early:]
            slot = self.slot[self.symbol[after >> 8 & 255] * self.size + self.symbol[after & 255]]
            node = self.node[slot * self.size + self.symbol[after >> 16]]
            rows = node.astype(np.int64) * self.size + self.symbol[text[begin - early:]]
            first = np.searchsorted(starts, begin, side="right") - 1
            last = np.searchsorted(starts, end, side="left")
            cuts = np.maximum(starts[first:last] - begin, 0)
            out[first:last] += np.add.reduceat(self.bits[rows], cuts, axis=0, dtype=np.float64)
        return out


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes end to end and each text's length; a null has none."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:][:len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], np.diff(offsets)


def held_out(doc_id) -> object:
    """Whether a row is kept from learning: crc32 of the id as text divides by 5, or no id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def known(docs: DataFrame) -> tuple[list[str], DataFrame]:
    """The languages to learn, and the rows (``lang``, ``text``) to learn them from.

    These are all rows with a text and a language that are not held out.
    """
    usable = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text")).where(
            ~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages = sorted(r["lang"] for r in usable.select("lang").distinct().collect())
    return languages, usable.select("lang", "text")


def fit(docs: DataFrame, least: int = 4) -> Model:
    """The model of the rows of :func:`known`; see :func:`learn`."""
    return learn(*known(docs), least)


def _summed(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(np.concatenate(codes), return_inverse=True)
    return found, np.bincount(place, np.concatenate(counts), len(found)).astype(np.int64)


def learn(languages: list[str], rows: DataFrame, least: int = 4) -> Model:
    """Count the contexts of all rows and freeze them.

    A context of two or three symbols counts from ``least`` occurrences on, and from more when
    the table would outgrow ``TABLE_BYTES``. The counts are summed in each task and again before
    they reach the driver; there are as many as the rows have different runs of four folded bytes.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: dict[str, tuple[list, list]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name in sorted(pending):
                codes, counts = _summed(*pending[name])
                for at in range(0, len(codes), EMITTED):
                    n = len(codes[at:at + EMITTED])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * n, pa.string()), pa.array(codes[at:at + EMITTED]),
                         pa.array(counts[at:at + EMITTED])], names=["lang", "code", "n"])
            pending.clear()

        for batch in batches:
            names = np.array(batch.column(0).to_pylist())
            for name in sorted(set(names.tolist())):
                chosen = batch.column(1).filter(pa.array(names == name))
                data, lengths = _flat(chosen)
                starts = (np.cumsum(lengths) - lengths)[lengths > 0]
                found, counts = np.unique(coded(data, starts), return_counts=True)
                mine = pending.setdefault(name, ([], []))
                mine[0].append(found)
                mine[1].append(counts)
                held += len(found)
            if held > HELD:
                for name, kept in pending.items():
                    codes, counts = _summed(*kept)
                    pending[name] = [codes], [counts]
                held = sum(len(codes[0]) for codes, _ in pending.values())
                if held > HELD // 2:
                    yield from flush()
                    held = 0
        yield from flush()

    counted = (rows.mapInArrow(count, "lang string, code long, n long")
               .groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow())
    names = np.array(counted.column("lang").to_pylist(), object)
    codes, counts = counted.column("code").to_numpy(), counted.column("n").to_numpy()
    grams = []
    for name in languages:
        mine = names == name
        grams.append((codes[mine], counts[mine]))
    return Model(languages, grams, least)


def predict(docs: DataFrame, model: Model | Broadcast, carry: list[str]) -> DataFrame:
    """lang_pred, score and bits_per_byte of each row, beside a struct ``row`` of ``carry``.

    The language is the one whose model codes the whole text in the fewest bits, the first by
    name of equals; the score is its share of the likelihood over all languages, each as likely
    beforehand. A text that is null or has no letters, and any text where nothing was learned,
    is ``und`` with score 0.
    """
    sent = (model if isinstance(model, Broadcast)
            else docs.sparkSession.sparkContext.broadcast(model))
    sources = list(dict.fromkeys([*carry, "text"]))
    text_at, names_out = sources.index("text"), ["row", "lang_pred", "score", "bits_per_byte"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            parts = batch.column(0).flatten()
            data, lengths = _flat(parts[text_at])
            letters = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            starts = np.cumsum(lengths) - lengths
            full = lengths > 0
            bits = np.zeros((batch.num_rows, len(model.languages)))
            if model.languages:
                bits[full] = model.code_lengths(data, starts[full])
                best, least = bits.argmin(axis=1), bits.min(axis=1)
                share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            else:
                best = least = share = np.zeros(batch.num_rows, np.int64)
                letters = letters & False
            row = pa.StructArray.from_arrays(parts[:len(carry)],
                                             fields=list(batch.column(0).type)[:len(carry)])
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(names[np.where(letters, best, -1)], pa.string()),
                 pa.array(np.where(letters, share, 0.0), pa.float64()),
                 pa.array(least / np.maximum(lengths, 1), pa.float64())], names=names_out)

    rows = docs.select(F.struct(*[docs[c] for c in sources]).alias("row"),
                       F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    kinds = {f.name: f for f in docs.schema}
    return rows.mapInArrow(score, T.StructType([
        T.StructField("row", T.StructType([kinds[c] for c in carry])),
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("bits_per_byte", T.DoubleType())]))


def identify(docs: DataFrame) -> DataFrame:
    """Predict the language of every whole text.

    ``docs`` has ``doc_id``, ``text`` and ``lang``; other columns are ignored. Returns one row
    per input row: doc_id, held_out, lang_pred, score, bits_per_byte. A row without an id is held
    out. See :func:`fit` and :func:`predict` for what is learned and for null, empty and
    letterless texts. One scan finds the labels, one learns, one predicts; nothing is shuffled but
    the counts. The broadcast model is bounded by ``TABLE_BYTES``.
    """
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    doc_id = F.col("row.doc_id")
    return predict(slim, fit(docs), ["doc_id"]).select(
        doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "lang_pred", "score",
        "bits_per_byte")


def limit(rows: DataFrame, model: Broadcast) -> float:
    """The greatest bits per byte of a text in its language, taken from all rows learned from.

    It is what ``LIMIT_SHARE`` of all these rows with letters do not exceed, and at least
    ``LIMIT_BITS``. The languages are judged together, so that one with few rows has a limit like
    any other, whatever the size of the corpus.
    """
    scored = predict(rows, model, ["lang"]).where("lang_pred <> 'und'")
    found = scored.agg(F.percentile_approx("bits_per_byte", LIMIT_SHARE, 10_000)).head()[0]
    return max(found or 0.0, LIMIT_BITS)


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in one of the languages learned, with the columns they came with.

    A row is rejected for one of two reasons: its text is null or has no letters, or the model of
    its language codes it in over ``LIMIT_EVIDENCE`` bits more than :func:`limit` allows for its
    bytes, as it does longer random strings and scripts that were not learned. Where nothing was
    learned, every text with letters stays. Beside the scans of :func:`identify`, one more scores
    the rows learned from.
    """
    languages, rows = known(docs)
    if not languages:
        return docs.where(F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)))
    model = docs.sparkSession.sparkContext.broadcast(learn(languages, rows))
    found = predict(docs, model, docs.columns).where(F.col("lang_pred") != "und")
    size = F.octet_length(F.col("row.text").cast("string"))
    over = (F.col("bits_per_byte") - limit(rows, model)) * size
    return found.where(over <= LIMIT_EVIDENCE).select([F.col("row").getField(c).alias(c) for c in docs.columns])

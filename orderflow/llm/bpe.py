"""Token counts by byte-pair merging with a heap and a linked list."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.common import worker_memory

#: Fixed value: the vocabulary's own split pattern.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

#: The same pieces, faster, for texts whose characters all lie below U+0240.
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ȿ", "0-9²³¹¼½¾"
COMMON_PIECES = re.compile(rf"[{_LETTER}]+|[{_NUMBER}]|'(?:s|t|re|ve|m|ll|d)|"
                           rf"[^\t-\r \x85\xa0{_LETTER}{_NUMBER}]+")
_HIGHER = bytes(range(0xC9, 0x100))

#: Words remembered per Python worker; beyond it the memory starts anew.
REMEMBERED = 500_000

#: Lower-case letters of the vocabulary's library that Python's tables lack, and the
#: sigma, which has one lower-case form there.
LOWER_ALSO = {"Σ": "σ", "\uA7CB": "\u0264", "\uA7DC": "\u019B"}


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = {b: chr(b) for b in shown}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(extra), extra + 1
    return [letters[b] for b in range(256)]


def read_merges(path: str) -> dict:
    """What counting needs of a vocabulary file: ids of single bytes, merges, special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
    letters = _byte_letters()
    pairs = {}
    for rank, (a, b) in enumerate(spec["model"]["merges"]):
        pairs.setdefault(vocab[a] << 17 | vocab[b], rank << 17 | vocab[a.removesuffix(suffix) + b])
    return {"inner": [vocab[x] for x in letters], "last": [vocab[x + suffix] for x in letters],
            "pairs": pairs, "special": [t["content"] for t in spec["added_tokens"]]}


def merged_length(word: bytes, inner: list[int], last: list[int], pairs: dict[int, int]) -> int:
    """Symbols left of one word when no adjacent pair can be merged any more.

    The symbols form a linked list. A heap holds each adjacent pair that has a rank; the pair of
    the lowest rank, the leftmost of equals, is merged first. Entries whose pair has changed
    meanwhile are skipped when they come up.
    """
    n = len(word)
    ids = [inner[b] for b in word]
    ids[-1] = last[word[-1]]
    find = pairs.get
    heap = []
    for i in range(n - 1):
        if (e := find(ids[i] << 17 | ids[i + 1])) is not None:
            heap.append(e << 32 | i)
    if not heap:
        return n
    heapq.heapify(heap)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    count = n
    while heap:
        top = heapq.heappop(heap)
        i, e = top & 0xFFFFFFFF, top >> 32
        j = right[i]
        if ids[i] < 0 or j >= n or find(ids[i] << 17 | ids[j]) != e:
            continue
        ids[i], ids[j] = e & 0x1FFFF, -1
        count -= 1
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            if (e := find(ids[i] << 17 | ids[k])) is not None:
                heapq.heappush(heap, e << 32 | i)
        if (h := left[i]) >= 0 and (e := find(ids[h] << 17 | ids[i])) is not None:
            heapq.heappush(heap, e << 32 | h)
    return count


class Counter(dict):
    """Tokens by word, counted at a word's first appearance."""

    def __init__(self, merges: dict) -> None:
        super().__init__()
        self.rules = merges["inner"], merges["last"], merges["pairs"]
        self.special = regex.compile("|".join(map(regex.escape, merges["special"])) or r"(?!)")

    def __missing__(self, word: str) -> int:
        n = self[word] = merged_length(word.encode(), *self.rules)
        return n

    def count(self, text: str) -> int:
        """Tokens of a text; special strings in it are one token each."""
        total = 0
        if "<|" in text:
            parts = self.special.split(text)
            total = len(parts) - 1
        else:
            parts = [text]
        for part in parts:
            total += sum(map(self.__getitem__, split_pieces(normalized(part))))
        if len(self) > REMEMBERED:
            self.clear()
        return total


def normalized(text: str) -> str:
    """NFC and lower case letter by letter, so a sigma at a word's end stays a plain sigma.

    White space needs no folding: no piece contains any.
    """
    if text.isascii():
        return text.lower()
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    for upper, lower in LOWER_ALSO.items():
        if upper in text:
            text = text.replace(upper, lower)
    return text.lower()


def split_pieces(text: str) -> list[str]:
    """The pieces of a normalised text that are merged on their own."""
    if text.isascii() or _no_higher(text.encode()):
        return COMMON_PIECES.findall(text)
    return PIECES.findall(text)


def _no_higher(text: bytes) -> bool:
    return len(text.translate(None, _HIGHER)) == len(text)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """Tokens of every whole text, without producing identifiers.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Returns one row per input
    row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit). A null text counts as
    empty: 0 bytes, 0 tokens. Null and repeated ids keep their rows. An empty table gives an
    empty table. No shuffle: each task streams its rows; the broadcast vocabulary is as large as
    its file.
    """
    spark: SparkSession = docs.sparkSession
    merges = spark.sparkContext.broadcast(read_merges(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_memory(f"counter {vocabulary}", lambda: Counter(merges.value))
        for batch in batches:
            sizes, tokens = [], []
            for text in batch.column(1).cast(pa.large_binary()):
                text = text.as_py() or b""
                sizes.append(len(text))
                tokens.append(counter.count(text.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return (rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))

"""WARC archives of pages, read back into a merged capture index."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.llm.common import ROW_KEY, fresh_path, keyed, stage

#: Records of one archive file. A file is read by one task, record by record.
FILE_RECORDS = 2000
#: Captures of one range of the merged index, about: what a task holds, packed, while it merges.
RANGE_ROWS = 100_000
#: Captures that a merging task unpacks of a run at a time.
OPEN_ROWS = 256

HEXES, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CAPTURE = ("archive string, position long, url_key string, captured string, page_id long, "
           "payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "intact boolean")


def base32_sha1(text: Column) -> Column:
    """SHA-1 of the text's UTF-8 bytes as 32 upper-case base32 letters."""
    digits = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), HEXES, BASE32)


def records(pages: DataFrame) -> DataFrame:
    """The text of one WARC record per page, without its closing empty lines.

    Pages with equal payloads are one group by length and SHA-1; the one with the largest id (no
    id comes last, then the first row) is the response. Only groups of more than one page are
    joined back, one row for each.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = keyed(pages).select(
        *ROW_KEY, F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"), html.alias("html"),
        F.octet_length(html).alias("size"), base32_sha1(html).alias("digest"))
    rank = F.struct(F.col("page_id").isNotNull(), "page_id", *[-F.col(c) for c in ROW_KEY],
                    *ROW_KEY)
    groups = rows.groupBy("digest", "size").agg(F.count("*").alias("n"), F.max(rank).alias("top"))
    twice = stage(groups.where("n > 1").select(
        "digest", "size", F.col("top.page_id").alias("first_id"),
        F.struct(*[F.col(f"top.{c}") for c in ROW_KEY]).alias("first_row")), "repeated_payloads")
    rows = rows.join(twice, ["digest", "size"], "left")
    again = F.col("first_row").isNotNull() & (F.col("first_row") != F.struct(*ROW_KEY))
    nl = F.lit("\r\n")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(again, http).otherwise(F.concat(http, "html"))

    def urn(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")),
                        F.lit(">"))

    # line ends inside a url would end its header line
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]", "")
    # a moment without a zone, so that the session's does not matter
    second = F.expr("timestampadd(SECOND, pmod(coalesce(page_id, 0), 1000000000) + 1000000000, "
                    "TIMESTAMP_NTZ'1970-01-01 00:00:00')").cast("string")
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")), F.lit("\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Date: "), F.translate(second, " ", "T"), F.lit("Z"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(again, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
                  "identical-payload-digest\r\nWARC-Refers-To: "), urn(F.col("first_id"))))
        .otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), nl, nl)
    return rows.select(F.concat(header, block).alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write the pages' records as gzip-compressed WARC files below ``path``.

    Spark's text writer ends each record with the two empty lines the format asks for, so its
    files are archives, and its committer replaces what a lost executor left undone.
    """
    (records(pages).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Position, headers and block of each record of an archive, by the lengths it states."""
    position = 0
    while line := stream.readline():
        start, size = position, len(line)
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no record at {position}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            size += len(line)
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            headers[name.lower()] = value.strip()
        length = int(headers["content-length"])
        block, end = stream.read(length), stream.read(4)
        if len(block) != length or end != b"\r\n\r\n":
            raise ValueError(f"broken record at {start}")
        position += size + len(line) + length + 4
        yield start, headers, block


def url_key(url: str) -> str:
    """The host's labels from the top down, then the rest, in lower case and without a fragment."""
    rest = url.partition("://")[2] or url
    host, slash, path = rest.partition("#")[0].partition("/")
    labels = host.rpartition("@")[2].lower().removeprefix("www.").split(":")[0].split(".")
    return ",".join(reversed(labels)) + ")" + slash + path.lower()


def _capture(archive: str, position: int, headers: dict[str, str], block: bytes) -> tuple:
    def page(name: str) -> int | None:
        text = headers.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text not in ("", "none") else None

    kind = headers["warc-type"]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(http.rpartition(b"Content-Length: ")[2])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    intact = (not payload) if kind == "revisit" else (
        stated == len(payload)
        and digest == base64.b32encode(hashlib.sha1(payload).digest()).decode())
    return (archive, position, url_key(headers.get("warc-target-uri", "")), headers["warc-date"],
            page("warc-record-id"), stated, digest, kind,
            page("warc-refers-to") if kind == "revisit" else None, intact)


def _order(row: Sequence) -> tuple:
    """URL key, time, then id and place in the archives."""
    return row[2], row[3], row[4] is not None, row[4] or 0, row[0], row[1]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


ARROW = pa.schema([
    ("archive", pa.string()), ("position", pa.int64()), ("url_key", pa.string()),
    ("captured", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("intact", pa.bool_())])
#: The merged index' order.
ORDER = ("url_key", "captured", "page_id", "archive", "position")
MERGED = ARROW.append(pa.field("place", pa.int64()))


def runs(spark: SparkSession, path: str) -> DataFrame:
    """One sorted run of captures per archive file below ``path``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                archive = name.rpartition("/")[2]
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_py())) as stream:
                    found = [_capture(archive, *record) for record in parse(stream)]
                yield _batch(sorted(found, key=_order), ARROW)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
             .select("path", "content"))
    return files.mapInArrow(read, CAPTURE)


class LoserTree:
    """K-way merge of sorted runs: each inner node keeps the loser of its last match.

    Taking the smallest row replays only the matches on its run's way to the root.
    """

    def __init__(self, sorted_runs: Sequence[Iterator[tuple]]) -> None:
        self.runs = list(sorted_runs)
        self.k = max(1, len(self.runs))
        self.heads: list[tuple | None] = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * self.k
        for i in range(self.k - 1, -1, -1):
            self._replay(i)

    def _next(self, i: int) -> tuple | None:
        row = next(self.runs[i], None) if self.runs else None
        return None if row is None else (_order(row), i, row)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x[:2] < y[:2])

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # while the tree fills, the first to come waits here
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while (head := self.heads[winner := self.losers[0]]) is not None:
            yield head[2]
            self.heads[winner] = self._next(winner)
            self._replay(winner)


def _slices(batches: Iterator[pa.RecordBatch]) -> list[list[pa.RecordBatch]]:
    """Rows that come archive by archive, cut into each archive's pieces, still packed."""
    slices: dict[str, list[pa.RecordBatch]] = {}
    for batch in batches:
        names = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
        for first, last in zip(cuts, cuts[1:], strict=False):
            if last > first:
                slices.setdefault(names[first], []).append(batch.slice(first, last - first))
    return list(slices.values())


def _opened(pieces: Sequence[pa.RecordBatch]) -> Iterator[tuple]:
    """The pieces' rows in their order, ``OPEN_ROWS`` unpacked at a time."""
    for piece in pieces:
        for first in range(0, piece.num_rows, OPEN_ROWS):
            some = piece.slice(first, OPEN_ROWS)
            yield from zip(*(c.to_pylist() for c in some.columns), strict=True)


def merge(sorted_runs: DataFrame, rows_per_batch: int = 5000) -> DataFrame:
    """All captures in the order of URL key, time, id and archive, with ``rank`` from 0.

    Sampled splitters over the whole order deal the runs' rows into ranges of about
    ``RANGE_ROWS``, so a URL with a third of all captures spans several. In its range a task finds
    each run's slice in the run's own order and merges the slices; it holds them packed and opens
    a few rows of each. Ranges follow each other, so a row's rank is its place in its range and
    the rows of the ranges before, which takes one small row per range. The merged index is
    written to the shared folder. The runs should be a staged table: they are counted first.
    """
    from pyspark import TaskContext

    def one_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [_opened(pieces) for pieces in _slices(batches)]
        base = TaskContext.get().partitionId() << 40
        out = []
        for n, row in enumerate(LoserTree(slices)):
            out.append((*row, base + n))
            if len(out) == rows_per_batch:
                yield _batch(out, MERGED)
                out = []
        if out:
            yield _batch(out, MERGED)

    spark = sorted_runs.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 -(-sorted_runs.count() // RANGE_ROWS))
    merged = stage(
        sorted_runs.repartitionByRange(ranges, *ORDER)
        .sortWithinPartitions("archive", *(c for c in ORDER if c != "archive"))
        .mapInArrow(one_range, CAPTURE + ", place long"), "merged")
    at = F.shiftright("place", 40)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    skipped = stage(merged.groupBy(at.alias("range")).agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skipped")), "ranges")
    inside = F.col("place").bitwiseAND((1 << 40) - 1)
    return (merged.withColumn("range", at).join(skipped, "range")
            .withColumn("rank", inside + F.col("skipped")).drop("range", "skipped", "place"))


def archive_captures(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write one record per page into archives, read them back and merge their indexes.

    ``pages`` has ``page_id``, ``url`` and ``html``; other columns are ignored. Returns one row
    per input row: the archive file, the record's position in it, url_key, captured, page_id,
    payload_bytes, payload_digest, record_type, refers_to, intact (the payload read back has the
    stated length and digest) and rank (the place in the order of :func:`merge`, from 0 and
    without gaps). Null html is empty; null ids and urls are kept, with ``none`` and an empty
    text in the record. Of rows with equal payloads the one with the largest id is the response,
    of equal ids the first row. An empty table gives no rows. ``path`` defaults to a new folder
    in the shared folder.
    """
    spark = pages.sparkSession
    path = path or fresh_path(spark, "archives")
    write_archives(pages, path)
    return merge(stage(runs(spark, path), "runs"))

"""WARC archives and a globally ordered index of their captures.

Pages become WARC records with Spark's text writer: the record separator of the format is
given as the line separator, so every file is a valid gzipped archive. Each file is a
run: its records are sorted by URL key and capture time. Reading parses whole archives
by their lengths. The index entries of all runs go to key ranges, and each range merges
its sorted segments with a loser tree, so the ranges in order hold the whole capture
history in order.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_mart.session import scratch_dir

from .common import stored, text_bytes

#: Payload bytes of an archive, about.
ARCHIVE_BYTES = 16 << 20
#: Index entries of a key range, about.
RANGE_ROWS = 200_000
#: Fixed values of the format.
SEPARATOR = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload: Column) -> Column:
    """Base32 SHA-1, from the hexadecimal digits ten at a time (40 bits, 8 letters)."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def url_key(url: Column) -> Column:
    """The host's names from the last to the first, then the rest: ``com,example)/path``."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, "^[^/?#]*", 0))
    names = F.array_join(F.reverse(F.split(host, "\\.")), ",")
    return F.concat(names, F.lit(")"), F.substring(bare, F.length(host) + 1, F.length(bare)))


def capture_time(page_id: Column) -> Column:
    """A made-up time of capture, a second per page: the pages have none."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1_000_000_000)).cast("int")
    return F.timestamp_add("SECOND", seconds, start)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _name(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows ``url_key, captured_at, page_id, row_no, bytes, record``: one WARC record per page.

    Of pages with equal payloads of ``least_bytes`` or more, the one with the largest
    page_id is the response (all rows that have it, if they repeat), others refer to it.
    Only payloads that occur more than once take part in the join. ``row_no`` numbers the
    rows of the table: after the join a task that runs again may meet them in another order.
    """
    payload = F.coalesce("html", F.lit(""))
    read = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.monotonically_increasing_id().alias("row_no"),
        "url",
        payload.alias("html"),
    )
    known = read.withColumns({"digest": payload_digest(F.col("html")), "bytes": text_bytes("html")})
    repeated = stored(
        known.where(F.col("bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1 AND keeper IS NOT NULL")
        .drop("n"),
        "repeated",
    )
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(SEPARATOR),
    )
    length = F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("bytes"))
    target = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]", "%0A")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _header("WARC-Record-ID", _name(F.col("page_id"))),
        _header("WARC-Date", F.date_format("captured_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _header("WARC-Target-URI", target),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            F.col("revisit"),
            F.concat(_header("WARC-Profile", F.lit(PROFILE)), _header("WARC-Refers-To", _name(F.col("keeper")))),
        ).otherwise(""),
        _header("Content-Type", F.lit("application/http;msgtype=response")),
        _header("Content-Length", length.cast("string")),
        F.lit("\r\n"),
    )
    body = F.when(F.col("revisit"), "").otherwise(F.col("html"))
    return (
        known.join(repeated, "digest", "left")
        .withColumns({"revisit": revisit, "captured_at": capture_time(F.col("page_id"))})
        .select(
            url_key(F.col("url")).alias("url_key"),
            "captured_at",
            "page_id",
            "row_no",
            "bytes",
            F.concat(head, http, body).alias("record"),
        )
    )


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Gzipped WARC files under ``path``, each sorted by URL key, capture time and page."""
    total = pages.agg(F.sum(text_bytes("html"))).first()[0] or 0
    files = max(1, -(-total // ARCHIVE_BYTES))
    # By a row number too, so that rows which repeat part.
    file = F.pmod(F.xxhash64("url_key", "page_id", "row_no"), F.lit(files))
    # The file number is the partition; hashed again, some files would be empty and others double.
    runs = records(pages, least_bytes).repartitionById(files, file.cast("int")).sortWithinPartitions("url_key", "captured_at", "page_id")
    runs.select("record").write.option("lineSep", SEPARATOR).option("compression", "gzip").text(path)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number not in ("", "none") else None


def parse_archive(data: bytes) -> Iterator[dict]:
    """The records of an archive, each placed by the lengths that their headers state."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        fields = _fields(data[at:stop])
        begin = stop + 4
        end = begin + int(fields["content-length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"no record end at byte {end}")
        split = data.index(b"\r\n\r\n", begin, end) + 4
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        payload_bytes = int(_fields(data[begin : split - 4])["content-length"])
        if fields["warc-type"] == "response":
            found = base64.b32encode(hashlib.sha1(memoryview(data)[split:end]).digest()).decode()
            if found != digest or end - split != payload_bytes:
                raise ValueError(f"damaged payload at byte {split}")
        yield {
            "page_id": _page(fields["warc-record-id"]),
            "url": fields["warc-target-uri"],
            "captured_at": fields["warc-date"],
            "record_type": fields["warc-type"],
            "payload_bytes": payload_bytes,
            "payload_digest": digest,
            "refers_to": _page(fields.get("warc-refers-to")),
            "offset": at,
        }
        at = end + 4


INDEX = (
    "page_id long, url string, captured_at string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, offset long, run string"
)
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
_NAMES = [x.split()[0] for x in INDEX.split(", ")]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            data = zlib.decompress(content.as_py(), wbits=31) if len(content.as_py()) else b""
            rows = [{**r, "run": path.as_py().rsplit("/", 1)[-1]} for r in parse_archive(data)]
            columns = [pa.array([r[n] for r in rows], t) for n, t in zip(_NAMES, _TYPES)]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES)


def read_archives(files: DataFrame) -> DataFrame:
    """An index entry per record of the archives (a ``binaryFile`` frame): see INDEX.

    A response's payload is checked against its digest; damage is an error.
    """
    return files.select("path", "content").mapInArrow(_parse, INDEX)


class LoserTree:
    """Merges sorted runs. Inner nodes keep the loser of their match, the winner goes up."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.heads = [self._head(r) for r in range(self.k)]
        self.losers = [-1] * max(self.k, 1)
        for run in range(self.k):
            self._up(run)

    def _head(self, run: int):
        rows = self.runs[run]
        at = self.at[run]
        return (self.key(rows[at]), run) if at < len(rows) else None

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def _up(self, run: int) -> None:
        node = (run + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:  # still being built: wait here for the opponent
                self.losers[node] = run
                return
            if self._beats(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self):
        while self.k and self.heads[self.losers[0]] is not None:
            run = self.losers[0]
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self.heads[run] = self._head(run)
            self._up(run)


def _key(row: dict) -> tuple:
    return row["url_key"], row["captured_at"], row["page_id"] is not None, row["page_id"] or 0


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One key range: about RANGE_ROWS short entries."""
    runs: dict[str, list[dict]] = {}
    names = []
    for batch in batches:
        names = batch.schema
        for row in batch.to_pylist():
            runs.setdefault(row["run"], []).append(row)
    if not runs:
        return
    for rows in runs.values():
        if any(_key(a) > _key(b) for a, b in zip(rows, rows[1:])):
            rows.sort(key=_key)  # a shuffle may deliver a run's parts in any order
    merged = list(LoserTree([runs[r] for r in sorted(runs)], _key))
    columns = [pa.array([r[f.name] for r in merged], f.type) for f in names]
    place = pa.array(range(len(merged)), pa.int64())
    yield pa.RecordBatch.from_arrays([*columns, place], names=[*names.names, "place"])


def merged_history(index: DataFrame) -> DataFrame:
    """The index with ``key_range``, ``place`` in it and ``rank``, the place (from 1) in the whole
    capture history: sorted by URL key, capture time and page, over all runs."""
    keyed = stored(index.withColumn("url_key", url_key(F.col("url"))), "index")
    ranges = max(1, -(-keyed.count() // RANGE_ROWS))
    dealt = keyed.repartitionByRange(ranges, "url_key", "captured_at", "page_id")
    merged = dealt.mapInArrow(_merge, f"{INDEX}, url_key string, place long")
    history = stored(merged.withColumn("key_range", F.spark_partition_id()), "history")
    counts = sorted(history.groupBy("key_range").count().collect())  # a row per RANGE_ROWS entries
    before = accumulate((n for _, n in counts), initial=0)
    starts = index.sparkSession.createDataFrame([(k, b) for (k, _), b in zip(counts, before)], "key_range int, before long")
    ranked = history.join(F.broadcast(starts), "key_range")
    return ranked.withColumn("rank", F.col("before") + F.col("place") + 1).drop("before")


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes all pages to archives on the shared folder, reads them back, merges the index.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to, url_key,
    captured_at, rank (in the order of the whole history, from 1), run, offset, key_range,
    place. Null html is an empty payload, a null url an empty one; pages without an id come
    first under equal URL key and time and refer to one with, if payloads are equal; a
    repeated row is a record each, with a rank each; an empty table gives no rows; other
    columns are not used.
    """
    spark = pages.sparkSession
    path = scratch_dir(spark, "archives")
    write_archives(pages, path, least_bytes)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return merged_history(read_archives(files)).select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        "url_key",
        "captured_at",
        "rank",
        "run",
        "offset",
        "key_range",
        "place",
    )

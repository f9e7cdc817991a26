"""What the operators share: table reads, results stored on the shared folder, text as arrays."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_mart.session import scratch_dir

#: Bytes of text that a task turns into arrays at a time (a longer text goes alone).
BLOCK_BYTES = 1 << 20
#: Rows of an Arrow batch while a stored frame is made.
BATCH_ROWS = 2000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside sends Python workers few rows at a time, which bounds what both sides hold.

    Not more than the session asks for, which is left as it was.
    """
    before = int(spark.conf.get(_BATCH_SETTING))
    if 0 < before <= BATCH_ROWS:
        yield
        return
    spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written under ``spark.checkpoint.dir`` and read back.

    The files outlive the executors that wrote them, and their sizes are known to the
    optimizer, so a join with a small one is broadcast and with a large one shuffled.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(text: str | Column) -> Column:
    """UTF-8 bytes of a text, 0 for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")


def spread(groups: DataFrame, cells: int, first: Column | None = None) -> DataFrame:
    """Groups of ``n`` equal records as rows ``cell``, ``m``: how many of them each cell gets.

    The copies of a record, numbered from ``first`` (0), go to the cells that follow
    ``content_hash``, one by one and round. So a record's cell depends on nothing but itself
    and its number among its equals, a record that repeats cannot fill a cell, and a group
    has at most ``cells`` rows here however often it repeats.
    """
    number = F.explode(F.sequence(F.lit(0), F.least("n", F.lit(cells)) - 1)).alias("step")
    begin = F.pmod("content_hash", F.lit(cells)) + (F.lit(0) if first is None else F.pmod(first, F.lit(cells)))
    return (
        groups.select("*", number)
        .withColumn("cell", F.pmod(begin + F.col("step"), F.lit(cells)).cast("int"))
        .withColumn("m", F.floor((F.col("n") - F.col("step") + (cells - 1)) / F.lit(cells)).cast("long"))
        .drop("step", "n")
    )


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow column, and where each begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8)
    return body[starts[0] : starts[-1]], starts - starts[0]


def blocks(starts: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``limit`` bytes; a longer text is a range by itself."""
    low, count = 0, len(starts) - 1
    while low < count:
        high = int(np.searchsorted(starts, starts[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), count)
        yield low, high
        low = high


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    return _mix(x.astype(np.uint64, copy=False) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64)))


class SliceHash:
    """64-bit hashes of any slices of a byte buffer, from one pass over it.

    The prefix sums of ``code(byte) * base ** position`` give each slice's sum by one
    subtraction; multiplying by the inverse power moves it to position 0. All modulo
    2 ** 64, where the odd base has an inverse.
    """

    BASE = 0x5851F42D4C957F2D
    CODES = mixed(np.arange(256), 7) | np.uint64(1)
    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    @classmethod
    def _upto(cls, n: int) -> None:
        if len(cls._powers) <= n:
            size = max(n + 1, BLOCK_BYTES + 1)
            for name, base in (("_powers", cls.BASE), ("_inverse", pow(cls.BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))

    def __init__(self, data: np.ndarray):
        self._upto(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.CODES[data] * self._powers[: len(data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[begin]) * self._inverse[begin]
        return mixed(raw + (end - begin).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of the runs without ASCII white space."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    # A text's edge also ends a word.
    edges = starts[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(starts, begin, side="right") - 1

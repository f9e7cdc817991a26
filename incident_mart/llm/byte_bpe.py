"""Byte-level BPE: vectorised pre-tokenisation, cached merging, offsets, decoding.

A block of texts becomes one array of code points. Each is looked up in a table of
classes (letter, number, white space, other), joined with what its neighbours say, and
so turned into the symbol of an automaton whose states say what kind of piece is open.
A symbol is a function from state to state; functions compose associatively, so the
block is cut into rows, every row's function is composed at once, the rows are chained,
and a second pass gives the state before each code point. State and symbol tell where a
piece begins. No regular expression runs over the text. Pieces are grouped by a hash and
their bytes compared, each distinct piece of a block is merged once (a cache keeps them),
and the ids of all pieces are gathered in one step.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import SliceHash, blocks, utf8

LETTER, NUMBER, OTHER, SPACE, WHITE = range(5)
#: The code points with the property White_Space.
WHITE_SPACE = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003,
    0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
#: What may follow an apostrophe as a piece of its own.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

# Symbols beyond the classes of letters, numbers and others.
JOINS, ALONE, RUN, ONE, TWO, KEEP = range(3, 9)
#: Added to the symbol of a text's first code point.
FRESH = 9
# States: nothing open, an open run of a class, a space that joins what follows,
# white space, and letters still to come in a contraction.
NOTHING, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, JOINING, LEFT_1, LEFT_2 = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece begins, at ``symbol * 8 + state``."""
    after, begins = np.zeros((18, 8), np.uint8), np.ones((18, 8), bool)
    for symbol, state in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        after[symbol] = state
        begins[symbol, [state, JOINING]] = False
    after[LETTER, LEFT_2], after[LETTER, LEFT_1] = LEFT_1, NOTHING
    begins[LETTER, [LEFT_2, LEFT_1]] = False
    after[JOINS], after[ALONE], after[RUN] = JOINING, NOTHING, IN_WHITE
    begins[RUN, IN_WHITE] = False
    after[ONE], after[TWO] = LEFT_1, LEFT_2
    after[KEEP], begins[KEEP] = np.arange(8), False
    for symbol in range(FRESH):
        after[FRESH + symbol] = after[symbol, NOTHING]
    return after.ravel(), begins.ravel()


AFTER, BEGINS = _automaton()
WIDTH = 256
#: Bytes of text of the parts in which a task takes its batches.
SLICE_BYTES = 4 << 20
#: Ids that are decoded in one step.
DECODED_IDS = 1 << 17


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for code in range(sys.maxunicode + 1):
        kind = kinds.get(unicodedata.category(chr(code))[0])
        if kind is not None:
            table[code] = kind
    table[list(WHITE_SPACE)] = WHITE
    table[0x20] = SPACE
    return table


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte at which each begins."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at]
    points = lead.astype(np.uint32)
    for low, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        some = np.flatnonzero((lead >= low) & (lead < (0x100 if low == 0xF0 else low + (0x20 if low == 0xC0 else 0x10))))
        if len(some):
            value = points[some] & mask
            for k in range(1, more + 1):
                value = (value << 6) | (data[at[some] + k] & 0x3F)
            points[some] = value
    return points, at


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The automaton's symbols; ``first`` marks the first code point of each text."""
    n = len(points)
    classes = class_table()[points]
    white = classes >= SPACE
    # Is there a next code point in the same text, and is it no white space?
    follows = np.zeros(n, bool)
    follows[:-1] = ~first[1:]
    before_solid = follows.copy()
    before_solid[:-1] &= ~white[1:]
    out = classes.copy()
    out[white] = RUN
    last = white & before_solid
    out[last] = np.where(points[last] == 0x20, JOINS, ALONE)
    # An apostrophe that begins a piece and is followed by the letters of a contraction.
    quote = np.flatnonzero((points == 0x27) & before_solid)
    if len(quote):
        inner = quote[~first[quote]]
        joined = (classes[inner - 1] == OTHER) | (points[inner - 1] == 0x20)
        quote = np.setdiff1d(quote, inner[joined], assume_unique=True)
        one = points[quote + 1]
        two = np.where(follows[quote + 1], points[np.minimum(quote + 2, n - 1)], 0)
        for letters in CONTRACTIONS:
            hit = one == ord(letters[0])
            if len(letters) == 2:
                hit &= two == ord(letters[1])
            out[quote[hit]] = ONE if len(letters) == 1 else TWO
    out[first] += FRESH
    return out


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Indexes of the code points that begin a piece, by a scan over transition functions."""
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    rows = -(-n // WIDTH)
    padded = np.full(rows * WIDTH, KEEP, np.uint8)
    padded[:n] = symbols(points, first)
    # One line per column, so that a step reads all rows' symbols in sequence.
    lines = np.ascontiguousarray(padded.reshape(rows, WIDTH).T).astype(np.uint8) << 3
    functions = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for line in lines:
        functions = AFTER[line[:, None] | functions]
    state, starts = NOTHING, np.empty(rows, np.uint8)
    for row in range(rows):
        starts[row] = state
        state = functions[row, state]
    begins = np.empty((WIDTH, rows), bool)
    for column, line in enumerate(lines):
        index = line | starts
        begins[column] = BEGINS[index]
        starts = AFTER[index]
    return np.flatnonzero(begins.T.ravel()[:n])


class Vocabulary:
    """Ranks of a byte-level vocabulary, with the merges of pieces seen so far."""

    CACHED_PIECES = 400_000

    def __init__(self, file_bytes: bytes):
        lines = (line.split() for line in file_bytes.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        size = max(self.ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.cache: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The lowest-ranked pair is joined again and again, the leftmost of equals first."""
        known = self.ranks.get(piece)
        if known is not None:
            return [known]
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        queue = []
        for i in range(len(parts) - 1):
            rank = self.ranks.get(parts[i] + parts[i + 1])
            if rank is not None:
                queue.append((rank, i, parts[i] + parts[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, joined = heapq.heappop(queue)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < len(parts):
                    pair = parts[left] + parts[right]
                    rank = self.ranks.get(pair)
                    if rank is not None:
                        heapq.heappush(queue, (rank, left, pair))
        return [self.ranks[p] for p in parts if p is not None]

    def ids_of(self, piece: bytes) -> bytes:
        """The piece's ids, four bytes each."""
        found = self.cache.get(piece)
        if found is None:
            found = np.array(self.merge(piece), np.uint32).tobytes()
            if len(piece) <= 256:
                if len(self.cache) >= self.CACHED_PIECES:
                    self.cache.clear()
                self.cache[piece] = found
        return found


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of all ranges, one after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin - (ends - length), length) + np.arange(total)


def distinct_pieces(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct piece, and for every piece which of these it equals.

    ``data`` consists of the pieces, one after the other. Hashes propose the groups; the
    bytes of each piece are then compared with those of its group's first.
    """
    _, where, kind = np.unique(SliceHash(data).of(begin, end), return_index=True, return_inverse=True)
    length = end - begin
    model = where[kind]
    other = length[model] != length
    against = data[_ranges(np.where(other, begin, begin[model]), length)]
    other[np.searchsorted(begin, np.flatnonzero(against != data), side="right") - 1] = True
    more: dict[bytes, int] = {}
    places = []
    for piece in np.flatnonzero(other).tolist():
        body = data[begin[piece] : end[piece]].tobytes()
        if body not in more:
            more[body] = len(where) + len(places)
            places.append(piece)
        kind[piece] = more[body]
    return np.append(where, np.array(places, where.dtype)), kind


def encode_block(data: np.ndarray, starts: np.ndarray, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block of texts, and where each text's ids begin (and the last's end)."""
    if not len(data):
        return np.empty(0, np.uint32), np.zeros(len(starts), np.int64)
    points, at = code_points(data)
    first = np.zeros(len(points), bool)
    lead = np.searchsorted(at, starts[:-1][starts[:-1] < starts[1:]])
    first[lead] = True
    begin = at[piece_starts(points, first)]
    end = np.append(begin[1:], len(data))
    where, kind = distinct_pieces(data, begin, end)
    body = data.tobytes()
    ids = [words.ids_of(body[b:e]) for b, e in zip(begin[where].tolist(), end[where].tolist())]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), np.uint32)
    each = lengths[kind]
    out = flat[_ranges((np.cumsum(lengths) - lengths)[kind], each)]
    tokens_before = np.concatenate([[0], np.cumsum(each)])
    return out, tokens_before[np.searchsorted(begin, starts)]


def decode_ids(ids: np.ndarray, words: Vocabulary) -> np.ndarray:
    """The bytes of all ids, one after the other."""
    lengths = words.lengths[ids]
    edges = np.concatenate([[0], np.cumsum(lengths)])
    out = np.empty(edges[-1], np.uint8)
    for low in range(0, len(ids), DECODED_IDS):
        high = min(low + DECODED_IDS, len(ids))
        part = _ranges(words.begins[ids[low:high]], lengths[low:high])
        out[edges[low] : edges[high]] = words.flat[part]
    return out


@lru_cache(maxsize=2)
def vocabulary(file_bytes: bytes) -> Vocabulary:
    return Vocabulary(file_bytes)


def encode_batch(texts: pa.Array, words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For an Arrow column: all ids, where each text's begin, and each token's end in its text's bytes."""
    data, starts = utf8(texts)
    parts, marks, base = [], [np.zeros(1, np.int64)], 0
    for low, high in blocks(starts):
        cut = starts[low : high + 1]
        ids, bounds = encode_block(data[cut[0] : cut[-1]], cut - cut[0], words)
        parts.append(ids)
        marks.append(bounds[1:] + base)
        base += len(ids)
    ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    bounds = np.concatenate(marks)
    ends = np.cumsum(words.lengths[ids]) - np.repeat(starts[:-1], np.diff(bounds))
    return ids, bounds, ends


def decode_batch(ids: np.ndarray, bounds: np.ndarray, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The decoded bytes of all texts, and where each begins."""
    data = decode_ids(ids, words)
    lengths = np.concatenate([[0], np.cumsum(words.lengths[ids])])
    return data, lengths[bounds]


def _file(df: DataFrame, path: str):
    """The vocabulary file, read where the driver runs and sent to the executors once."""
    with open(path, "rb") as source:
        return df.sparkSession.sparkContext.broadcast(source.read())


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(values.astype(np.int32)))


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with few MB of text each, which bounds what a task holds."""
    for low, high in blocks(utf8(batch.column(text))[1], SLICE_BYTES):
        yield batch.slice(low, high - low)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", ends: str = "ends") -> DataFrame:
    """Adds ``ids``, and ``ends``: for each token, the UTF-8 byte of the text at which it ends.

    Null and empty texts have no ids. A column of these names is replaced.
    """
    file = _file(df, path)
    kept = [c for c in df.columns if c not in (ids, ends)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(file.value)
        for batch in batches:
            for part in _slices(batch, text):
                tokens, bounds, stops = encode_batch(part.column(text), words)
                columns = [part.column(c) for c in kept]
                columns += [_lists(tokens, bounds), _lists(stops, bounds)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, ids, ends])

    numbers = ArrayType(IntegerType())
    fields = [df.schema[c] for c in kept] + [StructField(ids, numbers), StructField(ends, numbers)]
    return df.mapInArrow(run, StructType(fields))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``, the bytes that the ids stand for; null ids give no bytes."""
    file = _file(df, path)
    kept = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(file.value)
        for batch in batches:
            lists = batch.column(ids)
            counts = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            data, starts = decode_batch(lists.flatten().to_numpy().astype(np.int64), bounds, words)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), _bodies(data, starts)], names=[*kept, out]
            )

    fields = [df.schema[c] for c in kept] + [StructField(out, BinaryType())]
    return df.mapInArrow(run, StructType(fields))


def _bodies(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, buffers).cast(pa.binary())


def transcode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``encode`` and ``decode`` in one pass: adds ``ids``, and the text is what they decode to."""
    file = _file(df, path)
    kept = [c for c in df.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(file.value)
        for batch in batches:
            for part in _slices(batch, text):
                tokens, bounds, _ = encode_batch(part.column(text), words)
                said = _bodies(*decode_batch(tokens, bounds, words)).cast(pa.string())
                columns = [said if c == text else part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, _lists(tokens, bounds)], names=[*kept, ids])

    fields = [df.schema[c] for c in kept] + [StructField(ids, ArrayType(IntegerType()))]
    return df.mapInArrow(run, StructType(fields))


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """Encodes, decodes and digests each text: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers,
    ``decoded_sha256`` over the bytes decoded from the ids. A null text is empty: no ids,
    the digest of nothing. Null and repeated ids and repeated rows stay as they are, other
    columns are not read, an empty table gives no rows. A text of any length is encoded whole.
    """
    file = _file(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(file.value)
        for batch in batches:
            for part in _slices(batch, "text"):
                ids, bounds, _ = encode_batch(part.column("text"), words)
                data, starts = decode_batch(ids, bounds, words)
                code, body = memoryview(ids.astype("<u4")).cast("B"), memoryview(np.ascontiguousarray(data))

                def digests(view: memoryview, edges: list[int]) -> pa.Array:
                    each = (hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(edges, edges[1:]))
                    return pa.array(list(each), pa.string())

                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(bounds)),
                        digests(code, (4 * bounds).tolist()),
                        digests(body, starts.tolist()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )

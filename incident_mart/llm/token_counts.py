"""Token counts from the pieces of distinct pre-tokens, without any token ids.

A vocabulary file of the ``tokenizers`` library says how a text is normalised, cut into
pre-tokens and merged into pieces. None of these steps looks across ASCII white space, nor
across places where ASCII letters, digits and other signs meet (see ``_BREAK``). So a text
is a bag of *chunks* between these places, and a chunk a bag of pre-tokens, mostly of one.

1. Chunks of all documents are counted, first within a task, then by one aggregate.
2. Each distinct chunk that is no plain word is normalised and cut once; each distinct
   pre-token is merged once, and only the number of its pieces is kept. A join adds them
   up by chunk.
3. Frequent chunks go to the tasks as a dictionary of bounded size (see ``FREQUENT``); a
   document's frequencies of them are summed where the document is read. Its other
   chunks, each of which is rare, are joined with their counts by a shuffle.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import blocks, stored, utf8

#: A chunk of up to ``SHORT`` bytes is frequent with one in ``FREQUENT`` of all chunks, a
#: longer one with proportionally more. So at most ``FREQUENT`` chunks are, and together
#: they have at most ``FREQUENT * SHORT`` bytes (16 MB), whatever the corpus.
FREQUENT = 1 << 20
SHORT = 16
#: Distinct chunks, and bytes of them, that a task gathers before it passes them on.
HELD_CHUNKS = 200_000
HELD_BYTES = 32 << 20


@lru_cache(maxsize=2)
def tokenizer(file_text: str) -> Tokenizer:
    return Tokenizer.from_str(file_text)


def _file(df: DataFrame, path: str):
    """The vocabulary file, read where the driver runs and sent to the executors once."""
    with open(path, encoding="utf-8") as source:
        return df.sparkSession.sparkContext.broadcast(_checked(source.read()))


#: What a vocabulary file must say for the cuts made here to be right.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _checked(file_text: str) -> str:
    """The file, if its steps are those that this operator knows how to cut for."""
    told = json.loads(file_text)
    cutters = (told["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    added = [t["content"] for t in told["added_tokens"]]
    plain = all(not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]) for t in told["added_tokens"])
    if (
        (told["normalizer"] or {}).get("normalizers") != _NORMALIZERS
        or cutters[0].get("pattern") != {"Regex": _PATTERN}
        or (cutters[0].get("behavior"), cutters[0].get("invert")) != ("Removed", True)
        or [c.get("type") for c in cutters] != ["Split", "ByteLevel"]
        or told["model"]["type"] != "BPE"
        or not plain
        or any(re.search(r"[\x20\x09-\x0D]", t) for t in added)
    ):
        raise ValueError("the vocabulary file normalises or cuts texts in a way this operator does not know")
    return file_text


SPACE, LETTER, DIGIT, SIGN, QUOTE, BEYOND = range(6)


def _classes() -> np.ndarray:
    table = np.full(256, BEYOND, np.uint8)
    table[:128] = SIGN
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = SPACE
    for first, last, kind in (("a", "z", LETTER), ("A", "Z", LETTER), ("0", "9", DIGIT)):
        table[ord(first) : ord(last) + 1] = kind
    table[ord("'")] = QUOTE
    return table


_CLASS = _classes()
#: Pairs of neighbours that no pre-token spans, whatever is around them. A quote may begin a
#: contraction with the letters that follow it, or stand among signs.
_BREAK = np.zeros((6, 6), bool)
_BREAK[LETTER, [DIGIT, SIGN, QUOTE]] = True
_BREAK[DIGIT, [LETTER, DIGIT, SIGN, QUOTE]] = True
_BREAK[SIGN, [LETTER, DIGIT]] = True
_BREAK[QUOTE, DIGIT] = True


def chunks_of(data: np.ndarray, starts: np.ndarray, special: tuple[bytes, ...]) -> list[list[bytes]]:
    """The chunks of each text of a block; ASCII letters are lower-cased where that is all it takes.

    A block that holds a special string in any case is only cut at white space.
    """
    body = data.tobytes()
    if any(s in body.lower() for s in special):
        edges = starts.tolist()
    else:
        kind = _CLASS[data]
        # The letters U+00C0 to U+00FF, which have two bytes; two signs are among them.
        latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
        kind[latin], kind[latin + 1] = LETTER, LETTER
        ends = starts[1:][starts[1:] > 0] - 1
        after = np.append(kind[1:], SPACE)
        after[ends] = SPACE
        # A letter before a non-ASCII sign may yet be composed with it.
        ascii_next = np.append(data[1:] < 0x80, True)
        ascii_next[ends] = True
        low = data | (((data >= 0x41) & (data <= 0x5A) & ascii_next).astype(np.uint8) << 5)
        cuts = np.flatnonzero(_BREAK[kind, after]) + 1
        body = np.insert(low, cuts, 0x20).tobytes()
        edges = (starts + np.searchsorted(cuts, starts)).tolist()
    return [body[a:b].split() for a, b in zip(edges, edges[1:])]


def _texts(
    batches: Iterator[pa.RecordBatch], column: str, special: tuple[bytes, ...]
) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Parts of the batches with about a MB of text, and their texts' chunks; null has none."""
    for batch in batches:
        data, starts = utf8(batch.column(column))
        for low, high in blocks(starts):
            cut_out = starts[low : high + 1]
            yield batch.slice(low, high - low), chunks_of(data[cut_out[0] : cut_out[-1]], cut_out - cut_out[0], special)


def chunk_totals(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``chunk, n``: how often each chunk occurs in all texts."""
    file = _file(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        size = 0

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["chunk", "n"]
            )

        for _, texts in _texts(batches, text, special_bytes(file.value)):
            for found in texts:
                held.update(found)
                size += sum(map(len, found))
            # Bytes are an upper bound until they are counted; a count is only needed beyond it.
            if len(held) > HELD_CHUNKS or size > HELD_BYTES:
                size = sum(map(len, held))
                if len(held) > HELD_CHUNKS or size > HELD_BYTES:
                    yield passed_on()
                    held.clear()
                    size = 0
        if held:
            yield passed_on()

    found = docs.select(text).mapInArrow(run, "chunk binary, n long")
    return found.groupBy("chunk").agg(F.sum("n").alias("n"))


def cut(chunk: str, coder: Tokenizer, special: re.Pattern | None) -> tuple[Counter, int]:
    """Pre-tokens of a chunk with their frequencies, and how many special strings it holds."""
    parts = special.split(chunk) if special else [chunk]
    found: Counter[str] = Counter()
    for part in parts:
        if part:
            said = coder.normalizer.normalize_str(part) if coder.normalizer else part
            cuts = coder.pre_tokenizer.pre_tokenize_str(said) if coder.pre_tokenizer else [(said, None)]
            found.update(p for p, _ in cuts if p)
    return found, len(parts) - 1


@lru_cache(maxsize=2)
def specials(file_text: str) -> re.Pattern | None:
    """The strings that the library takes out of a text before anything else."""
    added = [t.content for t in tokenizer(file_text).get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None


@lru_cache(maxsize=2)
def special_bytes(file_text: str) -> tuple[bytes, ...]:
    """These strings in lower case."""
    return tuple(t.content.lower().encode() for t in tokenizer(file_text).get_added_tokens_decoder().values())


def pieces_by_chunk(totals: DataFrame, path: str) -> DataFrame:
    """Adds ``pieces`` to ``chunk, n``; every distinct pre-token is merged once."""
    file = _file(totals, path)

    def pre_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, special = tokenizer(file.value), specials(file.value)
        for batch in batches:
            chunks, ns, names, counts = [], [], [], []
            for raw, n in zip(batch.column("chunk").to_pylist(), batch.column("n").to_pylist()):
                found, own = cut(raw.decode("utf-8", "replace"), coder, special)
                chunks += [raw] * (1 + len(found))
                ns += [n, *[None] * len(found)]
                names += [None, *found]
                counts += [own, *found.values()]
            arrays = [pa.array(chunks, pa.binary()), pa.array(ns, pa.int64())]
            arrays += [pa.array(names, pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "n", "pre_token", "times"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(file.value).model
        for batch in batches:
            counts = [len(model.tokenize(p)) for p in batch.column("pre_token").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], names=["pre_token", "pieces"])

    # A word of lower-case ASCII letters is its own and only pre-token.
    word = F.col("chunk").cast("string")
    is_word = word.rlike("^[a-z]+$")
    words = totals.where(is_word).select("chunk", "n", word.alias("pre_token"), F.lit(1).cast("long").alias("times"))
    others = totals.where(~is_word).mapInArrow(pre_tokens, "chunk binary, n long, pre_token string, times long")
    cuts = stored(words.unionByName(others), "pre-tokens")
    distinct = cuts.select("pre_token").where(F.col("pre_token").isNotNull()).distinct()
    counted = distinct.mapInArrow(merged, "pre_token string, pieces long")
    # A chunk's row without a pre-token counts its special strings, of one piece each.
    own = cuts.where(F.col("pre_token").isNull()).select("chunk", "n", F.col("times").alias("pieces"))
    joined = cuts.join(counted, "pre_token").select("chunk", "n", (F.col("times") * F.col("pieces")).alias("pieces"))
    return own.unionByName(joined).groupBy("chunk").agg(F.max("n").alias("n"), F.sum("pieces").alias("pieces"))


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    The tokens are those of the vocabulary file at ``path`` as its library gives them,
    without added begin or end; special strings inside a text are one token each. A null
    text counts as empty: no bytes, no tokens. Null and repeated ids and repeated rows
    stay as they are, other columns are not read, an empty table gives no rows. A text of
    any length is counted whole; a chunk is one key, as long as it is. A vocabulary file that
    normalises or cuts texts otherwise is an error. ``docs`` must be a table or a stored
    frame, whose rows come in the same order when a task runs again.
    """
    file = _file(docs, path)
    counts = stored(pieces_by_chunk(stored(chunk_totals(docs, path, text), "chunks"), path), "pieces")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    weight = F.greatest(F.lit(SHORT), F.octet_length("chunk")).cast("double")
    frequent = counts.where(F.col("n") * float(FREQUENT * SHORT) >= float(total) * weight)
    listed = frequent.select("chunk", "pieces").toArrow()
    known = docs.sparkSession.sparkContext.broadcast(dict(zip(*(c.to_pylist() for c in listed.columns))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = known.value
        for part, texts in _texts(batches, "text", special_bytes(file.value)):
            numbers, sums, chunks, times, heads = [], [], [], [], []
            for at, (row, found) in enumerate(zip(part.column("row").to_pylist(), texts)):
                tokens, first = 0, len(chunks)
                # No chunk holds a space: this key meets none, and spreads over all tasks.
                chunks.append(b" " + row.to_bytes(8))
                times.append(0)
                for chunk, n in Counter(found).items():
                    each = pieces.get(chunk)
                    if each is None:
                        chunks.append(chunk)
                        times.append(n)
                    else:
                        tokens += n * each
                more = len(chunks) - first - 1
                numbers += [row] * (more + 1)
                sums += [tokens, *[0] * more]
                heads += [at, *[None] * more]
            whole, at = pa.int64(), pa.array(heads, pa.int64())
            columns = [pa.array(numbers, whole), part.column("doc_id").take(at), part.column("n_bytes").take(at)]
            columns += [pa.array(sums, whole), pa.array(chunks, pa.binary()), pa.array(times, whole)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_bytes", "tokens", "chunk", "times"])

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    said = numbered.mapInArrow(run, "row long, doc_id long, n_bytes long, tokens long, chunk binary, times long")
    tokens = F.col("tokens") + F.col("times") * F.coalesce("pieces", F.lit(0))
    summed = (
        said.join(counts.select("chunk", "pieces"), "chunk", "left")
        .groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(tokens).alias("n_tokens"))
    )
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

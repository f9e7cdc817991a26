"""Ranked lexical search by presence masks.

A posting is a document's frequency of a query term. The documents of a block are grouped,
for each query item, by the mask that says which of the item's terms they hold: the
postings of a term set its bit in all their documents at once. A mask's terms, each with
the largest contribution any document of the block has, bound the score of all its
documents. Distinct masks are visited by falling bound, their documents scored exactly,
until no bound left reaches the k-th best score. All arithmetic is 64-bit integer.

Documents are read twice: once for their terms, of which those of the query items are
stored as numbers, and once, as these numbers, for the search. Neither pass shuffles
documents; only each block's k best per item are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, stored, utf8

#: Documents whose masks are grouped at a time.
BLOCK_DOCS = 8192
#: Bytes of query texts that are searched at a time; more are searched in further rounds.
QUERY_BYTES = 8 << 20

#: Bytes that belong to no term become spaces, A-Z become a-z; all else is a term's.
_FOLD = bytes(
    0x20 if c < 0x30 or 0x39 < c < 0x41 or 0x5A < c < 0x61 or 0x7A < c < 0x80 else c + 0x20 if 0x41 <= c <= 0x5A else c
    for c in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats."""
    return text.translate(_FOLD).split()


def term_table(docs: DataFrame, numbers: dict[bytes, int], text: str = "text") -> DataFrame:
    """``doc_id, n, terms, tfs``: all terms of a document counted, the numbered ones listed."""
    known = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = known.value
        for batch in batches:
            data, starts = utf8(batch.column("text"))
            for low, high in blocks(starts):
                edges = starts[low : high + 1].tolist()
                sizes, ids, tfs = [], [], []
                for a, b in zip(edges, edges[1:]):
                    found = terms(data[a:b].tobytes())
                    counts = Counter(found)
                    own = listed.keys() & counts.keys()
                    sizes.append(len(found))
                    ids.append([listed[t] for t in own])
                    tfs.append([counts[t] for t in own])
                arrays = [batch.column("doc_id").slice(low, high - low), pa.array(sizes, pa.int64())]
                arrays += [pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "terms", "tfs"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def _lists(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False)


class Postings:
    """The postings of a block of documents by term, each with what it adds per unit of weight."""

    def __init__(self, batch: pa.RecordBatch, n_docs: int, n_terms: int):
        n = batch.column("n").to_numpy()
        counts = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        found, tf = _lists(batch, "terms"), _lists(batch, "tfs").astype(np.int64)
        doc = np.repeat(np.arange(len(n)), counts)
        order = np.argsort(found, kind="stable")
        found, tf, self.doc = found[order], tf[order], doc[order]
        length = 25 + (75 * n * n_docs) // n_terms
        self.adds = (1_000_000_000 * tf) // (1000 * tf + 8 * length[self.doc])
        self.ids, first = np.unique(found, return_index=True)
        self.edges = np.append(first, len(found))
        self.most = np.maximum.reduceat(self.adds, first) if len(first) else np.empty(0, np.int64)
        self.size = len(n)

    def of(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the (ascending) wanted terms occur here, and where."""
        if not len(self.ids):
            return np.zeros(len(wanted), bool), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.ids, wanted), len(self.ids) - 1)
        here = self.ids[at] == wanted
        return here, at[here]


def masks(block: Postings, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct masks over the terms at ``at`` (as rows of 64-bit words), and each document's."""
    words = np.zeros((block.size, -(-len(at) // 64)), np.uint64)
    for bit, term in enumerate(at):
        docs = block.doc[block.edges[term] : block.edges[term + 1]]
        words[docs, bit // 64] |= np.uint64(1 << (bit % 64))
    if words.shape[1] == 1:
        distinct, group = np.unique(words[:, 0], return_inverse=True)
        return distinct[:, None], group
    distinct, group = np.unique(words, axis=0, return_inverse=True)
    return distinct, group.reshape(-1)


def best_documents(block: Postings, wanted: np.ndarray, weights: np.ndarray, ids: np.ndarray, k: int):
    """Documents and scores of an item's k best in a block: higher scores, then smaller ids."""
    here, at = block.of(wanted)
    weights = weights[here]
    none = np.empty(0, np.int64)
    if not len(at):
        return none, none
    distinct, group = masks(block, at)
    bits = np.arange(len(at))
    holds = (distinct[:, bits // 64] >> (bits % 64).astype(np.uint64)) & np.uint64(1)
    bounds = holds.astype(np.int64) @ (weights * block.most[at])
    members = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[members], np.arange(len(distinct) + 1))
    order = np.argsort(-bounds, kind="stable")
    best, scores = none, none
    place, room = 0, 64
    while place < len(order) and bounds[order[place]] > 0 and (len(best) < k or bounds[order[place]] >= scores[-1]):
        some, held = [], 0
        while place < len(order) and held < room and bounds[order[place]] > 0:
            mask = order[place]
            some.append(members[edges[mask] : edges[mask + 1]])
            held += len(some[-1])
            place += 1
        room *= 2
        docs = np.sort(np.concatenate(some))
        sums = np.zeros(len(docs), np.int64)
        for term, weight in zip(at, weights):
            low, high = block.edges[term], block.edges[term + 1]
            spots = np.minimum(np.searchsorted(block.doc[low:high], docs), high - low - 1) + low
            sums += np.where(block.doc[spots] == docs, block.adds[spots], 0) * weight
        best, scores = np.concatenate([best, docs]), np.concatenate([scores, sums])
        first = np.lexsort((ids[best], -scores))[:k]
        best, scores = best[first], scores[first]
    return best[scores > 0], scores[scores > 0]


def _query_blocks(items: DataFrame, limit: int) -> Iterator[list]:
    """The query items, a bounded number of bytes at a time."""
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    count = max(1, -(-size // limit))
    for block in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block) if count > 1 else items
        yield part.collect()


def _search(docs: DataFrame, items: list, k: int) -> DataFrame | None:
    """The k best documents of each block for each of some items, as ``query, item_id, doc_id, score``."""
    asked = [Counter(terms((item.text or "").encode())) for item in items]
    numbers = {t: i for i, t in enumerate(sorted(set().union(*asked)))}
    if not numbers:
        return None
    listed = stored(term_table(docs, numbers), "lexical-terms")
    sizes = listed.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    if not sizes.docs:
        return None
    counts = listed.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
    weight = {r.t: math.floor(1000 * math.log((2 * sizes.docs + 2) / (2 * r["count"] + 1))) for r in counts}
    queries = []
    for item, bag in zip(items, asked):
        known = sorted((numbers[t], times) for t, times in bag.items() if weight.get(numbers[t]))
        ids = np.array([i for i, _ in known], np.int64)
        queries.append((item.item_id, ids, np.array([times * weight[i] for i, times in known], np.int64)))
    sent = docs.sparkSession.sparkContext.broadcast(queries)
    n_docs, n_terms = sizes.docs, sizes.terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(low, BLOCK_DOCS)
                block = Postings(part, n_docs, n_terms)
                column = part.column("doc_id")
                # A null id comes after all others.
                ids = column.fill_null(2**63 - 1).to_numpy()
                query, item, doc, score = [], [], [], []
                for number, (item_id, wanted, weights) in enumerate(sent.value):
                    best, scores = best_documents(block, wanted, weights, ids, k)
                    query += [number] * len(best)
                    item += [item_id] * len(best)
                    doc += best.tolist()
                    score += scores.tolist()
                whole = pa.int64()
                found = column.take(pa.array(doc, whole))
                arrays = [pa.array(query, pa.int32()), pa.array(item, whole), found, pa.array(score, whole)]
                yield pa.RecordBatch.from_arrays(arrays, names=["query", "item_id", "doc_id", "score"])

    return listed.mapInArrow(run, "query int, item_id long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each query item its k highest scores above 0.

    The score of a document is the sum, over the item's terms with repeats, of a term's
    weight by document frequency and its frequency in the document against the document's
    length. Every row of ``docs`` is a document and every row of ``items`` an item, repeated
    rows and ids included; equal scores come by ascending doc_id, null last. Null texts have
    no terms: such a document is not counted, such an item has no rows. Empty tables give no
    rows. Other columns are not read. Texts of any length are read whole.
    """
    narrow = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    found = [f for block in _query_blocks(narrow, query_bytes) if (f := _search(docs, block, k)) is not None]
    schema = "item_id long, rank int, doc_id long, score long"
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    out = None
    for part in found:
        ranked = part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked = ranked.select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return out

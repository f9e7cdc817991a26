"""Toxicity by multiple-instance learning: only documents have labels, sentences get scores.

A sentence's score is a logistic function of its words and their stems, a document's the noisy-or of
its sentences: it is toxic unless every sentence is clean. Sentences without a word that
tells either label say the same, so all of a document count as one: a text is not toxic
for its length. The model is fitted to
document labels alone, so the weight goes to the sentences that explain them, and the
same sentence scores then say where a document offends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SliceHash, blocks, stored, utf8

#: Buckets of hashed words and stems; the one after them stands for no feature.
BUCKETS = 1 << 18
EMPTY = BUCKETS
#: Leading bytes of a word that are a feature of their own, for words with many endings.
STEMS = (4, 5, 6)
#: Features of fewer documents of the label they speak for are not used; of a label with
#: fewer than three times as many documents, a third of them is enough.
LEAST_DOCUMENTS = 5
#: Features tell toxic from clean documents, either way, by this log-likelihood ratio at
#: least (chance reaches it once in 1,000). Where no feature can, the best are used.
LEAST_RATIO = 10.83
#: At most so many labelled documents fit the model, those with the smallest hashes.
TRAINING_ROWS = 12_000
ROUNDS = 120
LEARNING_RATE = 0.25
#: Pull of each weight towards 0, which only words that explain labels resist.
PULL = 1e-4
#: The bias at the start: a sentence is clean unless its words say otherwise.
START = -6.0
#: The bias of a model that has seen no labels.
UNTAUGHT = -50.0

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Letters, digits, and every byte of a character beyond ASCII.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_ENDS = np.zeros(256, bool)
_ENDS[[0x0A, 0x21, 0x2E, 0x3F]] = True


def words_of(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block of texts: buckets (a row per word), sentence, text, first and last byte.

    Words are lower-cased runs of letters and digits; sentences end at ``. ! ?`` or a
    line's end and count through the block.
    """
    inside = _IN_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = starts[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes, stops = SliceHash(_LOWER[data]), [end]
    stops += [np.minimum(begin + n, end) for n in STEMS]
    buckets = np.stack([hashes.of(begin, stop) % np.uint64(BUCKETS) for stop in stops], axis=1)
    # A word no longer than a stem is counted once.
    for k in range(1, len(stops)):
        buckets[stops[k] == end, k] = EMPTY
    text = np.searchsorted(starts, begin, side="right") - 1
    breaks = np.searchsorted(np.flatnonzero(_ENDS[data]), begin)
    new = np.ones(len(begin), bool)
    new[1:] = (breaks[1:] != breaks[:-1]) | (text[1:] != text[:-1])
    return buckets.astype(np.int32), np.cumsum(new) - 1, text, begin, end


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def fit(feature: np.ndarray, sentence: np.ndarray, text: np.ndarray, toxic: np.ndarray, n_features: int) -> np.ndarray:
    """Weights, the bias last, that make the labels likely; ``text`` is each sentence's document.

    Full gradients, Adam steps and a proximal step that sets small weights to 0; the same
    rows give the same model.
    """
    weights = np.zeros(n_features + 1)
    weights[-1] = START
    mean, spread = np.zeros_like(weights), np.zeros_like(weights)
    n_sentences, n = len(text), max(len(toxic), 1)
    for step in range(1, ROUNDS + 1):
        z = np.bincount(sentence, weights[feature], n_sentences) + weights[-1]
        clean = np.bincount(text, _softplus(z), n)  # -log of P(no sentence offends)
        odds = 1.0 / np.expm1(np.clip(clean, 1e-9, 700))  # (1 - P) / P
        pull = np.where(toxic == 1, odds, -1.0)[text] * _logistic(z) / n
        gradient = np.append(np.bincount(feature, pull[sentence], n_features), pull.sum())
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient**2
        rate = LEARNING_RATE * (1 - 0.9 * step / ROUNDS) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-7)
        weights += rate * mean / (1 - 0.9**step)
        words = weights[:-1]
        weights[:-1] = np.sign(words) * np.maximum(np.abs(words) - rate[:-1] * PULL, 0)
    return weights


#: The first feature of a sentence is stored as ``-1 - bucket``.
FEATURES = "doc_id long, toxic int, buckets array<int>"
#: Documents whose features are counted in one step.
COUNTED = 500


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, starts = utf8(batch.column("text"))
        for low, high in blocks(starts):
            cut = starts[low : high + 1]
            buckets, sentence, text, _, _ = words_of(data[cut[0] : cut[-1]], cut - cut[0])
            bounds = np.searchsorted(text, np.arange(high - low + 1)).astype(np.int32)
            head = np.flatnonzero(np.diff(sentence, prepend=-1))
            buckets[head, 0] = -1 - buckets[head, 0]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, high - low),
                    batch.column("toxic").slice(low, high - low),
                    pa.ListArray.from_arrays(bounds * buckets.shape[1], pa.array(buckets.ravel())),
                ],
                names=["doc_id", "toxic", "buckets"],
            )


def _counted(buckets: np.ndarray, document: np.ndarray) -> np.ndarray:
    """In how many documents each bucket occurs."""
    pairs = np.unique(document.astype(np.int64) * (BUCKETS + 1) + buckets)
    return np.bincount(pairs % (BUCKETS + 1), minlength=BUCKETS + 1)


def ratios(seen: np.ndarray, seen_toxic: np.ndarray, n: int, n_toxic: int) -> np.ndarray:
    """Log-likelihood ratio of each feature and the label, from the documents that have both."""

    def part(found: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return found * np.log(np.maximum(found, 1) / np.maximum(expected, 1e-300))

    n_clean, seen_clean, rest = n - n_toxic, seen - seen_toxic, n - seen
    return 2 * (
        part(seen_toxic, seen * (n_toxic / n))
        + part(seen_clean, seen * (n_clean / n))
        + part(n_toxic - seen_toxic, rest * (n_toxic / n))
        + part(n_clean - seen_clean, rest * (n_clean / n))
    )


def telling(seen: np.ndarray, seen_toxic: np.ndarray, n: int, n_toxic: int) -> np.ndarray:
    """The features that speak for one label: toxic or clean."""
    ratio = ratios(seen, seen_toxic, n, n_toxic)
    for_toxic = seen_toxic * n > seen * n_toxic
    label = np.where(for_toxic, n_toxic, n - n_toxic)
    enough = np.where(for_toxic, seen_toxic, seen - seen_toxic) >= np.clip(-(-label // 3), 1, LEAST_DOCUMENTS)
    # Of one label alone no feature tells anything.
    able = enough & (seen > 0) & (ratio > 1e-6)
    best = ratio[able].max(initial=0.0)
    return np.flatnonzero(able & (ratio >= min(LEAST_RATIO, best * (1 - 1e-9))))


def _merged(sentence: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sentences numbered anew, with the silent ones (no feature) of a document as one."""
    silent = np.ones(len(text), bool)
    silent[sentence] = False
    at = np.flatnonzero(silent)
    kept = ~silent
    kept[at[np.unique(text[at], return_index=True)[1]]] = True
    return (np.cumsum(kept) - 1)[sentence], text[kept]


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task, over at most TRAINING_ROWS documents."""
    parts, toxic, texts = [], [], []
    n_sentences = n_texts = 0
    seen, seen_toxic = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)
    for batch in batches:
        for at in range(0, len(batch), COUNTED):
            some = batch.slice(at, COUNTED)
            label = some.column("toxic").to_numpy()
            codes = some.column("buckets").flatten().to_numpy()
            document = np.repeat(np.arange(len(some)), some.column("buckets").value_lengths().to_numpy())
            head = codes < 0
            buckets = np.where(head, -1 - codes, codes)
            seen += _counted(buckets, document)
            of_toxic = label[document] == 1
            seen_toxic += _counted(buckets[of_toxic], document[of_toxic])
            parts.append((buckets, (np.cumsum(head) - 1 + n_sentences).astype(np.int32)))
            texts.append(document[head] + n_texts)
            toxic.append(label)
            n_texts += len(some)
            n_sentences += int(head.sum())
    if not n_texts:
        return
    labels = np.concatenate(toxic)
    seen[EMPTY] = seen_toxic[EMPTY] = 0
    used = telling(seen, seen_toxic, n_texts, int((labels == 1).sum()))
    place = np.full(BUCKETS + 1, -1, np.int32)
    place[used] = np.arange(len(used))
    chosen = [(place[b[place[b] >= 0]], s[place[b] >= 0]) for b, s in parts]
    feature, sentence = (np.concatenate(x) for x in zip(*chosen))
    del parts, chosen
    sentence, text = _merged(sentence, np.concatenate(texts))
    weights = fit(feature, sentence, text, labels, len(used))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1).astype(np.int32)), pa.array(weights.astype(np.float32))], names=["bucket", "weight"]
    )


def in_holdout(doc_id: str = "doc_id") -> F.Column:
    """Documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> tuple[np.ndarray, float]:
    """The model from the documents' labels, held-out ones left out.

    Uses ``rows`` labelled documents at most; a document labelled twice counts as toxic
    if either says so; null labels are none, nor are those without a document. Of rows
    that repeat a doc_id one text is used. Without labels every score is near 0.
    """
    # A hot id is one row before the shuffle.
    present = docs.select("doc_id").distinct()
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~in_holdout())
    sample = (
        known.groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .join(present, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    sample = stored(sample, "labelled")
    # At most `rows` short rows: a proven bound.
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    labelled = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(one)
        .select("doc_id", "toxic", "one.text")
    )
    features = labelled.mapInArrow(_features, FEATURES)
    fitted = features.repartition(1).sortWithinPartitions("doc_id").mapInArrow(_train, "bucket int, weight float")
    weights, bias = np.zeros(BUCKETS + 1, np.float32), UNTAUGHT
    for bucket, weight in fitted.collect():
        if bucket < 0:
            bias = weight
        else:
            weights[bucket] = weight
    return weights, bias


def score_batch(texts: pa.Array, weights: np.ndarray, bias: float, offends: float) -> tuple[np.ndarray, pa.Array]:
    """Scores of the texts, and per text the sentences whose own score reaches ``offends``."""
    data, starts = utf8(texts)
    scores, counts, found = [], [], []
    for low, high in blocks(starts):
        cut = starts[low : high + 1]
        part = data[cut[0] : cut[-1]]
        buckets, sentence, text, begin, end = words_of(part, cut - cut[0])
        if not len(buckets):
            scores.append(np.zeros(high - low))
            counts.append(np.zeros(high - low, np.int64))
            continue
        heads = np.flatnonzero(np.diff(sentence, prepend=-1))
        tails = np.append(heads[1:], len(sentence)) - 1
        said = np.add.reduceat(weights[buckets].sum(axis=1, dtype=np.float64), heads)
        z, of, silent = said + bias, text[heads], said == 0
        clean = np.bincount(of[~silent], _softplus(z[~silent]), high - low)
        clean = clean + (np.bincount(of[silent], minlength=high - low) > 0) * _softplus(bias)
        scores.append(-np.expm1(-clean))
        chance = _logistic(z)
        bad = np.flatnonzero(chance >= offends)
        points = np.cumsum((part & 0xC0) != 0x80) - 1
        origin = points[np.minimum(cut[text[heads[bad]]] - cut[0], len(part) - 1)]
        found.append((points[begin[heads[bad]]] - origin, points[end[tails[bad]] - 1] + 1 - origin, chance[bad]))
        counts.append(np.bincount(text[heads[bad]], minlength=high - low))
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1)
    start, stop, chance = (np.concatenate(x) for x in zip(*found)) if found else ([], [], [])
    spans = pa.StructArray.from_arrays(
        [pa.array(start, pa.int64()), pa.array(stop, pa.int64()), pa.array(chance, pa.float64())], names=["start", "end", "score"]
    )
    return np.concatenate(scores) if scores else np.empty(0), pa.ListArray.from_arrays(bounds.astype(np.int32), spans)


SPANS = "array<struct<start: bigint, end: bigint, score: double>>"


def scored(docs: DataFrame, model: tuple[np.ndarray, float], offends: float = 0.5) -> DataFrame:
    """One row per document: doc_id, score, offending.

    ``offending`` has start, end (code points, end exclusive) and score of the
    sentences that score ``offends`` or more. A text without words, empty or null,
    scores 0. The model is 1 MB however many documents there are.
    """
    weights, bias = model
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, spans = score_batch(batch.column("text"), sent.value, bias, offends)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), spans], names=["doc_id", "score", "offending"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, score double, offending {SPANS}")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, offending."""
    return scored(docs, learn(docs, labels)).select(
        "doc_id",
        in_holdout().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "offending",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns.

    Rows are judged where they are read: one pass, no shuffle.
    """
    weights, bias = learn(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, _ = score_batch(batch.column("text"), sent.value, bias, 2.0)
            yield batch.filter(pa.array(score < threshold))

    return docs.mapInArrow(run, docs.schema)

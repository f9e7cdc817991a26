"""Near-duplicate documents by ProbMinHash over weighted word shingles.

A document is a weighted set: its shingles of five words, each with the weight
``1 + ln(count)``. Every shingle sends a Poisson process of arrivals whose rate is its
weight; arrival ``k`` of a shingle is the same in all documents but for the rate. Each
arrival falls on one component of the signature, and a component keeps the shingle of
its earliest arrival. Two documents agree in a component with a probability equal to
their probability Jaccard similarity. A shingle stops as soon as its next arrival is
later than every component's earliest.

Bands of components give buckets. Pairs from buckets are verified on the texts, with the
exact similarity. Equal texts are compared once. A bucket does not list its pairs: first
each member meets the one it shares most buckets with. Members that are connected by
then are not compared again. What is left of large buckets is dealt out anew by the
members' rarest shingles (two near texts share one of them, see ``_by_rare_shingles``),
with bounds that rule out most pairs unseen, and compared with some members (hubs) at a
time, until no bucket holds two members that are neither connected nor compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SliceHash, blocks, mixed, stored, utf8, words
from .components import connected_components

SHINGLE = 5
THRESHOLD = 0.8
#: Room for the rounding of sums: a similarity of 12 / 15 counts as 0.8.
ROUNDING = 1e-9
#: A pair at the threshold shares no band with a probability of 5e-6.
BANDS, ROWS = 40, 6
#: Buckets of so many members, or fewer, compare all that are not connected at once.
SMALL = 16
#: Hubs of a larger bucket in its first round; each round has eight times as many.
HUBS = 8

_FACTORS = np.array([pow(0xD6E8FEB86659FD93, k, 1 << 64) for k in range(SHINGLE)], np.uint64)


def weighted_shingles(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and weight of the distinct shingles of a block of texts, in this order.

    A text of one to four words is one shingle; one without words has none.
    """
    begin, end, text = words(data, starts)
    if not len(begin):
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0)
    codes = SliceHash(data).of(begin, end)
    whole = np.zeros(max(len(codes) - SHINGLE + 1, 0), np.uint64)
    for k in range(SHINGLE):
        whole += codes[k : k + len(whole)] * _FACTORS[k]
    inside = text[: len(whole)] == text[SHINGLE - 1 :]
    counts = np.bincount(text, minlength=len(starts) - 1)
    first = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    few = np.zeros(len(short), np.uint64)
    for k in range(SHINGLE - 1):
        has = counts[short] > k
        few[has] += codes[first[short[has]] + k] * _FACTORS[k]
    owner = np.concatenate([text[: len(whole)][inside], short])
    value = np.concatenate([mixed(whole[inside]), mixed(few + counts[short].astype(np.uint64), 1)])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return owner[at], value[at], 1.0 + np.log(np.diff(np.append(at, len(owner))))


def signatures(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, texts: int, size: int) -> np.ndarray:
    """``[text, component]`` shingle of the earliest arrival; texts without shingles have 0."""
    earliest = np.full(texts * size, np.inf)
    out = np.zeros(texts * size, np.uint64)
    active = np.arange(len(owner))
    time, arrivals = np.zeros(len(owner)), np.zeros(len(owner), np.int64)
    while len(active):
        # Texts of few shingles draw more arrivals of each at a time.
        have = np.bincount(owner[active], minlength=texts)
        each = np.maximum(1, -(-2 * size // have[owner[active]]))
        item = np.repeat(active, each)
        ends = np.cumsum(each)
        step = np.arange(len(item)) - np.repeat(ends - each, each)
        draw = mixed(value[item] + (arrivals[item] + step).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3)
        # The upper bits make the waiting time, the lower ones the component.
        gaps = -np.log(((draw >> np.uint64(20)).astype(np.float64) + 1.0) / 2.0**44)
        sums = np.cumsum(gaps)
        before = (sums - gaps)[ends - each]
        when = (time[item] + sums - np.repeat(before, each)) / weight[item]
        place = owner[item] * size + (draw & np.uint64(0xFFFFF)).astype(np.int64) * size // (1 << 20)
        np.minimum.at(earliest, place, when)
        won = when == earliest[place]
        out[place[won]] = value[item[won]]
        time[active] += sums[ends - 1] - before
        arrivals[active] += each
        latest = earliest.reshape(texts, size).max(axis=1)
        active = active[time[active] / weight[active] < latest[owner[active]]]
    return out.reshape(texts, size)


def similarity(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Probability Jaccard of two sets with sorted shingles ``a``, ``b`` and weights ``x``, ``y``.

    The sum over common d of ``1 / sum over e of max(x_e / x_d, y_e / y_d)``. In the
    order of ``x_e / y_e`` the inner sum splits in two that prefix sums give.
    """
    common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    only_a, only_b = np.ones(len(a), bool), np.ones(len(b), bool)
    only_a[i] = only_b[j] = False
    ratio = x[i] / y[j]
    order = np.argsort(ratio)
    low_y = np.concatenate([[0.0], np.cumsum(y[j][order])])  # ratios below: their y counts
    high_x = np.concatenate([np.cumsum(x[i][order][::-1])[::-1], [0.0]])
    at = np.searchsorted(ratio[order], ratio, side="left")
    total = (high_x[at] + x[only_a].sum()) / x[i] + (low_y[at] + y[only_b].sum()) / y[j]
    return float((1.0 / total).sum())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, starts = utf8(batch.column("text"))
        for low, high in blocks(starts):
            cut = starts[low : high + 1]
            n = high - low
            owner, value, weight = weighted_shingles(data[cut[0] : cut[-1]], cut - cut[0])
            parts = signatures(owner, value, weight, n, BANDS * ROWS).reshape(n, BANDS, ROWS)
            keys = np.repeat(np.arange(BANDS, dtype=np.uint64)[None, :], n, axis=0)
            for k in range(ROWS):
                keys = mixed(keys * _FACTORS[1] + parts[:, :, k], 5)
            full = np.bincount(owner, minlength=n) > 0
            bounds = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
            bands = pa.ListArray.from_arrays(bounds, pa.array(keys[full].ravel().view(np.int64)))
            kept = [batch.column(c).slice(low, n) for c in ("doc_id", "row_no", "digest")]
            yield pa.RecordBatch.from_arrays([*kept, bands], names=["doc_id", "row_no", "digest", "bands"])


def _sets(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shingles and weights of each text."""
    data, starts = utf8(column)
    sets = []
    for low, high in blocks(starts):
        cut = starts[low : high + 1]
        owner, value, weight = weighted_shingles(data[cut[0] : cut[-1]], cut - cut[0])
        edges = np.searchsorted(owner, np.arange(high - low + 1))
        sets += [(value[p:q], weight[p:q]) for p, q in zip(edges, edges[1:])]
    return sets


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [utf8(batch.column(name))[1] for name in ("left_text", "right_text")]
            # As many pairs at a time as have about a MB of text on both sides.
            for low, high in blocks(sizes[0] + sizes[1]):
                part = batch.slice(low, high - low)
                sides = zip(_sets(part.column("left_text")), _sets(part.column("right_text")))
                near = [similarity(*p, *q) >= threshold - ROUNDING for p, q in sides]
                yield part.select(["u", "v"]).filter(pa.array(near, pa.bool_()))

    return run


def _linked(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``u, v`` whose texts are near."""
    left = texts.select(F.col("node").alias("u"), F.col("text").alias("left_text"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("right_text"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "left_text", "right_text").mapInArrow(
        _verify(threshold), "u long, v long"
    )


def _draw(round_no: int) -> Column:
    """A number from 0 to 1 by which members become hubs, the same in all buckets."""
    return F.pmod(F.xxhash64("node", F.lit(round_no)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _first_pairs(live: DataFrame) -> DataFrame:
    """Each member with the hub that it meets in most of its buckets."""
    hubs = live.groupBy("bucket").agg(F.min(F.struct(_draw(0).alias("draw"), "node")).alias("hub"))
    met = live.join(hubs, "bucket").select("node", F.col("hub.node").alias("hub")).where("node <> hub")
    best = F.max(F.struct("count", "hub")).alias("best")
    pairs = met.groupBy("node", "hub").count().groupBy("node").agg(best)
    low, high = F.least("node", "best.hub"), F.greatest("node", "best.hub")
    return pairs.select(low.alias("u"), high.alias("v")).distinct()


def _placed(live: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component."""
    return live.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _open_buckets(placed: DataFrame) -> DataFrame:
    """The members of buckets whose members are not all connected, with the bucket's size."""
    open_ = (
        placed.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("component").alias("a"), F.max("component").alias("b"))
        .where("a <> b")
        .drop("a", "b")
    )
    return placed.join(open_, "bucket")


def _explode_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, starts = utf8(batch.column("text"))
        nodes = batch.column("node").to_numpy()
        for low, high in blocks(starts):
            cut = starts[low : high + 1]
            owner, value, weight = weighted_shingles(data[cut[0] : cut[-1]], cut - cut[0])
            total = np.bincount(owner, weight, high - low)
            excess = total - np.bincount(owner, minlength=high - low)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (value.view(np.int64), nodes[low:high][owner], weight, total[owner], excess[owner])],
                names=["bucket", "node", "weight", "total", "excess"],
            )


def _by_rare_shingles(texts: DataFrame, threshold: float) -> DataFrame:
    """Buckets of texts by their rarest shingles: bucket, node, before, total, excess.

    The similarity of two texts is at most the share of either's weight that is in
    common shingles. So if it reaches the threshold, the rarest common shingle has less
    than ``1 - threshold`` of each text's weight on shingles rarer still: it is in both
    texts' prefixes, whatever the order of shingles, as long as it is one order.
    ``before`` is the weight on rarer shingles, ``excess`` the weight above 1 per shingle.
    """
    rows = stored(
        texts.mapInArrow(_explode_shingles, "bucket long, node long, weight double, total double, excess double"), "shingles"
    )
    counts = rows.groupBy("bucket").agg(F.count("*").alias("texts"))
    order = Window.partitionBy("node").orderBy("texts", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("weight").over(order), F.lit(0.0))
    return (
        rows.join(counts, "bucket")
        .withColumn("before", before)
        .where((F.col("before") <= (1 - threshold) * F.col("total") + 1e-6) & (F.col("texts") > 1))
        .select("bucket", "node", "before", "total", "excess")
    )


def _at_most(x: dict[str, Column], y: dict[str, Column]) -> Column:
    """A bound of the similarity of two texts that have nothing in common before a shingle.

    With ``c`` the weight that can be common, the sum of the larger weights is at least
    ``X + Y - c``. Every common shingle adds at most its larger weight over that sum,
    and larger weights exceed smaller ones by the excesses at most.
    """
    common = F.least(x["total"] - x["before"], y["total"] - y["before"])
    return (common + x["excess"] + y["excess"]) / (x["total"] + y["total"] - common)


def _possible(members: DataFrame, threshold: float) -> DataFrame:
    """Without the members that no text as short as the bucket's shortest could be near to."""
    least = members.groupBy("bucket").agg(F.min("total").alias("shortest"), F.max("excess").alias("most"))
    known = members.join(least, "bucket")
    common = F.col("total") - F.col("before")
    bound = (common + F.col("excess") + F.col("most")) / (F.col("total") + F.col("shortest") - common)
    keep = F.col("total").isNull() | (F.col("shortest") < common) | (bound >= threshold - 1e-6)
    return known.where(keep).drop("shortest", "most")


def _labels(live: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``node, component`` of all members that links connect; see the module's rounds."""
    tested = stored(_first_pairs(live), "pairs")
    links = stored(_linked(tested, texts, threshold), "links")
    labels = stored(connected_components(links), "labels")
    open_ = stored(_open_buckets(_placed(live, labels)), "open")
    large = open_.where(F.col("n") > SMALL).select("node").distinct()
    fields = [F.lit(None).cast("double").alias(c) for c in ("before", "total", "excess")]
    live = open_.where(F.col("n") <= SMALL).select("bucket", "node", *fields)
    rare = _by_rare_shingles(texts.join(large, "node"), threshold)
    live = stored(live.unionByName(rare), "rare")
    hubs = HUBS
    while True:
        near = _open_buckets(_placed(live, labels)).drop("n")
        members = stored(_open_buckets(_possible(near, threshold)).withColumn("draw", _draw(hubs)), "open")
        if members.isEmpty():
            return labels
        least = members.groupBy("bucket").agg(F.min("draw").alias("least"))
        is_hub = (F.col("n") <= SMALL) | (F.col("draw") * F.col("n") < hubs) | (F.col("draw") == F.col("least"))
        members = members.join(least, "bucket").withColumn("is_hub", is_hub)
        some = members.where("is_hub").alias("x")
        other = members.alias("y")

        def side(name: str) -> dict[str, Column]:
            return {c: F.col(f"{name}.{c}") for c in ("before", "total", "excess")}

        bound = F.coalesce(_at_most(side("x"), side("y")), F.lit(1.0))
        pairs = (
            some.join(
                other,
                (F.col("x.bucket") == F.col("y.bucket"))
                & (F.col("x.component") != F.col("y.component"))
                & (bound >= threshold - 1e-6),
            )
            .select(F.least("x.node", "y.node").alias("u"), F.greatest("x.node", "y.node").alias("v"))
            .distinct()
            .join(tested, ["u", "v"], "left_anti")
        )
        pairs = stored(pairs, "pairs")
        links = stored(links.union(_linked(pairs, texts, threshold)), "links")
        labels = stored(connected_components(links), "labels")
        tested = tested.union(pairs)
        # A hub has now been compared with all others of its bucket.
        live = members.where("NOT is_hub").select("bucket", "node", "before", "total", "excess")
        hubs *= 8


def numbered(docs: DataFrame) -> DataFrame:
    """The documents as ``row`` with ``row_no``, stored, so that the numbers stay what they are."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("row_no"))
    return stored(rows, "numbered")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, row_no, class_id, kept.

    Links are pairs of texts with a probability Jaccard similarity of at least
    ``threshold`` over shingles of five words (runs without ASCII white space); a class
    is what links connect, ``class_id`` its smallest doc_id, and exactly one row of a
    class is kept, the first that has this id. Texts without words (null or empty)
    and rows without an id are classes of their own. ``docs`` comes from ``numbered``.
    """
    rows = docs.select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        "row_no",
        F.coalesce("row.text", F.lit("")).alias("text"),
    )
    digested = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    sketched = stored(
        digested.mapInArrow(_sketch, "doc_id long, row_no long, digest string, bands array<long>"), "sketches"
    )
    usable = (F.size("bands") > 0) & F.col("doc_id").isNotNull()
    # Equal texts become one node, named after the row that stands for them.
    nodes = stored(
        sketched.where(usable)
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "row_no")).alias("rep"), F.any_value("bands").alias("bands")),
        "nodes",
    )
    buckets = nodes.select(F.col("rep.row_no").alias("node"), F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    live = stored(buckets.join(shared, "bucket"), "buckets")
    wanted = live.select("node").distinct()
    texts = stored(rows.select(F.col("row_no").alias("node"), "text").join(wanted, "node"), "texts")
    labels = _labels(live, texts, threshold)
    named = nodes.select("digest", "rep").join(
        labels, F.col("rep.row_no") == F.col("node"), "left"
    ).withColumn("component", F.coalesce("component", "rep.row_no"))
    first = named.groupBy("component").agg(F.min("rep").alias("first"))
    known = named.join(first, "component").select("digest", "first")
    out = sketched.where(usable).join(known, "digest").select(
        "doc_id", "row_no", F.col("first.doc_id").alias("class_id"), (F.col("first.row_no") == F.col("row_no")).alias("kept")
    )
    alone = sketched.where(~F.coalesce(usable, F.lit(False))).select(
        "doc_id", "row_no", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept")
    )
    return out.union(alone)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id, kept; see ``classes``."""
    return classes(numbered(docs.select("doc_id", "text")), threshold).drop("row_no")


def without_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, with all columns of ``docs``.

    Only the numbers of the rows to drop are joined with the texts, and only rows that
    share a class with others can be among them.
    """
    rows = numbered(docs)
    dropped = stored(classes(rows, threshold).where("NOT kept").select("row_no"), "dropped")
    return rows.join(dropped, "row_no", "left_anti").select("row.*")

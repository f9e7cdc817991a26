"""Mixing sources to target weights by a multivariate hypergeometric splitting tree.

Each source's documents hash into blocks. Its target becomes an exact number of block
draws (its quota, a block at most twice). The vector of quotas is split down a binary
tree of output shards: a node hands its left half a multivariate hypergeometric sample
of its draws and its right half the rest, so every shard has exact quotas that add up.
A source's draws stand in a random order of its blocks; shards take disjoint ranges of
it, and each shard shuffles its rows locally. The copies of a repeated document take
blocks in turn, by their number among their equals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import spread, stored

#: Blocks of a source; small sources have about one document in each.
BLOCKS = 1024
#: Parts into which the rows of one content that differ in other columns are numbered.
BUCKETS = 256
WEIGHTS = (5, 2, 1)
WORD = "[^\\x20\\x09-\\x0D]+"


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """``share`` of all sizes dealt out by weight; none above ``most`` times its own size.

    What a source cannot take is dealt out to the others by weight, until none is above.
    """
    out, left, open_ = [0.0] * len(sizes), share * sum(sizes), set(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in sorted(open_))
        want = {i: left * weights[i] / total for i in sorted(open_)}
        full = [i for i in want if want[i] > most * sizes[i]]
        if not full:
            for i, x in want.items():
                out[i] = x
            break
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
            open_.remove(i)
    return out


def split_quotas(quotas: np.ndarray, n_shards: int, seed: int) -> np.ndarray:
    """``[shard, source]`` draws; rows are near equal in sum, columns add up to the quotas."""
    out = np.zeros((n_shards, len(quotas)), np.int64)

    def split(low: int, high: int, here: np.ndarray) -> None:
        if high - low == 1:
            out[low] = here
            return
        middle = (low + high) // 2
        part = int(here.sum()) * (middle - low) // (high - low)
        random = np.random.default_rng([seed, low, high])
        left = random.multivariate_hypergeometric(here, part, method="marginals")
        split(low, middle, left)
        split(middle, high, here - left)

    if len(quotas):
        split(0, n_shards, quotas.astype(np.int64))
    return out


def choose_blocks(words: np.ndarray, order: np.ndarray, target: float) -> np.ndarray:
    """Times each block is drawn, so that the words drawn come near the target.

    Whole rounds first; what is left is filled with blocks in random order that still
    fit. Then one block more, or one in place of another, if that brings the sum nearer.
    """
    total = int(words.sum())
    if not total:
        return np.zeros(len(words), np.int64)
    rounds = int(target // total)
    copies, left = np.full(len(words), rounds, np.int64), target - rounds * total
    for i in order:
        if words[i] <= left:
            copies[i] += 1
            left -= words[i]
    unused = np.flatnonzero((copies == rounds) & (words > 0))
    if left <= 0 or not len(unused):
        return copies
    unused = unused[np.argsort(words[unused], kind="stable")]
    # A block of no words in the place of one stands for taking one block more.
    used = np.append(np.flatnonzero(copies > rounds), -1)
    given = np.append(words[used[:-1]], 0)
    at = np.searchsorted(words[unused], given + left)
    gaps = [(abs(left + given - words[unused[np.clip(at + k, 0, len(unused) - 1)]])) for k in (-1, 0)]
    best = np.argmin(np.minimum(*gaps))
    if min(gaps[0][best], gaps[1][best]) < left:
        choice = at[best] - 1 if gaps[0][best] <= gaps[1][best] else at[best]
        copies[unused[np.clip(choice, 0, len(unused) - 1)]] += 1
        if used[best] >= 0:
            copies[used[best]] -= 1
    return copies


def _drawer(target: dict[int, float], seed: int):
    def draw(blocks: pd.DataFrame) -> pd.DataFrame:
        """At most BLOCKS rows, the blocks of one source."""
        blocks = blocks.sort_values("cell")
        source = int(blocks["source_no"].iloc[0])
        random = np.random.default_rng([seed, source])
        first, second = random.permutation(len(blocks)), random.permutation(len(blocks))
        copies = choose_blocks(blocks["words"].to_numpy(), first, target[source])
        rounds = [first[copies[first] >= 1], second[copies[second] >= 2]]
        drawn = blocks["cell"].to_numpy()[np.concatenate(rounds)]
        return pd.DataFrame({"source_no": source, "place": np.arange(len(drawn)), "cell": drawn})

    return draw


def _gather(plan: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for sources in plan:
        draws = []
        for pairs in sources["pairs"]:
            shards: list[list[int]] = [[] for _ in range(BLOCKS)]
            for x in sorted(pairs, key=lambda x: x["place"]):
                shards[x["cell"]].append(x["shard"])
            draws.append(shards)
        yield pd.DataFrame({"source_no": sources["source_no"], "draws": draws})


def mixing_plan(
    groups: DataFrame,
    n_shards: int,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 11,
) -> DataFrame:
    """One row per source: source, source_size, target, draws.

    ``groups`` has source, size, content_hash, n: n equal documents. ``draws[b]`` lists the
    shards that get block ``b``. The driver sees one row per source; blocks stay in tasks,
    at most BLOCKS per source.
    """
    spark = groups.sparkSession
    words = F.sum(F.col("size") * F.col("n")).alias("words")
    found = sorted(groups.groupBy("source").agg(words).collect(), key=lambda r: (r.source is None, r.source or ""))
    sizes = [r.words for r in found]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, most)
    sources = spark.createDataFrame(
        [(i, r.source, r.words, wanted[i]) for i, r in enumerate(found)],
        "source_no int, source string, source_size long, target double",
    )
    known = sources.select("source_no", F.col("source").alias("known"))
    blocks = (
        spread(groups.select("source", "size", "content_hash", "n"), BLOCKS)
        .groupBy("source", "cell")
        .agg(F.sum(F.col("size") * F.col("m")).alias("words"))
        .join(known, F.col("source").eqNullSafe(F.col("known")))
        .select("source_no", "cell", "words")
    )
    draws = stored(
        blocks.groupBy("source_no").applyInPandas(
            _drawer(dict(enumerate(wanted)), seed), "source_no int, place long, cell int"
        ),
        "draws",
    )
    quotas = np.zeros(len(found), np.int64)
    for source_no, n in draws.groupBy("source_no").count().collect():
        quotas[source_no] = n
    ends = split_quotas(quotas, n_shards, seed).cumsum(axis=0)
    ranges = spark.createDataFrame(
        [(i, [int(x) for x in ends[:, i]]) for i in range(len(found))],
        "source_no int, ends array<long>",
    )
    shard = F.size(F.filter("ends", lambda e: e <= F.col("place"))).alias("shard")
    drawn = (
        draws.join(ranges, "source_no")
        .groupBy("source_no")
        .agg(F.collect_list(F.struct("place", "cell", shard)).alias("pairs"))
        .mapInPandas(_gather, "source_no int, draws array<array<int>>")
    )
    return stored(sources.join(drawn, "source_no", "left").drop("source_no"), "mixing")


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


#: What tells documents of the mix apart; the hashes stand in for the null-safe columns.
IDENTITY = ("content_hash", "source_hash")


def identified(docs: DataFrame) -> DataFrame:
    """The documents with IDENTITY, from which their blocks follow."""
    return docs.withColumns({"content_hash": F.xxhash64("doc_id", "text"), "source_hash": F.xxhash64("source")})


def with_draws(cells: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of ``spread`` with source_size, target and ``shards``, those that get the rows of the cell."""
    known = plan.withColumnRenamed("source", "known")
    none = F.array().cast("array<int>")
    return (
        cells.join(known, F.col("source").eqNullSafe(F.col("known")), "left")
        .withColumn("shards", F.coalesce(F.element_at("draws", F.col("cell") + 1), none))
        .drop("known", "draws")
    )


def each(cells: DataFrame) -> DataFrame:
    """One row per document of rows with ``m``; where that is many, over all tasks."""
    every = F.explode(F.sequence(F.lit(1), F.col("m")))
    many = cells.where("m > 1").repartition("content_hash", "cell")
    return cells.where("m = 1").unionByName(many).select("*", every.alias("copy_no")).drop("m")


def _numbered(variants: DataFrame) -> DataFrame:
    """Of documents that repeat: IDENTITY, row_hash, ``first`` (the number among all rows of
    the same id, text and source of the first row equal to it) and ``n``, how many are equal.

    Rows are numbered by ``row_hash`` within its bucket, buckets one after the other, so
    no task sorts all rows of one content.
    """
    dealt = variants.withColumn("bucket", F.pmod("row_hash", F.lit(BUCKETS)))
    buckets = dealt.groupBy(*IDENTITY, "bucket").agg(F.sum("n").alias("here"))
    whole = Window.partitionBy(*IDENTITY)
    past = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select("*", F.sum("here").over(whole).alias("all"), F.sum("here").over(past).alias("past")).where("all > 1")
    inside = Window.partitionBy(*IDENTITY, "bucket").orderBy("row_hash").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce("past", F.lit(0)) + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return dealt.join(starts, [*IDENTITY, "bucket"]).select(*IDENTITY, "row_hash", first.alias("first"), "n")


def _row_hash(docs: DataFrame) -> Column:
    """Of all columns; maps, which have no hash, by their text."""
    return F.xxhash64(
        F.lit(1), *[F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema]
    )


def mix_documents(docs: DataFrame, n_shards: int = 24, **options: object) -> DataFrame:
    """The mix itself: each document as often as drawn, in the order of its shard.

    Has the columns of the documents and nothing else; rows come ordered by shard and
    by a random order within. Extra columns are kept whatever their names. Of rows that
    are equal throughout one is carried, with their number; rows that differ in an extra
    column only are each drawn by themselves. Nulls, empty texts and an empty table are as
    in ``mix_report``, which tells the same draws.
    """
    packed = identified(
        docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("row"), _row_hash(docs).alias("row_hash"))
    )
    sizes = packed.select("source", word_count("text").alias("size"), *IDENTITY, "row_hash")
    variants = stored(sizes.groupBy(*sizes.columns).agg(F.count("*").alias("n")), "sizes")
    plan = mixing_plan(variants.groupBy("source", "size", *IDENTITY).agg(F.sum("n").alias("n")), n_shards, **options)
    repeats = stored(_numbered(variants), "repeats")
    key = [*IDENTITY, "row_hash"]
    carried = packed.drop("doc_id", "text")
    joined = carried.join(repeats, key, "left").fillna({"first": 0, "n": 1})
    rows = joined.where("n = 1")
    if not repeats.where("n > 1").isEmpty():
        equal = carried.join(repeats.where("n > 1"), key).groupBy(*key, "source", "first", "n")
        rows = rows.unionByName(equal.agg(F.first("row").alias("row")))
    copies = each(with_draws(spread(rows, BLOCKS, F.col("first")), plan)).select(
        "row", "content_hash", "row_hash", "cell", "copy_no", F.posexplode("shards").alias("copy", "shard")
    )
    seat = F.xxhash64("content_hash", "row_hash", "cell", "copy_no", "copy", "shard")
    return (
        copies.withColumn("seat", seat)
        .repartitionByRange(F.col("shard"), F.col("seat"))
        .sortWithinPartitions("shard", "seat")
        .select("row.*")
    )


def mix_report(docs: DataFrame, n_shards: int = 24, **options: object) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, shards.

    ``size`` counts words (runs without ASCII white space), ``taken`` the words that the
    mix takes of the document, repeats counted: 0, 1 or 2 times its size. Null text has
    size 0; a null source is a source, the last; a source without words has target 0;
    repeated rows are drawn each by itself; an empty table gives no rows; other columns
    are not used; a text of any length is one document. The same documents give the same
    mix, in whatever order and number of splits they are read.
    """
    rows = identified(docs.select("doc_id", "text", "source"))
    narrow = rows.select("doc_id", "source", word_count("text").alias("size"), *IDENTITY)
    groups = stored(narrow.groupBy(*narrow.columns).agg(F.count("*").alias("n")), "sizes")
    return each(with_draws(spread(groups, BLOCKS), mixing_plan(groups, n_shards, **options))).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("shards")).alias("taken"),
        "shards",
    )

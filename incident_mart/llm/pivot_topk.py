"""Exact top-k inner products by pivot-table elimination.

For every vector a table holds its distances to a set of pivots. By the triangle
inequality ``|d(q, p) - d(x, p)|`` is at most ``d(q, x)``; the largest over all pivots is
a lower bound of the distance and so an upper bound of the inner product, since
``2 q.x = |q|^2 + |x|^2 - d(q, x)^2``. A query visits candidates in the order of that
bound and stops once no bound left reaches its k-th best score. Ties are kept, so the
result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .int8_tiles import matrix

PIVOTS = 32
#: Rows, those of smallest hash, among which pivots are chosen far from each other.
SAMPLE = 1024
QUERY_ROWS = 512
CANDIDATE_ROWS = 8192
#: Whole numbers below this are exact in double precision, and those below ``LONG`` fit a long.
EXACT, LONG = 1 << 53, 1 << 63


def scaled(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Rows ``vec_id, size, vector, copies`` of whole numbers; repeated rows are one, counted.

    Vectors that are null or empty, or hold null or non-finite components, are left
    out, as are rows without an id. A scaled component that fits no long is an error.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    too_large = F.raise_error(F.lit("a scaled component does not fit a long")).cast("long")

    def whole(v: Column) -> Column:
        value = v.cast("double") * scale
        return F.when(F.abs(value) < float(LONG), F.floor(value)).otherwise(too_large)

    return (
        vectors.where(F.coalesce(x.isNotNull() & (F.size(x) > 0) & ~bad, F.lit(False)) & F.col("vec_id").isNotNull())
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.size(x).alias("size"), F.transform(x, whole).alias("vector"))
        .groupBy("vec_id", "size", "vector")
        .agg(F.count("*").alias("copies"))
    )


def far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of the sample, each the farthest from those taken before."""
    taken, nearest = [0], np.full(len(sample), np.inf)
    while len(taken) < min(count, len(sample)):
        gap = sample - sample[taken[-1]]
        nearest = np.minimum(nearest, np.einsum("ij,ij->i", gap, gap))
        taken.append(int(nearest.argmax()))
    return sample[taken]


def _distances(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            out = [None] * len(sizes)
            for size in np.unique(sizes):
                some = np.flatnonzero(sizes == size)
                rows = matrix(batch.column("vector").take(pa.array(some)), int(size))
                gaps = [np.sqrt(np.einsum("ij,ij->i", rows - p, rows - p)) for p in pivots[size]]
                for at, distances in zip(some, np.stack(gaps, axis=1)):
                    out[at] = distances
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.list_(pa.float64()))], names=[*batch.schema.names, "pivots"]
            )

    return run


def pivot_table(rows: DataFrame, count: int = PIVOTS) -> DataFrame:
    """``rows`` with ``pivots``, the distances to the pivots of their size, stored."""
    pivots = {}
    for (size,) in rows.select("size").distinct().collect():
        sample = rows.where(F.col("size") == size).orderBy(F.xxhash64("vector"), "vec_id").limit(SAMPLE)
        pivots[size] = far_apart(np.array([x.vector for x in sample.collect()], np.float64), count)
    schema = "vec_id long, size int, vector array<long>, copies long, pivots array<double>"
    return stored(rows.mapInArrow(_distances(pivots), schema), "pivot-table")


def _largest(values: np.ndarray) -> int:
    """The largest absolute value; -2**63 has none in its own type."""
    return max(-int(values.min(initial=0)), int(values.max(initial=0)))


def search(queries: np.ndarray, table_q: np.ndarray, rows: np.ndarray, table: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int):
    """For each query the places and scores of its k best rows, ties to smaller ids.

    ``queries`` and ``rows`` are 64-bit integers; sums that may not fit are made of Python's.
    """
    most = _largest(rows) * _largest(queries) * rows.shape[1]
    kind = np.float64 if most < EXACT else np.int64 if most < LONG else object
    numbers = (rows.astype(kind), queries.astype(kind))
    rows, queries = rows.astype(np.float64), queries.astype(np.float64)
    squares = np.einsum("ij,ij->i", rows, rows)
    by_pivot = np.ascontiguousarray(table.T)
    for q in range(len(queries)):
        low = np.abs(by_pivot[0] - table_q[q, 0])
        for p in range(1, len(by_pivot)):
            np.maximum(low, np.abs(by_pivot[p] - table_q[q, p]), out=low)
        both = squares + queries[q] @ queries[q]
        # Room for the rounding of distances.
        bound = (both - low * low) / 2 + 1e-9 * both + 1e-6
        bound[ids == own[q]] = -np.inf
        order = np.argsort(-bound, kind="stable")
        best = np.empty(0, np.int64)
        scores = np.empty(0, numbers[0].dtype)
        at, step = 0, 64
        while at < len(order) and bound[order[at]] > -np.inf and (len(best) < k or bound[order[at]] >= scores[-1]):
            some = order[at : at + step]
            some = some[bound[some] > -np.inf]
            best = np.concatenate([best, some])
            scores = np.concatenate([scores, numbers[0][some] @ numbers[1][q]])
            first = np.lexsort((ids[best], -scores))[:k]
            best, scores = best[first], scores[first]
            at, step = at + step, step * 2
        yield best, scores


def _search_block(k: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        size = rows.column("size")[0].as_py()
        vectors = matrix(rows.column("vector"), size, np.int64)
        table = matrix(rows.column("pivots"), len(rows.column("pivots")[0]))
        ids, asks = rows.column("vec_id").to_numpy(), rows.column("asks").to_numpy(zero_copy_only=False)
        q, c = np.flatnonzero(asks), np.flatnonzero(~asks)
        found = search(vectors[q], table[q], vectors[c], table[c], ids[c], ids[q], k)
        out = {"query_key": [], "query_id": [], "queries": [], "vec_id": [], "copies": [], "score": []}
        keys, copies = rows.column("key").to_numpy(), rows.column("copies").to_numpy()
        for i, (best, scores) in zip(q, found):
            out["query_key"] += [keys[i]] * len(best)
            out["query_id"] += [ids[i]] * len(best)
            out["queries"] += [copies[i]] * len(best)
            out["copies"] += copies[c[best]].tolist()
            out["vec_id"] += ids[c[best]].tolist()
            out["score"] += [int(s) for s in scores]
            if any(not -LONG <= s < LONG for s in out["score"][-len(best) :]):
                raise OverflowError(f"a score of query {ids[i]} does not fit a long")
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    return run


def top_k(
    vectors: DataFrame,
    every: int = 50,
    k: int = 5,
    query_rows: int = QUERY_ROWS,
    candidate_rows: int = CANDIDATE_ROWS,
) -> DataFrame:
    """Rows ``query_id, rank, vec_id, score``: for each query its k highest inner products.

    Queries are the vectors whose vec_id is divisible by ``every``; candidates are all
    vectors of the same length with another vec_id. Components are floor(256 x). Fewer
    candidates give fewer rows; ties go to the smaller vec_id. Unusable vectors take no
    part, an empty table gives no rows, other columns are not read. Repeated rows count as
    often as they occur, as candidates and as queries, but are compared once. Scores are
    exact; one that fits no long is an error. Every pair of a query block and a candidate
    block is read; the pivots rule out candidates within it.
    """
    table = pivot_table(scaled(vectors))
    asks = F.col("vec_id") % every == 0
    counts = table.agg(F.count("*").alias("n"), F.count_if(asks).alias("q")).first()
    q_blocks, c_blocks = -(-(counts.q or 1) // query_rows), -(-(counts.n or 1) // candidate_rows)
    keyed = table.withColumn("key", F.xxhash64("vec_id", "vector"))

    def blocks(n: int):
        return F.pmod("key", F.lit(n)).cast("int")

    def all_of(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    queries = keyed.where(asks).select("*", F.lit(True).alias("asks"), blocks(q_blocks).alias("q"), all_of(c_blocks).alias("c"))
    candidates = keyed.select("*", F.lit(False).alias("asks"), all_of(q_blocks).alias("q"), blocks(c_blocks).alias("c"))
    found = (
        queries.unionByName(candidates)
        .groupBy("size", "q", "c")
        .applyInArrow(_search_block(k), "query_key long, query_id long, queries long, vec_id long, copies long, score long")
    )
    # No more than k copies of a candidate can be among the k best.
    copied = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (
        copied.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .withColumn("asked", F.explode(F.sequence(F.lit(1), F.col("queries"))))
        .select("query_id", "rank", "vec_id", "score")
    )

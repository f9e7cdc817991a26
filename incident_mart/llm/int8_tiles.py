"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Unit vectors are rounded to int8 with a scale each. For a pair, the product of the
rounded vectors is exact, and the norms of what rounding left out bound how far it is
from the true cosine. Tiles of codes are multiplied as matrices; a pair is linked when
the bound proves it, dropped when the bound rules it out, and left open in between. The
vectors in full go only where a pair of theirs is open, and such pairs are computed anew in
double precision. Pairs never leave their task: a tile pair reports, for each of its
vectors, a number of links, the smallest vector that they lead to, and whether it is open.

Vectors are first grouped around sampled centres. Two groups are compared only if the
angle between their centres, less both radii, is within reach of the threshold; this
never loses a pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import stored, utf8
from .components import connected_components

TILE_ROWS = 4096
#: Vectors per centre, and the most centres there are of a vector length.
ROWS_PER_CENTRE = 16_384
MOST_CENTRES = 512
STRIP = 512
#: What names a pair of tiles.
PAIR = ["size", "cell_a", "part_a", "cell_b", "part_b"]
#: Room for the rounding of single-precision scaling and double-precision sums.
SLACK = 2e-6


def usable(embedding: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(embedding, lambda x: x != 0)
    return F.coalesce(embedding.isNotNull() & ~bad & some, F.lit(False))


def matrix(column: pa.Array, size: int, kind: type = np.float64) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), size)


def unit(rows: np.ndarray) -> np.ndarray:
    # The largest component first, so that no square overflows or vanishes.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


class Tile(NamedTuple):
    """Unit vectors rounded to int8: codes, a scale each, and the norm of what rounding left out."""

    codes: np.ndarray
    scale: np.ndarray
    rest: np.ndarray

    def of(self, rows: np.ndarray) -> Tile:
        return Tile(self.codes[rows], self.scale[rows], self.rest[rows])


def quantised(units: np.ndarray) -> Tile:
    scale = np.abs(units).max(axis=1) / 127.0
    codes = np.rint(units / scale[:, None])
    rest = units - codes * scale[:, None]
    return Tile(codes.astype(np.int8), scale, np.sqrt(np.einsum("ij,ij->i", rest, rest)))


def near_pairs(a: Tile, b: Tile, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows of two tiles that may link, and which of them surely do, strip by strip.

    What is said of a pair depends on its two rows alone, in either order, so a pair that is
    left open here is left open wherever the same codes meet again.
    """
    # Floats whose sums of products of codes are exact: matrix products are fast on them.
    exact = np.float32 if a.codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
    turned = np.ascontiguousarray(b.codes.T.astype(exact))
    for low in range(0, len(a.codes), STRIP):
        strip = a.of(np.arange(low, min(low + STRIP, len(a.codes))))
        whole = strip.codes.astype(exact) @ turned
        rough = whole * strip.scale.astype(exact)[:, None]
        rough *= b.scale.astype(exact)
        # |x.y - x'.y'| <= r_x + r_y + r_x r_y for unit vectors with residual norms r.
        widest = (1 + strip.rest.max()) * (1 + b.rest.max()) - 1 + SLACK
        at = np.flatnonzero(rough.ravel() >= threshold - widest - SLACK)
        i, j = at // len(b.codes), at % len(b.codes)
        value = whole.ravel()[at].astype(np.float64) * (strip.scale[i] * b.scale[j])
        error = (1 + strip.rest[i]) * (1 + b.rest[j]) - 1 + SLACK
        near = value + error >= threshold
        i += low
        if same:
            near &= j > i
        yield i[near], j[near], (value - error >= threshold)[near]


def _summary(ids: np.ndarray, copies: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple:
    """Of linked pairs: the rows that have any, the number of each, and a root to hang it on."""
    links, root = np.zeros(len(ids), np.int64), np.argsort(np.argsort(ids))
    by_rank = np.argsort(ids)
    for i, j in pairs:
        links += np.bincount(i, copies[j], len(ids)).astype(np.int64)
        links += np.bincount(j, copies[i], len(ids)).astype(np.int64)
        while True:  # the smaller root of a link's ends wins, until all agree
            low = np.minimum(root[i], root[j])
            if (low == root[i]).all() and (low == root[j]).all():
                break
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
            # Roots that were beaten follow the one that beat them.
            root = np.minimum(root, root[by_rank[root]])
    used = np.flatnonzero(links)
    return used, links[used], ids[by_rank[root[used]]]


def _met(rows: pa.Table) -> tuple[Tile, np.ndarray, np.ndarray, bool]:
    """The vectors of a pair of tiles, the rows of either, and whether it is one tile with itself."""
    side = rows.column("side").to_numpy()
    codes, _ = utf8(rows.column("codes"))
    tile = Tile(
        codes.view(np.int8).reshape(len(side), -1), rows.column("scale").to_numpy(), rows.column("rest").to_numpy()
    )
    same = bool((side == 2).any())
    left = np.flatnonzero((side == 0) | (side == 2))
    return tile, left, left if same else np.flatnonzero(side == 1), same


def _compare(threshold: float):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """One pair of tiles by codes: the links that are sure, and the rows of pairs left open."""
        tile, left, right, same = _met(rows)
        ids, copies = rows.column("rep").to_numpy(), rows.column("copies").to_numpy()
        is_open = np.zeros(len(ids), bool)

        def sure_pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for i, j, sure in near_pairs(tile.of(left), tile.of(right), same, threshold):
                i, j = left[i], right[j]
                is_open[i[~sure]] = True
                is_open[j[~sure]] = True
                yield i[sure], j[sure]

        used, links, root = (
            _summary(ids, copies, sure_pairs()) if len(left) and len(right) else (np.empty(0, np.int64),) * 3
        )
        open_ = np.flatnonzero(is_open)
        node, side = rows.column("node").to_numpy()[open_], rows.column("side").to_numpy()[open_]
        many = len(used) + len(open_)
        return pa.table(
            {
                **{name: pa.array([part.as_py()] * many, pa.int32()) for name, part in zip(PAIR, key, strict=True)},
                "node": pa.array([None] * len(used) + node.tolist(), pa.int64()),
                "side": pa.array([None] * len(used) + side.tolist(), pa.int32()),
                "u": np.concatenate([ids[used], ids[open_]]),
                "links": np.concatenate([links, np.zeros(len(open_), np.int64)]),
                "v": np.concatenate([root, ids[open_]]),
            }
        )

    return run


def _settle(threshold: float):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """The open pairs of a pair of tiles in double precision."""
        tile, left, right, same = _met(rows)
        units = unit(matrix(rows.column("embedding"), tile.codes.shape[1]))
        ids, copies = rows.column("rep").to_numpy(), rows.column("copies").to_numpy()

        def linked() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for i, j, sure in near_pairs(tile.of(left), tile.of(right), same, threshold):
                i, j = left[i[~sure]], right[j[~sure]]
                for low in range(0, len(i), 1 << 16):
                    x, y = i[low : low + (1 << 16)], j[low : low + (1 << 16)]
                    met = np.einsum("ij,ij->i", units[x], units[y]) >= threshold
                    yield x[met], y[met]

        used, links, root = _summary(ids, copies, linked())
        return pa.table({"u": ids[used], "links": links, "v": root})

    return run


def _placed(centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector with its nearest centre, the angle to that, and its codes."""
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            cell, angle = np.zeros(len(sizes), np.int32), np.full(len(sizes), math.pi)
            scale, rest, codes = np.empty(len(sizes)), np.empty(len(sizes)), [b""] * len(sizes)
            for size in np.unique(sizes):
                some = np.flatnonzero(sizes == size)
                units = unit(matrix(batch.column("embedding").take(pa.array(some)), int(size)))
                tile = quantised(units)
                scale[some], rest[some] = tile.scale, tile.rest
                for at, row in zip(some, tile.codes, strict=True):
                    codes[at] = row.tobytes()
                if size in centres:
                    near = units @ centres[size].T
                    cell[some] = near.argmax(axis=1)
                    angle[some] = np.arccos(np.clip(near.max(axis=1), -1, 1)) + 1e-6
            more = {"cell": cell, "angle": angle, "codes": pa.array(codes, pa.binary()), "scale": scale, "rest": rest}
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x) for x in more.values())], names=[*batch.schema.names, *more]
            )

    return run


def _in_reach(centres: dict[int, np.ndarray], reach: float):
    def run(key: tuple, cells: pa.Table) -> pa.Table:
        """The pairs of cells of one vector length that may hold links."""
        size = key[0].as_py()
        cell, radius = cells.column("cell").to_numpy(), cells.column("radius").to_numpy()
        apart = np.zeros((len(cell), len(cell)))
        if size in centres:
            among = centres[size][cell]
            apart = np.arccos(np.clip(among @ among.T, -1, 1)) - radius[:, None] - radius
            np.fill_diagonal(apart, 0)
        a, b = np.nonzero((apart <= reach + 1e-6) & (cell[:, None] <= cell))
        return pa.table({"size": np.full(len(a), size, np.int32), "cell_a": cell[a], "cell_b": cell[b]})

    return run


def _tiles(distinct: DataFrame, threshold: float, tile_rows: int, rows_per_centre: int) -> tuple[DataFrame, DataFrame]:
    """The vectors with their tile, and the pairs of tiles that may hold links."""
    centres = {}
    # Lengths with centres have at least two times ``rows_per_centre`` vectors.
    sizes = distinct.groupBy("size").count().where(F.col("count") >= 2 * rows_per_centre)
    for size, n in sizes.collect():
        k = min(n // rows_per_centre, MOST_CENTRES)
        sample = distinct.where(F.col("size") == size).orderBy(F.xxhash64("embedding"), "rep").limit(k)
        centres[size] = unit(np.array([list(x.embedding) for x in sample.select("embedding").collect()], np.float64))
    more = "cell int, angle double, codes binary, scale double, rest double"
    schema = StructType([*distinct.schema.fields, *StructType.fromDDL(more).fields])
    placed = stored(
        distinct.mapInArrow(_placed(centres), schema).withColumn("node", F.monotonically_increasing_id()), "placed"
    )
    parts = F.ceil(F.count("*") / tile_rows).cast("int").alias("parts")
    cells = stored(placed.groupBy("size", "cell").agg(parts, F.max("angle").alias("radius")), "cells")
    # At most ``MOST_CENTRES`` cells of a length meet in a task.
    met = cells.groupBy("size").applyInArrow(
        _in_reach(centres, math.acos(threshold)), "size int, cell_a int, cell_b int"
    )
    tiled = placed.join(cells.select("size", "cell", "parts"), ["size", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    )
    numbered = cells.select("size", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    left = numbered.select("size", F.col("cell").alias("cell_a"), F.col("part").alias("part_a"))
    right = numbered.select("size", F.col("cell").alias("cell_b"), F.col("part").alias("part_b"))
    tile_pairs = met.join(left, ["size", "cell_a"]).join(right, ["size", "cell_b"])
    return tiled, tile_pairs.where("cell_a < cell_b OR part_a <= part_b")


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.95,
    tile_rows: int = TILE_ROWS,
    rows_per_centre: int = ROWS_PER_CENTRE,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Two vectors link when their cosine in double precision is at least ``threshold``.
    ``n_links`` counts the other vectors linked directly; ``component_id`` is the
    smallest vec_id that links lead to, itself included; ``kept`` marks that one.
    Vectors that are null, zero, or hold null or non-finite components link with
    nothing, nor do vectors of different length or without an id. Equal vectors are
    compared once, however many; repeated rows are vectors each. An empty table gives
    no rows, other columns are not used.
    """
    rows = stored(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            "embedding",
            (usable(F.col("embedding")) & F.col("vec_id").isNotNull()).alias("used"),
        ),
        "vectors",
    )
    used = rows.where("used")
    distinct = stored(
        used.groupBy("embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("size", F.size("embedding")),
        "distinct",
    )
    tiled, pairs = _tiles(distinct, threshold, tile_rows, rows_per_centre)
    one = (F.col("cell_a") == F.col("cell_b")) & (F.col("part_a") == F.col("part_b"))
    seats = pairs.select(
        *PAIR, F.col("cell_a").alias("cell"), F.col("part_a").alias("part"), F.when(one, 2).otherwise(0).alias("side")
    ).union(pairs.where(~one).select(*PAIR, F.col("cell_b"), F.col("part_b"), F.lit(1)))
    tags = "size int, cell_a int, part_a int, cell_b int, part_b int, "
    compared = stored(
        tiled.select("node", "rep", "copies", "codes", "scale", "rest", "size", "cell", "part")
        .join(seats, ["size", "cell", "part"])
        .drop("cell", "part")
        .groupBy(*PAIR)
        .applyInArrow(_compare(threshold), tags + "node long, side int, u long, links long, v long"),
        "compared",
    )
    # Vectors in full go only to the pairs of tiles in which a pair of theirs is open.
    settled = stored(
        compared.where("node IS NOT NULL")
        .select(*PAIR, "node", "side")
        .join(tiled.select("node", "rep", "copies", "codes", "scale", "rest", "embedding"), "node")
        .groupBy(*PAIR)
        .applyInArrow(_settle(threshold), "u long, links long, v long"),
        "settled",
    )
    found = compared.where("node IS NULL").select("u", "links", "v").union(settled)
    counts = found.groupBy("u").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select("u", "v").distinct())
    known = (
        distinct.select("embedding", "rep", "copies")
        .join(counts.withColumnRenamed("u", "rep"), "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    )
    out = used.select("vec_id", "embedding").join(known, "embedding").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    alone = rows.where("NOT used").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

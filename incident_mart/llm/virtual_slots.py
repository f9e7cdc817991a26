"""Shards from fixed virtual slots and a versioned slot-to-shard map.

Every record hashes into one of thousands of virtual slots, for good. The bytes of each
slot are summed (map-side, a row per slot), and a small stored map says which shard a slot
is in. Version 1 places heavy slots first; when weights have changed or a shard is added,
the map is edited, which moves as few slots as it takes and is stored as one more version. A
record never hashes anew: its slot follows from its id and text, and for the copies of a
record from their number among their equals, so the slots that a corpus fills are the same
however its files are split.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from incident_mart.session import scratch_dir

from .common import spread, stored, text_bytes

SLOTS = 4096


def _best_swap(full: list[tuple[int, int]], empty: list[tuple[int, int]], gap: int) -> tuple:
    """The slots of two shards whose exchange narrows the gap most, or nothing."""
    best, found = gap, ((0, 0), None)
    for x in full:
        at = bisect_right(empty, (x[0] - gap // 2, -1))
        for y in empty[max(at - 1, 0) : at + 1]:
            if 0 < x[0] - y[0] and abs(gap - 2 * (x[0] - y[0])) < best:
                best, found = abs(gap - 2 * (x[0] - y[0])), (x, y)
    return found


@dataclass(frozen=True)
class SlotMap:
    """``shard_of[slot]`` under a version, and the slot weights that it was made from."""

    version: int
    n_shards: int
    shard_of: tuple[int, ...]
    weights: tuple[int, ...]

    @staticmethod
    def first(weights: list[int], n_shards: int) -> SlotMap:
        """Version 1, of a corpus that has no shards yet: heavy slots first, to the emptiest shard."""
        shard_of, loads = [0] * len(weights), [(0, s) for s in range(n_shards)]
        for slot in sorted(range(len(weights)), key=lambda s: (-weights[s], s)):
            load, shard = loads[0]
            shard_of[slot] = shard
            heapq.heapreplace(loads, (load + weights[slot], shard))
        return SlotMap(1, n_shards, tuple(shard_of), tuple(weights))

    def weighed(self, weights: list[int]) -> SlotMap:
        """The same places, with the slots' weights of today."""
        return replace(self, weights=tuple(weights))

    def _edited(self, loads: list[int], slots: list[list[tuple[int, int]]], low: list, high: list) -> tuple[int, ...]:
        """Move slots from the fullest to the emptiest shard while that narrows their gap.

        Where no slot is light enough to move, two slots change places.
        """
        shard_of = list(self.shard_of)
        while True:
            while loads[low[0][1]] != low[0][0]:
                heapq.heapreplace(low, (loads[low[0][1]], low[0][1]))
            while loads[high[0][1]] != -high[0][0]:
                heapq.heapreplace(high, (-loads[high[0][1]], high[0][1]))
            to, source = low[0][1], high[0][1]
            gap = loads[source] - loads[to]
            # The heaviest slot up to half the gap; else the lightest, if that still helps.
            at = bisect_right(slots[source], (gap // 2, len(shard_of)))
            choices = [slots[source][i] for i in (at - 1, at) if 0 <= i < len(slots[source])]
            best = min(choices, key=lambda x: (abs(gap - 2 * x[0]), x), default=(0, 0))
            back = None
            if not 0 < best[0] < gap:
                best, back = _best_swap(slots[source], slots[to], gap)
                if back is None:
                    return tuple(shard_of)
            moves = [(best, source, to)] + ([(back, to, source)] if back else [])
            for slot, here, there in moves:
                slots[here].remove(slot)
                insort(slots[there], slot)
                shard_of[slot[1]] = there
                loads[here] -= slot[0]
                loads[there] += slot[0]

    def balanced(self) -> SlotMap:
        """The next version: shards' weights as near equal as moving slots makes them."""
        loads = [0] * self.n_shards
        slots: list[list[tuple[int, int]]] = [[] for _ in loads]
        for slot, weight in enumerate(self.weights):
            loads[self.shard_of[slot]] += weight
            insort(slots[self.shard_of[slot]], (weight, slot))
        low = [(x, i) for i, x in enumerate(loads)]
        high = [(-x, i) for i, x in enumerate(loads)]
        heapq.heapify(low)
        heapq.heapify(high)
        return replace(self, version=self.version + 1, shard_of=self._edited(loads, slots, low, high))

    def grown(self) -> SlotMap:
        """The next version with one more shard, which takes slots and gives none."""
        n, shard_of = self.n_shards, list(self.shard_of)
        loads = [0] * n
        slots: list[list[tuple[int, int]]] = [[] for _ in loads]
        for slot, weight in enumerate(self.weights):
            loads[shard_of[slot]] += weight
            insort(slots[shard_of[slot]], (weight, slot))
        fair, taken = sum(self.weights) // (n + 1), 0
        while True:
            source = max(range(n), key=lambda i: (loads[i], -i))
            at = bisect_right(slots[source], (fair - taken, len(shard_of)))
            filled = bisect_right(slots[source], (0, len(shard_of)))
            if at <= filled or loads[source] <= fair:
                return replace(self, version=self.version + 1, n_shards=n + 1, shard_of=tuple(shard_of))
            # Of middling weight, so that no single shard gives all.
            weight, slot = slots[source].pop((filled + at) // 2)
            shard_of[slot] = n
            loads[source] -= weight
            taken += weight

    def frame(self, spark: SparkSession) -> DataFrame:
        """The map as rows, one per slot: see MAP."""
        rows = [(self.version, self.n_shards, len(self.weights), s, self.shard_of[s], w) for s, w in enumerate(self.weights)]
        return spark.createDataFrame(rows, MAP)

    def save(self, spark: SparkSession, path: str) -> None:
        """The map as one more version under ``path``; a version that is there is never changed."""
        self.frame(spark).coalesce(1).write.parquet(f"{path.rstrip('/')}/map-{self.version:09d}")

    @staticmethod
    def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap | None:
        """A stored version, the latest if none is named; nothing if there is none.

        A version counts if all its slots are there, so one whose write was cut off does not.
        """
        try:
            rows = spark.read.schema(MAP).parquet(f"{path.rstrip('/')}/map-*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        whole = rows.groupBy("version", "slots").agg(F.countDistinct("cell").alias("n")).where("n = slots")
        if version is not None:
            whole = whole.where(F.col("version") == version)
        latest = whole.agg(F.max("version")).first()[0]
        if latest is None:
            return None
        found = sorted(rows.where(F.col("version") == latest).collect(), key=lambda r: r.cell)  # a row per slot
        return SlotMap(latest, found[0].n_shards, tuple(r.shard for r in found), tuple(r.cell_bytes for r in found))


#: The columns of a stored map.
MAP = "version int, n_shards int, slots int, cell int, shard int, cell_bytes long"


def slotted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """Rows ``doc_id, size, text_crc32, content_hash, cell, m``: ``m`` equal records in a slot.

    ``size`` is the text's UTF-8 bytes (0 for null) plus 8. The slot (``cell``) comes from
    the id and the text; the copies of a record take the slots after it in turn.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (text_bytes(text) + 8).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("content_hash"),
    )
    groups = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    return stored(spread(groups, slots), "slotted")


def slot_weights(rows: DataFrame, slots: int = SLOTS) -> list[int]:
    """Bytes per slot: ``slots`` numbers, however many rows there are."""
    weights = [0] * slots
    for cell, weight in rows.groupBy("cell").agg(F.sum(F.col("size") * F.col("m"))).collect():
        weights[cell] = weight
    return weights


def shard_records(rows: DataFrame, slot_map: SlotMap, grown: SlotMap | None = None) -> DataFrame:
    """A row per record of ``slotted``, with ``shard`` and ``slot``, its gapless place in the shard.

    Places are counted inside a virtual slot, by doc_id, and moved by the rows of the
    shard's slots before it: no task sorts a whole shard.
    """
    spark = rows.sparkSession
    counts = {c: n for c, n in rows.groupBy("cell").agg(F.sum("m")).collect()}
    before, offsets = [0] * slot_map.n_shards, []
    for cell, shard in enumerate(slot_map.shard_of):
        offsets.append(before[shard])
        before[shard] += counts.get(cell, 0)
    later = (grown or slot_map).shard_of
    places = spark.createDataFrame(
        [(c, s, offsets[c], later[c]) for c, s in enumerate(slot_map.shard_of)],
        "cell int, shard int, before long, next_shard int",
    )
    order = Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size", "content_hash")
    upto = F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        rows.withColumn("upto", upto)
        .join(F.broadcast(places), "cell")
        .withColumn("last", F.col("before") + F.col("upto") - 1)
        .withColumn("slot", F.explode(F.sequence(F.col("last") - F.col("m") + 1, F.col("last"))))
        .drop("upto", "last", "m")
    )


def current_map(rows: DataFrame, n_shards: int, path: str, slots: int = SLOTS) -> SlotMap:
    """The map that rows are placed by: the stored one, edited for the weights of today.

    Where none is stored, version 1 is made and stored first. An edit that moves slots is
    stored as the next version; if none has to move, the stored version stays.
    """
    spark, weights = rows.sparkSession, slot_weights(rows, slots)
    if SlotMap.load(spark, path) is None:
        SlotMap.first(weights, n_shards).save(spark, path)
    known = SlotMap.load(spark, path)
    if (known.n_shards, len(known.shard_of)) != (n_shards, slots):
        raise ValueError(f"{path} maps {len(known.shard_of)} slots to {known.n_shards} shards")
    edited = known.weighed(weights).balanced()
    if edited.shard_of == known.shard_of:
        return known
    edited.save(spark, path)
    return SlotMap.load(spark, path)


def shard_documents(docs: DataFrame, n_shards: int = 24, map_path: str | None = None) -> DataFrame:
    """One row per document: shard and place under a stored map that balances bytes.

    Columns: doc_id, size, text_crc32, law ('bytes'), shard, slot (place in the shard,
    0, 1, ...), grown_shard (null: under this law growing follows the bytes),
    virtual_slot, next_shard (the shard after one more is added by the next map
    version: either the same or the new one), map_version.

    ``map_path`` is where the map's versions are stored; a later run over it starts from the
    latest and moves only the slots of its edit. Without it the map is a new one.

    Null text has size 8 and the checksum of an empty text; null ids are records like
    any other; repeated records each get a place; an empty table gives no rows; other
    columns are not used; a text of any length is one record. The result does not depend
    on the number of splits that the files are read in.
    """
    rows = slotted(docs)
    slot_map = current_map(rows, n_shards, map_path or scratch_dir(docs.sparkSession, "slot_map"))
    return shard_records(rows, slot_map, slot_map.grown()).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("cell").alias("virtual_slot"),
        "next_shard",
        F.lit(slot_map.version).alias("map_version"),
    )

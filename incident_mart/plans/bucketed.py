"""Persons and crashes bucketed by crash id as they are loaded, so that the fact needs no shuffle.

A bucket is one task, so no id with many rows may lie in one: the rows of *apart* ids, and
those without an id, go to tables of their own that are not bucketed. Which ids are apart
follows from counts that each load leaves; rows are never moved, reads take the current list.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import HOT_ROWS
from ..operators.projection import assert_columns
from ..schemas import CRASHES as CRASHES_FEED
from ..schemas import LOAD_ID
from ..schemas import PERSONS as PERSONS_FEED
from ..session import scratch_dir
from ..sources.files import names_at, remove, store, store_counted
from ..sources.tables import compactions, create_table_if_absent, live_loads, read_table
from .feeds import Layout
from .models import fact_traffic_accidents, stg_persons_data, stg_traffic_data

ID = "crash_record_id"
PERSONS, CRASHES = "persons", "crashes"
#: The last is there while a load is added.
_BY_CRASH, _APART, _DEALT = "by_crash", "apart", "dealt"
#: Plan parameter: how many rows of a bucket one task ranks and joins at most, about.
SLICE_ROWS = 2_000_000
#: Plan parameter: up to so many apart ids are broadcast; of more, the hottest alone.
FEW_IDS = 100_000
_NOTES = "kind string, apart_id string, rows bigint, spread boolean"


@dataclass(frozen=True)
class _Apart:
    """Apart ids ``(apart_id)``, by how they meet the rows.

    ``sent`` is broadcast: all ids if they are few, else at most one per ``HOT_ROWS`` rows.
    ``joined`` are the others, which grow with the tables if ``hot_rows`` is low: they are
    sorted and joined by id, in the buckets where the rows are in buckets.
    """

    sent: DataFrame
    joined: DataFrame | None = None

    @classmethod
    def of(cls, ids: DataFrame, few: bool) -> _Apart:
        """Of ``(apart_id, rows)``."""
        if few:
            return cls(ids.select("apart_id"))
        is_hot = F.col("rows") > HOT_ROWS
        return cls(*(some.select("apart_id") for some in (ids.filter(is_hot), ids.filter(~is_hot))))


@dataclass(frozen=True)
class CrashBuckets:
    """Tables of a catalog database over files under one root.

    ``buckets`` is fixed by the first load; a bucket of a whole table should hold some
    hundred MB. An id with more than ``hot_rows`` rows in either table, over all loads, is
    apart. Loads note ids from a hundredth of that on, so the notes stay small and an id
    that grows by less in each of more than a hundred loads stays in its bucket.

    ``add`` replaces a load that is run again. Readers take loads that are whole; one that
    is run again after it was whole must be run to its end before it is read. One writer at
    a time. The files can be attached to a new catalog: the tables are made again on use.
    """

    database: str
    root: str
    buckets: int = 512
    hot_rows: int = HOT_ROWS

    def _name(self, kind: str, place: str) -> str:
        return f"`{self.database}`.`{kind}_{place}`"

    def _attach(self, spark: SparkSession, kind: str, place: str, rows: DataFrame | None) -> str:
        """The table's name, made if the catalog lacks it: from ``rows``, or from its files."""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        name, path = self._name(kind, place), f"{self.root}/{kind}_{place}"
        if not spark.catalog.tableExists(name):
            if rows is None:
                rows = spark.read.parquet(f"{self.root}/schemas/{kind}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
            bucketed = f"CLUSTERED BY ({ID}) SORTED BY ({ID}) INTO {self.buckets} BUCKETS"
            spark.sql(
                f"CREATE TABLE {name} ({columns}, `{LOAD_ID}` string) USING parquet "
                f"PARTITIONED BY ({LOAD_ID}) {'' if place == _APART else bucketed} LOCATION '{path}'"
            )
            if names_at(spark, f"{path}/{LOAD_ID}=*"):
                spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    def _check_buckets(self, spark: SparkSession, name: str) -> None:
        about = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'")
        found = int(about.first()["data_type"])
        if found != self.buckets:
            raise ValueError(f"{name} has {found} buckets, not {self.buckets}")

    def loads(self, spark: SparkSession) -> list[str]:
        """The loads that are whole."""
        marks = names_at(spark, f"{self.root}/notes/*/_SUCCESS")
        return sorted(mark.rsplit("/", 2)[1] for mark in marks)

    def _notes(self, spark: SparkSession, without: str | None = None) -> DataFrame:
        folders = [f"{self.root}/notes/{load}" for load in self.loads(spark) if load != without]
        if not folders:
            columns = [c.rsplit(" ", 1) for c in _NOTES.split(", ")]
            return spark.range(0).select(*[F.lit(None).cast(kind).alias(c) for c, kind in columns])
        return spark.read.schema(_NOTES).parquet(*folders)

    def _apart_ids(self, notes: DataFrame) -> DataFrame:
        """``(apart_id, rows)``: at most one id per ``hot_rows`` rows of either table.

        ``rows`` are the noted rows in the table that has more of them.
        """
        by_kind = notes.groupBy("apart_id", "kind").agg(
            F.sum("rows").alias("rows"), F.max("spread").alias("spread")
        )
        is_apart = F.col("spread") | (F.col("rows") > self.hot_rows)
        return by_kind.filter(is_apart).groupBy("apart_id").agg(F.max("rows").alias("rows"))

    def _noted(self, rows: DataFrame, kind: str) -> DataFrame:
        """The ids worth counting, with their rows in this load; shrinks before its shuffle."""
        counts = rows.filter(F.col(ID).isNotNull()).groupBy(F.col(ID).cast("string").alias("apart_id"))
        floor = max(1, self.hot_rows // 100)
        many = counts.agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") >= floor)
        return many.select(F.lit(kind).alias("kind"), "apart_id", "rows", F.lit(False).alias("spread"))

    def add(
        self,
        spark: SparkSession,
        load_id: str,
        persons: DataFrame | None = None,
        crashes: DataFrame | None = None,
    ) -> None:
        """Add one load's rows of the staging models, or replace those it had before.

        A load that never has rows of one kind may leave it out.
        """
        given = {PERSONS: persons, CRASHES: crashes}
        frames = {kind: rows for kind, rows in given.items() if rows is not None}
        scratch = scratch_dir(spark, "crash-buckets")
        try:
            counted = [self._noted(rows, kind) for kind, rows in frames.items()]
            every = reduce(DataFrame.unionByName, counted)
            noted, notes = store_counted(every, f"{scratch}/noted", ids=F.count(F.lit(1)))
            known = self._notes(spark, without=load_id).unionByName(noted)
            ids, found = store_counted(self._apart_ids(known), f"{scratch}/apart", ids=F.count(F.lit(1)))
            apart = _Apart.of(ids, few=found["ids"] <= FEW_IDS)
            for kind, rows in frames.items():
                self._write(spark, load_id, kind, rows, apart)
            spread = ids.select(
                F.lit(None).cast("string").alias("kind"),
                "apart_id",
                F.lit(0).cast("bigint").alias("rows"),
                F.lit(True).alias("spread"),
            )
            # Written last: this is what makes the load one that is read.
            files = 1 + (notes["ids"] + found["ids"]) // (10 * FEW_IDS)
            store(noted.unionByName(spread).coalesce(files), f"{self.root}/notes/{load_id}")
        finally:
            remove(spark, scratch)

    def _write(self, spark: SparkSession, load_id: str, kind: str, rows: DataFrame, apart: _Apart) -> None:
        if not names_at(spark, f"{self.root}/schemas/{kind}/_SUCCESS"):
            store(rows.filter(F.lit(False)).coalesce(1), f"{self.root}/schemas/{kind}")
        names = spark.read.parquet(f"{self.root}/schemas/{kind}").columns
        assert_columns(rows, names)
        rows = rows.select(*names)
        usual, others = _told_apart(rows, F.broadcast(apart.sent))
        spread = others.unionByName(rows.filter(F.col(ID).isNull())).hint("rebalance")
        bucketed = self._attach(spark, kind, _BY_CRASH, rows)
        self._check_buckets(spark, bucketed)
        # Dealt as the buckets are, so a load adds one file to each.
        usual = usual.repartition(self.buckets, ID)
        try:
            if apart.joined is not None:
                # Stored in buckets of their own: the rows are dealt once, and told apart there.
                dealt = self._attach(spark, kind, _DEALT, rows)
                self._insert(spark, dealt, load_id, usual)
                stored = spark.table(dealt).filter(F.col(LOAD_ID) == load_id).drop(LOAD_ID)
                usual, more = _told_apart(stored, apart.joined.hint("merge"))
                spread = spread.unionByName(more)
            self._insert(spark, bucketed, load_id, usual)
            self._insert(spark, self._attach(spark, kind, _APART, rows), load_id, spread)
        finally:
            if apart.joined is not None:
                spark.sql(f"DROP TABLE IF EXISTS {self._name(kind, _DEALT)}")
                remove(spark, f"{self.root}/{kind}_{_DEALT}")

    def _insert(self, spark: SparkSession, name: str, load_id: str, rows: DataFrame) -> None:
        spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION ({LOAD_ID} = '{load_id}') SELECT * FROM {{rows}}",
            rows=rows,
        )

    def catch_up(self, spark: SparkSession, layout: Layout) -> list[str]:
        """Add the staging rows of each load of the feeds' tables that is not in yet; their names.

        A load of a table is a load here, named after its feed. A compaction of loads that
        are all in adds nothing, one of loads that are not is added as one; one that mixes
        them is an error, so catch up before compacting.
        """
        done, added = set(self.loads(spark)), []
        for feed, kind, staged in (
            (PERSONS_FEED, PERSONS, stg_persons_data),
            (CRASHES_FEED, CRASHES, stg_traffic_data),
        ):
            path, schema = layout.table(feed), feed.table_schema
            create_table_if_absent(spark, path, schema, layout.prefix_digits)
            replaced = compactions(spark, path)
            for load in live_loads(spark, path):
                name = f"{kind}-{load}"
                if name in done:
                    continue
                known = [f"{kind}-{old}" in done for old in replaced.get(load, [])]
                if any(known) and not all(known):
                    raise ValueError(f"{path}: {load} replaces loads of which only some are in the buckets")
                rows = read_table(spark, path, schema, only_load=load)
                self.add(spark, name, **{kind: staged(rows.limit(0) if any(known) else rows)})
                added.append(name)
        return added

    def _rows(self, spark: SparkSession, kind: str, place: str) -> DataFrame:
        table = spark.table(self._attach(spark, kind, place, None))
        return table.filter(F.col(LOAD_ID).isin(self.loads(spark))).drop(LOAD_ID)

    def rows(self, spark: SparkSession, kind: str) -> DataFrame:
        """All rows of ``"persons"`` or ``"crashes"``."""
        return self._rows(spark, kind, _BY_CRASH).unionByName(self._rows(spark, kind, _APART))

    def fact(self, spark: SparkSession) -> DataFrame:
        """``fact_traffic_accidents`` of all rows.

        Rank and join of the bucketed rows run inside the buckets, without a shuffle. Apart
        ids, if any, take the general plan: they shrink before the rank's shuffle, and the
        join's skew is split at run time. A list of more than ``FEW_IDS`` apart ids is stored
        under ``spark.checkpoint.dir``, where it must stay until the fact has been read.
        """
        people, crashes = (self._rows(spark, kind, _BY_CRASH) for kind in (PERSONS, CRASHES))
        ids = self._apart_ids(self._notes(spark))
        slices = self._slices(people, crashes)
        found = ids.limit(FEW_IDS + 1).count()
        if not found:
            return _sliced_fact(people, crashes, slices)
        if found > FEW_IDS:
            ids = store(ids, scratch_dir(spark, "crash-buckets-apart"))
        apart = _Apart.of(ids, few=found <= FEW_IDS)
        (people, more_people), (crashes, more_crashes) = _split(people, apart), _split(crashes, apart)
        others = fact_traffic_accidents(
            more_people.unionByName(self._rows(spark, PERSONS, _APART)),
            more_crashes.unionByName(self._rows(spark, CRASHES, _APART)),
        )
        return _sliced_fact(people, crashes, slices).unionByName(others)

    def _slices(self, people: DataFrame, crashes: DataFrame) -> int:
        """Into how many slices by id the buckets must be cut; counts are read off the files' footers."""
        return max(1, *(-(-rows.count() // (self.buckets * SLICE_ROWS)) for rows in (people, crashes)))


def _sliced_fact(people: DataFrame, crashes: DataFrame, slices: int) -> DataFrame:
    """The fact inside the buckets, by a task for each slice of a bucket.

    Buckets are as many as when the first load came, so what a task holds would grow with
    the tables. A slice has a part of the ids of each bucket; its tasks read the buckets'
    files and keep that part, so slices cost reads, but neither a shuffle nor memory.
    """
    if slices == 1:
        return fact_traffic_accidents(people, crashes)
    part = F.pmod(F.xxhash64(ID), F.lit(slices))
    facts = [fact_traffic_accidents(people.filter(part == i), crashes.filter(part == i)) for i in range(slices)]
    return reduce(DataFrame.unionByName, facts)


def _split(rows: DataFrame, apart: _Apart) -> tuple[DataFrame, DataFrame]:
    """Bucketed rows of usual ids and of apart ids; none without an id."""
    usual, others = _told_apart(rows, F.broadcast(apart.sent))
    if apart.joined is None:
        return usual, others
    usual, more = _told_apart(usual, apart.joined.hint("merge"))
    return usual, others.unionByName(more)


def _id_of(rows: DataFrame) -> Column:
    """The apart id in the type of the rows' ids, which is what buckets go by."""
    return F.col("ids.apart_id").try_cast(rows.schema[ID].dataType)


def _told_apart(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with one of the ids, joined as ``ids`` is hinted; none without an id."""
    with_id = rows.filter(F.col(ID).isNotNull()).alias("rows")
    same = F.col(f"rows.{ID}") == _id_of(rows)
    return with_id.join(ids.alias("ids"), same, "left_anti"), with_id.join(ids.alias("ids"), same, "left_semi")

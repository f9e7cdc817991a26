"""The fact table kept by change: a load touches only the parts its crashes are in.

Loads only ever add rows, so the latest person of a group follows from the latest one
before and the rows of the load. Three folders under one root, all partitioned by a hash of
the crash id: ``latest`` (a row per person type and crash), ``conditions`` (the crashes'
columns that the fact shows, by load) and ``fact``. A load reads the touched parts of the
first two, never the feeds' tables, and replaces just those parts of the third.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import latest_per_group
from ..session import scratch_dir
from ..sources.files import exists, read_parquet_as, remove, store
from .models import (
    FACT_COLUMNS,
    FACT_CRASH_COLUMNS,
    FACT_PERSON_COLUMNS,
    fact_of_latest,
    person_ties,
    without_passengers,
)

PART, LOAD = "crash_part", "load_id"
GROUP = ["person_type", "crash_record_id"]


@dataclass(frozen=True)
class KeptFact:
    """The folders of a kept fact. ``parts`` is fixed by the first load into a root.

    A part should hold some hundred MB of the fact, and parts should outnumber what a load
    touches where loads are small.
    """

    root: str
    parts: int = 256

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("crash_record_id"), F.lit(self.parts)).cast("int")

    def _read(self, spark: SparkSession, name: str, schema: T.StructType, touched: list[int]) -> DataFrame:
        """The touched parts of a folder, by partition pruning; none if it is not there yet."""
        if not exists(spark, self._path(name)):
            return spark.createDataFrame([], schema)
        return read_parquet_as(spark, self._path(name), schema).filter(F.col(PART).isin(touched))

    def _replace(self, rows: DataFrame, name: str, *by: str) -> None:
        """Replace the partitions that ``rows`` has; a large one is written by several tasks."""
        even = rows.hint("rebalance", *by).write.mode("overwrite")
        even.option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(self._path(name))

    def bring_in(self, spark: SparkSession, load_id: str, persons: DataFrame, crashes: DataFrame) -> list[int]:
        """Add one load's rows of the staging models; the parts that it touched.

        Either frame may be empty. A load that is run again, also after it was cut off,
        gives the same fact; one that was cut off must be run again before the next one.
        One writer at a time.
        """
        ties = person_ties(persons)
        wanted = [*dict.fromkeys([*GROUP, *FACT_PERSON_COLUMNS, *ties])]
        scratch = scratch_dir(spark, "kept-fact")
        try:
            return self._bring_in(spark, load_id, persons.select(*wanted), crashes, ties, scratch)
        finally:
            remove(spark, scratch)

    def _bring_in(
        self,
        spark: SparkSession,
        load_id: str,
        persons: DataFrame,
        crashes: DataFrame,
        ties: list[str],
        scratch: str,
    ) -> list[int]:
        # Ranked once, with what was known before: the rows are shuffled a single time.
        news = without_passengers(persons).withColumn(PART, self._part())
        columns = ["crash_record_id", *FACT_CRASH_COLUMNS]
        labels = {LOAD: F.lit(load_id), PART: self._part()}
        said = store(crashes.select(*columns).withColumns(labels), f"{scratch}/said")
        changed = news.select(PART).union(said.select(PART)).distinct().collect()  # at most ``parts``
        touched = sorted(r[PART] for r in changed)
        if not touched:
            return []
        before = self._read(spark, "latest", news.schema, touched)
        every = before.unionByName(news)
        # Stored first: a folder cannot be read and replaced by one plan.
        latest = store(latest_per_group(every, GROUP, "traffic_crash_date", ties), f"{scratch}/latest")
        self._replace(said, "conditions", PART, LOAD)
        self._replace(latest, "latest", PART)
        known = self._read(spark, "conditions", said.schema, touched).drop(PART)
        self._replace(fact_of_latest(latest, known, carried=(PART,)), "fact", PART)
        return touched

    def read(self, spark: SparkSession) -> DataFrame:
        """The whole fact, with the columns of ``fact_traffic_accidents``."""
        return spark.read.parquet(self._path("fact")).select(*FACT_COLUMNS)

"""Keyed tables: parquet, one ``load_id=...`` folder per load.

A load writes a folder of its own and deletes no committed one, so a load that is run
again, after a failure or not, leaves each row once. One writer per table at a time:
loads that one driver runs side by side take turns, several drivers must not.

Two things keep a table of many loads cheap. A table made with ``prefix_digits`` has a
folder ``key_prefix=...`` per leading hex digits of the key inside each load, and a merge
reads only the prefixes its batch has. ``compact_table`` writes the rows of many loads as
one; ``read_table`` takes the loads that are *live*: committed, and not replaced by a
compaction whose mark is written.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.contract import required
from ..operators.merge import (
    FEW_KEYS,
    KEY,
    NEW,
    ROWS,
    counted_keys,
    rows_of_new_keys,
    rows_without_known_keys,
    status_of,
)
from ..operators.projection import assert_columns
from ..schemas import LOAD_ID, ROW_KEY
from .files import exists, names_at, remove, sizes_at, store_counted

_CREATED = "created"
#: Spark's readers skip folders whose name starts with an underscore.
_KEYS = "_keys"
_LAYOUT = "_layout"
_MARKS = "_compactions"
_COMPACT = "compact-"
#: Directory column of tables laid out by the leading hex digits of their key.
KEY_PREFIX = "key_prefix"
#: 16 ** 4 prefixes are the most a merge lists.
_MOST_DIGITS = 4
#: Plan parameters: how large a compacted file is about, up to how many prefix folders a
#: compaction copies one by one, and from how many rows on a load is not gathered by
#: prefix where there are at most 16 of them.
_FILE_BYTES = 128 << 20
_MOST_COPIED = 300
_LARGE_LOAD = 1_000_000
_WRITERS: defaultdict[str, Lock] = defaultdict(Lock)
_LOAD_NAME = re.compile(r"[A-Za-z0-9_.-]+")
#: How to make a session's view anew.
_VIEWS: dict[tuple[SparkSession, str], Callable[[], DataFrame]] = {}


def key_prefix(key: Column, kind: T.DataType, digits: int) -> Column:
    """The first hex digits of a key: of its bytes, or of the MD5 hash of any other key."""
    if isinstance(kind, T.BinaryType):
        return F.left(F.lower(F.hex(F.substring(key, 1, (digits + 1) // 2))), F.lit(digits))
    return F.left(F.md5(key.cast("string")), F.lit(digits))


def create_table_if_absent(
    spark: SparkSession, path: str, schema: T.StructType, prefix_digits: int = 0
) -> None:
    """An empty table, unless there is one.

    ``prefix_digits`` (0 to 4) lays its loads out by the leading hex digits of the key, for
    tables so large that a merge should not read every key. Two digits make 256 folders
    a load; merge daily loads into fewer with ``compact_table``.
    """
    if not 0 <= prefix_digits <= _MOST_DIGITS:
        raise ValueError(f"prefix_digits is 0 to {_MOST_DIGITS}, not {prefix_digits}")
    folder = f"{path}/{LOAD_ID}={_CREATED}"
    if exists(spark, f"{folder}/_SUCCESS"):
        return
    empty = spark.createDataFrame([], schema)
    if prefix_digits:
        digits = spark.createDataFrame([(str(prefix_digits),)], "value string")
        digits.coalesce(1).write.mode("overwrite").text(f"{path}/{_LAYOUT}")
        # Without a row there is no folder of a prefix, nor a file outside of one.
        empty.withColumn(KEY_PREFIX, F.lit("")).write.mode("overwrite").partitionBy(
            KEY_PREFIX
        ).parquet(folder)
    else:
        empty.write.mode("overwrite").parquet(folder)


def prefix_digits_of(spark: SparkSession, path: str) -> int:
    """By how many digits of the key a table is laid out."""
    if not exists(spark, f"{path}/{_LAYOUT}/_SUCCESS"):
        return 0
    return int(spark.read.text(f"{path}/{_LAYOUT}").first()[0])


def _name(folder: str) -> str:
    return folder.rsplit("/", 1)[1].partition("=")[2]


def compactions(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """For every committed compaction, the loads that it replaced."""
    found = {}
    for mark in names_at(spark, f"{path}/{_MARKS}/*/_SUCCESS"):
        folder = mark.rsplit("/", 1)[0]
        name = folder.rsplit("/", 1)[1]
        found[name] = [row.value for row in spark.read.text(folder).collect()]
    return found


def _loads(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Names of the live loads, and of the folders that are not."""
    marks = compactions(spark, path)
    replaced = {name for names in marks.values() for name in names}
    whole = {_name(mark.rsplit("/", 1)[0]) for mark in names_at(spark, f"{path}/{LOAD_ID}=*/_SUCCESS")}
    every = sorted(_name(folder) for folder in names_at(spark, f"{path}/{LOAD_ID}=*"))

    def is_live(name: str) -> bool:
        return name in whole and name not in replaced and (name in marks or not name.startswith(_COMPACT))

    return [n for n in every if is_live(n)], [n for n in every if not is_live(n)]


def live_loads(spark: SparkSession, path: str) -> list[str]:
    """The loads whose rows are the table's."""
    return _loads(spark, path)[0]


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    without_load: str | None = None,
    prefixes: list[str] | None = None,
    only_load: str | None = None,
) -> DataFrame:
    """The table's rows; ``without_load`` leaves one load's folder unread.

    ``only_load`` reads one live load's folder and no other.

    Only live loads count: what a failed load or a killed compaction left is not read, nor
    what a compaction replaced. ``prefixes`` reads these prefixes of the key alone.
    """
    df = _rows_with_prefix(spark, path, schema, without_load, only_load)
    if prefixes is not None:
        df = df.filter(F.col(KEY_PREFIX).isin(prefixes))
    return df.drop(KEY_PREFIX)


def _rows_with_prefix(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    without_load: str | None = None,
    only_load: str | None = None,
) -> DataFrame:
    """``read_table``, with the key's prefix in a table laid out by it."""
    folders = [T.StructField(LOAD_ID, T.StringType())]
    if prefix_digits_of(spark, path):
        folders.append(T.StructField(KEY_PREFIX, T.StringType()))
    df = spark.read.schema(T.StructType([*schema.fields, *folders])).parquet(path)
    dead = _loads(spark, path)[1]
    if without_load is not None:
        dead.append(without_load)
    if dead:
        df = df.filter(~F.col(LOAD_ID).isin(sorted(set(dead))))
    if only_load is not None:
        df = df.filter(F.col(LOAD_ID) == only_load)
    return df.drop(LOAD_ID)


def _write_load(rows: DataFrame, folder: str, key: str, digits: int, count: int | None = None) -> None:
    """Write a load; ``count`` is how many rows it has, if that is known."""
    if not digits:
        rows.write.mode("overwrite").parquet(folder)
        return
    prefix = key_prefix(F.col(key), rows.schema[key].dataType, digits)
    laid_out = rows.withColumn(KEY_PREFIX, prefix)
    if digits > 1 or (rows.count() if count is None else count) < _LARGE_LOAD:
        # Each prefix is gathered into files of an even size. In a large load every task
        # has enough rows for a file of each of 16 prefixes, and nothing need be shuffled.
        laid_out = laid_out.hint("rebalance", KEY_PREFIX)
    # Keys in order.
    ordered = laid_out.sortWithinPartitions(KEY_PREFIX, key)
    ordered.write.mode("overwrite").partitionBy(KEY_PREFIX).parquet(folder)


def _write_compacted(
    spark: SparkSession, path: str, schema: T.StructType, folder: str, key: str, loads: list[str]
) -> None:
    """Write all live rows into one folder; files are put together without a shuffle.

    Tasks read whole files, of one prefix where the table is laid out by them.
    """
    digits = prefix_digits_of(spark, path)
    inside = f"{KEY_PREFIX}=*/*" if digits else "*"
    sizes: defaultdict[str, int] = defaultdict(int)
    for load in loads:
        for file, size in sizes_at(spark, f"{path}/{LOAD_ID}={load}/{inside}").items():
            sizes[_name(file.rsplit("/", 1)[0]) if digits else ""] += size
    rows = _rows_with_prefix(spark, path, schema)

    def together(some: DataFrame, size: int, least: int) -> DataFrame:
        return some.coalesce(max(least, -(-size // _FILE_BYTES)))

    if not digits:
        together(rows, sizes[""], 1).write.mode("overwrite").parquet(folder)
    elif not sizes or len(sizes) > _MOST_COPIED:
        _write_load(rows.drop(KEY_PREFIX), folder, key, digits, 0)
    else:
        parts = []
        for prefix, size in sorted(sizes.items()):
            # A null key has none, and its folder has Spark's name for null.
            has = F.col(KEY_PREFIX) == prefix if _is_hex(prefix) else F.col(KEY_PREFIX).isNull()
            # Not 1: a union of frames of one partition each is again a single one.
            parts.append(together(rows.filter(has), size, 2).sortWithinPartitions(key))
        every = reduce(DataFrame.unionByName, parts)
        every.write.mode("overwrite").partitionBy(KEY_PREFIX).parquet(folder)


def _is_hex(prefix: str) -> bool:
    return bool(re.fullmatch("[0-9a-f]+", prefix))


def compact_table(
    spark: SparkSession, path: str, schema: T.StructType, key: str = ROW_KEY, at_least: int = 2
) -> str | None:
    """Write the rows of all live loads as one load; its name, or None if there are few.

    The rows are written first, to a folder that no reader takes yet. Then one mark, which
    lists the loads they come from, makes that folder live and those loads dead in a single
    step. A rewrite that is killed before loses nothing and doubles nothing, and neither
    does one killed after. Replaced folders stay for readers that planned before, until
    ``remove_replaced``.
    """
    with _WRITERS[path]:
        loads = [name for name in live_loads(spark, path) if name != _CREATED]
        if len(loads) < at_least:
            return None
        numbers = [int(name[len(_COMPACT) :]) for name in compactions(spark, path)]
        name = f"{_COMPACT}{max(numbers, default=0) + 1:06d}"
        _write_compacted(spark, path, schema, f"{path}/{LOAD_ID}={name}", key, loads)
        mark = spark.createDataFrame([(load,) for load in loads], "value string")
        mark.coalesce(1).write.mode("overwrite").text(f"{path}/{_MARKS}/{name}")
        return name


def remove_replaced(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders of loads that are not live; their names.

    Call it when no reader is left that planned before the last compaction. A mark goes
    only after all that it replaced, and its own folder is replaced and gone too.
    """
    with _WRITERS[path]:
        dead = _loads(spark, path)[1]
        for name in dead:
            remove(spark, f"{path}/{LOAD_ID}={name}")
        left = {_name(folder) for folder in names_at(spark, f"{path}/{LOAD_ID}=*")}
        for mark, replaced in sorted(compactions(spark, path).items()):
            if mark not in left and not left.intersection(replaced):
                remove(spark, f"{path}/{_MARKS}/{mark}")
        return dead


def _folder_for(spark: SparkSession, path: str, load_id: str) -> str:
    """The load's folder name; a load that was committed before gets a further one.

    Without its commit mark a folder is what a failed attempt left, to be replaced. A name
    that a compaction has replaced is never used again.
    """
    taken = {name for names in compactions(spark, path).values() for name in names}
    name, attempt = load_id, 1
    while name in taken or exists(spark, f"{path}/{LOAD_ID}={name}/_SUCCESS"):
        attempt += 1
        name = f"{load_id}.{attempt}"
    return name


def insert_only_merge(
    source: DataFrame,
    path: str,
    schema: T.StructType,
    load_id: str,
    key: str = ROW_KEY,
    target_filter: Column | None = None,
    prefix_digits: int = 0,
    source_rows: int | None = None,
) -> None:
    """Insert the source rows whose key the table lacks; change and delete nothing.

    A committed load stays, whatever comes later under its name: the rows that are still
    missing then go to a further folder. Only what a failed attempt left is replaced.

    Few source keys are counted and stored first, in a folder readers of the table skip,
    then for any number the decision which are new. Only the key column of the table is
    read. While the keys are few, the table is not shuffled, nor while it is empty. Rows
    are filtered by the new keys or by the known ones, whichever are fewer, without a
    shuffle if these are few, and not at all if every key is new.

    ``target_filter`` narrows the rows of the table that can match (say, to the dates of
    the batch) and must hold for every row that shares a key with the source.
    ``prefix_digits`` is that of ``create_table_if_absent``, for a table not yet there; in
    such a table only the folders of the batch's own key prefixes are read, while the
    batch's keys are few. ``source_rows``, if the caller knows how many rows the source
    has, saves a look at its keys; a source of many rows then counts as one of many keys.
    """
    reserved = load_id == _CREATED or load_id.startswith(_COMPACT)
    if reserved or not _LOAD_NAME.fullmatch(load_id):
        raise ValueError(f"not usable as a load id: {load_id!r}")
    assert_columns(source, schema.fieldNames())
    with _WRITERS[path]:
        create_table_if_absent(source.sparkSession, path, schema, prefix_digits)
        _merge(source, path, schema, load_id, key, target_filter, source_rows)


def _merge(
    source: DataFrame,
    path: str,
    schema: T.StructType,
    load_id: str,
    key: str,
    target_filter: Column | None,
    source_rows: int | None,
) -> None:
    spark = source.sparkSession
    folder = _folder_for(spark, path, load_id)
    digits = prefix_digits_of(spark, path)

    def lookup(prefixes: list[str] | None = None) -> DataFrame:
        target = read_table(spark, path, schema, folder, prefixes)
        return target if target_filter is None else target.filter(target_filter)

    rows = source.select(*schema.fieldNames())
    notes = f"{path}/{_KEYS}/{folder}"
    # A look at any row would read folders that the batch does not touch.
    is_empty = live_loads(spark, path) == [_CREATED] or (not digits and lookup().isEmpty())
    fresh, count = rows, source_rows
    if not is_empty:
        keys = counted_keys(rows, key)
        about = source_rows
        if about is None:
            about = rows.agg(F.approx_count_distinct(key)).first()[0]
        few, prefixes = about <= FEW_KEYS, None
        if few:
            keys, seen = store_counted(keys, f"{notes}/source", keys=F.count(F.lit(1)))
            few = seen["keys"] <= FEW_KEYS
            prefixes = prefixes_of(keys, KEY, digits) if digits else None
        decided = status_of(keys, lookup(prefixes), key, few_keys=few, every=True)
        totals = {"keys": F.count(F.lit(1)), "new": F.count_if(NEW), "rows": F.sum(F.when(F.col(NEW), F.col(ROWS)))}
        status, seen = store_counted(decided, f"{notes}/status", **totals)
        count = seen["rows"] or 0
        if folder != load_id and not seen["new"]:
            remove(spark, notes)
            return
        known = seen["keys"] - seen["new"]
        if known:
            chosen = rows_of_new_keys if seen["new"] <= known else rows_without_known_keys
            fresh = chosen(rows, status, key)
    needed = [f.name for f in schema.fields if not f.nullable]
    checked = required(fresh, needed) if needed else fresh
    _write_load(checked, f"{path}/{LOAD_ID}={folder}", key, digits, count)
    remove(spark, notes)


def prefixes_of(keys: DataFrame, key: str, digits: int) -> list[str]:
    """The key prefixes that occur, at most 16 ** digits; a null key has none."""
    prefix = key_prefix(F.col(key), keys.schema[key].dataType, digits).alias(KEY_PREFIX)
    found = keys.select(prefix).distinct().filter(F.col(KEY_PREFIX).isNotNull())
    return sorted(row[0] for row in found.collect())


def as_view(
    df: DataFrame, name: str, again: Callable[[], DataFrame] | None = None
) -> DataFrame:
    """Name a frame for SQL; nothing is stored.

    ``again`` makes the frame anew when ``refresh_views`` is called.
    """
    df.createOrReplaceTempView(name)
    _VIEWS.pop((df.sparkSession, name), None)
    if again is not None:
        _VIEWS[df.sparkSession, name] = again
    return df


def refresh_views(spark: SparkSession, names: list[str]) -> None:
    """Make the views that this session has under these names read the tables as they are.

    A view with an ``again`` is made anew; any other lists its files anew, and so keeps
    the loads that were dead when it was made out, and no others.
    """
    for name in names:
        if spark.catalog.tableExists(name):
            again = _VIEWS.get((spark, name))
            if again is None:
                spark.catalog.refreshTable(name)
            else:
                again().createOrReplaceTempView(name)

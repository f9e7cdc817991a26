"""Insert-only merge on a key: the rows to insert.

Two steps, so that the wide rows need not be shuffled to find out that most are known:
``key_status`` decides on the keys alone, ``rows_of_new_keys`` filters the rows by the
decision. A caller may store the decision in between; its size is then known, and Spark
broadcasts it when it is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY, ROWS, NEW = "__key", "__rows", "__new"

#: The rows of a key with more rows than this are not shuffled by key. A plan parameter:
#: results are the same for any value; lower it only in tests, hot keys are broadcast.
HOT_ROWS = 10_000_000
#: Up to so many source keys (32 MB at 32 bytes each) the target is cut by a broadcast.
FEW_KEYS = 1_000_000


def counted_keys(source: DataFrame, key: str) -> DataFrame:
    """``(key, rows)`` of the source; shrinks before its shuffle."""
    return source.groupBy(F.col(key).alias(KEY)).agg(F.count(F.lit(1)).alias(ROWS))


def key_status(
    source: DataFrame, target: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``(key, rows in the source, new)`` of the keys the target lacks and of hot keys.

    Both key sets shrink to one row per key before they are shuffled, so a key that
    fills a third of either side sends one row per task. A NULL key matches nothing
    and is new.
    """
    return status_of(counted_keys(source, key), target, key, hot_rows)


def status_of(
    source_keys: DataFrame,
    target: DataFrame,
    key: str,
    hot_rows: int = HOT_ROWS,
    few_keys: bool = False,
    every: bool = False,
) -> DataFrame:
    """``key_status``, given the ``counted_keys`` of the source; with ``every`` of all keys.

    ``few_keys`` says that there are at most ``FEW_KEYS`` of them: the target is then cut
    to them where it is read, and what is shuffled grows with the batch, not the table.
    """
    target_keys = target.select(F.col(key).alias(KEY))
    if few_keys:
        target_keys = target_keys.join(F.broadcast(source_keys.select(KEY)), KEY, "left_semi")
    target_keys = target_keys.distinct().withColumn(NEW, F.lit(False))
    known = source_keys.join(target_keys, KEY, "left")
    status = known.withColumn(NEW, F.coalesce(NEW, F.lit(True)))
    return status if every else status.filter(F.col(NEW) | (F.col(ROWS) > hot_rows))


def rows_of_new_keys(
    source: DataFrame, status: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every source row of a new key, repeats of a key included.

    Hot keys are broadcast, at most one per ``hot_rows`` source rows; their rows are
    kept or left out where they are read. All other rows meet the new keys in a join
    that is broadcast or shuffled by the size of the keys.
    """
    is_hot = F.col(ROWS) > hot_rows
    same = F.col(f"rows.{key}").eqNullSafe(F.col(f"keys.{KEY}"))

    def matched(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return rows.alias("rows").join(keys.select(KEY).alias("keys"), same, how)

    hot = status.filter(is_hot)
    usual = matched(source, F.broadcast(hot), "left_anti")
    fresh = matched(usual, status.filter(~is_hot & F.col(NEW)), "left_semi")
    return fresh.unionByName(matched(source, F.broadcast(hot.filter(NEW)), "left_semi"))


def rows_without_known_keys(
    source: DataFrame, status: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``rows_of_new_keys`` by the keys that are not new; ``status`` holds every key.

    To be used where they are the fewer ones. Hot keys are broadcast as there.
    """
    known = status.filter(~F.col(NEW))
    is_hot = F.col(ROWS) > hot_rows
    same = F.col(f"rows.{key}").eqNullSafe(F.col(f"keys.{KEY}"))
    hot, others = (keys.select(KEY).alias("keys") for keys in (known.filter(is_hot), known.filter(~is_hot)))
    usual = source.alias("rows").join(F.broadcast(hot), same, "left_anti")
    return usual.alias("rows").join(others, same, "left_anti")


def unmatched_rows(
    source: DataFrame, target: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every source row whose key the target lacks, as one plan."""
    return rows_of_new_keys(source, key_status(source, target, key, hot_rows), key, hot_rows)


def merged(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The target after the merge, as a frame. Matched rows keep their old values."""
    return target.unionByName(unmatched_rows(source, target, key))

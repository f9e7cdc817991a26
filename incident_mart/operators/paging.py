"""Rules over pages: which pages count, and which page a row may come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import HOT_ROWS

_NO_PAGE = (1 << 63) - 1


def rows_kept(df: DataFrame, page: str, name: str = "rows_kept") -> DataFrame:
    """Rows per page."""
    return df.groupBy(page).agg(F.count(F.lit(1)).alias(name))


def page_ledger(
    df: DataFrame, page: str, bad: Column, needed: list[Column] | tuple[Column, ...] = ()
) -> DataFrame:
    """One row per page: ``(page, bad)``.

    A page is bad if one of its rows is, or if one of the ``needed`` flags is true on
    no row at all (a column the whole page lacks).
    """
    broken = F.max(F.coalesce(bad, F.lit(False)))
    for flag in needed:
        broken = broken | ~F.max(F.coalesce(flag, F.lit(False)))
    return df.groupBy(page).agg(broken.alias("bad"))


def _mark(number: Column, found: Column, bad: Column) -> Column:
    return F.struct(number.alias("stop"), found.alias("found"), bad.alias("bad"))


def _stops(ledger: DataFrame, page: str, first_page: int | None) -> DataFrame:
    """The numbers at which a load ends: bad pages and, with ``first_page``, missing ones.

    The number after the last page is missing too.
    """
    number = F.col(page).cast("bigint")
    if first_page is None:
        return ledger.filter("bad").select(number.alias("stop"))
    # Each page vouches for itself and asks for the next one; a number asked for
    # that no page vouches for is a gap.
    here = _mark(number, F.lit(True), F.col("bad"))
    following = _mark(number + 1, F.lit(False), F.lit(False))
    start = ledger.sparkSession.range(first_page, first_page + 1).select(
        _mark(F.col("id"), F.lit(False), F.lit(False)).alias("mark")
    )
    wanted = (
        ledger.filter(number >= first_page)
        .select(F.explode(F.array(here, following)).alias("mark"))
        .unionByName(start)
        .select("mark.*")
    )
    pages = wanted.groupBy("stop").agg(F.max("found").alias("found"), F.max("bad").alias("bad"))
    return pages.filter(~F.col("found") | F.col("bad")).select("stop")


def page_prefix(
    df: DataFrame, ledger: DataFrame, page: str, first_page: int | None = None
) -> DataFrame:
    """Rows of the pages before the first bad one.

    With ``first_page`` the pages must also follow each other from that number on,
    and the first gap ends the load. The limit is one number, read as a scalar
    subquery; the pages are never listed on the driver.
    """
    stops = _stops(ledger, page, first_page)
    limit = stops.agg(F.coalesce(F.min("stop"), F.lit(_NO_PAGE)).alias("stop")).scalar()
    kept = F.col(page) < limit
    if first_page is not None:
        kept = kept & (F.col(page) >= first_page)
    return df.filter(kept)


def first_unusable(ledger: DataFrame, page: str, first_page: int | None = None) -> int | None:
    """The first bad page, or with ``first_page`` the first missing one before the last.

    Starts a job over the ledger and gives one number.
    """
    stop = _stops(ledger, page, first_page).agg(F.min("stop")).first()[0]
    if stop is None or first_page is None:
        return stop
    last = ledger.agg(F.max(page)).first()[0]
    return stop if last is not None and stop <= last else None


def first_page_wins(df: DataFrame, key: str, page: str) -> DataFrame:
    """All rows of the first page a key appears on; its rows on later pages go.

    Repeats inside that first page stay. The first page of every key is an aggregate
    that shrinks before its shuffle, and the rows are then matched on key *and* page,
    so the rows of a hot key spread over its pages instead of meeting in one task.
    """
    firsts = df.groupBy(F.col(key).alias("__key")).agg(F.min(page).alias("__page"))
    same = F.col(f"rows.{key}").eqNullSafe(F.col("firsts.__key")) & (
        F.col(f"rows.{page}") == F.col("firsts.__page")
    )
    return df.alias("rows").join(firsts.alias("firsts"), same, "left_semi")


def repeated_keys(df: DataFrame, key: str, page: str) -> DataFrame:
    """``(key, first page, rows)`` of the keys that appear on more than one page."""
    spans = df.groupBy(F.col(key).alias("__key")).agg(
        F.min(page).alias("__first"),
        F.max(page).alias("__last"),
        F.count(F.lit(1)).alias("__rows"),
    )
    return spans.filter(F.col("__first") < F.col("__last")).drop("__last")


def drop_later_pages(
    df: DataFrame, repeats: DataFrame, key: str, page: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``first_page_wins``, given the stored ``repeated_keys``.

    Few keys repeat across pages as a rule: Spark sees how small the stored list is,
    broadcasts it, and the rows are not shuffled at all. A long list is joined by
    key; the later rows of hot keys are gone by then, taken out by a broadcast of at
    most one key per ``hot_rows`` rows.
    """
    is_hot = F.col("__rows") > hot_rows
    later = F.col(f"rows.{key}").eqNullSafe(F.col("keys.__key")) & (
        F.col(f"rows.{page}") > F.col("keys.__first")
    )
    hot = F.broadcast(repeats.filter(is_hot)).alias("keys")
    usual = df.alias("rows").join(hot, later, "left_anti")
    return usual.alias("rows").join(repeats.filter(~is_hot).alias("keys"), later, "left_anti")

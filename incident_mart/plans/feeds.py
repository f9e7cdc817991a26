"""One feed: text pages to cleaned rows, to conformed parquet, to a keyed table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coercion import strict_value, unreadable, value_or_null
from ..functions.text import blank_to_null
from ..operators.keys import with_surrogate_key
from ..operators.paging import (
    drop_later_pages,
    first_page_wins,
    first_unusable,
    page_ledger,
    page_prefix,
    repeated_keys,
    rows_kept,
)
from ..operators.projection import assert_columns, keep_columns
from ..schemas import BROKEN, PAGE, Feed
from ..schemas import Column as FeedColumn
from ..session import scratch_dir
from ..sources.files import (
    read_csv,
    read_parquet_as,
    remove,
    replace_rows,
    store,
    store_counted,
)
from ..sources.pages import numbered
from ..sources.tables import insert_only_merge, refresh_views
from .models import MODELS

#: Why a staged row is where it is: kept, dropped as incomplete, or ending the load.
STATE = "row_state"
KEPT, DROPPED, BAD = "kept", "dropped", "bad"
#: Which of the feed's columns are not NULL on this row: a bit for each, in columns of so many.
_PRESENT = "fields_present"
_BITS = 60
#: The columns that no record of a page names.
_ABSENT = "fields_absent"
#: Plan parameter: more keys on several pages than these are matched with the rows once, and
#: the rows left are stored; by fewer keys each step filters the rows where it reads them.
_MANY_REPEATS = 100_000


@dataclass(frozen=True)
class Layout:
    """Where the files of a warehouse lie under one root folder.

    ``prefix_digits`` is that of ``create_table_if_absent``, for tables not yet there.
    """

    root: str
    prefix_digits: int = 0

    def staged(self, feed: Feed, load_id: str) -> str:
        return f"{self.root}/staged/{feed.name}/{load_id}"

    def report(self, feed: Feed, load_id: str) -> str:
        return f"{self.root}/reports/{feed.name}/{load_id}"

    def conformed(self, feed: Feed) -> str:
        return f"{self.root}/conformed/{feed.name}"

    def table(self, feed: Feed) -> str:
        return f"{self.root}/tables/{feed.table}"

    def model(self, name: str) -> str:
        return f"{self.root}/models/{name}"


@dataclass(frozen=True)
class KeyForm:
    """How the parts of a surrogate key are joined.

    Tables that were published elsewhere have keys whose timestamp text carries the
    zone: ``timestamp_suffix="+00"`` gives those. A ``separator`` keeps parts apart
    where old keys need not be matched.
    """

    separator: str = ""
    timestamp_suffix: str = ""


PLAIN_KEYS = KeyForm()


def _any(flags: list[Column]) -> Column:
    return reduce(or_, flags)


def _incomplete(feed: Feed, absent: Column) -> Column:
    needed = [c.name for c in feed.columns if c.name not in feed.filled_first]
    return _any([F.col(c).isNull() & ~F.array_contains(absent, c) for c in needed])


def _with_page_columns(raw: DataFrame, feed: Feed) -> DataFrame:
    assert_columns(raw, [PAGE, feed.page_key])
    broken = F.col(BROKEN) if BROKEN in raw.columns else F.lit(False)
    return keep_columns(raw.withColumn(BROKEN, broken), [PAGE, BROKEN, *feed.column_names])


def _used_by_name(feed: Feed) -> list[str]:
    """Columns a page must have: the key and all that are converted."""
    return [c.name for c in feed.columns if c.name == feed.page_key or c.reads_as != "text"]


def _names(columns: list[str]) -> Column:
    return F.array(*[F.lit(c) for c in columns]).cast("array<string>")


def _present_words(feed: Feed) -> list[Column]:
    """The columns whose bits ``_is_present`` reads."""
    bits = [
        F.when(F.col(name).isNotNull(), F.lit(1 << i % _BITS)).otherwise(F.lit(0)).cast("bigint")
        for i, name in enumerate(feed.column_names)
    ]
    starts = range(0, len(bits), _BITS)
    words = [reduce(Column.bitwiseOR, bits[start : start + _BITS]) for start in starts]
    return [word.alias(f"{_PRESENT}_{n}") for n, word in enumerate(words)]


def _is_present(place: int) -> Column:
    bit = F.lit(1 << place % _BITS).cast("bigint")
    return F.col(f"{_PRESENT}_{place // _BITS}").bitwiseAND(bit) != 0


def _hollow_fields(staged: DataFrame, feed: Feed) -> DataFrame:
    """``(page_no, field)``: the columns that are NULL on every row of a page."""
    words = [c for c in staged.columns if c.startswith(f"{_PRESENT}_")]
    pages = staged.groupBy(PAGE).agg(*[F.bit_or(c).alias(c) for c in words])
    empty = [F.when(~_is_present(i), F.lit(name)) for i, name in enumerate(feed.column_names)]
    fields = F.array_compact(F.array(*empty))
    return pages.select(PAGE, F.explode(fields).alias("field"))


def absent_fields(
    staged: DataFrame, sent: DataFrame, feed: Feed, path: str
) -> tuple[DataFrame, bool]:
    """``(page_no, fields_absent)`` of the pages that lack a column altogether.

    Also says whether any of these columns is text that no page must have.

    ``sent`` is that of ``sent_fields``. Only where a column is NULL on all rows of a page
    can it be absent, so ``sent`` is read for such pages alone, and not at all if there
    are none. Stored under ``path``.
    """
    found = _hollow_fields(staged, feed)
    hollow, seen = store_counted(found, f"{path}/hollow", fields=F.count(F.lit(1)))
    if seen["fields"]:
        named = sent.join(hollow.select(PAGE).distinct(), PAGE, "left_semi")
        hollow = hollow.join(named, [PAGE, "field"], "left_anti")
    used = _used_by_name(feed)
    text = F.arrays_overlap(_ABSENT, _names([c for c in feed.column_names if c not in used]))
    pages = hollow.groupBy(PAGE).agg(F.collect_set("field").alias(_ABSENT))
    absent, seen = store_counted(pages, f"{path}/absent", text=F.count_if(text))
    return absent, seen["text"] > 0


def stage_pages(
    raw: DataFrame, feed: Feed, strict: bool = False, absent: DataFrame | None = None
) -> DataFrame:
    """Typed rows, none removed: a ``row_state`` says what the load does with each.

    Written once, this lets every later step read the few columns it needs instead of
    parsing the pages again. ``strict`` fails on a broken body or an unreadable field
    of a complete row, where otherwise the row is marked as bad. A column that ``absent``
    (``absent_fields``) lists for a page does not make the page's rows incomplete.
    """
    pages = _with_page_columns(raw, feed)
    lacks = _names([])
    if absent is not None:
        pages = pages.withColumn(PAGE, numbered(F.col(PAGE))).join(absent, PAGE, "left")
        lacks = F.coalesce(_ABSENT, lacks)
    incomplete = _incomplete(feed, lacks)
    bad = _any([unreadable(F.col(c.name), c.reads_as) for c in feed.columns])
    broken = F.lit(BAD)
    if strict:
        broken = F.raise_error(F.lit("a page body is no list of records")).cast("string")
        bad = F.lit(False)
    state = (
        F.when(F.col(BROKEN), broken)
        .when(incomplete, F.lit(DROPPED))
        .when(bad, F.lit(BAD))
        .otherwise(F.lit(KEPT))
    )
    def value(column: FeedColumn) -> Column:
        if not strict:
            return value_or_null(F.col(column.name), column.reads_as)
        return F.when(~incomplete, strict_value(F.col(column.name), column.reads_as))

    return pages.select(
        numbered(F.col(PAGE)).alias(PAGE),
        state.alias(STATE),
        *_present_words(feed),
        *[value(c).alias(c.name) for c in feed.columns],
    )


def _ledger(staged: DataFrame, feed: Feed, absent: DataFrame | None = None) -> DataFrame:
    """Every page and whether it is bad: a bad row, or a read column that the page lacks.

    Where it is not known what a page lacks, that is a column without any value.
    """
    used = _used_by_name(feed)
    bad = F.col(STATE) == BAD
    if absent is None:
        places = [feed.column_names.index(c) for c in used]
        return page_ledger(staged, PAGE, bad, [_is_present(i) for i in places])
    lacks = F.coalesce(F.arrays_overlap(_ABSENT, _names(used)), F.lit(False))
    pages = page_ledger(staged, PAGE, bad).join(absent, PAGE, "left")
    return pages.select(PAGE, (F.col("bad") | lacks).alias("bad"))


def kept_pages(
    staged: DataFrame,
    feed: Feed,
    first_page: int | None = None,
    absent: DataFrame | None = None,
) -> DataFrame:
    """Kept rows of the pages before the first bad one, as ``(page_no, columns...)``."""
    ledger = _ledger(staged, feed, absent)
    rows = page_prefix(staged.filter(F.col(STATE) == KEPT), ledger, PAGE, first_page)
    return rows.select(PAGE, *feed.column_names)


def all_pages(
    staged: DataFrame,
    feed: Feed,
    first_page: int | None = None,
    absent: DataFrame | None = None,
) -> DataFrame:
    """Kept rows of all pages; a page that cannot be used, or a gap, is an error."""
    stop = first_unusable(_ledger(staged, feed, absent), PAGE, first_page)
    if stop is not None:
        raise ValueError(
            f"{feed.name}: page {stop} is missing, or none of its rows has a column that is read"
        )
    return staged.filter(F.col(STATE) == KEPT).select(PAGE, *feed.column_names)


def _by_prefix(on_error: str) -> bool:
    if on_error not in ("fail", "prefix"):
        raise ValueError(f"on_error is 'fail' or 'prefix', not {on_error!r}")
    return on_error == "prefix"


def _staged_rows(
    raw: DataFrame,
    feed: Feed,
    path: str,
    on_error: str,
    first_page: int | None,
    sent: DataFrame | None,
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The staged pages, stored, the rows of them that a load may use, and absent columns."""
    prefix = _by_prefix(on_error)
    staged = store(stage_pages(raw, feed, strict=not prefix), f"{path}/pages")
    absent = None
    if sent is not None:
        absent, lacks_text = absent_fields(staged, sent, feed, path)
        if lacks_text:
            # Rows that looked incomplete are not, and their fields must be read.
            staged = store(stage_pages(raw, feed, not prefix, absent), f"{path}/pages-again")
    rows = (kept_pages if prefix else all_pages)(staged, feed, first_page, absent)
    return staged, rows, absent


def clean_pages(
    raw: DataFrame,
    feed: Feed,
    on_error: str = "fail",
    first_page: int | None = None,
    sent: DataFrame | None = None,
) -> DataFrame:
    """Text pages to typed rows: incomplete rows out, later repeats of a key out.

    ``on_error="prefix"`` keeps the pages before the first bad one (and, with
    ``first_page``, before the first gap); ``"fail"`` fails on a bad field, a broken
    body, a page without a column that is read, and with ``first_page`` on a gap. The
    pages are parsed once, into a scratch folder.

    ``sent`` (``sent_fields`` of the same pages) tells a column that a page lacks from one
    that is null. A text column that a whole page lacks then leaves its rows as they are,
    the column NULL; without ``sent`` it counts as null, and the rows are incomplete.
    """
    _by_prefix(on_error)
    scratch = scratch_dir(raw.sparkSession, f"staged-{feed.name}")
    _, rows, _ = _staged_rows(raw, feed, scratch, on_error, first_page, sent)
    return first_page_wins(rows, feed.page_key, PAGE)


def _conformed_value(name: str, kind: str) -> Column:
    value = F.col(name)
    if kind == "string":
        return blank_to_null(value.cast("string"))
    if kind == "int":
        # Out of range reads as NULL, as any bad field of a typed file does.
        return value.try_cast("int")
    if kind == "float":
        # Neither NaN nor an infinite value survives a text file.
        return F.when(F.abs(value) < F.lit(float("inf")), value).cast("float")
    return value.cast(kind)


def conform(rows: DataFrame, feed: Feed) -> DataFrame:
    """Cleaned rows under the declared file types, without the page number."""
    return rows.select(*[_conformed_value(c.name, c.conformed).alias(c.name) for c in feed.columns])


def widen(conformed: DataFrame, feed: Feed) -> DataFrame:
    """Conformed rows under the table's types."""
    return conformed.select(*[F.col(c.name).cast(c.loaded).alias(c.name) for c in feed.columns])


def keyed_rows(wide: DataFrame, feed: Feed, keys: KeyForm = PLAIN_KEYS) -> DataFrame:
    """Rows of the table's form, surrogate key first."""
    return with_surrogate_key(
        wide,
        feed.hash_columns,
        separator=keys.separator,
        timestamp_suffix=keys.timestamp_suffix,
    )


def page_report(
    staged: DataFrame, loaded: DataFrame, feed: Feed, absent: DataFrame | None = None
) -> DataFrame:
    """``(page_no, rows_staged, rows_kept, is_bad)`` of every page.

    ``loaded`` holds the rows that the load keeps; a page that it did not reach has no
    rows kept.
    """
    staged_rows = rows_kept(staged, PAGE, "rows_staged")
    ledger = _ledger(staged, feed, absent).withColumnRenamed("bad", "is_bad")
    found = staged_rows.join(ledger, PAGE).join(rows_kept(loaded, PAGE), PAGE, "left")
    return found.select(
        PAGE, "rows_staged", F.coalesce("rows_kept", F.lit(0)).alias("rows_kept"), "is_bad"
    )


def load_pages(
    raw: DataFrame,
    feed: Feed,
    layout: Layout,
    load_id: str,
    on_error: str = "fail",
    first_page: int | None = None,
    target_filter: Column | None = None,
    keys: KeyForm = PLAIN_KEYS,
    keep_files: bool = False,
    sent: DataFrame | None = None,
) -> int:
    """Clean, conform and merge the pages into the feed's table; the rows merged.

    The pages are parsed once, into staged files of this load; the few keys on more than
    one page are stored next, so that the rows need no shuffle. Where they are many, the
    rows that they leave are stored too, for the report and the merge. What every page gave is
    stored as the load's report (``page_report``), where a load that ended early shows.
    ``keep_files`` also leaves the conformed rows as files of the layout.
    ``target_filter`` is that of ``insert_only_merge``, ``sent`` that of ``clean_pages``.
    Staged files go when the load ends.
    """
    spark = raw.sparkSession
    _by_prefix(on_error)
    folder = f"{layout.staged(feed, load_id)}-{uuid.uuid4().hex}"
    try:
        staged, rows, absent = _staged_rows(raw, feed, folder, on_error, first_page, sent)
        found = repeated_keys(rows, feed.page_key, PAGE)
        repeats, seen = store_counted(found, f"{folder}/repeats", keys=F.count(F.lit(1)))
        first = drop_later_pages(rows, repeats, feed.page_key, PAGE)
        if seen["keys"] > _MANY_REPEATS:
            first = store(first, f"{folder}/first")
        report = page_report(staged, first, feed, absent)
        _, seen = store_counted(report, layout.report(feed, load_id), rows=F.sum("rows_kept"))
        conformed = conform(first, feed)
        if keep_files:
            conformed = store(conformed, layout.conformed(feed))
        kept = seen["rows"] or 0
        _merge(widen(conformed, feed), feed, layout, load_id, target_filter, keys, kept)
        return kept
    finally:
        remove(spark, folder)


def report_pages(raw: DataFrame, feed: Feed, layout: Layout, load_id: str) -> DataFrame:
    """The report of a load that merged nothing: which of its pages are bad."""
    folder = f"{layout.staged(feed, load_id)}-{uuid.uuid4().hex}"
    try:
        staged = store(stage_pages(raw, feed), f"{folder}/pages")
        none = staged.filter(F.lit(False))
        return store(page_report(staged, none, feed), layout.report(feed, load_id))
    finally:
        remove(raw.sparkSession, folder)


def conform_csv(spark: SparkSession, path: str, feed: Feed, layout: Layout) -> None:
    """A feed's CSV, read by position under the file types, as conformed parquet."""
    replace_rows(read_csv(spark, path, feed.conformed_schema), layout.conformed(feed))


def _merge(
    wide: DataFrame,
    feed: Feed,
    layout: Layout,
    load_id: str,
    target_filter: Column | None,
    keys: KeyForm,
    rows: int | None = None,
) -> None:
    insert_only_merge(
        keyed_rows(wide, feed, keys),
        layout.table(feed),
        feed.table_schema,
        load_id,
        target_filter=target_filter,
        prefix_digits=layout.prefix_digits,
        source_rows=rows,
    )
    refresh_views(wide.sparkSession, list(MODELS))


def load_conformed(
    spark: SparkSession,
    feed: Feed,
    layout: Layout,
    load_id: str,
    target_filter: Column | None = None,
    keys: KeyForm = PLAIN_KEYS,
) -> None:
    """Merge the conformed files into the feed's table."""
    wide = read_parquet_as(spark, layout.conformed(feed), feed.wide_schema)
    _merge(wide, feed, layout, load_id, target_filter, keys)


def empty_pages(spark: SparkSession, feed: Feed) -> DataFrame:
    """A page frame without rows."""
    fields = [T.StructField(PAGE, T.LongType())]
    fields += [T.StructField(c, T.StringType()) for c in feed.column_names]
    return spark.createDataFrame([], T.StructType(fields))

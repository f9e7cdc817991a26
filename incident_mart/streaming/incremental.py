"""Loads of newly landed pages with Structured Streaming.

The stream's checkpoint remembers the files it has read and the table holds the keys,
so no state is kept between batches and nothing grows with the number of keys seen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.feeds import PLAIN_KEYS, KeyForm, Layout, load_pages
from ..schemas import ROW_KEY, Feed
from ..sources.files import remove, store
from ..sources.pages import (
    FILE_PAGE,
    bounded_log,
    read_json_pages,
    read_json_stream,
    read_sent_fields,
)
from ..sources.tables import insert_only_merge
from .pulls import LOADED, load_pull, set_aside_pulls


def _load_name(stream_name: str, checkpoint: str, batch_id: int) -> str:
    """Batches count from 0 in every checkpoint, so the checkpoint is part of the name."""
    where = hashlib.md5(checkpoint.encode()).hexdigest()[:8]
    return f"{stream_name}-{where}-{batch_id:09d}"


def _start(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str,
    every: str | None,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).queryName(name)
    writer = writer.option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()


def merge_stream(
    stream: DataFrame,
    path: str,
    schema: T.StructType,
    checkpoint: str,
    name: str,
    key: str = ROW_KEY,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    target_filter: Column | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Merge each batch of new rows into a keyed table.

    Stops when all that has landed is merged, or with ``every`` (``"10 minutes"``)
    goes on looking. A batch that is run again adds only what is missing. A batch is
    prepared once, into files that the merge's steps read.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        load_id = _load_name(name, checkpoint, batch_id)
        folder = f"{path}/_batches/{load_id}"
        try:
            rows = store(prepare(batch), folder)
            insert_only_merge(rows, path, schema, load_id, key, target_filter)
        finally:
            remove(batch.sparkSession, folder)

    return _start(stream, each, checkpoint, name, every)


@dataclass(frozen=True)
class PullLoad:
    """How a feed's pulls are read and loaded; ``start_feed_stream`` tells what is what."""

    feed: Feed
    landing: str
    root: str
    page_from: str = "directory"
    page_layout: str = "lines"
    pattern: str = FILE_PAGE
    target_filter: Column | None = None
    on_error: str = "fail"
    first_page: int | None = None
    keys: KeyForm = PLAIN_KEYS
    prefix_digits: int = 0

    @property
    def layout(self) -> Layout:
        return Layout(self.root, self.prefix_digits)

    @property
    def name(self) -> str:
        return f"{self.feed.name}-stream"

    def load(self, pages: DataFrame, load_id: str, sent: DataFrame | None = None) -> int:
        return load_pages(
            pages,
            self.feed,
            self.layout,
            load_id,
            self.on_error,
            self.first_page,
            self.target_filter,
            self.keys,
            sent=sent,
        )

    def load_pull(self, spark: SparkSession, pull: str, set_aside: bool) -> str:
        """Load a pull's folder; what came of it."""
        where = (f"{self.landing}/{pull}", self.feed.column_names)
        read = (self.page_from, self.page_layout, self.pattern)
        pages = read_json_pages(spark, *where, *read)
        sent = read_sent_fields(spark, *where, *read)
        load_id = f"{self.name}-{pull}"
        if not set_aside:
            self.load(pages, load_id, sent)
            return LOADED
        whole = partial(self.load, pages, load_id, sent)
        return load_pull(self.feed, self.layout, pull, load_id, pages, whole)


def start_feed_stream(
    spark: SparkSession,
    feed: Feed,
    landing: str,
    root: str,
    checkpoint: str,
    page_from: str = "directory",
    page_layout: str = "lines",
    pattern: str = FILE_PAGE,
    closed: str | None = None,
    max_files: int | None = None,
    every: str | None = None,
    target_filter: Column | None = None,
    on_error: str = "fail",
    first_page: int | None = None,
    keys: KeyForm = PLAIN_KEYS,
    prefix_digits: int = 0,
    set_aside: bool = False,
    archive: str | None = None,
    max_file_age: str | None = None,
) -> StreamingQuery:
    """Load the pages of ``landing`` that no earlier run has loaded.

    The page rules hold within a pull, so a pull must be loaded as a whole. Without
    ``closed``, all that is new when the stream starts is one pull, and the stream
    stops when it is loaded. With ``closed``, each pull has a folder of its own,
    ``<landing>/<pull>/...``, and when it is complete a text file in the folder
    ``closed`` names it, on a line of its own. Only then is it loaded, under a load id
    of its own, so what ends up in the table depends neither on the time of a batch nor
    on its size (``max_files`` marks). ``every`` goes on looking for pulls. Pulls are
    read with what each page names (``sent_fields``), a batch without ``closed`` is not.

    A pull that its data make fail ends the stream, and every start after it. With
    ``set_aside`` it is noted with its reason instead (``pull_outcomes``), its report
    names the bad pages, and the pulls after it are loaded; ``retry_set_aside`` loads it
    once it is mended.

    The files that the stream itself watches, pages or marks, are remembered and listed
    for ever unless ``archive`` and ``max_file_age`` bound that (``bounded_log``).
    """
    how = PullLoad(
        feed, landing, root, page_from, page_layout, pattern, target_filter, on_error, first_page, keys, prefix_digits
    )
    if closed is None:
        if every or max_files:
            raise ValueError("batches of a pull need marks of closed pulls: pass closed=")
        if set_aside:
            raise ValueError("only closed pulls can be set aside: pass closed=")
        pages = read_json_stream(
            spark,
            landing,
            feed.column_names,
            page_from,
            page_layout,
            pattern,
            archive=archive,
            max_file_age=max_file_age,
        )

        def whole(batch: DataFrame, batch_id: int) -> None:
            how.load(batch, _load_name(how.name, checkpoint, batch_id))

        return _start(pages, whole, checkpoint, how.name, None)

    marks = bounded_log(spark.readStream.format("text"), archive, max_file_age)
    if max_files:
        marks = marks.option("maxFilesPerTrigger", max_files)

    def pulls(batch: DataFrame, batch_id: int) -> None:
        # As many names as pulls were closed since the last batch.
        named = batch.select(F.trim("value").alias("pull")).filter("pull <> ''").distinct()
        for (pull,) in sorted(named.collect()):
            how.load_pull(batch.sparkSession, pull, set_aside)

    return _start(marks.load(closed), pulls, checkpoint, how.name, every)


def retry_set_aside(spark: SparkSession, how: PullLoad) -> dict[str, str]:
    """Load the pulls that were set aside again; what came of each.

    One that still fails stays set aside, with its new reason.
    """
    waiting = set_aside_pulls(spark, how.feed, how.root)
    return {pull: how.load_pull(spark, pull, set_aside=True) for pull in waiting}


def close_pull(spark: SparkSession, closed: str, pull: str) -> None:
    """Mark a pull as complete, once all its pages have landed."""
    spark.createDataFrame([(pull,)], "value string").write.mode("append").text(closed)

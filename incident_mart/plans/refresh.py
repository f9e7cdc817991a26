"""The whole refresh: load the feeds, then build the models on the loaded tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from ..schemas import FEEDS
from ..sources.files import replace_rows
from ..sources.tables import (
    as_view,
    compact_table,
    create_table_if_absent,
    read_table,
    refresh_views,
    remove_replaced,
)
from .bucketed import CrashBuckets
from .feeds import PLAIN_KEYS, KeyForm, Layout, load_pages
from .models import CORE, MODELS, build_models


def read_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The loaded table of each feed; a feed never loaded gives an empty one."""
    frames = {}
    for name, feed in FEEDS.items():
        create_table_if_absent(
            spark, layout.table(feed), feed.table_schema, layout.prefix_digits
        )
        frames[name] = read_table(spark, layout.table(feed), feed.table_schema)
    return frames


def publish_models(
    spark: SparkSession,
    layout: Layout,
    sample: int | None = None,
    select: list[str] | None = None,
    buckets: CrashBuckets | None = None,
) -> dict[str, DataFrame]:
    """Staging models as views, core models as tables; the frames to read them by.

    ``select`` names the models to publish (default: all). With ``buckets``, loads that are
    new are added to them and the fact is made from them, without a shuffle of either side;
    they hold all rows, so there is no ``sample`` then.
    """
    if buckets and sample is not None:
        raise ValueError("a fact from buckets is of all rows; leave out sample or buckets")
    models = build_models(**read_tables(spark, layout), sample=sample)
    if buckets and (select is None or "fact_traffic_accidents" in select):
        buckets.catch_up(spark, layout)
        models["fact_traffic_accidents"] = buckets.fact(spark)
    wanted = list(models) if select is None else select
    unknown = [name for name in wanted if name not in models]
    if unknown:
        raise ValueError(f"no such model: {', '.join(unknown)}")
    for name in wanted:
        if name in CORE:
            replace_rows(models[name], layout.model(name))
            models[name] = spark.read.parquet(layout.model(name))
            as_view(models[name], name)
        else:
            as_view(models[name], name, partial(_model, spark, layout, sample, name))
    return {name: models[name] for name in wanted}


def _model(spark: SparkSession, layout: Layout, sample: int | None, name: str) -> DataFrame:
    return build_models(**read_tables(spark, layout), sample=sample)[name]


def compact_feeds(
    spark: SparkSession, layout: Layout, at_least: int = 2, keep_replaced: bool = False
) -> dict[str, str | None]:
    """Write each feed's table of many loads as one load; the new load's name by feed.

    A table with fewer than ``at_least`` loads stays as it is (None), as does one that is
    not there. ``keep_replaced`` leaves the old folders for readers that planned before;
    ``remove_replaced`` deletes them later.
    """
    names = {}
    for name, feed in FEEDS.items():
        path = layout.table(feed)
        names[name] = compact_table(spark, path, feed.table_schema, at_least=at_least)
        if not keep_replaced:
            remove_replaced(spark, path)
    refresh_views(spark, list(MODELS))
    return names


def full_refresh(
    spark: SparkSession,
    pages: dict[str, DataFrame],
    root: str,
    load_id: str,
    on_error: str = "fail",
    first_page: int | None = None,
    sample: int | None = None,
    target_filter: Column | None = None,
    keys: KeyForm = PLAIN_KEYS,
    prefix_digits: int = 0,
    sent: dict[str, DataFrame] | None = None,
    buckets: CrashBuckets | None = None,
) -> tuple[dict[str, int], dict[str, DataFrame]]:
    """Load each feed's pages and publish the models.

    ``pages`` maps feed names to page frames; feeds left out keep their tables.
    Running it again with the same pages adds nothing. ``target_filter`` is that of
    ``insert_only_merge`` and may name columns that all these feeds have;
    ``prefix_digits`` lays out tables that are not yet there; ``sent`` maps feed names to
    the ``sent`` of ``clean_pages``; ``buckets`` is that of ``publish_models``. Gives the
    rows merged per feed and the models.
    """
    unknown = [name for name in pages if name not in FEEDS]
    if unknown:
        raise ValueError(f"no such feed: {', '.join(unknown)}")
    layout = Layout(root, prefix_digits)

    def load(name: str) -> int:
        return load_pages(
            pages[name],
            FEEDS[name],
            layout,
            load_id,
            on_error,
            first_page,
            target_filter,
            keys,
            sent=(sent or {}).get(name),
        )

    # The feeds do not depend on each other; side by side, one fills the other's gaps.
    with ThreadPoolExecutor(max_workers=len(FEEDS)) as pool:
        counts = dict(zip(pages, pool.map(load, pages), strict=True))
    return counts, publish_models(spark, layout, sample, buckets=buckets)

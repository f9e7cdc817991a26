"""The mart in a catalog: tables over its files and views as SQL, which outlast a session.

Sessions that share a catalog then read the mart by name, without this package. How long
the names last is up to the catalog: one with a metastore keeps them for good, the one
Spark has by itself as long as the application.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions.dates import MONTHS
from ..functions.text import PEDESTRIAN_FILL, UNKNOWN_EQUIPMENT
from ..schemas import FEEDS, LOAD_ID, Feed
from ..sources.files import exists
from ..sources.tables import KEY_PREFIX, create_table_if_absent, live_loads, prefix_digits_of
from .feeds import Layout
from .models import CORE


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(database: str, name: str) -> str:
    return f"`{database}`.`{name}`"


_MONTH_NAMES = ", ".join(_text(m) for m in MONTHS)
#: The staging models as SQL over the feeds' tables; ``{persons}`` and so on are their names.
STAGING_SQL = {
    "stg_persons_data": f"""
        SELECT *, coalesce(safety_equipment, {_text(UNKNOWN_EQUIPMENT)}) AS safety_equipment_updated,
            CAST(month(crash_date) AS BIGINT) AS crash_month_number,
            CAST(year(crash_date) AS BIGINT) AS crash_year,
            CAST(crash_date AS TIMESTAMP) AS traffic_crash_date,
            CASE WHEN crash_date IS NULL THEN 'Unknown'
                ELSE element_at(array({_MONTH_NAMES}), month(crash_date)) END AS crash_month
        FROM {{persons}} WHERE age <> 0""",
    "stg_traffic_data": "SELECT * FROM {crashes}",
    "stg_vehicles_data": f"""
        SELECT * EXCEPT (make, model), coalesce(make, {_text(PEDESTRIAN_FILL)}) AS make,
            coalesce(model, {_text(PEDESTRIAN_FILL)}) AS model
        FROM {{vehicles}}""",
}


def _publish_feed(spark: SparkSession, layout: Layout, feed: Feed, database: str) -> str:
    """The feed's files as a table, and what is live of them as a view; the view's name."""
    path = layout.table(feed)
    create_table_if_absent(spark, path, feed.table_schema, layout.prefix_digits)
    folders = [LOAD_ID, KEY_PREFIX] if prefix_digits_of(spark, path) else [LOAD_ID]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in feed.table_schema.fields]
    columns += [f"`{name}` string" for name in folders]
    files = _name(database, f"{feed.table}_files")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {files} ({', '.join(columns)}) USING parquet "
        f"PARTITIONED BY ({', '.join(folders)}) LOCATION {_text(path)}"
    )
    spark.sql(f"ALTER TABLE {files} RECOVER PARTITIONS")
    spark.catalog.refreshTable(files)
    live = ", ".join(_text(load) for load in live_loads(spark, path))
    names = ", ".join(f"`{c}`" for c in feed.table_schema.fieldNames())
    view = _name(database, feed.table)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {names} FROM {files} WHERE {LOAD_ID} IN ({live})")
    return view


def publish_catalog(spark: SparkSession, layout: Layout, database: str) -> list[str]:
    """Make or renew the mart's tables and views in a database; their names.

    Each feed has a view of its table's live loads, each staging model a view on that, and
    each core model that is stored a table. A view's loads are those live when it was made:
    call this again after a load or a compaction (and before ``remove_replaced``). What a
    view reads changes in one step, when it is replaced.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    feeds = {name: _publish_feed(spark, layout, feed, database) for name, feed in FEEDS.items()}
    made = [feed.table for feed in FEEDS.values()]
    for name, text in STAGING_SQL.items():
        spark.sql(f"CREATE OR REPLACE VIEW {_name(database, name)} AS {text.format(**feeds)}")
        made.append(name)
    for name in CORE:
        if exists(spark, f"{layout.model(name)}/_SUCCESS"):
            table = _name(database, name)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION {_text(layout.model(name))}")
            spark.catalog.refreshTable(table)
            made.append(name)
    return made

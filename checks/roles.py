"""How the test tables stand in for the three feeds, in Spark and in SQL.

crashes come from orders, persons from lineitem, vehicles from part. ``*_TABLE`` is
a feed's loaded form without the surrogate key, ``*_PAGES`` its raw text pages with
missing and unreadable fields and with rows sent on more than one page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from incident_mart.schemas import CRASHES, PERSONS, VEHICLES, Feed
from incident_mart.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) as crash_record_id",
        "cast(o_orderdate as timestamp) as crash_date",
        "o_orderpriority as weather_condition",
        "o_orderstatus as lighting_condition",
        "substr(o_orderpriority, 1, 1) as road_defect",
        "o_custkey % 5 as injuries_total",
        "o_custkey % 2 as injuries_fatal",
        "cast(o_custkey % 91 as double) as latitude",
        "cast(o_orderkey % 181 as double) as longitude",
    )


CRASHES_TABLE = """
SELECT CAST(o_orderkey AS VARCHAR) AS crash_record_id,
       o_orderdate AS crash_date,
       o_orderpriority AS weather_condition,
       o_orderstatus AS lighting_condition,
       substr(o_orderpriority, 1, 1) AS road_defect,
       o_custkey % 5 AS injuries_total,
       o_custkey % 2 AS injuries_fatal,
       CAST(o_custkey % 91 AS DOUBLE) AS latitude,
       CAST(o_orderkey % 181 AS DOUBLE) AS longitude
FROM orders
"""


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as person_id",
        "case l_returnflag when 'A' then 'DRIVER' when 'N' then 'PEDESTRIAN' "
        "else 'PASSENGER' end as person_type",
        "cast(l_orderkey as string) as crash_record_id",
        "cast(l_suppkey as string) as vehicle_id",
        "cast(l_shipdate as timestamp) as crash_date",
        "l_linestatus as sex",
        "nullif(cast(cast(round(l_discount * 100) as int) as string), '0') as safety_equipment",
        "l_linestatus as airbag_deployed",
        "cast(l_quantity as bigint) % 50 as age",
    )


PERSONS_TABLE = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS person_id,
       CASE l_returnflag WHEN 'A' THEN 'DRIVER' WHEN 'N' THEN 'PEDESTRIAN'
            ELSE 'PASSENGER' END AS person_type,
       CAST(l_orderkey AS VARCHAR) AS crash_record_id,
       CAST(l_suppkey AS VARCHAR) AS vehicle_id,
       l_shipdate AS crash_date,
       l_linestatus AS sex,
       nullif(CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR), '0') AS safety_equipment,
       l_linestatus AS airbag_deployed,
       CAST(l_quantity AS BIGINT) % 50 AS age
FROM lineitem
"""


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as crash_unit_id",
        "cast(p_partkey % 1000 as string) as crash_record_id",
        "timestamp '2024-01-01 00:00:00' as crash_date",
        "cast(p_size as string) as unit_no",
        "p_name as unit_type",
        "cast(p_size as bigint) as vehicle_id",
        "nullif(p_brand, 'Brand#2') as make",
        "nullif(p_type, 'ECONOMY') as model",
    )


VEHICLES_TABLE = """
SELECT CAST(p_partkey AS VARCHAR) AS crash_unit_id,
       CAST(p_partkey % 1000 AS VARCHAR) AS crash_record_id,
       TIMESTAMP '2024-01-01 00:00:00' AS crash_date,
       CAST(p_size AS VARCHAR) AS unit_no,
       p_name AS unit_type,
       CAST(p_size AS BIGINT) AS vehicle_id,
       nullif(p_brand, 'Brand#2') AS make,
       nullif(p_type, 'ECONOMY') AS model
FROM part
"""


def crash_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per year of orders, each order sent again on the next page."""
    return table(spark, sf_dir, "orders").selectExpr(
        "explode(array(year(o_orderdate) - 1995L, year(o_orderdate) - 1994L)) as page_no",
        "cast(o_orderkey as string) as crash_record_id",
        "case o_orderstatus when 'P' then concat('about ', year(o_orderdate)) "
        "when 'O' then date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") "
        "else cast(o_orderdate as string) end as crash_date",
        "nullif(o_orderpriority, '4-NOT SPECIFIED') as weather_condition",
        "case when o_orderpriority = '5-LOW' then '' else o_orderstatus end as lighting_condition",
        "substr(o_orderpriority, 1, 1) as road_defect",
        "case when o_custkey % 7 = 0 then 'n/a' else concat(o_custkey % 5, '.9') end "
        "as injuries_total",
        "concat('-', o_custkey % 3, '.5') as injuries_fatal",
        "concat(o_custkey % 90, '.25') as latitude",
        "concat('-', o_orderkey % 180, '.5') as longitude",
    )


CRASH_PAGES = """
SELECT unnest([year(o_orderdate) - 1995, year(o_orderdate) - 1994]) AS page_no,
       CAST(o_orderkey AS VARCHAR) AS crash_record_id,
       CASE o_orderstatus WHEN 'P' THEN 'about ' || year(o_orderdate)
            WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
            ELSE CAST(o_orderdate AS VARCHAR) END AS crash_date,
       nullif(o_orderpriority, '4-NOT SPECIFIED') AS weather_condition,
       CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderstatus END AS lighting_condition,
       substr(o_orderpriority, 1, 1) AS road_defect,
       CASE WHEN o_custkey % 7 = 0 THEN 'n/a' ELSE (o_custkey % 5) || '.9' END AS injuries_total,
       '-' || (o_custkey % 3) || '.5' AS injuries_fatal,
       (o_custkey % 90) || '.25' AS latitude,
       '-' || (o_orderkey % 180) || '.5' AS longitude
FROM orders
"""


def person_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per line number; a person appears on several pages and repeats in one."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_linenumber as bigint) as page_no",
        "concat(l_orderkey, '-', l_partkey % 3) as person_id",
        "case l_returnflag when 'A' then 'DRIVER' when 'N' then 'PEDESTRIAN' "
        "else 'PASSENGER' end as person_type",
        "cast(l_orderkey as string) as crash_record_id",
        "concat('0', l_suppkey) as vehicle_id",
        "cast(l_shipdate as string) as crash_date",
        "l_linestatus as sex",
        "nullif(cast(cast(round(l_discount * 100) as int) as string), '0') as safety_equipment",
        "case when l_linenumber = 7 then '' else l_returnflag end as airbag_deployed",
        "case when l_quantity < 5 then null when l_quantity < 10 then 'unknown' "
        "else cast(l_quantity as string) end as age",
    )


PERSON_PAGES = """
SELECT CAST(l_linenumber AS BIGINT) AS page_no,
       l_orderkey || '-' || (l_partkey % 3) AS person_id,
       CASE l_returnflag WHEN 'A' THEN 'DRIVER' WHEN 'N' THEN 'PEDESTRIAN'
            ELSE 'PASSENGER' END AS person_type,
       CAST(l_orderkey AS VARCHAR) AS crash_record_id,
       '0' || l_suppkey AS vehicle_id,
       CAST(l_shipdate AS VARCHAR) AS crash_date,
       l_linestatus AS sex,
       nullif(CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR), '0') AS safety_equipment,
       CASE WHEN l_linenumber = 7 THEN '' ELSE l_returnflag END AS airbag_deployed,
       CASE WHEN l_quantity < 5 THEN NULL WHEN l_quantity < 10 THEN 'unknown'
            ELSE CAST(l_quantity AS VARCHAR) END AS age
FROM lineitem
"""


def vehicle_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per part size, each part sent again on the next page."""
    return table(spark, sf_dir, "part").selectExpr(
        "explode(array(cast(p_size as bigint), p_size + 1L)) as page_no",
        "concat('00', p_partkey) as crash_unit_id",
        "cast(p_partkey % 1000 as string) as crash_record_id",
        "case when p_size > 40 then 'unknown' else '2024-01-01T00:00:00.000' end as crash_date",
        "cast(p_size as string) as unit_no",
        "p_name as unit_type",
        "concat('+', p_size) as vehicle_id",
        "nullif(p_brand, 'Brand#2') as make",
        "case when p_type = 'ECONOMY' then '' else p_type end as model",
    )


VEHICLE_PAGES = """
SELECT unnest([CAST(p_size AS BIGINT), CAST(p_size + 1 AS BIGINT)]) AS page_no,
       '00' || p_partkey AS crash_unit_id,
       CAST(p_partkey % 1000 AS VARCHAR) AS crash_record_id,
       CASE WHEN p_size > 40 THEN 'unknown' ELSE '2024-01-01T00:00:00.000' END AS crash_date,
       CAST(p_size AS VARCHAR) AS unit_no,
       p_name AS unit_type,
       '+' || p_size AS vehicle_id,
       nullif(p_brand, 'Brand#2') AS make,
       CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_type END AS model
FROM part
"""

PAGES = {"crashes": crash_pages, "vehicles": vehicle_pages, "persons": person_pages}
PAGES_SQL = {"crashes": CRASH_PAGES, "vehicles": VEHICLE_PAGES, "persons": PERSON_PAGES}
TABLES_SQL = {"crashes": CRASHES_TABLE, "vehicles": VEHICLES_TABLE, "persons": PERSONS_TABLE}

_READS = {
    "text": "{c}",
    "timestamp": "try_cast({c} AS TIMESTAMP)",
    "int_or_zero": "coalesce(CAST(trunc(try_cast({c} AS DOUBLE)) AS BIGINT), 0)",
    "int": "CAST({c} AS BIGINT)",
    "float": "CAST({c} AS DOUBLE)",
}
_CONFORMED = {
    "string": "nullif(CAST({c} AS VARCHAR), '')",
    "timestamp": "{c}",
    "int": "CAST({c} AS INTEGER)",
    "float": "CAST({c} AS FLOAT)",
}
_LOADED = {"string": "VARCHAR", "timestamp": "TIMESTAMP", "bigint": "BIGINT", "double": "DOUBLE"}


def typed_sql(feed: Feed) -> str:
    """SELECT list that types a feed's text fields."""
    return ", ".join(f"{_READS[c.reads_as].format(c=c.name)} AS {c.name}" for c in feed.columns)


def clean_sql(feed: Feed, pages: str, absent: dict[str, str] | None = None) -> str:
    """Complete rows, typed, of the first page of each key.

    ``absent`` says, by column, which pages lack it: there it may be NULL.
    """
    needed = [c.name for c in feed.columns if c.name not in feed.filled_first]
    spared = absent or {}
    complete = " AND ".join(f"({c} IS NOT NULL OR {spared.get(c, 'false')})" for c in needed)
    names = ", ".join(feed.column_names)
    return f"""
    SELECT page_no, {names} FROM (
      SELECT *, rank() OVER (PARTITION BY {feed.page_key} ORDER BY page_no) AS seen FROM (
        SELECT page_no, {typed_sql(feed)} FROM ({pages}) WHERE {complete}))
    WHERE seen = 1
    """


def conform_sql(feed: Feed, cleaned: str) -> str:
    """Cleaned rows through the file types to the table types."""
    through = ", ".join(
        f"CAST({_CONFORMED[c.conformed].format(c=c.name)} AS {_LOADED[c.loaded]}) AS {c.name}"
        for c in feed.columns
    )
    return f"SELECT {through} FROM ({cleaned})"


def key_sql(feed: Feed, rows: str, zone: str = "") -> str:
    """Rows with their surrogate key as lower-case hex; ``zone`` ends timestamp text."""
    kinds = {c.name: c.loaded for c in feed.columns}
    texts = [
        f"CAST({c} AS VARCHAR)" + (f" || '{zone}'" if kinds[c] == "timestamp" else "")
        for c in feed.hash_columns
    ]
    joined = " || ".join(f"coalesce({text}, '')" for text in texts)
    return f"SELECT md5({joined}) AS unique_id, * FROM ({rows})"


def loaded_sql(feed: Feed, zone: str = "") -> str:
    """The feed's loaded table, from its raw pages."""
    return key_sql(feed, conform_sql(feed, clean_sql(feed, PAGES_SQL[feed.name])), zone)


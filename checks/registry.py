"""The registered queries, each with the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_mart import functions as X
from incident_mart import operators as ops
from incident_mart import plans
from incident_mart.schemas import (
    CRASHES,
    FEEDS,
    PAGE,
    PERSONS,
    ROW_KEY,
    STAGING_CONTRACTS,
    VEHICLES,
    Column,
    Feed,
    schema_of,
)
from incident_mart.session import scratch_dir
from incident_mart.sources import files, pages, tables
from incident_mart.streaming import (
    PullLoad,
    close_pull,
    merge_stream,
    retry_set_aside,
    set_aside_pulls,
    start_feed_stream,
)

from . import roles
from .roles import table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL it must equal."""

    def add(run: Query) -> Query:
        @wraps(run)
        def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
            return zoneless(run(spark, sf_dir))

        _QUERIES[run.__name__] = plain
        _SQL[run.__name__] = sql
        return plain

    return add


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as the UTC wall time the tables hold, whatever the reader's zone."""
    instants = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants})


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def hex_key(df: DataFrame, name: str = ROW_KEY) -> DataFrame:
    """Binary keys as lower-case hex, to compare and to print."""
    return df.withColumn(name, F.lower(F.hex(name)))


# Events as a fourth feed: the operators take any feed, not the three published ones.
EVENTS = Feed(
    name="events",
    table="event_data",
    page_key="event_id",
    hash_columns=("event_id", "ts"),
    columns=(
        Column("event_id", "int", "string", "string"),
        Column("ts", "timestamp", "timestamp", "timestamp"),
        Column("user_id", "int", "string", "string"),
        Column("event_type", "text", "string", "string"),
        Column("value", "float", "float", "double"),
    ),
)

# ------------------------------------------------------------------ models

_STG_PERSONS = f"""
SELECT *, coalesce(safety_equipment, 'USAGE UNKNOWN') AS safety_equipment_updated,
       month(crash_date) AS crash_month_number, year(crash_date) AS crash_year,
       crash_date AS traffic_crash_date, monthname(crash_date) AS crash_month
FROM ({roles.PERSONS_TABLE}) WHERE age <> 0
"""


_STG_PERSONS_OF_LOADS = f"""
SELECT *, coalesce(safety_equipment, 'USAGE UNKNOWN') AS safety_equipment_updated,
       month(crash_date) AS crash_month_number, year(crash_date) AS crash_year,
       crash_date AS traffic_crash_date, monthname(crash_date) AS crash_month
FROM ({roles.key_sql(PERSONS, roles.PERSONS_TABLE)}) WHERE age <> 0
"""


def _fact_sql(persons: str, crashes: str, ties: str) -> str:
    return f"""
    WITH p AS (
      SELECT *, row_number() OVER (
          PARTITION BY person_type, crash_record_id
          ORDER BY crash_date DESC NULLS LAST, {ties} NULLS FIRST) AS rn
      FROM ({persons}) WHERE person_type <> 'PASSENGER' AND age <> 0)
    SELECT p.person_type, p.crash_date AS traffic_crash_date,
           CASE WHEN p.crash_date IS NULL THEN 'Unknown' ELSE monthname(p.crash_date) END
             AS crash_month,
           year(p.crash_date) AS crash_year, p.safety_equipment, c.weather_condition,
           c.lighting_condition, c.road_defect, c.injuries_total, c.injuries_fatal
    FROM p JOIN ({crashes}) c ON p.crash_record_id = c.crash_record_id
    WHERE rn = 1
    """


@query(_fact_sql(roles.PERSONS_TABLE, roles.CRASHES_TABLE, "person_id, safety_equipment"))
def fact_latest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons = plans.stg_persons_data(roles.persons(spark, sf_dir))
    crashes = plans.stg_traffic_data(roles.crashes(spark, sf_dir))
    return plans.fact_traffic_accidents(persons, crashes)


@query(_fact_sql(roles.PERSONS_TABLE, roles.CRASHES_TABLE, "person_id, safety_equipment"))
def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact kept by change over two loads that share crashes, the second one run twice."""
    kept = plans.KeptFact(scratch_dir(spark, "kept"), parts=16)
    persons = plans.stg_persons_data(roles.persons(spark, sf_dir))
    crashes = plans.stg_traffic_data(roles.crashes(spark, sf_dir))
    late = F.month("crash_date") > 6
    first = (persons.filter(~late), crashes.filter(F.col("injuries_fatal") == 0))
    second = (
        persons.filter(late | late.isNull()),
        crashes.filter(~F.col("injuries_fatal").eqNullSafe(F.lit(0))),
    )
    for load, rows in (("first", first), ("second", second), ("second", second)):
        kept.bring_in(spark, load, *rows)
    return kept.read(spark)


@query(_fact_sql(roles.PERSONS_TABLE, roles.CRASHES_TABLE, "person_id, safety_equipment"))
def fact_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of two loads bucketed by crash; crashes of more than five persons lie apart."""
    root = scratch_dir(spark, "buckets")
    kept = plans.CrashBuckets(f"buckets_{root[-32:]}", root, buckets=8, hot_rows=5)
    persons = plans.stg_persons_data(roles.persons(spark, sf_dir))
    crashes = plans.stg_traffic_data(roles.crashes(spark, sf_dir))
    late = F.coalesce(F.month("crash_date") > 6, F.lit(True))
    fatal = F.coalesce(F.col("injuries_fatal") > 0, F.lit(True))
    kept.add(spark, "first", persons.filter(~late), crashes.filter(~fatal))
    kept.add(spark, "second", persons.filter(late), crashes.filter(fatal))
    return kept.fact(spark)


@query(_STG_PERSONS)
def stg_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.stg_persons_data(roles.persons(spark, sf_dir))


@query(roles.CRASHES_TABLE)
def stg_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.stg_traffic_data(roles.crashes(spark, sf_dir))


@query(
    f"""SELECT * EXCLUDE (make, model), coalesce(make, 'PEDESTRAIN') AS make,
               coalesce(model, 'PEDESTRAIN') AS model
        FROM ({roles.VEHICLES_TABLE})"""
)
def stg_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.stg_vehicles_data(roles.vehicles(spark, sf_dir))


@query(
    f"""SELECT crash_date AS traffic_crash_date, age, sex, safety_equipment, airbag_deployed
        FROM ({roles.PERSONS_TABLE}) WHERE person_type <> 'PASSENGER' AND age > 15"""
)
def age_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.age_distri(plans.stg_persons_data(roles.persons(spark, sf_dir)))


@query(
    f"""SELECT longitude, latitude, injuries_total, injuries_fatal,
               longitude AS point_longitude, latitude AS point_latitude,
               'POINT(' || longitude || ' ' || latitude || ')' AS geo_wkt
        FROM (SELECT * REPLACE (0.25 - longitude AS longitude, 45.5 - latitude AS latitude)
              FROM ({roles.CRASHES_TABLE}))"""
)
def location_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractional positions, west and east, north and south."""
    crashes = roles.crashes(spark, sf_dir).withColumns(
        {"longitude": 0.25 - F.col("longitude"), "latitude": 45.5 - F.col("latitude")}
    )
    located = plans.crashes_location(crashes)
    return located.select(
        "longitude",
        "latitude",
        "injuries_total",
        "injuries_fatal",
        F.col("geo_point.longitude").alias("point_longitude"),
        F.col("geo_point.latitude").alias("point_latitude"),
        "geo_wkt",
    )


# ------------------------------------------------- windows, joins, expressions


@query(
    """SELECT l_returnflag, l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey FROM (
         SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_orderkey
           ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
       WHERE rn = 1"""
)
def latest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = ["l_returnflag", "l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf_dir, "lineitem").select(*shown)
    ties = ["l_linenumber", "l_partkey", "l_suppkey"]
    return ops.latest_per_group(lines, ["l_returnflag", "l_orderkey"], "l_shipdate", ties)


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity, o_orderdate, o_orderpriority
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def inner_join_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.join_on_key(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "orders"),
        "l_orderkey",
        ["l_orderkey", "l_linenumber", "l_quantity"],
        ["o_orderdate", "o_orderpriority"],
        right_key="o_orderkey",
    )


@query(
    """SELECT o_orderkey, n, year(o_orderdate) AS y,
              CASE WHEN n BETWEEN 1 AND 12
                   THEN monthname(make_date(2000, greatest(1, least(12, n)), 1))
                   ELSE 'Unknown' END AS name
       FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL
                            ELSE month(o_orderdate) + o_custkey % 3 - 1 END AS n FROM orders)"""
)
def month_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = X.month_number(F.col("o_orderdate"))
    shifted = F.when(F.col("o_orderstatus") != "P", month + F.col("o_custkey") % 3 - 1)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        shifted.alias("n"),
        X.year_number(F.col("o_orderdate")).alias("y"),
        X.month_name(shifted).alias("name"),
    )


@query(
    """SELECT p_partkey, coalesce(nullif(p_brand, 'Brand#2'), 'USAGE UNKNOWN') AS equipment,
              CASE WHEN nullif(p_type, 'ECONOMY') IS NULL THEN 'PEDESTRAIN' ELSE p_type END AS kind
       FROM part"""
)
def fill_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        X.fill_safety_equipment(F.nullif("p_brand", F.lit("Brand#2"))).alias("equipment"),
        X.fill_pedestrian(F.nullif("p_type", F.lit("ECONOMY"))).alias("kind"),
    )


@query(
    """SELECT p_partkey, CASE WHEN nullif(id, '') IS NULL THEN 1 ELSE CAST(id AS BIGINT) END AS id
       FROM (SELECT p_partkey, CASE WHEN p_size < 10 THEN '' WHEN p_size < 20 THEN NULL
                                    ELSE CAST(p_size AS VARCHAR) END AS id FROM part)"""
)
def id_or_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(
        "case when p_size < 10 then '' when p_size < 20 then null else cast(p_size as string) end"
    )
    return table(spark, sf_dir, "part").select("p_partkey", X.id_or_one(text).alias("id"))


@query(roles.key_sql(CRASHES, roles.CRASHES_TABLE))
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hex_key(ops.with_surrogate_key(roles.crashes(spark, sf_dir), CRASHES.hash_columns))


# ---------------------------------------------------------------- cleaning


@query(
    """SELECT p_partkey, coalesce(CAST(trunc(try_cast(t AS DOUBLE)) AS BIGINT), 0) AS whole
       FROM (SELECT p_partkey, CASE WHEN p_size > 45 THEN p_name WHEN p_size > 40 THEN NULL
                  WHEN p_size > 30 THEN '-' || p_retailprice
                  ELSE CAST(p_retailprice AS VARCHAR) END AS t FROM part)"""
)
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(
        "case when p_size > 45 then p_name when p_size > 40 then null "
        "when p_size > 30 then concat('-', p_retailprice) else cast(p_retailprice as string) end"
    )
    return table(spark, sf_dir, "part").select("p_partkey", X.int_or_zero(text).alias("whole"))


@query(
    f"""SELECT page_no, crash_record_id, try_cast(crash_date AS TIMESTAMP) AS crash_date
        FROM ({roles.PAGES_SQL["crashes"]})"""
)
def coerce_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.crash_pages(spark, sf_dir).select(
        PAGE, "crash_record_id", X.timestamp_or_null(F.col("crash_date")).alias("crash_date")
    )


@query("SELECT o_orderkey AS whole, o_totalprice AS number FROM orders")
def strict_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) as k", "cast(o_totalprice as string) as p"
    )
    return text.select(
        X.strict_int(F.col("k")).alias("whole"), X.strict_float(F.col("p")).alias("number")
    )


@query(
    """SELECT p_partkey, nullif(p_brand, 'Brand#2') AS p_brand, nullif(p_type, 'ECONOMY') AS p_type
       FROM part WHERE p_brand <> 'Brand#2' AND p_type <> 'ECONOMY'"""
)
def drop_any_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "nullif(p_brand, 'Brand#2') as p_brand", "nullif(p_type, 'ECONOMY') as p_type"
    )
    return ops.drop_incomplete(ops.keep_columns(holed, ["p_partkey", "p_brand", "p_type"]))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
         SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS r FROM lineitem)
       WHERE r = 1"""
)
def page_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return ops.first_page_wins(lines, "l_orderkey", "l_linenumber")


@query(
    """WITH p AS (SELECT event_id // 100 AS page_no, event_id, value FROM events)
       SELECT * FROM p WHERE page_no < (
         SELECT min(page_no) FROM p WHERE value > 0.9 * (SELECT max(value) FROM events))"""
)
def page_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page with a value near the greatest of all ends the load."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id div 100 as page_no", "event_id", "value"
    )
    ledger = ops.page_ledger(rows, PAGE, _near_greatest(rows))
    return ops.page_prefix(rows, ledger, PAGE)


def _near_greatest(events: DataFrame) -> SparkColumn:
    return F.col("value") > F.lit(0.9) * events.agg(F.max("value")).scalar()


@query(
    """WITH p AS (SELECT DISTINCT l_orderkey AS k FROM lineitem),
            n AS (SELECT 0 AS k UNION ALL SELECT k + 1 FROM p)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
       WHERE l_orderkey < (SELECT min(k) FROM n ANTI JOIN p USING (k))"""
)
def page_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys as page numbers: the first order without lines ends the load."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    ledger = ops.page_ledger(rows, "l_orderkey", F.lit(False))
    return ops.page_prefix(rows, ledger, "l_orderkey", first_page=0)


@query(
    """SELECT l_linenumber, count(*) AS rows_kept FROM (
         SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS r FROM lineitem)
       WHERE r = 1 GROUP BY l_linenumber"""
)
def page_rows_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return ops.rows_kept(ops.first_page_wins(lines, "l_orderkey", "l_linenumber"), "l_linenumber")


def _clean(feed: Feed) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plans.clean_pages(roles.PAGES[feed.name](spark, sf_dir), feed)

    run.__name__ = f"clean_{feed.name}"
    return run


for _feed in FEEDS.values():
    query(roles.clean_sql(_feed, roles.PAGES_SQL[_feed.name]))(_clean(_feed))


_EVENT_PAGES = """
SELECT event_id // 100 AS page_no, CAST(event_id AS VARCHAR) AS event_id,
       CAST(ts AS VARCHAR) AS ts,
       CASE WHEN value > 0.9 * (SELECT max(value) FROM events) THEN 'unknown'
            ELSE CAST(user_id AS VARCHAR) END AS user_id,
       nullif(event_type, 'error') AS event_type, CAST(value AS VARCHAR) AS value
FROM events
"""
_EVENT_CLEAN = roles.clean_sql(
    EVENTS,
    f"""SELECT * FROM ({_EVENT_PAGES}) WHERE page_no < coalesce(
        (SELECT min(page_no) FROM ({_EVENT_PAGES})
         WHERE user_id = 'unknown' AND event_type IS NOT NULL), 9223372036854775807)""",
)


@query(_EVENT_CLEAN)
def clean_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unreadable id on a complete row ends the load; one on a dropped row does not."""
    raw = _event_pages(spark, sf_dir)
    return plans.clean_pages(raw, EVENTS, on_error="prefix", first_page=0)


def _event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    user = F.when(_near_greatest(events), "unknown").otherwise(F.col("user_id").cast("string"))
    return events.select(
        F.expr("event_id div 100").alias(PAGE),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("string").alias("ts"),
        user.alias("user_id"),
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.col("value").cast("string").alias("value"),
    )


@query(
    f"""SELECT page_no, count(*) AS rows_staged, coalesce(any_value(n), 0) AS rows_kept,
               bool_or(user_id = 'unknown' AND event_type IS NOT NULL) AS is_bad
        FROM ({_EVENT_PAGES}) LEFT JOIN
             (SELECT page_no, count(*) AS n FROM ({_EVENT_CLEAN}) GROUP BY page_no) USING (page_no)
        GROUP BY page_no"""
)
def prefix_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each page of a load gave that ended at a bad page."""
    raw = _event_pages(spark, sf_dir)
    loaded = plans.clean_pages(raw, EVENTS, on_error="prefix", first_page=0)
    return plans.page_report(plans.stage_pages(raw, EVENTS), loaded, EVENTS)


# ----------------------------------------------------------------- sources

_EVENT_TEXT = [
    "cast(event_id as string) as event_id",
    "cast(ts as string) as ts",
    "cast(user_id as string) as user_id",
    "event_type",
    "cast(value as string) as value",
]
_EVENT_DAY = "cast(datediff(ts, date '2024-01-01') as bigint) as page_no"


def _typed_events(raw: DataFrame, *before: str) -> DataFrame:
    return raw.select(
        *before,
        X.strict_int(F.col("event_id")).alias("event_id"),
        X.timestamp_or_null(F.col("ts")).alias("ts"),
        X.strict_int(F.col("user_id")).alias("user_id"),
        "event_type",
        X.strict_float(F.col("value")).alias("value"),
    )


@query(
    """SELECT date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS page_no,
              event_id, ts, user_id, event_type, value FROM events"""
)
def json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_dir(spark, "json-pages")
    events = table(spark, sf_dir, "events").selectExpr(_EVENT_DAY, *_EVENT_TEXT)
    pages.write_json_pages(events, landing, compression="gzip")
    return _typed_events(pages.read_json_pages(spark, landing, EVENTS.column_names), PAGE)


@query(
    """SELECT event_id AS page_no,
              CASE WHEN event_id % 11 <> 3 THEN CAST(CAST(props AS JSON)->>'k' AS BIGINT) END AS k,
              CAST(NULL AS VARCHAR) AS absent, event_id % 11 = 3 AS body_broken
       FROM events WHERE event_id % 11 <> 5"""
)
def json_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of one record, empty ones (the end of a pull) and ones that are no list."""
    body = (
        F.when(F.col("event_id") % 11 == 3, F.concat(F.lit("<html>"), "props"))
        .when(F.col("event_id") % 11 == 5, F.lit(" [ ]"))
        .otherwise(F.concat(F.lit("["), "props", F.lit("]")))
    )
    bodies = table(spark, sf_dir, "events").select(F.col("event_id").alias(PAGE), body.alias("body"))
    rows = pages.explode_bodies(bodies, "body", ["k", "absent"])
    return rows.withColumn("k", X.strict_int(F.col("k")))


@query(
    roles.conform_sql(
        CRASHES,
        f"""SELECT * REPLACE (
              CASE WHEN injuries_total <> 3 THEN injuries_total END AS injuries_total,
              CASE WHEN latitude <> 7 THEN latitude END AS latitude,
              CASE WHEN CAST(crash_record_id AS BIGINT) % 9 <> 4 THEN crash_date END AS crash_date)
            FROM ({roles.CRASHES_TABLE})""",
    )
)
def csv_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bad field of a line reads as NULL and its other fields stay."""
    folder = scratch_dir(spark, "csv")
    layout = plans.Layout(f"{folder}/mart")
    crashes = roles.crashes(spark, sf_dir)
    late = F.col("crash_record_id").cast("bigint") % 9 == 4
    text = crashes.withColumns(
        {
            "crash_date": F.when(late, "soon").otherwise(F.col("crash_date").cast("string")),
            "injuries_total": F.when(F.col("injuries_total") == 3, "few").otherwise(
                F.col("injuries_total").cast("string")
            ),
            "latitude": F.when(F.col("latitude") == 7, "north").otherwise(
                F.col("latitude").cast("string")
            ),
        }
    )
    files.append_csv(text, f"{folder}/csv")
    plans.conform_csv(spark, f"{folder}/csv", CRASHES, layout)
    return plans.widen(spark.read.parquet(layout.conformed(CRASHES)), CRASHES)


@query(roles.conform_sql(CRASHES, roles.CRASHES_TABLE))
def parquet_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "narrow")
    files.replace_rows(plans.conform(roles.crashes(spark, sf_dir), CRASHES), folder)
    return files.read_parquet_as(spark, folder, CRASHES.wide_schema)


@query(f"SELECT * FROM ({roles.CRASHES_TABLE}) ORDER BY crash_record_id LIMIT 100")
def sample_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.stg_traffic_data(roles.crashes(spark, sf_dir), 100, ["crash_record_id"])


# ------------------------------------------------------------------ checks

_PERSON_CONTRACT = STAGING_CONTRACTS["stg_persons_data"]


def _report_sql(source: str, contract: list, needed: list[str]) -> str:
    lines = []
    for column, kind in contract:
        ok = f"count(*) = count({column})" if column in needed else "true"
        lines.append(
            f"""SELECT '{column}' AS "column", '{kind}' AS expected, '{kind}' AS actual,
                       count(*) AS "rows", count(*) - count({column}) AS nulls, {ok} AS ok FROM s"""
        )
    return f"WITH s AS ({source}) " + " UNION ALL ".join(lines)


@query(
    _report_sql(
        f"SELECT md5(person_id) AS unique_id, * FROM ({_STG_PERSONS})",
        _PERSON_CONTRACT,
        ["unique_id", "safety_equipment"],
    )
)
def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = ops.with_surrogate_key(roles.persons(spark, sf_dir), PERSONS.hash_columns)
    staged = plans.stg_persons_data(keyed)
    return ops.contract_report(staged, _PERSON_CONTRACT, [ROW_KEY, "safety_equipment"])


@query(roles.key_sql(VEHICLES, roles.VEHICLES_TABLE))
def required_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row passes the check of its required key."""
    keyed = ops.with_surrogate_key(roles.vehicles(spark, sf_dir), VEHICLES.hash_columns)
    return hex_key(ops.required(keyed, [ROW_KEY]))


# ------------------------------------------------------------------- merge


@query(
    f"""SELECT * FROM ({roles.key_sql(CRASHES, roles.CRASHES_TABLE)}) ANTI JOIN
        (SELECT CAST(l_orderkey AS VARCHAR) AS crash_record_id FROM lineitem)
        USING (crash_record_id)"""
)
def merge_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crashes the table lacks, where it holds those that have lines."""
    source = ops.with_surrogate_key(roles.crashes(spark, sf_dir), CRASHES.hash_columns)
    return hex_key(ops.unmatched_rows(source, _crashes_with_lines(spark, sf_dir), ROW_KEY))


def _crashes_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as string) as crash_record_id"
    )
    rows = roles.crashes(spark, sf_dir).join(lines, "crash_record_id", "left_semi")
    return ops.with_surrogate_key(rows, CRASHES.hash_columns)


@query(roles.key_sql(CRASHES, roles.CRASHES_TABLE))
def insert_only_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the crashes with lines, after all crashes are merged into it."""
    path, schema = scratch_dir(spark, "merge"), CRASHES.table_schema
    tables.insert_only_merge(_crashes_with_lines(spark, sf_dir), path, schema, "first")
    source = ops.with_surrogate_key(roles.crashes(spark, sf_dir), CRASHES.hash_columns)
    tables.insert_only_merge(source, path, schema, "second")
    return hex_key(tables.read_table(spark, path, schema))


@query(roles.key_sql(CRASHES, roles.CRASHES_TABLE))
def merge_same_load_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of the crashes, merged under one load id: the first one stays."""
    path, schema = scratch_dir(spark, "merge-same"), CRASHES.table_schema
    source = ops.with_surrogate_key(roles.crashes(spark, sf_dir), CRASHES.hash_columns)
    odd = F.col("crash_record_id").cast("bigint") % 2 == 1
    for half in (source.filter(odd), source.filter(~odd)):
        tables.insert_only_merge(half, path, schema, "daily")
    return hex_key(tables.read_table(spark, path, schema))


@query(roles.key_sql(PERSONS, roles.PERSONS_TABLE))
def merge_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows merged as two loads, and the second load run again."""
    path, schema = scratch_dir(spark, "merge-twice"), PERSONS.table_schema
    source = ops.with_surrogate_key(roles.persons(spark, sf_dir), PERSONS.hash_columns)
    for load in ("first", "second", "second"):
        tables.insert_only_merge(source, path, schema, load)
    return hex_key(tables.read_table(spark, path, schema))


@query(roles.key_sql(CRASHES, roles.CRASHES_TABLE))
def compact_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five overlapping loads, written as one after the second and after the last, twice."""
    path, schema = scratch_dir(spark, "compact"), CRASHES.table_schema
    source = ops.with_surrogate_key(roles.crashes(spark, sf_dir), CRASHES.hash_columns)
    order = F.col("crash_record_id").cast("bigint")
    for load in range(5):
        # Every load sends the one before it again.
        part = source.filter((order % 5 == load) | (order % 5 == load - 1))
        tables.insert_only_merge(part, path, schema, f"load-{load}")
        if load in (1, 4):
            tables.compact_table(spark, path, schema)
    tables.remove_replaced(spark, path)
    tables.compact_table(spark, path, schema)
    return hex_key(tables.read_table(spark, path, schema))


@query(roles.key_sql(CRASHES, roles.CRASHES_TABLE))
def merge_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table laid out by the first digit of its key; the last merge reads a few prefixes only."""
    path, schema = scratch_dir(spark, "merge-prefix"), CRASHES.table_schema
    source = ops.with_surrogate_key(roles.crashes(spark, sf_dir), CRASHES.hash_columns)
    late = F.hex(ROW_KEY).substr(1, 1) == "0"
    tables.insert_only_merge(source.filter(~late), path, schema, "most", prefix_digits=1)
    both = source.filter(late | (F.hex(ROW_KEY).substr(1, 1) == "7"))
    tables.insert_only_merge(both, path, schema, "late")
    return hex_key(tables.read_table(spark, path, schema))


@query(_STG_PERSONS_OF_LOADS)
def catalog_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The persons model as a view of a catalog, read by another session, after a compaction."""
    layout = plans.Layout(scratch_dir(spark, "catalog"), prefix_digits=1)
    source = ops.with_surrogate_key(roles.persons(spark, sf_dir), PERSONS.hash_columns)
    path, schema = layout.table(PERSONS), PERSONS.table_schema
    odd = F.col("crash_record_id").cast("bigint") % 2 == 1
    database = f"mart_{layout.root[-32:]}"
    for load, part in (("odd", source.filter(odd)), ("all", source)):
        tables.insert_only_merge(part, path, schema, load, prefix_digits=1)
        plans.publish_catalog(spark, layout, database)
    tables.compact_table(spark, path, schema)
    plans.publish_catalog(spark, layout, database)
    tables.remove_replaced(spark, path)
    return hex_key(spark.newSession().table(f"{database}.stg_persons_data"))


@query(
    """SELECT c_custkey AS key, -1 AS line FROM customer UNION ALL
       SELECT l_orderkey, l_linenumber FROM lineitem
       WHERE l_orderkey NOT IN (SELECT c_custkey FROM customer)"""
)
def merge_source_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines keyed by order, merged into customers: each line of a new key comes in."""
    target = table(spark, sf_dir, "customer").selectExpr("c_custkey as key", "-1 as line")
    lines = table(spark, sf_dir, "lineitem")
    source = lines.selectExpr("l_orderkey as key", "l_linenumber as line")
    return ops.merged(source, target, "key")


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of pages, each streamed in; the second sends the first one's events again."""
    root = scratch_dir(spark, "stream")
    schema = schema_of(
        [
            ("event_id", "bigint"),
            ("ts", "timestamp"),
            ("user_id", "bigint"),
            ("event_type", "string"),
            ("value", "double"),
        ]
    )
    events = table(spark, sf_dir, "events").selectExpr(_EVENT_DAY, *_EVENT_TEXT)
    for drop in (events.filter("event_type <> 'click'"), events):
        pages.write_json_pages(drop, f"{root}/landing", compression="gzip")
        stream = pages.read_json_stream(spark, f"{root}/landing", EVENTS.column_names)
        run = merge_stream(
            stream,
            f"{root}/table",
            schema,
            f"{root}/checkpoint",
            "events",
            key="event_id",
            prepare=_typed_events,
        )
        run.awaitTermination()
    return tables.read_table(spark, f"{root}/table", schema)


@query(roles.loaded_sql(PERSONS))
def stream_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The persons feed, landed as JSON pages and loaded by its stream."""
    root = scratch_dir(spark, "stream-persons")
    pages.write_json_pages(roles.person_pages(spark, sf_dir), f"{root}/landing", compression="gzip")
    run = start_feed_stream(
        spark, PERSONS, f"{root}/landing", f"{root}/mart", f"{root}/checkpoint"
    )
    run.awaitTermination()
    path = plans.Layout(f"{root}/mart").table(PERSONS)
    return hex_key(tables.read_table(spark, path, PERSONS.table_schema))


@query(roles.loaded_sql(PERSONS))
def stream_persons_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The persons feed in three pulls, loaded in a batch for each."""
    root = scratch_dir(spark, "stream-split")
    rows = roles.person_pages(spark, sf_dir)
    for pull in range(3):
        part = rows.filter(F.col("crash_record_id").cast("bigint") % 3 == pull)
        pages.write_json_pages(part, f"{root}/landing/pull-{pull}", compression="gzip")
        close_pull(spark, f"{root}/closed", f"pull-{pull}")
    run = start_feed_stream(
        spark,
        PERSONS,
        f"{root}/landing",
        f"{root}/mart",
        f"{root}/checkpoint",
        closed=f"{root}/closed",
        max_files=1,
    )
    run.awaitTermination()
    path = plans.Layout(f"{root}/mart").table(PERSONS)
    return hex_key(tables.read_table(spark, path, PERSONS.table_schema))


@query(roles.loaded_sql(CRASHES))
def stream_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings, each with a stream and a checkpoint of its own, into one table."""
    root = scratch_dir(spark, "stream-two")
    rows = roles.crash_pages(spark, sf_dir)
    for part in range(2):
        mine = rows.filter(F.col("crash_record_id").cast("bigint") % 2 == part)
        pages.write_json_pages(mine, f"{root}/landing-{part}", compression="gzip")
        run = start_feed_stream(
            spark, CRASHES, f"{root}/landing-{part}", f"{root}/mart", f"{root}/checkpoint-{part}"
        )
        run.awaitTermination()
    path = plans.Layout(f"{root}/mart").table(CRASHES)
    return hex_key(tables.read_table(spark, path, CRASHES.table_schema))


_LACKING = f"""
SELECT * REPLACE (CASE WHEN page_no IN (2, 4) THEN NULL ELSE road_defect END AS road_defect,
                  CASE WHEN page_no = 4 THEN NULL ELSE lighting_condition END AS lighting_condition)
FROM ({roles.PAGES_SQL["crashes"]})
"""


@query(
    roles.key_sql(
        CRASHES,
        roles.conform_sql(
            CRASHES,
            roles.clean_sql(
                CRASHES,
                _LACKING,
                {"road_defect": "page_no IN (2, 4)", "lighting_condition": "page_no = 4"},
            ),
        ),
    )
)
def load_pages_lacking_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crash pages two of which name no road defects, and one no lighting either."""
    root = scratch_dir(spark, "load-lacking")
    rows = roles.crash_pages(spark, sf_dir)
    # A record that is written leaves out what is NULL, so these pages never name it.
    lacking = rows.withColumns(
        {
            "road_defect": F.when(~F.col(PAGE).isin(2, 4), F.col("road_defect")),
            "lighting_condition": F.when(F.col(PAGE) != 4, F.col("lighting_condition")),
        }
    )
    pages.write_json_pages(lacking, f"{root}/landing", compression="gzip")
    where = (spark, f"{root}/landing", CRASHES.column_names)
    layout = plans.Layout(f"{root}/mart")
    sent = pages.read_sent_fields(*where)
    plans.load_pages(pages.read_json_pages(*where), CRASHES, layout, "first", sent=sent)
    return hex_key(tables.read_table(spark, layout.table(CRASHES), CRASHES.table_schema))


_PULLED = f"SELECT * FROM ({roles.PAGES_SQL['crashes']}) WHERE CAST(crash_record_id AS BIGINT) % 4 = "


def _each_pull(pulls: list[int]) -> str:
    each = [roles.conform_sql(CRASHES, roles.clean_sql(CRASHES, f"{_PULLED}{n}")) for n in pulls]
    return roles.key_sql(CRASHES, " UNION ALL ".join(each))


def _pulls_with_a_bad_one(spark: SparkSession, sf_dir: str, label: str) -> PullLoad:
    """Four pulls of crashes, loaded by a stream; the third has a position that is none."""
    root = scratch_dir(spark, label)
    order = F.col("crash_record_id").cast("bigint")
    for n in range(4):
        mine = roles.crash_pages(spark, sf_dir).filter(order % 4 == n)
        if n == 2:
            least = mine.agg(F.min(F.col("crash_record_id").cast("bigint"))).scalar()
            north = F.when(order == least, "north").otherwise(F.col("latitude"))
            # On every page of that crash a complete row, so that it counts.
            mine = mine.withColumn("latitude", north).withColumn(
                "weather_condition", F.when(order == least, "FOG").otherwise(F.col("weather_condition"))
            )
        pages.write_json_pages(mine, f"{root}/landing/pull-{n}", compression="gzip")
        close_pull(spark, f"{root}/closed", f"pull-{n}")
    start_feed_stream(
        spark,
        CRASHES,
        f"{root}/landing",
        f"{root}/mart",
        f"{root}/checkpoint",
        closed=f"{root}/closed",
        set_aside=True,
    ).awaitTermination()
    return PullLoad(CRASHES, f"{root}/landing", f"{root}/mart")


@query(_each_pull([0, 1, 3]))
def stream_sets_bad_pull_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is loaded when one pull of four is bad: the others, also those after it."""
    how = _pulls_with_a_bad_one(spark, sf_dir, "stream-aside")
    return hex_key(tables.read_table(spark, how.layout.table(CRASHES), CRASHES.table_schema))


@query(_each_pull([0, 1, 2, 3]))
def stream_retries_mended_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pull that was set aside, mended and loaded by the second queue."""
    how = _pulls_with_a_bad_one(spark, sf_dir, "stream-retry")
    order = F.col("crash_record_id").cast("bigint")
    for name in set_aside_pulls(spark, CRASHES, how.root):
        files.remove(spark, f"{how.landing}/{name}")
        mended = roles.crash_pages(spark, sf_dir).filter(order % 4 == int(name[-1]))
        pages.write_json_pages(mended, f"{how.landing}/{name}", compression="gzip")
    retry_set_aside(spark, how)
    return hex_key(tables.read_table(spark, how.layout.table(CRASHES), CRASHES.table_schema))


# -------------------------------------------------------------- whole feeds


@query(roles.loaded_sql(CRASHES, zone="+00"))
def load_crashes_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose timestamp text carries the zone."""
    layout = plans.Layout(scratch_dir(spark, "load-zoned"))
    keys = plans.KeyForm(timestamp_suffix="+00")
    plans.load_pages(roles.crash_pages(spark, sf_dir), CRASHES, layout, "first", keys=keys)
    return hex_key(tables.read_table(spark, layout.table(CRASHES), CRASHES.table_schema))


def _load(feed: Feed) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        layout = plans.Layout(scratch_dir(spark, f"load-{feed.name}"))
        plans.load_pages(roles.PAGES[feed.name](spark, sf_dir), feed, layout, "first")
        return hex_key(tables.read_table(spark, layout.table(feed), feed.table_schema))

    run.__name__ = f"load_{feed.name}"
    return run


for _feed in FEEDS.values():
    query(roles.loaded_sql(_feed))(_load(_feed))


@query(
    _fact_sql(
        roles.loaded_sql(PERSONS),
        roles.loaded_sql(CRASHES),
        "person_id, unique_id, safety_equipment",
    )
)
def feeds_to_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON pages of all three feeds to the published fact table."""
    root = scratch_dir(spark, "feeds")
    raw = {}
    for name, feed in FEEDS.items():
        landing = f"{root}/landing/{name}"
        pages.write_json_pages(roles.PAGES[name](spark, sf_dir), landing, compression="gzip")
        raw[name] = pages.read_json_pages(spark, landing, feed.column_names)
    _, models = plans.full_refresh(spark, raw, f"{root}/mart", "first")
    return models["fact_traffic_accidents"]

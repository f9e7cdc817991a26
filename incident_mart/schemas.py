"""The three feeds: columns, types per stage, keys, and how each text field is read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

#: Name of the surrogate key column of every loaded table.
ROW_KEY = "unique_id"
#: Name of the page number column of every page frame.
PAGE = "page_no"
#: True where a page body or record could not be parsed.
BROKEN = "body_broken"
#: Directory column that tells the loads of a table apart.
LOAD_ID = "load_id"

_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "binary": T.BinaryType(),
}


@dataclass(frozen=True)
class Column:
    """One feed column.

    ``reads_as`` says how page text becomes a value:
    ``text`` as it is; ``timestamp`` bad text gives NULL; ``int_or_zero`` bad text
    gives 0; ``int`` and ``float`` bad text makes the whole page bad.
    """

    name: str
    reads_as: str
    conformed: str
    loaded: str


@dataclass(frozen=True)
class Feed:
    name: str
    table: str
    page_key: str
    hash_columns: tuple[str, ...]
    columns: tuple[Column, ...]
    #: Columns whose missing value is filled before incomplete rows are dropped.
    filled_first: tuple[str, ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def conformed_schema(self) -> T.StructType:
        return schema_of([(c.name, c.conformed) for c in self.columns])

    @property
    def wide_schema(self) -> T.StructType:
        """The loaded table without its surrogate key."""
        return schema_of([(c.name, c.loaded) for c in self.columns])

    @property
    def table_schema(self) -> T.StructType:
        key = T.StructField(ROW_KEY, T.BinaryType(), nullable=False)
        return T.StructType([key, *self.wide_schema.fields])


def schema_of(columns: list[tuple[str, str]]) -> T.StructType:
    """``[(name, type name)]`` as a schema of nullable fields."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


# Column names, their order, types and key columns of the published feeds.
CRASHES = Feed(
    name="crashes",
    table="crash_data",
    page_key="crash_record_id",
    hash_columns=("crash_record_id", "crash_date", "latitude", "longitude"),
    columns=(
        Column("crash_record_id", "text", "string", "string"),
        Column("crash_date", "timestamp", "timestamp", "timestamp"),
        Column("weather_condition", "text", "string", "string"),
        Column("lighting_condition", "text", "string", "string"),
        Column("road_defect", "text", "string", "string"),
        Column("injuries_total", "int_or_zero", "int", "bigint"),
        Column("injuries_fatal", "int_or_zero", "int", "bigint"),
        Column("latitude", "float", "float", "double"),
        Column("longitude", "float", "float", "double"),
    ),
)

VEHICLES = Feed(
    name="vehicles",
    table="vehicle_data",
    page_key="crash_unit_id",
    hash_columns=("crash_record_id", "crash_unit_id", "crash_date", "vehicle_id"),
    columns=(
        Column("crash_unit_id", "int", "string", "string"),
        Column("crash_record_id", "text", "string", "string"),
        Column("crash_date", "timestamp", "timestamp", "timestamp"),
        Column("unit_no", "text", "string", "string"),
        Column("unit_type", "text", "string", "string"),
        Column("vehicle_id", "int", "int", "bigint"),
        Column("make", "text", "string", "string"),
        Column("model", "text", "string", "string"),
    ),
)

PERSONS = Feed(
    name="persons",
    table="person_data",
    page_key="person_id",
    hash_columns=("crash_record_id", "crash_date", "person_id", "vehicle_id"),
    columns=(
        Column("person_id", "text", "string", "string"),
        Column("person_type", "text", "string", "string"),
        Column("crash_record_id", "text", "string", "string"),
        Column("vehicle_id", "int", "string", "string"),
        Column("crash_date", "timestamp", "timestamp", "timestamp"),
        Column("sex", "text", "string", "string"),
        Column("safety_equipment", "text", "string", "string"),
        Column("airbag_deployed", "text", "string", "string"),
        Column("age", "int_or_zero", "int", "bigint"),
    ),
    filled_first=("age",),
)

FEEDS = {feed.name: feed for feed in (CRASHES, VEHICLES, PERSONS)}

# Declared columns and types of the staging models. The persons
# contract names 12 of the model's 15 columns.
STAGING_CONTRACTS = {
    "stg_vehicles_data": [
        ("unique_id", "binary"),
        ("crash_unit_id", "string"),
        ("crash_record_id", "string"),
        ("crash_date", "timestamp"),
        ("unit_no", "string"),
        ("unit_type", "string"),
        ("vehicle_id", "bigint"),
        ("make", "string"),
        ("model", "string"),
    ],
    "stg_traffic_data": [
        ("unique_id", "binary"),
        ("crash_record_id", "string"),
        ("crash_date", "timestamp"),
        ("weather_condition", "string"),
        ("lighting_condition", "string"),
        ("road_defect", "string"),
        ("injuries_total", "bigint"),
        ("injuries_fatal", "bigint"),
        ("latitude", "double"),
        ("longitude", "double"),
    ],
    "stg_persons_data": [
        ("unique_id", "binary"),
        ("person_id", "string"),
        ("person_type", "string"),
        ("crash_record_id", "string"),
        ("vehicle_id", "string"),
        ("crash_date", "timestamp"),
        ("sex", "string"),
        ("safety_equipment", "string"),
        ("airbag_deployed", "string"),
        ("age", "bigint"),
        ("safety_equipment_updated", "string"),
        ("traffic_crash_date", "timestamp"),
    ],
}

"""Staging views and core tables. Each model is a function of the frames it reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    fill_pedestrian,
    fill_safety_equipment,
    geo_point,
    geo_wkt,
    month_name,
    month_number,
    year_number,
)
from ..operators import (
    join_on_key,
    latest_per_group,
    replace_columns,
    sample_rows,
    with_computed,
)
from ..schemas import ROW_KEY

# The excluded person type, the age bound, and the columns of the core tables.
PASSENGER = "PASSENGER"
MINOR_AGE = 15
FACT_COLUMNS = [
    "person_type",
    "traffic_crash_date",
    "crash_month",
    "crash_year",
    "safety_equipment",
    "weather_condition",
    "lighting_condition",
    "road_defect",
    "injuries_total",
    "injuries_fatal",
]
FACT_PERSON_COLUMNS = ["person_type", "traffic_crash_date", "safety_equipment"]
FACT_CRASH_COLUMNS = FACT_COLUMNS[5:]
AGE_COLUMNS = ["traffic_crash_date", "age", "sex", "safety_equipment", "airbag_deployed"]


def stg_persons_data(
    persons: DataFrame,
    sample: int | None = None,
    order_by: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """Persons of known age, with filled equipment and calendar columns."""
    aged = with_computed(
        persons.filter(F.col("age") != 0),
        {
            "safety_equipment_updated": fill_safety_equipment(F.col("safety_equipment")),
            "crash_month_number": month_number(F.col("crash_date")),
            "crash_year": year_number(F.col("crash_date")),
        },
    )
    dated = with_computed(
        aged,
        {
            "traffic_crash_date": F.col("crash_date").cast("timestamp"),
            "crash_month": month_name(F.col("crash_month_number")),
        },
    )
    return sample_rows(dated, sample, order_by)


def stg_traffic_data(
    crashes: DataFrame,
    sample: int | None = None,
    order_by: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """Crashes as they are."""
    return sample_rows(crashes, sample, order_by)


def stg_vehicles_data(vehicles: DataFrame) -> DataFrame:
    """Vehicles; a unit without make or model is a pedestrian."""
    return replace_columns(
        vehicles,
        {"make": fill_pedestrian(F.col("make")), "model": fill_pedestrian(F.col("model"))},
    )


def person_ties(persons: DataFrame) -> list[str]:
    """What decides between persons of one date, in this order."""
    return [c for c in ("person_id", ROW_KEY) if c in persons.columns] + ["safety_equipment"]


def without_passengers(persons: DataFrame) -> DataFrame:
    return persons.filter(F.col("person_type") != PASSENGER)


def fact_traffic_accidents(
    persons: DataFrame, crashes: DataFrame, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Latest non-passenger per person type and crash, with the crash's conditions.

    Ties on the date go to the lower ``person_id``, then to the lower surrogate key;
    the last tie-breaker is the only other person column in the result, so the rows
    do not depend on the order of the input. ``carried`` names person columns to add.
    """
    latest = latest_per_group(
        without_passengers(persons),
        ["person_type", "crash_record_id"],
        "traffic_crash_date",
        person_ties(persons),
    )
    return fact_of_latest(latest, crashes, carried)


def fact_of_latest(
    latest: DataFrame, crashes: DataFrame, carried: tuple[str, ...] = ()
) -> DataFrame:
    """``fact_traffic_accidents``, given the latest persons; nothing is ranked again."""
    joined = join_on_key(
        latest, crashes, "crash_record_id", [*FACT_PERSON_COLUMNS, *carried], FACT_CRASH_COLUMNS
    )
    # Month and year follow from the date; made here, they are not shuffled twice.
    when = F.col("traffic_crash_date")
    calendar = {"crash_month": month_name(month_number(when)), "crash_year": year_number(when)}
    return with_computed(joined, calendar).select(*FACT_COLUMNS, *carried)


def age_distri(persons: DataFrame) -> DataFrame:
    """Non-passengers above the age bound."""
    grown = (F.col("person_type") != PASSENGER) & (F.col("age") > MINOR_AGE)
    return persons.filter(grown).select(*AGE_COLUMNS)


def crashes_location(crashes: DataFrame) -> DataFrame:
    """Where crashes happened, as a point and as its text."""
    lon, lat = F.col("longitude"), F.col("latitude")
    return crashes.select(
        "longitude",
        "latitude",
        geo_point(lon, lat).alias("geo_point"),
        "injuries_total",
        "injuries_fatal",
        geo_wkt(lon, lat).alias("geo_wkt"),
    )


#: Models that are stored; the others are views.
CORE = ("fact_traffic_accidents", "age_distri", "crashes_location")


MODELS = ("stg_persons_data", "stg_traffic_data", "stg_vehicles_data", *CORE)


def build_models(
    crashes: DataFrame, vehicles: DataFrame, persons: DataFrame, sample: int | None = None
) -> dict[str, DataFrame]:
    """All six models, lazy, by name."""
    stg_persons = stg_persons_data(persons, sample)
    stg_traffic = stg_traffic_data(crashes, sample)
    return {
        "stg_persons_data": stg_persons,
        "stg_traffic_data": stg_traffic,
        "stg_vehicles_data": stg_vehicles_data(vehicles),
        "fact_traffic_accidents": fact_traffic_accidents(stg_persons, stg_traffic),
        "age_distri": age_distri(stg_persons),
        "crashes_location": crashes_location(stg_traffic),
    }

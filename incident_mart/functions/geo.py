"""Points. Spark cannot store a geography yet, so a point is a struct and a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _wrapped(longitude: Column) -> Column:
    # Longitude is an angle: 190 is -170.
    return F.when(longitude.between(-180, 180), longitude).otherwise(
        F.pmod(longitude + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
    )


def _guarded(longitude: Column, latitude: Column, point: Column) -> Column:
    message = F.concat(F.lit("latitude outside -90 to 90: "), latitude.cast("string"))
    return (
        F.when(longitude.isNull() | latitude.isNull(), F.lit(None))
        .when(latitude.between(-90, 90), point)
        .otherwise(F.raise_error(message))
    )


def _plain(number: Column) -> Column:
    # Whole numbers without ".0"; very small ones without an exponent.
    decimal = F.rtrim(number.cast("decimal(38,18)").cast("string"), F.lit("0"))
    text = F.when((F.abs(number) < 1e-3) & (number != 0), decimal).otherwise(number.cast("string"))
    return F.regexp_replace(text, r"\.0?$", "")


def geo_point(longitude: Column, latitude: Column) -> Column:
    """``struct<longitude,latitude>``; NULL if either is NULL; raises on a bad latitude."""
    lon, lat = longitude.cast("double"), latitude.cast("double")
    point = F.struct(_wrapped(lon).alias("longitude"), lat.alias("latitude"))
    return _guarded(lon, lat, point)


def geo_wkt(longitude: Column, latitude: Column) -> Column:
    """The same point as text, ``POINT(lon lat)``."""
    lon, lat = longitude.cast("double"), latitude.cast("double")
    text = F.concat(
        F.lit("POINT("), _plain(_wrapped(lon)), F.lit(" "), _plain(lat), F.lit(")")
    )
    return _guarded(lon, lat, text)

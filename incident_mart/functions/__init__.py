"""Scalar expressions. Each takes and returns a ``Column``; none is a Python UDF."""

from .coercion import (
    int_or_zero,
    strict_float,
    strict_int,
    timestamp_or_null,
    unreadable,
    value_or_null,
)
from .dates import month_name, month_number, year_number
from .geo import geo_point, geo_wkt
from .keys import md5_key
from .text import blank_to_null, fill_null, fill_pedestrian, fill_safety_equipment, id_or_one

__all__ = [
    "blank_to_null",
    "fill_null",
    "fill_pedestrian",
    "fill_safety_equipment",
    "geo_point",
    "geo_wkt",
    "id_or_one",
    "int_or_zero",
    "md5_key",
    "month_name",
    "month_number",
    "strict_float",
    "strict_int",
    "timestamp_or_null",
    "unreadable",
    "value_or_null",
    "year_number",
]

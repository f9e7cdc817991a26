"""Filling of missing text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .coercion import strict_int

# Fill texts as published, spelling included.
UNKNOWN_EQUIPMENT = "USAGE UNKNOWN"
PEDESTRIAN_FILL = "PEDESTRAIN"


def fill_null(text: Column, value: str) -> Column:
    """``value`` for NULL; the empty string stays."""
    return F.coalesce(text, F.lit(value))


def fill_safety_equipment(text: Column) -> Column:
    return fill_null(text, UNKNOWN_EQUIPMENT)


def fill_pedestrian(text: Column) -> Column:
    return fill_null(text, PEDESTRIAN_FILL)


def blank_to_null(text: Column) -> Column:
    """NULL for the empty string, which a CSV file cannot tell from NULL."""
    return F.nullif(text, F.lit(""))


def id_or_one(text: Column) -> Column:
    """1 for NULL and the empty string, else the whole number; other text raises."""
    return F.when(blank_to_null(text).isNull(), F.lit(1).cast("bigint")).otherwise(strict_int(text))

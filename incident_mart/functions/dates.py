"""Calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names.
MONTHS = (
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
)


def month_number(when: Column) -> Column:
    return F.month(when).cast("bigint")


def year_number(when: Column) -> Column:
    return F.year(when).cast("bigint")


def month_name(number: Column) -> Column:
    """English month name; ``Unknown`` for NULL and anything outside 1 to 12."""
    names = F.array(*[F.lit(name) for name in MONTHS])
    return F.when(number.between(1, 12), F.element_at(names, number.cast("int"))).otherwise(
        F.lit("Unknown")
    )

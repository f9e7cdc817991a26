"""Text to value: the lenient and the strict casts of page fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _double_or_null(text: Column) -> Column:
    # Java reads a trailing d or f as part of a number ("1.5d"); feeds do not mean one.
    trimmed = F.rtrim(text.cast("string"))
    suffixed = F.right(trimmed, F.lit(1)).isin("d", "D", "f", "F")
    infinite = F.lower(trimmed).endswith("inf")
    return F.when(~suffixed | infinite, text.cast("string")).try_cast("double")


def _or_raise(text: Column, value: Column, kind: str) -> Column:
    message = F.concat(F.lit(f"not a {kind}: "), text.cast("string"))
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(message)))


def _zero_if_none(text: Column) -> Column:
    number = F.coalesce(_double_or_null(text), F.lit(float("nan")))
    return F.nanvl(number, F.lit(0.0))


def timestamp_or_null(text: Column) -> Column:
    """Timestamp; text that is none gives NULL.

    A time without a date is none: Spark would add the day the job runs on.
    """
    colon = F.instr(F.ltrim(text.cast("string")), ":")
    return F.when(~colon.between(1, 4), F.try_to_timestamp(text))


def int_or_zero(text: Column) -> Column:
    """Whole part of a number; NULL, NaN and text that is no number give 0.

    The text goes through double, so ``'2.9'`` is 2 and not NULL. An infinite value
    raises, as it has no whole part.
    """
    return _or_raise(text, _zero_if_none(text).try_cast("bigint"), "count")


def strict_int(text: Column) -> Column:
    """Whole number; any other text, ``'12.0'`` included, raises."""
    return _or_raise(text, text.try_cast("bigint"), "whole number")


def strict_float(text: Column) -> Column:
    """Number; any other text raises."""
    return _or_raise(text, _double_or_null(text), "number")


def value_or_null(text: Column, reads_as: str) -> Column:
    """The value of a page field that never raises; ``unreadable`` tells why it is NULL."""
    if reads_as == "timestamp":
        return timestamp_or_null(text)
    if reads_as == "int_or_zero":
        return _zero_if_none(text).try_cast("bigint")
    if reads_as == "int":
        return text.try_cast("bigint")
    if reads_as == "float":
        return _double_or_null(text)
    return text


def unreadable(text: Column, reads_as: str) -> Column:
    """True where the strict reading of ``text`` would raise."""
    if reads_as in ("int", "float", "int_or_zero"):
        return text.isNotNull() & value_or_null(text, reads_as).isNull()
    return F.lit(False)


def strict_value(text: Column, reads_as: str) -> Column:
    """The value of a page field; raises where the field is unreadable."""
    readers = {
        "timestamp": timestamp_or_null,
        "int_or_zero": int_or_zero,
        "int": strict_int,
        "float": strict_float,
    }
    return readers.get(reads_as, lambda c: c)(text)

"""Column selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assert_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Fail before any plan runs if a column is not there."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"required columns are missing: {', '.join(absent)}")
    return df


def keep_columns(df: DataFrame, names: list[str], absent_type: str = "string") -> DataFrame:
    """The listed columns in the listed order; an absent one reads as NULL."""
    present = set(df.columns)
    return df.select(
        *[F.col(n) if n in present else F.lit(None).cast(absent_type).alias(n) for n in names]
    )


def with_computed(df: DataFrame, computed: dict[str, Column]) -> DataFrame:
    """All columns plus computed ones."""
    return df.withColumns(computed)


def replace_columns(df: DataFrame, replaced: dict[str, Column]) -> DataFrame:
    """All columns but the replaced ones, which follow at the end with new values."""
    kept = [c for c in df.columns if c not in replaced]
    return df.select(*kept, *[value.alias(name) for name, value in replaced.items()])

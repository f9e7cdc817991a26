"""Row filters of the cleaning step."""

from __future__ import annotations

from pyspark.sql import DataFrame


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any of ``columns`` (default: all)."""
    return df.na.drop("any", subset=columns or df.columns)

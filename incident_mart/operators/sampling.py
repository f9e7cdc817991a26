"""Small builds for trying a model out."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sample_rows(
    df: DataFrame, rows: int | None, order_by: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """The first ``rows`` rows, or all for None. Any rows will do unless ordered."""
    if rows is None:
        return df
    return (df.orderBy(*order_by) if order_by else df).limit(rows)

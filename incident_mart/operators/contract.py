"""Checks of columns, types and required values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .projection import assert_columns

Contract = list[tuple[str, str]]


def _actual_types(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def schema_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """``(column, expected, actual, ok)`` for each declared column. Reads no data."""
    actual = _actual_types(df)
    rows = [(c, want, actual.get(c), actual.get(c) == want) for c, want in contract]
    return df.sparkSession.createDataFrame(
        rows, "column string, expected string, actual string, ok boolean"
    )


def contract_report(
    df: DataFrame, contract: Contract, required_columns: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """``schema_contract`` with the rows and NULLs found, in one pass over the data.

    ``ok`` also needs a required column to hold no NULL.
    """
    actual = _actual_types(df)
    found = {c: c in actual for c, _ in contract}
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"n{i}") for i, (c, _) in enumerate(contract) if found[c]],
    )
    lines = []
    for i, (column, want) in enumerate(contract):
        nulls = F.col("rows") - (F.col(f"n{i}") if found[column] else F.lit(0))
        ok = F.lit(actual.get(column) == want)
        if column in required_columns:
            ok = ok & (nulls == 0)
        lines.append(
            F.struct(
                F.lit(column).alias("column"),
                F.lit(want).alias("expected"),
                F.lit(actual.get(column)).cast("string").alias("actual"),
                F.col("rows").alias("rows"),
                nulls.alias("nulls"),
                ok.alias("ok"),
            )
        )
    return totals.select(F.inline(F.array(*lines)))


def required(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same rows; a NULL in one of ``columns`` fails the job that reads it."""
    assert_columns(df, columns)
    checked = {
        c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is required"))).otherwise(F.col(c))
        for c in columns
    }
    return df.withColumns(checked)

"""CSV and parquet files."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, check_header: bool = False
) -> DataFrame:
    """CSV with a header line, read by position against ``schema``.

    A bad field reads as NULL and the row stays. ``check_header`` fails on a header
    whose names differ from the schema, instead of reading shifted values.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", not check_header)
        .csv(path)
    )


def read_parquet_as(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet under declared, possibly wider, types."""
    return spark.read.schema(schema).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a parquet folder in one write."""
    df.write.mode("append").parquet(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Add rows to a CSV folder; each file has one header line."""
    df.write.mode("append").option("header", True).csv(path)


def replace_rows(df: DataFrame, path: str) -> None:
    """Replace a parquet folder. ``df`` must not read from it."""
    df.write.mode("overwrite").parquet(path)


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a frame and read it back: its lineage ends here and its size is known."""
    replace_rows(df, path)
    return read_parquet_as(df.sparkSession, path, df.schema)


def store_counted(df: DataFrame, path: str, **counts: Column) -> tuple[DataFrame, dict[str, Any]]:
    """``store``, and aggregates over the rows that are taken while they are written.

    They need no job and no second read. The write's last stage counts a row once, also
    when tasks run again.
    """
    seen = Observation()
    observed = df.observe(seen, *[count.alias(name) for name, count in counts.items()])
    return store(observed, path), seen.get


def _on_disk(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever store the path names."""
    store_of, at = _on_disk(spark, path)
    return store_of.exists(at)


def names_at(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a glob pattern, on whatever store it names."""
    store_of, at = _on_disk(spark, pattern)
    return [found.getPath().toString() for found in store_of.globStatus(at) or []]


def sizes_at(spark: SparkSession, pattern: str) -> dict[str, int]:
    """``names_at``, with the bytes of each file."""
    store_of, at = _on_disk(spark, pattern)
    return {found.getPath().toString(): found.getLen() for found in store_of.globStatus(at) or []}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files."""
    store_of, at = _on_disk(spark, path)
    store_of.delete(at, True)


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    bucket_by: tuple[int, list[str]] | None = None,
) -> None:
    """Write a catalog table.

    ``bucket_by=(n, keys)`` on both sides of a join that runs often saves its
    shuffles. Leave it out where a key may be hot: a bucket is one task.
    """
    writer = df.write.mode(mode).format("parquet")
    if bucket_by:
        count, keys = bucket_by
        writer = writer.bucketBy(count, *keys).sortBy(*keys)
    writer.saveAsTable(name)


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """Print schema and some rows. A job of its own; keep it out of scheduled runs."""
    df.printSchema()
    df.show(rows)
    return df

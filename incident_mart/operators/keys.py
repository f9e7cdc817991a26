"""Surrogate key of a table row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import key_text, md5_key
from ..schemas import ROW_KEY
from .projection import assert_columns


def with_surrogate_key(
    df: DataFrame,
    hash_columns: list[str] | tuple[str, ...],
    name: str = ROW_KEY,
    separator: str = "",
    timestamp_suffix: str = "",
) -> DataFrame:
    """The hash of ``hash_columns`` first, then all columns.

    ``timestamp_suffix`` (such as ``+00``) matches keys of a store that writes the
    zone into timestamp text.
    """
    assert_columns(df, list(hash_columns))
    parts = [
        key_text(
            F.col(c),
            timestamp_suffix if isinstance(df.schema[c].dataType, T.TimestampType) else "",
        )
        for c in hash_columns
    ]
    return df.select(md5_key(parts, separator).alias(name), "*")

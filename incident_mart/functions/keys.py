"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(value: Column, suffix: str = "") -> Column:
    """Text of one key part: NULL is empty, and only a value gets the suffix."""
    text = value.cast("string")
    if suffix:
        text = F.concat(text, F.lit(suffix))
    return F.coalesce(text, F.lit(""))


def md5_key(parts: list[Column], separator: str = "") -> Column:
    """MD5 of the joined texts, as 16 bytes.

    Without a separator ('ab','c') and ('a','bc') share a key; that is the published
    form. Pass a separator where old keys need not be matched.
    """
    joined = F.concat_ws(separator, *parts) if separator else F.concat(*parts)
    return F.unhex(F.md5(joined))

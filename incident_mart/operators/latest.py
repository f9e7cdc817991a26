"""Top row per group, and the join that follows it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_group(
    df: DataFrame, group: list[str], latest: str, tie_breakers: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """The row with the greatest ``latest`` of each group; NULL sorts last.

    ``tie_breakers`` (ascending) make the choice repeatable. The rank filter lets
    Spark cut every input partition to one row per group before the shuffle, so a
    group of any size sends at most one row per task.
    """
    rank = "__rank"
    order = [F.col(latest).desc(), *[F.col(c).asc() for c in tie_breakers]]
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col(rank) == 1).drop(rank)


def join_on_key(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_columns: list[str],
    right_columns: list[str],
    right_key: str | None = None,
) -> DataFrame:
    """Inner equi-join that keeps the named columns of each side.

    No hint: Spark broadcasts a side it has measured to be small, and otherwise
    shuffles both, splitting partitions a hot key makes too large.
    """
    condition = F.col(f"l.{key}") == F.col(f"r.{right_key or key}")
    return (
        left.alias("l")
        .join(right.alias("r"), condition, "inner")
        .select(*[F.col(f"l.{c}") for c in left_columns], *[F.col(f"r.{c}") for c in right_columns])
    )

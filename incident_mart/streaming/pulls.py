"""Pulls that could not be loaded: set aside with their reason, and loaded again later.

Every closed pull has one outcome, ``loaded`` or ``set aside``, in a folder of its own
under ``<root>/pulls/<feed>``. A load that is run again replaces the outcome of its pull.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.feeds import Layout, report_pages
from ..schemas import Feed
from ..sources.files import names_at

LOADED, SET_ASIDE = "loaded", "set aside"
_OUTCOME = "outcome string, reason string, rows_merged bigint"
#: Spark's names for errors that the data of a load cause.
_DATA_ERRORS = (
    "USER_RAISED_EXCEPTION",
    "CAST_INVALID_INPUT",
    "CAST_OVERFLOW",
    "ARITHMETIC_OVERFLOW",
    "MALFORMED_RECORD_IN_PARSING",
)
_REASON_CHARS = 2000


def is_data_error(error: Exception) -> bool:
    """Whether the data of a load is at fault, so that running it again would not help."""
    if isinstance(error, ValueError):
        return True
    if not isinstance(error, PySparkException | Py4JJavaError):
        return False
    return any(f"[{name}]" in str(error) or f"[{name}." in str(error) for name in _DATA_ERRORS)


def _folder(layout: Layout, feed: Feed) -> str:
    return f"{layout.root}/pulls/{feed.name}"


def _note(
    spark: SparkSession, layout: Layout, feed: Feed, pull: str, outcome: str, reason: str | None, rows: int
) -> None:
    told = spark.createDataFrame([(outcome, reason, rows)], _OUTCOME)
    told.coalesce(1).write.mode("overwrite").parquet(f"{_folder(layout, feed)}/pull={pull}")


def load_pull(
    feed: Feed,
    layout: Layout,
    pull: str,
    load_id: str,
    pages: DataFrame,
    load: Callable[[], int],
) -> str:
    """Run one pull's load and note what came of it.

    An error of the data sets the pull aside: nothing of it is merged, its report says
    which pages are bad, and the outcome holds the reason. Any other error is raised, as
    the pull may be whole.
    """
    spark = pages.sparkSession
    try:
        rows = load()
    except Exception as error:
        if not is_data_error(error):
            raise
        report_pages(pages, feed, layout, load_id)
        _note(spark, layout, feed, pull, SET_ASIDE, str(error)[:_REASON_CHARS], 0)
        return SET_ASIDE
    _note(spark, layout, feed, pull, LOADED, None, rows)
    return LOADED


def pull_outcomes(spark: SparkSession, feed: Feed, root: str) -> DataFrame:
    """``pull, outcome, reason, rows_merged`` of every pull noted so far."""
    folder = _folder(Layout(root), feed)
    schema = f"{_OUTCOME}, pull string"
    if not names_at(spark, f"{folder}/pull=*/_SUCCESS"):
        return spark.createDataFrame([], schema).select("pull", "outcome", "reason", "rows_merged")
    return spark.read.schema(schema).parquet(folder).select("pull", "outcome", "reason", "rows_merged")


def set_aside_pulls(spark: SparkSession, feed: Feed, root: str) -> list[str]:
    """Names of the pulls that wait to be mended."""
    waiting = pull_outcomes(spark, feed, root).filter(F.col("outcome") == SET_ASIDE)
    return sorted(row.pull for row in waiting.select("pull").collect())

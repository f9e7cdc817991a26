"""Landed JSON pages. Every field is read as text; the cleaning step gives types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from ..functions.coercion import strict_int
from ..schemas import BROKEN, PAGE

_CORRUPT = "_corrupt_record"
#: The last number before the file extension: ``page-000012.json.gz`` is page 12.
FILE_PAGE = r"([0-9]+)\.[A-Za-z.]+$"


def _text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _page_schema(columns: list[str], page_from: str) -> T.StructType:
    schema = _text_schema(columns).add(_CORRUPT, T.StringType())
    return schema.add(PAGE, T.LongType()) if page_from == "directory" else schema


def numbered(page: Column) -> Column:
    """The page number; a row without one cannot be placed and fails the job."""
    return F.coalesce(page, F.raise_error(F.lit("a row has no page number")).cast("bigint"))


def _as_page_frame(df: DataFrame, columns: list[str], page_from: str, pattern: str) -> DataFrame:
    page = F.col(PAGE)
    if page_from == "file_name":
        page = strict_int(F.regexp_extract(F.col("_metadata.file_name"), pattern, 1))
    # The check sits beside the page number, so that filters on pages still prune files.
    broken = F.when(numbered(page).isNotNull(), F.col(_CORRUPT).isNotNull())
    return df.select(page.alias(PAGE), *columns, broken.alias(BROKEN))


def read_json_pages(
    spark: SparkSession,
    path: str,
    columns: list[str],
    page_from: str = "directory",
    layout: str = "lines",
    pattern: str = FILE_PAGE,
) -> DataFrame:
    """``(page_no, columns..., body_broken)`` of all landed pages.

    ``page_from``: ``directory`` reads ``page_no=N`` folders, so page filters prune
    files; ``file_name`` reads the number off the file name.
    ``layout``: ``lines`` has one record a line and splits; ``array`` has one JSON
    array a file, which one task must read.
    """
    reader = spark.read.schema(_page_schema(columns, page_from))
    df = reader.option("multiLine", layout == "array").json(path)
    return _as_page_frame(df, columns, page_from, pattern)


def bounded_log(
    reader: DataStreamReader, archive: str | None, max_file_age: str | None = None
) -> DataStreamReader:
    """Keeps what a stream of files must remember and list from growing for ever.

    ``archive`` is a folder, outside of the landing one, to which files move once a batch
    after theirs is done, so that they are listed no more. ``max_file_age`` (``"30d"``)
    is how far behind the newest file a file may land; older names are forgotten.
    """
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.option("maxFileAge", max_file_age) if max_file_age else reader


def read_json_stream(
    spark: SparkSession,
    path: str,
    columns: list[str],
    page_from: str = "directory",
    layout: str = "lines",
    pattern: str = FILE_PAGE,
    max_files: int | None = None,
    archive: str | None = None,
    max_file_age: str | None = None,
) -> DataFrame:
    """``read_json_pages`` as a stream of newly landed files; see ``bounded_log``."""
    reader = spark.readStream.schema(_page_schema(columns, page_from))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    reader = bounded_log(reader, archive, max_file_age)
    df = reader.option("multiLine", layout == "array").json(path)
    return _as_page_frame(df, columns, page_from, pattern)


def sent_fields(df: DataFrame, text: str, columns: list[str], page: str = PAGE) -> DataFrame:
    """``(page_no, field)``: the columns that some record of a page names, be its value null.

    ``text`` holds a record, or an array of records, as JSON. A page's other columns are
    absent from it, which a frame of values cannot tell from null.
    """
    is_list = F.ltrim(text, F.lit(" \t\r\n")).startswith("[")
    records = F.when(is_list, F.from_json(F.col(text), T.ArrayType(T.StringType())))
    each = F.explode(F.coalesce(records, F.array(F.col(text))))
    one_each = df.select(F.col(page).alias(PAGE), each.alias("__record"))
    named = one_each.select(PAGE, F.json_object_keys("__record").alias("__named"))
    wanted = F.array_intersect("__named", F.array(*[F.lit(c) for c in columns]))
    return named.select(PAGE, F.explode(wanted).alias("field")).distinct()


def read_sent_fields(
    spark: SparkSession,
    path: str,
    columns: list[str],
    page_from: str = "directory",
    layout: str = "lines",
    pattern: str = FILE_PAGE,
) -> DataFrame:
    """``sent_fields`` of landed pages; the arguments are those of ``read_json_pages``."""
    schema = _text_schema(["value"])
    if page_from == "directory":
        schema = schema.add(PAGE, T.LongType())
    df = spark.read.schema(schema).text(path, wholetext=layout == "array")
    if page_from == "file_name":
        page = strict_int(F.regexp_extract(F.col("_metadata.file_name"), pattern, 1))
        df = df.select(page.alias(PAGE), "value")
    return sent_fields(df, "value", columns)


def write_json_pages(
    df: DataFrame, path: str, page: str = PAGE, compression: str = "none"
) -> None:
    """Land rows as ``page_no=N`` folders of JSON lines.

    Rows are first gathered by page into files of an even size: small pages share no
    folder with others, and a page that holds much of the data gets several files. That
    is why they may be compressed: ``"gzip"`` takes a tenth of the space, and though one
    task reads such a file, none grows with its page.
    """
    gathered = df.hint("rebalance", page).write.mode("append").partitionBy(page)
    gathered.option("compression", compression).json(path)


def explode_bodies(df: DataFrame, body: str, columns: list[str], page: str = PAGE) -> DataFrame:
    """Pages held as one JSON text per row: one output row per record.

    A body that is no array of records gives a single row of NULLs marked as broken. An
    empty array is the page after the last one and gives no row.
    """
    blank = F.lit(" \t\r\n")
    is_list = F.ltrim(body, blank).startswith("[") & F.rtrim(body, blank).endswith("]")
    records = F.from_json(F.col(body), T.ArrayType(_text_schema(columns)))
    parsed = df.select(F.col(page).alias(PAGE), F.when(is_list, records).alias("__records"))
    broken = F.col("__records").isNull()
    full = parsed.filter(broken | (F.size("__records") > 0))
    return full.select(PAGE, broken.alias(BROKEN), F.inline_outer("__records")).select(
        PAGE, *columns, BROKEN
    )

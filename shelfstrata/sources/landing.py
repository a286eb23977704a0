"""Landed CSV files and the lineage of what is read from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from shelfstrata.functions.columns import named

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}

#: Rows of a file that ``write_csv`` writes at most, as one task reads a whole file.
ROWS_PER_FILE = 250_000


def read_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV with a header, quoted fields, doubled quotes and line breaks inside fields.

    All columns are text: types are given in silver, and identifiers such as ``007`` keep their
    zeros. Each file is read by one task, as a line break may be inside a field; a large
    source lands as many files.
    """
    return (
        spark.read.options(**CSV_OPTIONS)
        .option("multiLine", True)
        .option("enforceSchema", False)
        .csv(path if isinstance(path, str) else list(path))
    )


def read_csv_checked(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The records of CSV files with as many fields as ``columns``, and the others.

    A record with surplus or missing fields, or with a quote that nothing closes, which takes the rest of its file, is
    bad. Bad rows have ``_file``, ``_line`` (where the record begins in its file; empty lines are not counted), ``_reason``
    (``surplus_fields``, ``missing_fields`` or ``open_quote``) and ``_record``, its text. Good rows have the columns alone. Both
    read the files on their own; lines are counted only in files that hold a bad row, each of which one task reads anyway.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_record"]])
    rows = (
        spark.read.options(**CSV_OPTIONS)
        .option("header", header)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_record")
        .schema(schema)
        .csv(path if isinstance(path, str) else list(path))
    )
    # The reader demands that a column is named besides the record; it holds for every row.
    known = F.coalesce(F.length(named(columns[0])), F.lit(0)) >= 0
    good = rows.filter(F.col("_record").isNull() & known).select(*[named(c) for c in columns])
    numbered = rows.select(
        _decoded(F.col("_metadata.file_path")).alias("_file"),
        F.monotonically_increasing_id().alias("_number"),
        _lines(rows, columns).alias("_lines"),
        "_record",
    )
    # So does this: every record has a line.
    held = numbered.filter("_record is not null and _lines > 0").select("_file").distinct()
    before = Window.partitionBy("_file").orderBy("_number").rowsBetween(Window.unboundedPreceding, -1)
    line = F.coalesce(F.sum("_lines").over(before), F.lit(0)) + (2 if header else 1)
    placed = numbered.join(held, "_file", "left_semi").withColumn("_line", line)
    bad = placed.filter("_record is not null and _lines > 0").select(
        "_file", "_line", _reason(F.col("_record"), len(columns)).alias("_reason"), "_record"
    )
    return good, bad


def _lines(rows: DataFrame, columns: Sequence[str]) -> Column:
    """How many lines a record takes: line breaks in it, and its end."""
    inside = lambda text: F.coalesce(F.regexp_count(text, F.lit("\r\n|\r|\n")), F.lit(0))
    whole = reduce(lambda total, c: total + inside(named(c)), columns, F.lit(1))
    text = F.regexp_replace("_record", "(\r\n|\r|\n)$", "")
    return F.when(F.col("_record").isNull(), whole).otherwise(inside(text) + 1)


def _reason(record: Column, fields: int) -> Column:
    """Why a record is bad: quoted parts are cut out of it, and commas counted in the rest."""
    rest = F.regexp_replace(record, '"[^"]*"', "")
    commas = F.length(rest) - F.length(F.replace(rest, F.lit(",")))
    return (
        F.when(F.contains(rest, F.lit('"')), F.lit("open_quote"))
        .when(commas >= fields, F.lit("surplus_fields"))
        .otherwise(F.lit("missing_fields"))
    )


def write_csv(df: DataFrame, path: str, compression: str = "none") -> str:
    """Write CSV that ``read_csv`` reads back. NULL and empty text both become empty fields, and are
    read back as NULL. A task writes several files if it has many rows: they are read whole, and packed into tasks
    of even size. ``compression`` is a codec of Spark's CSV source; the reader tells it by the names of the files, and as a task reads
    whole files anyway, compressed ones are read by as many tasks."""
    # Unlike the reader, the writer trims values unless told not to.
    whole = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    whole |= {"maxRecordsPerFile": ROWS_PER_FILE, "compression": compression}
    df.write.mode("overwrite").options(**CSV_OPTIONS, **whole).csv(path)
    return path


def with_lineage(
    df: DataFrame, source_name: str, at: datetime | None = None, path: Column | None = None
) -> DataFrame:
    """Add source name, file name and path, and the instant and date of ingestion as ISO text.

    ``df`` must come straight from files, unless ``path`` gives the column to take: the path of each row is taken from the file it was read
    from, so folders and patterns of many files keep their lineage. In a stream the instant is that
    of each batch.
    """
    if df.isStreaming and at is None:
        instant = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        day = F.date_format(F.current_timestamp(), "yyyy-MM-dd")
    else:
        at = at or datetime.now(tz=timezone.utc)
        instant, day = F.lit(at.isoformat()), F.lit(at.date().isoformat())
    path = _decoded(F.col("_metadata.file_path") if path is None else path)
    return df.select(
        "*",
        F.lit(source_name).alias("_bronze_source_name"),
        F.substring_index(path, "/", -1).alias("_bronze_source_file"),
        path.alias("_bronze_source_path"),
        instant.alias("_bronze_ingested_at"),
        day.alias("_bronze_ingestion_date"),
    )


def _decoded(path: Column) -> Column:
    """Most paths hold nothing to decode, which is much cheaper to see than to decode for each row."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(path, F.lit("%")), decoded).otherwise(path)

"""Table reads, writes that count their rows, catalog registration and reconciliation."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

T = TypeVar("T")


def read_table(spark: SparkSession, base: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A table stored as a folder ``base/table``, or as the single file Spark finds in it."""
    return spark.read.format(fmt).load(table_path(base, table))


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> int:
    """Write and return the number of rows written, counted by the write itself.

    ``fmt`` may be any installed format; for Delta pass ``{"overwriteSchema": "true"}``. Overwriting
    replaces the whole table, also a partitioned one, whatever the session's setting: a partition without
    rows goes (``overwrite_partitions`` is the way to keep the others).
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    given = {"partitionOverwriteMode": "static"} | dict(options or {})
    writer = counted.write.format(fmt).mode(mode).options(**given)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return seen.get["rows"]


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], T]], ways: int = 4) -> list[T]:
    """Results of independent jobs, in their order, ``ways`` of them running at a time.

    One after the other, the cores that the last tasks of a job leave idle wait for the next job, which tells where
    tables have few tasks or tasks differ in size. The first error is raised once what has started is done.
    """
    run = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=ways) as pool:
        started = [pool.submit(run(job)) for job in jobs]
        try:
            return [job.result() for job in started]
        finally:
            for job in started:
                job.cancel()


def write_report(report: DataFrame, path: str) -> str:
    """Write a report, one row per check or source, as CSV with a header."""
    report.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def reconcile(spark: SparkSession, source_rows: int, path: str, fmt: str = "parquet") -> DataFrame:
    """Compare the rows of a source with the rows found where they were written."""
    target = spark.read.format(fmt).load(path)
    return target.agg(
        F.lit(source_rows).cast("bigint").alias("source_rows"),
        F.count(F.lit(1)).alias("target_rows"),
    ).select("*", (F.col("source_rows") == F.col("target_rows")).alias("ok"))


def register_tables(
    spark: SparkSession,
    schema: str,
    base: str,
    tables: Iterable[str],
    fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """Create a catalog schema and a table over each folder ``base/table``. Nothing is copied."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{place}")
    for table in tables:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {schema}.{table} USING {fmt} "
            f"LOCATION '{table_path(base, table)}'"
        )


def registered_row_counts(spark: SparkSession, schema: str) -> DataFrame:
    """Row count of every table of a catalog schema, ordered by table name."""
    names = sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)
    if not names:
        raise ValueError(f"No tables registered in {schema}")
    counts = [
        spark.table(f"{schema}.{name}").agg(
            F.lit(schema).alias("schema_name"),
            F.lit(name).alias("table_name"),
            F.lit(f"{schema}.{name}").alias("registered_table_name"),
            F.count(F.lit(1)).alias("row_count"),
        )
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def preview(spark: SparkSession, schema: str, table: str, rows: int = 10) -> DataFrame:
    return spark.table(f"{schema}.{table}").limit(rows)


def describe(spark: SparkSession, schema: str, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {schema}.{table}")


def save_models(models: Mapping[str, DataFrame], schema: str, base: str, fmt: str = "parquet") -> None:
    """Store gold models as tables of a catalog schema, with their files under ``base``."""
    for name, model in models.items():
        model.write.format(fmt).mode("overwrite").option("path", table_path(base, name)).saveAsTable(
            f"{schema}.{name}"
        )


def save_bucketed(
    df: DataFrame, table: str, path: str, key: str, buckets: int, fmt: str = "parquet"
) -> None:
    """Store a catalog table in buckets of a key, sorted by it.

    Tables with as many buckets of the key they are joined by, such as order headers and order lines by
    ``order_id``, join without a shuffle. Rows are shuffled by the key once, here, into one file per
    bucket. A key with very many rows makes one large bucket; leave such tables unbucketed.
    """
    (
        df.repartition(buckets, F.col(key))
        .write.format(fmt)
        .mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )


def create_views(models: Mapping[str, DataFrame]) -> None:
    """Make staging and intermediate models visible to SQL under their names."""
    for name, model in models.items():
        model.createOrReplaceTempView(name)

"""Incremental silver: upserts, freshness, schema drift."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfstrata.functions.columns import named
from shelfstrata.operators.dedup import keep_latest


def upsert(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], recency: Sequence[str] = ()
) -> DataFrame:
    """``current`` with rows replaced or added by the newest change of each key.

    A change always wins over the current row. Rows of NULL keys are never matched: those of
    ``current`` stay.
    """
    newest = keep_latest(changes, keys, recency)
    replaced = newest.select(*[named(k) for k in keys])
    return current.join(replaced, list(keys), "left_anti").unionByName(newest)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` has rows for."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def freshness(df: DataFrame, column: str, as_of: datetime, max_age_hours: float) -> DataFrame:
    """One row: newest value, its age in hours at ``as_of``, and whether that is fresh enough."""
    newest = df.agg(F.max(named(column).cast("timestamp")).alias("newest"))
    # As text, a time without zone is one of the session's zone, as that of the column is.
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp")
    age = (F.unix_micros(now) - F.unix_micros("newest")) / 3_600_000_000
    return newest.select("newest", age.alias("age_hours")).select(
        "*", F.coalesce(F.col("age_hours") <= max_age_hours, F.lit(False)).alias("is_fresh")
    )


def schema_drift(spark: SparkSession, df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per column that is missing, not expected, or of another type. Reads no data."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = [(c, "missing", kind, None) for c, kind in wanted.items() if c not in found]
    rows += [(c, "unexpected", None, kind) for c, kind in found.items() if c not in wanted]
    rows += [
        (c, "type", wanted[c], found[c]) for c in wanted if c in found and wanted[c] != found[c]
    ]
    return spark.createDataFrame(
        rows, "column_name string, issue string, expected_type string, found_type string"
    )

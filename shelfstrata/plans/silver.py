"""Bronze to silver: conform, keep one row per key, stamp."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from shelfstrata.operators.conform import conform, stamp_silver
from shelfstrata.operators.dedup import keep_latest
from shelfstrata.schemas import ENTITIES
from shelfstrata.sources.tables import read_table, side_by_side, table_path, write_table


def to_silver(bronze: DataFrame, entity: str, counted: str | None = None) -> DataFrame:
    """The silver table of one entity; ``counted`` is that of ``keep_latest``."""
    if entity not in ENTITIES:
        raise ValueError(f"No silver schema for table: {entity}")
    declared = ENTITIES[entity]
    conformed = conform(bronze, declared.schema)
    return stamp_silver(keep_latest(conformed, declared.key, declared.recency, counted))


@dataclass(frozen=True)
class Transformed:
    """What one silver transformation wrote."""

    table_name: str
    silver_path: str
    row_count: int
    column_count: int


def transform(
    spark: SparkSession,
    entity: str,
    bronze_base: str,
    silver_base: str,
    bronze_fmt: str = "parquet",
    silver_fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> Transformed:
    """Read one bronze table and overwrite its silver table; rows are counted by the write."""
    silver = to_silver(read_table(spark, bronze_base, entity, bronze_fmt), entity)
    path = table_path(silver_base, entity)
    rows = write_table(silver, path, silver_fmt, options=options)
    return Transformed(entity, path, rows, len(silver.columns))


def transform_all(
    spark: SparkSession, bronze_base: str, silver_base: str, **formats
) -> list[Transformed]:
    """Every entity, some side by side; ``formats`` are those of ``transform``, and its options."""
    return side_by_side(
        spark, [partial(transform, spark, e, bronze_base, silver_base, **formats) for e in ENTITIES]
    )

"""Landing to bronze: one table per source and an audit row for each."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from shelfstrata.sources.landing import read_csv, with_lineage
from shelfstrata.sources.tables import side_by_side, table_path, write_table

# The landed file of each source.
SOURCE_FILES = {
    "customers": "customers.csv",
    "stores": "stores.csv",
    "products": "products.csv",
    "orders": "orders.csv",
    "order_items": "order_items.csv",
    "inventory_snapshots": "inventory_snapshots.csv",
    "promotions": "promotions.csv",
}

# The columns of the audit, in their order; the fields of Ingested.
AUDIT_SCHEMA = (
    "source_name string, source_path string, bronze_path string, row_count bigint, "
    "column_count int, ingestion_datetime string"
)


@dataclass(frozen=True)
class Ingested:
    """What one ingestion did."""

    source_name: str
    source_path: str
    bronze_path: str
    row_count: int
    column_count: int
    ingestion_datetime: str


def ingest(
    spark: SparkSession,
    name: str,
    path: str,
    bronze_base: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> Ingested:
    """Read one landed source, add lineage, write its bronze table with the ``options`` of the format; rows are counted on the way."""
    at = datetime.now(tz=timezone.utc)
    bronze = with_lineage(read_csv(spark, path), name, at)
    target = table_path(bronze_base, name)
    rows = write_table(bronze, target, fmt, options=options)
    return Ingested(name, path, target, rows, len(bronze.columns), at.isoformat())


def ingest_all(
    spark: SparkSession,
    landing_base: str,
    bronze_base: str,
    sources: Mapping[str, str] = SOURCE_FILES,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Ingest every source, some side by side; the audit has one row per source, in the order given."""
    jobs = [
        partial(ingest, spark, name, table_path(landing_base, file), bronze_base, fmt, options)
        for name, file in sources.items()
    ]
    done = side_by_side(spark, jobs)
    return spark.createDataFrame([asdict(d) for d in done], AUDIT_SCHEMA)

"""The quarantine store: failing rows per table, run, rule and column."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfstrata.operators.conform import stamp_silver
from shelfstrata.operators.quarantine import tag
from shelfstrata.schemas import ENTITIES
from shelfstrata.sources.tables import write_table

_PARTITIONS = ("_quarantine_rule_name", "_quarantine_column_name")


def quarantine_path(base: str, table: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/silver/{table}/run_id={run_id}"


def write_quarantine(quarantined: DataFrame, base: str, table: str, run_id: str) -> int:
    """Store the failing rows of one table, a folder for each rule and column that failed.

    A run has its own folder: a rule that passes leaves nothing there, and a run done again
    replaces what it wrote. Rows are rebalanced first, which splits a rule that very many rows
    break over several files and keeps rules that few break from leaving a file per task.
    """
    balanced = quarantined.withColumns(
        {name: F.replace(name, F.lit("."), F.lit("_")) for name in _PARTITIONS}
    ).hint("rebalance", *_PARTITIONS)
    return write_table(balanced, quarantine_path(base, table, run_id), partition_by=_PARTITIONS)


def read_quarantine(spark: SparkSession, base: str, table: str, run_id: str) -> DataFrame:
    """The failing rows of a table and run; none, with the columns of its silver table, if it was clean.

    A partitioned write of no rows leaves no file to take the columns from.
    """
    try:
        return spark.read.parquet(quarantine_path(base, table, run_id))
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
    silver = stamp_silver(spark.createDataFrame([], ENTITIES[table].schema))
    return tag(silver, table, "", "", "")


def read_runs(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The failing rows of a table over all runs that left any, with ``run_id``."""
    runs = spark.read.option("mergeSchema", True).parquet(f"{base.rstrip('/')}/silver/{table}")
    return runs.withColumn("run_id", F.col("run_id").cast("string"))

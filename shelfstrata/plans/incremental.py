"""Silver kept up to date from the files that are new, rewriting only the partitions they touch.

A silver table is stored in partitions by the hash of its key. ``state`` records, in one file per run, the
files a run took and where each partition lies now; a partition no run has touched lies nowhere. A run writes its
partitions into a folder of its own and its record last, so one that is lost leaves nothing that is read, and
runs again under the same number.

Keeping the newest row of a key does not depend on the order of deliveries, so what is stored and what is new,
merged, equals a rebuild from all files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfstrata.functions.columns import named
from shelfstrata.operators.conform import conform
from shelfstrata.operators.dedup import keep_latest
from shelfstrata.schemas import ENTITIES
from shelfstrata.sources.landing import read_csv

_FILE = "path string, modified timestamp, bytes bigint"
_STATE = f"run int, {_FILE}, part int, stored_by int"


@dataclass(frozen=True)
class Merged:
    """What one incremental run did."""

    table_name: str
    run: int
    files_taken: int
    partitions_rewritten: int


def found_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """The files under a folder with time and size. Their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return files.load(folder).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def read_state(spark: SparkSession, base: str, entity: str) -> DataFrame:
    try:
        return spark.read.schema(_STATE).parquet(f"{base}/{entity}/state")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _STATE)


def new_files(files: DataFrame, state: DataFrame) -> DataFrame:
    """The files no run has taken; one that was replaced since is new again."""
    return files.join(state.filter("path is not null"), ["path", "modified", "bytes"], "left_anti")


def _partition(keys: Sequence[str], partitions: int):
    return F.pmod(F.xxhash64(*[named(k) for k in keys]), F.lit(partitions)).cast("int")


def _stored(spark: SparkSession, base: str, entity: str, placed: dict[int, int]) -> DataFrame:
    """The rows of some partitions, given the run that stored each."""
    empty = spark.createDataFrame([], ENTITIES[entity].schema)
    if not placed:
        return empty
    paths = [f"{base}/{entity}/data/run={run}/part={part}" for part, run in sorted(placed.items())]
    # A partition is read by its own path: others are not even listed.
    return spark.read.schema(empty.schema).parquet(*paths)


def read_silver(spark: SparkSession, base: str, entity: str) -> DataFrame:
    """The silver table as the last run left it, without the silver metadata."""
    return _stored(spark, base, entity, _places(read_state(spark, base, entity)))


def _places(state: DataFrame) -> dict[int, int]:
    """Per partition the run that stored it last: at most a row for each partition."""
    last = state.filter("part is not null").groupBy("part").agg(F.max("stored_by").alias("run"))
    return {r.part: r.run for r in last.collect()}


def merge_new(spark: SparkSession, entity: str, landing: str, base: str, partitions: int = 64) -> Merged:
    """Take the landed files of an entity that are new into its silver table under ``base``.

    The names of the new files and the numbers of the touched partitions come to the driver, rows do not. The number of
    partitions must stay the same between runs; a table of ``n`` bytes wants about ``n`` / 256 MB of them.
    """
    state = read_state(spark, base, entity)
    known = state.agg(F.max("run").alias("run")).first().run
    run = 0 if known is None else known + 1
    taken = new_files(found_files(spark, landing), state).collect()
    if not taken:
        return Merged(entity, run, 0, 0)
    declared = ENTITIES[entity]
    changes = conform(read_csv(spark, [f.path for f in taken]), declared.schema)
    part = _partition(declared.key, partitions)
    newest = keep_latest(changes, declared.key, declared.recency).withColumn("part", part)
    staged = f"{base}/{entity}/new/run={run}"
    newest.write.mode("overwrite").parquet(staged)
    newest = spark.read.schema(newest.schema).parquet(staged)
    touched = sorted(r.part for r in newest.select("part").distinct().collect())
    places = _places(state)
    stored = _stored(spark, base, entity, {p: places[p] for p in touched if p in places})
    merged = keep_latest(stored.unionByName(newest.drop("part")), declared.key, declared.recency).withColumn("part", part)
    (
        merged.hint("rebalance", "part").write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("part").parquet(f"{base}/{entity}/data/run={run}")
    )
    record = [(run, f.path, f.modified, f.bytes, None, None) for f in taken]
    record += [(run, None, None, None, p, run) for p in touched]
    # One file, which is there or not.
    spark.createDataFrame(record, _STATE).coalesce(1).write.mode("append").parquet(f"{base}/{entity}/state")
    return Merged(entity, run, len(taken), len(touched))

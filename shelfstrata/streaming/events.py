"""Streaming twins of ingestion, deduplication, volume counts and validation.

Every query takes its checkpoint folder from the caller and stops when it has read all that is
there (``availableNow``), so it can run on a schedule or be restarted after a loss. State of many
keys belongs in RocksDB (``spark.sql.streaming.stateStore.providerClass``), which is the session's choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shelfstrata.functions.columns import named
from shelfstrata.operators.quarantine import flag
from shelfstrata.operators.rules import Contract
from shelfstrata.sources.landing import with_lineage


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Stream of the files of a folder, old and new, with a declared schema."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def bronze_stream(files: DataFrame, source_name: str) -> DataFrame:
    """Streamed rows with the bronze lineage columns."""
    return with_lineage(files, source_name)


def with_event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """Give a stream its watermark; local timestamps, which cannot carry one, are cast first."""
    return stream.withColumn(column, named(column).cast("timestamp")).withWatermark(column, delay)


def drop_duplicates(
    stream: DataFrame,
    keys: Sequence[str],
    event_time: str,
    delay: str,
    spread_by: Column | None = None,
    ways: int = 32,
) -> DataFrame:
    """Pass one row per key among those that arrive within ``delay`` of each other in event time.

    If one key may come in very many copies, give ``spread_by``, a column that differs between
    copies and is the same when a row is read again, such as a row number in its file or an offset.
    Copies are then dropped in ``ways`` groups first, so that at most that many rows of one key meet in
    one task.
    """
    timed = with_event_time(stream, event_time, delay)
    if spread_by is None:
        return timed.dropDuplicatesWithinWatermark(list(keys))
    group = F.pmod(F.xxhash64(spread_by), F.lit(ways)).alias("_group")
    grouped = timed.select("*", group)
    thinned = grouped.dropDuplicatesWithinWatermark([*keys, "_group"]).drop("_group")
    return thinned.dropDuplicatesWithinWatermark(list(keys))


def volume(
    stream: DataFrame, event_time: str, by: str, width: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Rows and value per tumbling window and ``by``. In append mode only closed windows come out:
    those that end at or before the watermark. Later rows of a closed window are dropped."""
    return (
        with_event_time(stream, event_time, delay)
        .groupBy(F.window(event_time, width), named(by))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            by,
            "rows",
        )
    )


def append_to(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append a stream to a file table, each row once, also after a restart."""
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def validate_to(
    stream: DataFrame, contract: Contract, path: str, checkpoint: str
) -> StreamingQuery:
    """Write each batch split into ``is_clean=true`` and ``is_clean=false`` rows.

    A batch that is run again after a loss replaces its own folder, so no row is doubled. Read the
    result with ``read_validated``.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        flagged = flag(batch, contract)
        (
            flagged.withColumn("is_clean", F.size("_broken_rules") == 0)
            .write.mode("overwrite")
            .partitionBy("is_clean")
            .parquet(f"{path}/batch_id={batch_id}")
        )

    return (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_validated(spark: SparkSession, path: str, clean: bool) -> DataFrame:
    """The clean rows, or the others with ``_broken_rules``, of all batches."""
    rows = spark.read.parquet(path).filter(F.col("is_clean") == clean)
    return rows.drop("is_clean", "batch_id", *(["_broken_rules"] if clean else []))

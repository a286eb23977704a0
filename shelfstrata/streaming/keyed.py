"""Streams whose rows are compared with rows of earlier batches: late and repeated rows, and uniqueness.

Each batch is settled by joins and groupings against a table of the keys still in reach, which the batch before it left, and
leaves one for the next. All that a batch writes lies in folders of its number, written anew if the batch runs again, and
the table it reads is of an earlier number, so a batch that runs again after a loss gives the same. A key
with very many rows is grouped before it is joined, and rows are told by their number, so that no task holds all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfstrata.functions.columns import named

PASSED, DUPLICATE, LATE = "passed", "duplicate", "late"


def _folder(path: str, kind: str, batch_id: int) -> str:
    return f"{path}/{kind}/batch_id={batch_id}"


def _write(df: DataFrame, path: str, kind: str, batch_id: int) -> DataFrame:
    folder = _folder(path, kind, batch_id)
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _earlier(spark: SparkSession, path: str, kind: str, batch_id: int) -> DataFrame | None:
    return spark.read.parquet(_folder(path, kind, batch_id - 1)) if batch_id else None


def _run(stream: DataFrame, settle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    query = stream.writeStream.foreachBatch(settle).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [named(k).eqNullSafe(F.col(f"_key.`{k}`")) for k in keys])


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[named(k) for k in keys]).alias("_key")


def _mark(df: DataFrame, delay: str, event_time: str, before: DataFrame | None) -> DataFrame:
    """One row: the watermark after a batch, which is ``delay`` behind the newest row so far."""
    newest = df.agg((F.max(event_time) - F.expr(f"interval {delay}")).alias("watermark"))
    both = newest if before is None else newest.unionByName(before)
    return both.agg(F.max("watermark").alias("watermark"))


def outcomes_to(
    stream: DataFrame, keys: Sequence[str], event_time: str, delay: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Write every row with its ``_outcome``: passed, duplicate or late. None is dropped.

    A row is late if its time is before the watermark that earlier batches have left; ``_lateness`` tells by how
    many seconds. Of the other rows of a key the first one passes (the oldest, ties by all columns), unless a row of the
    key that is not older than the watermark has passed before. NULL keys count as one key; rows without a time are never late.
    """

    def settle(batch: DataFrame, batch_id: int) -> None:
        spark, columns = batch.sparkSession, batch.columns
        timed = batch.withColumn(event_time, named(event_time).cast("timestamp"))
        rows = _write(timed.withColumn("_row", F.monotonically_increasing_id()), path, "rows", batch_id)
        mark, open_keys = (_earlier(spark, path, kind, batch_id) for kind in ("watermark", "keys"))
        watermark = F.lit(None).cast("timestamp") if mark is None else mark.select("watermark").scalar()
        time = F.col(event_time)
        is_late = F.coalesce(time < watermark, F.lit(False))
        order = F.struct(time, *[named(c) for c in columns if c != event_time], F.col("_row"))
        firsts = rows.filter(~is_late).groupBy(_key(keys)).agg(F.min(order).alias("first"))
        firsts = firsts.select("_key", F.col(f"first.`{event_time}`").alias("_time"), "first._row")
        if open_keys is not None:
            held = open_keys.select(F.col("_key").alias("_held"))
            firsts = firsts.join(held, reduce(lambda a, b: a & b, [F.col(f"_key.`{k}`").eqNullSafe(F.col(f"_held.`{k}`")) for k in keys]), "left_anti")
        passed = _write(firsts, path, "first", batch_id)
        lateness = (F.unix_micros(watermark) - F.unix_micros(time)) / 1e6
        told = rows.join(passed.select("_row", F.lit(True).alias("_first")), "_row", "left").select(
            *[named(c) for c in columns],
            F.when(is_late, LATE).when(F.col("_first"), PASSED).otherwise(DUPLICATE).alias("_outcome"),
            F.when(is_late, lateness).alias("_lateness"),
        )
        _write(told, path, "outcomes", batch_id)
        after = _write(_mark(rows, delay, event_time, mark), path, "watermark", batch_id)
        known = passed.select("_key", "_time")
        known = known if open_keys is None else known.unionByName(open_keys)
        # Without a watermark, or a time, a key stays in reach.
        limit = after.select("watermark").scalar()
        _write(known.filter(F.coalesce(F.col("_time") >= limit, F.lit(True))), path, "keys", batch_id)

    return _run(stream, settle, checkpoint)


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """All rows of all batches with ``_outcome`` and ``_lateness``."""
    return spark.read.parquet(f"{path}/outcomes").drop("batch_id")


def duplicates_to(
    stream: DataFrame, keys: Sequence[str], event_time: str, horizon: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Write the rows that break uniqueness of ``keys``: all rows of each key that comes more than once.

    The first row of a key is kept until ``horizon`` after the newest row of the key, and written once a second one has come.
    So over keys that come again within the horizon the result is that of the batch rule. NULL in a key breaks no rule.
    """

    def settle(batch: DataFrame, batch_id: int) -> None:
        spark, columns = batch.sparkSession, batch.columns
        present = reduce(lambda a, b: a & b, [named(k).isNotNull() for k in keys])
        timed = batch.withColumn(event_time, named(event_time).cast("timestamp"))
        rows = _write(timed, path, "rows", batch_id)
        mark, held = (_earlier(spark, path, kind, batch_id) for kind in ("watermark", "keys"))
        order = F.struct(named(event_time), *[named(c) for c in columns if c != event_time])
        found = rows.filter(present).groupBy(_key(keys)).agg(
            F.count(F.lit(1)).alias("_rows"), F.min(order).alias("_first"), F.max(event_time).alias("_newest")
        )
        if held is None:
            held = spark.createDataFrame([], found.select("_key", "_first", "_newest", F.lit(True).alias("_told")).schema)
        old = held.select(F.col("_key").alias("_old"), F.col("_first").alias("_old_first"), F.col("_newest").alias("_old_newest"), "_told")
        same = reduce(lambda a, b: a & b, [F.col(f"_key.`{k}`") == F.col(f"_old.`{k}`") for k in keys])
        known = _write(found.join(old, same, "full"), path, "known", batch_id)
        came, was = F.col("_key").isNotNull(), F.col("_old").isNotNull()
        again = known.filter(came & (was | (F.col("_rows") > 1))).select("_key")
        # Keys that came again are one row each; a key with very many rows is on the side that can be split.
        repeated = rows.filter(present).join(again, _same(keys), "left_semi").select(*[named(c) for c in columns])
        firsts = known.filter(came & was & ~F.col("_told"))
        firsts = firsts.select(*[F.col(f"_old_first.`{c}`").alias(c) for c in columns])
        _write(repeated.unionByName(firsts), path, "duplicates", batch_id)
        after = _write(_mark(rows, horizon, event_time, mark), path, "watermark", batch_id)
        kept = known.select(
            F.coalesce("_key", "_old").alias("_key"),
            F.coalesce("_old_first", "_first").alias("_first"),
            F.greatest("_newest", "_old_newest").alias("_newest"),
            (F.coalesce("_told", F.lit(False)) | (came & was) | F.coalesce(F.col("_rows") > 1, F.lit(False))).alias("_told"),
        )
        limit = after.select("watermark").scalar()
        _write(kept.filter(F.coalesce(F.col("_newest") >= limit, F.lit(True))), path, "keys", batch_id)

    return _run(stream, settle, checkpoint)


def read_duplicates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/duplicates").drop("batch_id")


def orphans(
    children: DataFrame,
    parents: DataFrame,
    child_key: str,
    parent_key: str,
    child_time: str,
    parent_time: str,
    within: str,
    delay: str,
    spread_by: Column | None = None,
    ways: int = 32,
) -> DataFrame:
    """The streamed child rows whose parent can no longer come.

    A parent counts if its time is at most ``within`` before or after the child's. A child without one is told when the
    watermarks of both streams, ``delay`` behind their newest rows, have passed the time up to which it could come. NULL keys have
    no parent to miss. If one parent may have very many children, give ``spread_by``, a column that differs between them: they are dealt
    out in ``ways`` groups, and each parent is repeated for every group.
    """
    number = F.lit(0) if spread_by is None else F.pmod(F.xxhash64(spread_by), F.lit(ways)).cast("int")
    group = F.lit(0) if spread_by is None else F.explode(F.sequence(F.lit(0), F.lit(ways - 1)))
    left = (
        children.withColumn(child_time, named(child_time).cast("timestamp"))
        .filter(named(child_key).isNotNull())
        .withColumn("_number", number)
        .withWatermark(child_time, delay)
    )
    right = parents.select(
        named(parent_key).alias("_parent"), named(parent_time).cast("timestamp").alias("_parent_time"), group.alias("_group")
    ).withWatermark("_parent_time", delay)
    near = F.expr(
        f"_parent_time >= `{child_time}` - interval {within} and _parent_time <= `{child_time}` + interval {within}"
    )
    matches = (named(child_key) == F.col("_parent")) & (F.col("_number") == F.col("_group")) & near
    joined = left.join(right, matches, "left_outer")
    return joined.filter(F.col("_parent").isNull()).drop("_parent", "_parent_time", "_group", "_number")

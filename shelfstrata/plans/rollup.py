"""Daily figures kept as states that add up, so that weeks and months need no facts.

Distinct orders, customers and products of a week are not the sum of its days. Each identifier gets a number once, in a
dictionary that only grows, and a day keeps the numbers it saw as bitmaps of 32,768 numbers each. Bitmaps of days are
merged by *or*, which is exact. Numbers are given in the order of the first day, so what a day sees first lies together;
a bitmap is stored whole, 4 KB before compression, also for few numbers.

Under a folder, each with a part per run: ``dictionary`` (kind, id, number), ``ids`` (bitmaps), ``amounts`` (sums), and
``days``, which tells the days a run brought up to date and is written last. The last run of a day holds its states, so
a run that is lost leaves nothing that is read, and runs again under the same number. One update runs at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfstrata.functions.columns import exact_parts, exact_total

#: What is counted, by the column of the facts that identifies it.
COUNTED = {"total_orders": "order_id", "unique_customers": "customer_id", "unique_products_sold": "product_id"}
_DICTIONARY = "kind string, id string, number bigint, run int"
_DAYS = "order_date date, run int"


def seen_ids(sales: DataFrame) -> DataFrame:
    """Each identifier once per day and channel. A missing identifier is not counted."""
    ids = [F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("id")) for kind, c in COUNTED.items()]
    return sales.select("order_date", "channel", F.inline(F.array(*ids))).filter("id is not null").distinct()


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_dictionary(spark: SparkSession, base: str, last_run: int) -> DataFrame:
    """The numbers given by runs up to ``last_run``."""
    return _read(spark, f"{base}/dictionary", _DICTIONARY).filter(F.col("run") <= last_run).drop("run")


def new_numbers(seen: DataFrame, dictionary: DataFrame, chunks: int = 16) -> DataFrame:
    """Numbers, without gaps behind those of the dictionary, for the identifiers it lacks.

    Identifiers are ranked within a chunk of their first day, behind what earlier chunks hold, so that no kind is one
    task; there is a row of totals per kind, day and chunk.
    """
    first = seen.groupBy("kind", "id").agg(F.min("order_date").alias("day")).join(dictionary, ["kind", "id"], "left_anti")
    first = first.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)))
    # A day that is not known comes first.
    earlier = Window.partitionBy("kind").orderBy("day", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = first.groupBy("kind", "day", "chunk").agg(F.count(F.lit(1)).alias("held"))
    starts = totals.select(
        F.col("kind").alias("_kind"), F.col("day").alias("_day"), F.col("chunk").alias("_chunk"),
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"),
    )
    inside = Window.partitionBy("kind", "day", "chunk").orderBy("id")
    placed = first.withColumn("at", F.row_number().over(inside))
    same = (F.col("kind") == F.col("_kind")) & F.col("day").eqNullSafe(F.col("_day")) & (F.col("chunk") == F.col("_chunk"))
    last = dictionary.groupBy("kind").agg(F.max("number").alias("last"))
    numbered = placed.join(starts, same).join(last, "kind", "left")
    number = F.coalesce("last", F.lit(0)) + F.col("start") + F.col("at")
    return numbered.select("kind", "id", number.cast("bigint").alias("number"))


def id_states(seen: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Per day, channel, kind and bucket of numbers, the bitmap of those seen.

    Rows are brought together by bucket first: a bucket has at most 32,768 of them, and no half-filled bitmaps are shuffled.
    """
    keys = ["order_date", "channel", "kind", "bucket"]
    numbered = seen.join(dictionary, ["kind", "id"]).select(
        "order_date", "channel", "kind",
        F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("place"),
    )
    return numbered.repartition(*keys).groupBy(*keys).agg(F.bitmap_construct_agg("place").alias("bitmap"))


def amount_states(sales: DataFrame) -> DataFrame:
    """Per day and channel: lines, units, and net revenue as its decimal and its other part."""
    decimals, others = exact_parts(F.col("net_amount"))
    return sales.groupBy("order_date", "channel").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units"),
        F.sum(decimals).alias("net_decimals"),
        F.sum(others).alias("net_others"),
    )


def update(spark: SparkSession, sales: DataFrame, base: str, chunks: int = 16) -> int:
    """Bring the states of the days in ``sales`` up to date, and return the number of the run. Other days stay as they are.

    ``sales`` holds all facts of its days: the states of a day are replaced, so corrections and deletions count. A day
    that has lost all its facts is not in ``sales`` and stays.
    """
    last = _read(spark, f"{base}/days", _DAYS).agg(F.max("run")).first()[0]
    run = 0 if last is None else last + 1

    def write(states: DataFrame, name: str) -> DataFrame:
        states.write.mode("overwrite").parquet(f"{base}/{name}/run={run}")
        return spark.read.schema(states.schema).parquet(f"{base}/{name}/run={run}")

    seen = write(seen_ids(sales), "seen")
    write(new_numbers(seen, read_dictionary(spark, base, run - 1), chunks), "dictionary")
    write(id_states(seen, read_dictionary(spark, base, run)), "ids")
    days = write(amount_states(sales), "amounts").select("order_date").distinct()
    # One file, which is there or not.
    write(days.coalesce(1), "days")
    return run


def _current(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The states of each day's last run. There is a row for each day and run to tell it."""
    days = _read(spark, f"{base}/days", _DAYS).groupBy(F.col("order_date").alias("_day")).agg(F.max("run").alias("_run"))
    last = F.col("order_date").eqNullSafe(F.col("_day")) & (F.col("run") == F.col("_run"))
    return spark.read.parquet(f"{base}/{name}").join(days, last, "left_semi")


def roll_up(spark: SparkSession, base: str, period: str = "week", by: Sequence[str] = ("channel",)) -> DataFrame:
    """Figures per ``week``, ``month``, ``quarter`` or ``year``, and per channel unless ``by`` is empty, from the states alone."""
    start = F.trunc("order_date", period).alias("period_start")
    keys = ["period_start", *by]
    ids = _current(spark, base, "ids").select(start, *by, "kind", "bucket", "bitmap")
    counts = ids.groupBy(*keys, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    counts = counts.groupBy(*keys).agg(*[F.sum(F.when(F.col("kind") == kind, F.col("n"))).alias(kind) for kind in COUNTED])
    sums = ["lines", "units", "net_decimals", "net_others"]
    amounts = _current(spark, base, "amounts").select(start, *by, *sums).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    # A row of each side at most, so a grouping joins them, also where a key is NULL.
    figures = amounts.unionByName(counts, allowMissingColumns=True)
    figures = figures.groupBy(*keys).agg(*[F.max(c).alias(c) for c in (*sums, *COUNTED)])
    return figures.select(
        *keys,
        *[F.coalesce(kind, F.lit(0)).cast("bigint").alias(kind) for kind in COUNTED],
        "lines",
        F.col("units").alias("total_units_sold"),
        exact_total(F.col("net_decimals"), F.col("net_others")).alias("net_revenue"),
    )

"""Join helpers that stay safe when a table or a key turns out large."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def month_bucket(day: Column) -> Column:
    """Number of the month of a date."""
    return F.year(day) * 12 + F.month(day) - 1


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: str,
    day: str,
    start: str,
    end: str,
    residual: Column | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """Inner join of dated rows to the intervals of the same key that hold the date, ends included.

    Intervals are repeated once for each month they touch and joined on key and month, so a key with
    many rows and many intervals compares only what shares a month, and its rows are spread over
    as many partitions as it has months. Months before the first and after the last day of the points are left
    out, so that an interval without a real end costs no more than the points span. Those two days are
    read from ``days``, a table with all days of the points that is cheaper to read than they are, or else
    from the points. Points before the first start and after the last end are left out as soon as their day is known.
    Columns of the two sides must have distinct names but for ``on``.

    Which side is broadcast, if any, is left to Spark, which knows their sizes when it runs.
    """
    if points.schema[on].dataType != intervals.schema[on].dataType:
        raise ValueError(f"Join column {on} differs in type")
    months = (points if days is None else days).select(month_bucket(F.col(day)).alias("_month"))
    both = F.struct(F.min("_month").alias("first"), F.max("_month").alias("last"))
    bounds = months.agg(both.alias("bounds")).scalar()
    first, last = bounds.getField("first"), bounds.getField("last")
    real = intervals.filter(F.col(start) <= F.col(end))
    covered = real.agg(F.struct(F.min(start).alias("first"), F.max(end).alias("last")).alias("covered")).scalar()
    points = points.filter(F.col(day).between(covered.getField("first"), covered.getField("last")))
    bounded = real.select(
        "*",
        F.greatest(month_bucket(F.col(start)), first).alias("_from"),
        # Without points there is no last month, and no interval is needed.
        F.least(month_bucket(F.col(end)), F.coalesce(last, F.lit(-1))).alias("_to"),
    )
    spans = bounded.filter("_from <= _to").select(
        *[c for c in intervals.columns if c != on],
        F.explode(
            F.transform(F.sequence("_from", "_to"), lambda bucket: _pair(F.col(on), bucket))
        ).alias("_interval_pair"),
    )
    dated = points.withColumn("_pair", _pair(F.col(on), month_bucket(F.col(day))))
    matches = (F.col("_pair") == F.col("_interval_pair")) & F.col(day).between(
        F.col(start), F.col(end)
    )
    if residual is not None:
        matches = matches & residual
    return dated.join(spans, matches, "inner").drop("_pair", "_interval_pair")


def _pair(key: Column, bucket: Column) -> Column:
    """Key and month as one value. Joined on two columns, rows that an earlier join left
    partitioned by the key alone would stay so, a hot key in one task."""
    return F.concat(bucket.cast("string"), F.lit("|"), key.cast("string"))


def packed(*keys: str) -> Column:
    """Grouping columns as one struct ``_key``, for rows that a join left partitioned by them.

    Grouped by the bare columns such rows are not shuffled again, and adaptive execution does not
    split a hot partition of the join where that would call for one more shuffle. Grouped by the struct
    they are, after partial aggregation, and the join is free to be split.
    """
    return F.struct(*keys).alias("_key")

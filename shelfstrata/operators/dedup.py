"""Keep one row per key, always the same one."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from shelfstrata.functions.columns import named


def keep_latest(
    df: DataFrame, keys: Sequence[str], recency: Sequence[str] = (), counted: str | None = None
) -> DataFrame:
    """The newest row of each key; rows whose key is NULL count as one key.

    Newest means greatest in the ``recency`` columns, in turn, NULLs last. Columns not in the
    data are passed over. What is still tied is decided by all the other columns, so the result is
    the same for any partitioning, also with no recency column at all.

    Spark limits each key to one row before the shuffle (``WindowGroupLimit`` in the plan), so a key
    that holds a third of the table sends one row per map task. Rows are sorted by the hash of the key
    first: ids often begin alike, and comparing hashes is much faster than comparing such ids.

    ``counted`` names a column to add: how many rows of the result have the row's key. They are counted where the
    rows lie sorted by that key, so it takes no shuffle.
    """
    missing = [key for key in keys if key not in df.columns]
    if missing:
        raise ValueError(f"Key columns not in the data: {missing}")
    order = [_orderable(df, c).desc_nulls_last() for c in _deciding(df.columns, keys, recency)]
    key = [named(k) for k in keys]
    if not order:
        kept, by_key = df.dropDuplicates(list(keys)), Window.partitionBy(*key)
    else:
        by_key = Window.partitionBy("_key_hash", *key)
        hashed = df.withColumn("_key_hash", F.hash(*key))
        kept = hashed.withColumn("_rank", F.row_number().over(by_key.orderBy(*order))).filter(F.col("_rank") == 1)
    if counted:
        kept = kept.withColumn(counted, F.count(F.lit(1)).over(by_key))
    return kept.drop("_rank", "_key_hash")


def columns_behind(columns: Sequence[str], wanted: Collection[str], keys: Sequence[str], recency: Sequence[str] = ()) -> list[str]:
    """Those of ``columns`` that ``keep_latest`` needs to give the ``wanted`` ones of the row it keeps.

    Columns are compared in turn, so what comes after the last wanted one only tells apart rows that are equal in
    all wanted columns, and may be left out of the data.
    """
    order = _deciding(columns, keys, recency)
    last = max((place for place, c in enumerate(order, 1) if c in wanted), default=0)
    return [c for c in columns if c in {*keys, *order[:last]}]


def _deciding(columns: Sequence[str], keys: Sequence[str], recency: Sequence[str]) -> list[str]:
    """The columns that say which row of a key is kept, the first one first."""
    newest_first = [c for c in recency if c in columns]
    return [*newest_first, *[c for c in columns if c not in {*keys, *newest_first}]]


def _orderable(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.MapType):
        return F.to_json(named(name))
    return named(name)

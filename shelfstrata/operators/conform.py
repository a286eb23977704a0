"""Bring a table of any shape into a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from shelfstrata.functions.columns import named, safe_cast


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``: its columns, in its order, with its types.

    Undeclared columns are dropped, absent ones become typed NULLs, values that do not convert
    become NULL. One projection; it fuses with the scan and prunes the columns not needed.
    """
    present = {field.name: field.dataType for field in df.schema.fields}
    columns = [
        (
            safe_cast(named(field.name), present[field.name], field.dataType)
            if field.name in present
            else F.lit(None).cast(field.dataType)
        ).alias(field.name)
        for field in schema.fields
    ]
    return df.select(*columns)


def stamp_silver(df: DataFrame) -> DataFrame:
    """Add the processing instant and date of the silver layer."""
    return df.select(
        "*",
        F.current_timestamp().alias("_silver_processed_at"),
        F.current_date().alias("_silver_processing_date"),
    )

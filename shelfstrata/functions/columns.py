"""Column helpers: safe names, NULL-on-failure casts, exact sums, keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed value: stands for a NULL part of a surrogate key, so that keys match those already stored.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# Wide enough for any sum of amounts; six places keep every amount the sources carry.
EXACT = T.DecimalType(28, 6)


def named(name: str) -> Column:
    """Column by its whole name, also when the name holds dots."""
    return F.col(f"`{name.replace('`', '``')}`")


def sql_text(value: str) -> str:
    """Text as a SQL literal. One expression text costs the driver far less to build than a call for
    each literal, which tells in a report of very many checks."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def safe_cast(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that yields NULL for what does not convert, whatever the ANSI setting.

    Text such as ``5.0`` is a valid integer here: what is no integer as it stands goes through decimal. Pairs
    Spark has no cast for (an integer into a date, say) go through text and so end as NULL
    instead of failing the whole plan.
    """
    if source == target:
        return column
    if isinstance(target, T.StringType):
        return column.cast(target)
    if isinstance(source, T.StringType):
        if isinstance(target, T.IntegralType):
            return F.coalesce(
                column.try_cast(target), column.try_cast(T.DecimalType(38, 10)).try_cast(target)
            )
        return column.try_cast(target)
    both_numeric = isinstance(source, T.NumericType) and isinstance(target, T.NumericType)
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if both_numeric or (isinstance(source, times) and isinstance(target, times)):
        return column.try_cast(target)
    if isinstance(source, T.NumericType) and isinstance(target, T.BooleanType):
        return column.try_cast(target)
    if isinstance(source, T.BooleanType) and isinstance(target, T.NumericType):
        return column.try_cast(target)
    return column.cast(T.StringType()).try_cast(target)


def exact(column: Column) -> Column:
    """A double amount in decimal. NaN and amounts too large for it become NULL."""
    return column.try_cast(EXACT)


def exact_parts(column: Column) -> tuple[Column, Column]:
    """A double amount as decimal, or else as the double it is; the other one is NULL.

    Decimal does not represent NaN, infinite and huge amounts, and those with digits beyond its places.
    """
    in_decimal = exact(column)
    # A difference this small is the noise of binary fractions such as 0.1.
    noise = F.abs(column) * F.lit(1e-9)
    fits = F.coalesce(F.abs(in_decimal.cast("double") - column) <= noise, F.lit(False))
    return F.when(fits, in_decimal), F.when(~fits, column)


def exact_total(decimals: Column, others: Column) -> Column:
    """Sums of both parts as one double, NULL when there is no value."""
    in_double = decimals.cast("double")
    return F.coalesce(in_double + others, in_double, others)


def exact_sum(column: Column) -> Column:
    """Sum of a double amount; it does not depend on the order of the rows as long as decimal represents them.

    Adds in decimal, returns double; NULL when there is no value. Amounts that decimal does not represent are added
    as doubles on the side, so that none is left out or rounded; the sum of these depends on their order.
    """
    decimals, others = exact_parts(column)
    return exact_total(F.sum(decimals), F.sum(others))


def surrogate_key(*columns: str) -> Column:
    """md5 over the columns as text, joined by ``-``, with a fixed text for NULL."""
    parts = [F.coalesce(named(c).cast("string"), F.lit(NULL_KEY_PART)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))

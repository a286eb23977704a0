"""Checks of amounts, stock flags and promotion periods against the rules that make them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfstrata.functions.columns import exact

HALF_A_CENT = 0.005


def line_amount_mismatch(order_items: DataFrame, tolerance: float = HALF_A_CENT) -> DataFrame:
    """Lines whose net is not gross less discount, or whose gross is not price times quantity."""
    net = F.col("gross_amount") - F.col("discount_amount")
    gross = F.round(F.col("unit_price") * F.col("quantity"), 2)
    return _off(order_items, ["order_item_id"], {"net": net, "gross": gross}, tolerance)


def _off(df: DataFrame, keys: list[str], expected: dict[str, Column], tolerance: float) -> DataFrame:
    off = [F.abs(F.col(f"{name}_amount") - value) > tolerance for name, value in expected.items()]
    flagged = df.select(
        *keys, *[o.alias(f"{name}_is_off") for name, o in zip(expected, off, strict=True)]
    )
    return flagged.filter(" or ".join(f"{name}_is_off" for name in expected))


def inventory_flag_mismatch(inventory_snapshots: DataFrame) -> DataFrame:
    """Snapshots whose stored flags are not those their stock and reorder point give."""
    stockout = F.col("stock_on_hand") == 0
    below = F.col("stock_on_hand") < F.col("reorder_point")
    return inventory_snapshots.select(
        "inventory_snapshot_id",
        (~F.col("is_stockout").eqNullSafe(stockout)).alias("stockout_is_off"),
        (~F.col("is_below_reorder_point").eqNullSafe(below)).alias("below_reorder_point_is_off"),
    ).filter("stockout_is_off or below_reorder_point_is_off")


def promotion_active(promotions: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Whether each promotion overlaps a period, next to the flag it is stored with."""
    overlaps = (F.col("start_date") <= F.lit(last_day).cast("date")) & (
        F.col("end_date") >= F.lit(first_day).cast("date")
    )
    return promotions.select(
        "promotion_id", "is_active", F.coalesce(overlaps, F.lit(False)).alias("is_in_period")
    )


def order_header_reconcile(
    orders: DataFrame, order_items: DataFrame, tolerance: float = HALF_A_CENT
) -> DataFrame:
    """Orders whose header amounts differ from the sums of their lines, also if one side is absent.

    Lines are added up per order before they meet the headers. Differences are taken in decimal, so
    that one of just the tolerance is judged the same everywhere. An amount that only one side has, or
    that decimal cannot hold (NaN, huge), differs as well; its difference is NULL.
    """
    amounts = ("gross", "discount", "tax")
    lines = order_items.groupBy("order_id").agg(
        *[F.sum(exact(F.col(f"{a}_amount"))).alias(f"lines_{a}") for a in amounts],
        *[F.max(_odd(a)).alias(f"lines_{a}_odd") for a in amounts],
    )
    lines = lines.withColumns(
        {
            "lines_net": F.col("lines_gross") - F.col("lines_discount"),
            "lines_net_odd": F.col("lines_gross_odd") | F.col("lines_discount_odd"),
        }
    )
    headers = orders.select(
        "order_id",
        *[exact(F.col(f"{a}_amount")).alias(f"header_{a}") for a in (*amounts, "net")],
        *[_odd(a).alias(f"header_{a}_odd") for a in (*amounts, "net")],
        F.lit(True).alias("_header"),
    )
    both = headers.join(lines.withColumn("_lines", F.lit(True)), "order_id", "full_outer").select(
        "*",
        F.col("_header").isNotNull().alias("has_header"),
        F.col("_lines").isNotNull().alias("has_lines"),
        *[
            (F.col(f"header_{a}") - F.col(f"lines_{a}")).alias(f"{a}_difference")
            for a in (*amounts, "net")
        ],
    )
    differs = " or ".join(
        f"header_{a}_odd or lines_{a}_odd or (header_{a} is null) <> (lines_{a} is null) "
        f"or abs({a}_difference) > cast({tolerance} as decimal(28,6))"
        for a in (*amounts, "net")
    )
    return both.filter(f"not has_header or not has_lines or {differs}").select(
        "order_id",
        "has_header",
        "has_lines",
        *[
            F.when(~F.coalesce(f"header_{a}_odd", F.lit(False)) & ~F.coalesce(f"lines_{a}_odd", F.lit(False)),
                   F.col(f"{a}_difference").cast("double")).alias(f"{a}_difference")
            for a in (*amounts, "net")
        ],
    )


def _odd(amount: str) -> Column:
    """Whether an amount is there but decimal cannot hold it."""
    column = F.col(f"{amount}_amount")
    return column.isNotNull() & exact(column).isNull()

"""Questions the marts leave open: breakdowns, stock risk, funnel, laggards, quality hot spots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shelfstrata.functions.columns import exact_sum
from shelfstrata.functions.joins import packed

BREAKDOWN = ["order_date", "channel", "store_id", "category"]


def sales_breakdown(sales: DataFrame) -> DataFrame:
    """Lines, units and net revenue per day, channel, store and category, with subtotals.

    ``level`` tells a subtotal (a bit per column summed over) from a value that is NULL.
    """
    return sales.rollup(*BREAKDOWN).agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units"),
        exact_sum(F.col("net_amount")).alias("net_revenue"),
    )


def stockout_risk(inventory_snapshots: DataFrame, sales: DataFrame, top: int = 50) -> DataFrame:
    """The products whose stock lasts the fewest days at their own rate of sale, ``top`` of them.

    A product's rate is its units over the days from its first to its last sale.
    """
    stock = inventory_snapshots.groupBy("product_id").agg(
        F.sum("stock_on_hand").alias("stock_on_hand"),
        F.count_if("is_stockout").alias("stores_out_of_stock"),
    )
    demand = (
        sales.groupBy(packed("product_id"))
        .agg(
            F.sum("quantity").alias("units_sold"),
            (F.date_diff(F.max("order_date"), F.min("order_date")) + 1).alias("days"),
        )
        .filter("units_sold > 0")
        .select("_key.*", "units_sold", "days")
    )
    cover = F.col("stock_on_hand") * F.col("days") / F.col("units_sold")
    return (
        stock.join(demand, "product_id", "inner")
        .select(
            "product_id",
            "stock_on_hand",
            "stores_out_of_stock",
            "units_sold",
            cover.alias("days_of_cover"),
        )
        .orderBy(F.col("days_of_cover").asc_nulls_last(), "product_id")
        .limit(top)
    )


def purchase_funnel(events: DataFrame) -> DataFrame:
    """Per day of a user's first view: users, those who bought after it, and their share.

    A user bought after the first view exactly if the last purchase is after it, so one aggregate
    per user is enough, with no join and no list of events.
    """
    of_type = lambda kind: F.when(F.col("event_type") == kind, F.col("ts"))
    users = events.groupBy("user_id").agg(
        F.min(of_type("view")).alias("first_view"),
        F.max(of_type("purchase")).alias("last_purchase"),
    )
    bought = F.count_if(F.col("last_purchase") > F.col("first_view"))
    return (
        users.filter("first_view is not null")
        .groupBy(F.to_date("first_view").alias("cohort_date"))
        .agg(F.count(F.lit(1)).alias("viewers"), bought.alias("buyers"))
        .select("*", (F.col("buyers") / F.col("viewers")).alias("conversion_rate"))
    )


def funnel_steps(events: DataFrame, steps: Sequence[str], within_seconds: int, chunk_seconds: int = 86_400) -> DataFrame:
    """Per step of a sequence: its position, kind, users who came so far, and their share of those at the first step.

    A user comes to a step with an event of its kind strictly after one that came to the step before, at most ``within_seconds`` after
    the event that began the sequence. Of all beginnings that lead to an event only the latest matters, so an event carries
    one time, the greatest carried by an event of the step before and before it. Such maxima merge: they are taken within chunks of a
    user's time, and over the chunks before, so a user with very many events is spread over as many tasks as there are chunks, and
    no list of events is built. Events without user, time or kind are left out.
    """
    kinds = F.array(*[F.lit(s) for s in steps])
    rows = events.select(
        F.col("user_id").alias("_user"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("_at"),
        (F.array_position(kinds, F.col("event_type")) - 1).cast("int").alias("_step"),
    ).filter("_user is not null and _at is not null and _step >= 0")
    rows = rows.select(
        "*",
        F.floor(F.col("_at") / (chunk_seconds * 1_000_000)).alias("_chunk"),
        F.when(F.col("_step") == 0, F.col("_at")).alias("_began"),
    )
    inside = Window.partitionBy("_user", "_chunk").orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("_user").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    for step in range(1, len(steps)):
        carried = F.when(F.col("_step") == step - 1, F.col("_began"))
        # A row for each user and chunk.
        chunks = rows.groupBy("_user", "_chunk").agg(F.max(carried).alias("_latest"))
        chunks = chunks.select("_user", "_chunk", F.max("_latest").over(before).alias("_earlier"))
        joined = rows.withColumn("_inside", F.max(carried).over(inside)).join(chunks, ["_user", "_chunk"])
        latest = F.greatest("_inside", "_earlier")
        in_time = F.when(F.col("_at") - latest <= within_seconds * 1_000_000, latest)
        began = F.when(F.col("_step") == step, in_time).otherwise(F.col("_began"))
        rows = joined.select("_user", "_at", "_step", "_chunk", began.alias("_began"))
    furthest = rows.filter("_began is not null").groupBy("_user").agg(F.max("_step").alias("_step"))
    counts = furthest.agg(*[F.count_if(F.col("_step") >= n).alias(f"_{n}") for n in range(len(steps))])
    share = lambda n: F.when(F.col("_0") > 0, F.col(f"_{n}") / F.col("_0"))
    found = [
        F.struct(F.lit(n).alias("position"), F.lit(s).alias("step"), F.col(f"_{n}").alias("users"), share(n).alias("share_of_first"))
        for n, s in enumerate(steps)
    ]
    return counts.select(F.inline(F.array(*found)))


def underperformers(sales: DataFrame, stores: DataFrame, below: float = 1.0) -> DataFrame:
    """Stores whose net revenue is under ``below`` times the average of their format.

    Sales are added up per store first; the averages are one row per format.
    """
    per_store = (
        sales.filter("store_id is not null")
        .groupBy("store_id")
        .agg(exact_sum(F.col("net_amount")).alias("net_revenue"))
        .join(stores.select("store_id", "store_format"), "store_id", "inner")
    )
    peers = per_store.groupBy(F.col("store_format").alias("peer_format")).agg(
        exact_sum(F.col("net_revenue")).alias("peer_revenue"),
        F.count(F.lit(1)).alias("peers"),
    )
    same_format = F.col("store_format").eqNullSafe(F.col("peer_format"))
    average = F.col("peer_revenue") / F.col("peers")
    return (
        per_store.join(peers, same_format, "inner")
        .select(
            "store_id",
            "store_format",
            "net_revenue",
            (F.col("net_revenue") / average).alias("share_of_peer_average"),
        )
        .filter(F.col("share_of_peer_average") < below)
    )


def peer_rank(df: DataFrame, peers: str, value: str, ranges: int = 64) -> DataFrame:
    """Rows with ``peer_rank``: the share of the other rows of their group with a smaller value, as SQL's ``percent_rank``.

    Groups are ranked in two steps: distinct values with their counts are dealt out by ranges of values, whose bounds are
    quantiles over all rows, and ranked within a range, behind what the group has in lower ranges. So neither a large group nor a
    value that very many rows share is sorted in one task. Equal values have the lowest rank of them; a row alone
    has rank 0; rows without a value are left out, rows without a group are peers of each other.
    """
    known = df.filter(F.col(value).isNotNull())
    shares = [n / ranges for n in range(1, ranges)]
    bounds = known.agg(F.percentile_approx(value, shares, 100 * ranges)).first()[0]
    if bounds is None:
        return known.withColumn("peer_rank", F.lit(0.0))
    limits = F.array(*[F.lit(b) for b in sorted(set(bounds))])
    at = F.size(F.filter(limits, lambda b: b < F.col("_value"))).alias("_range")
    values = known.groupBy(F.col(peers).alias("_peers"), F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    values = values.select("*", at)
    # A row for each group and range.
    sizes = values.groupBy("_peers", "_range").agg(F.sum("_rows").alias("_held"))
    group = Window.partitionBy("_peers")
    lower = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("_peers").alias("_of"),
        F.col("_range").alias("_at"),
        F.coalesce(F.sum("_held").over(lower), F.lit(0)).alias("_lower"),
        F.sum("_held").over(group).alias("_all"),
    )
    within = Window.partitionBy("_peers", "_range").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    placed = values.withColumn("_smaller", F.coalesce(F.sum("_rows").over(within), F.lit(0)))
    same_range = F.col("_peers").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_at"))
    below = F.col("_lower") + F.col("_smaller")
    rank = F.when(F.col("_all") > 1, below / (F.col("_all") - 1)).otherwise(F.lit(0.0))
    ranked = placed.join(sizes, same_range).select("_peers", "_value", rank.alias("peer_rank"))
    same_value = F.col(peers).eqNullSafe(F.col("_peers")) & (F.col(value) == F.col("_value"))
    return known.join(ranked, same_value).drop("_peers", "_value")


def quality_hotspots(report: DataFrame) -> DataFrame:
    """Per table: checks, failed checks, failing rows over all checks, and the worst check."""
    check = F.concat_ws(":", "rule_name", "column_name")
    return report.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.sum("failed_count").alias("failures"),
        F.max(F.struct("failed_count", check.alias("check"))).getField("check").alias("worst_check"),
    )

"""Plans under skew: a key that holds a third or more of the rows, and broadcasts switched off."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shelfstrata.operators import validate as v
from shelfstrata.operators.dedup import keep_latest
from shelfstrata.operators.quarantine import failing_rows
from shelfstrata.operators.rules import Rule
from shelfstrata.plans.insights import stockout_risk
from shelfstrata.plans.intermediate import int_order_revenue
from shelfstrata.plans.marts import mart_promotion_performance

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skewed(spark):
    for name, value in SKEW.items():
        spark.conf.set(name, value)
    yield spark
    for name in SKEW:
        spark.conf.unset(name)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def final_plan(df, capsys):
    df.collect()
    df.explain()
    return capsys.readouterr().out


def hot(spark, rows=60_000):
    """Half of the rows share one key, the others have a key each."""
    key = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(rows, numPartitions=8).select(
        key.cast("string").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )


def test_failing_rows_of_a_hot_duplicate_are_split(skewed, capsys):
    df = failing_rows(hot(skewed), Rule("k", "unique"))
    plan = final_plan(df, capsys)
    assert "SortMergeJoin(skew=true)" in plan
    assert "Window" not in plan
    assert df.count() == 30_000


AMOUNTS = ("unit_price", "gross_amount", "discount_amount", "net_amount", "tax_amount")


def hot_product_revenue(spark):
    """Order lines, half of them of one product, and silver products."""
    lines = hot(spark).select(
        F.col("k").alias("product_id"),
        F.monotonically_increasing_id().cast("string").alias("order_id"),
        F.col("payload").alias("order_item_id"),
        F.lit(1).alias("line_number"),
        F.lit(2).alias("quantity"),
        *[F.lit(1.0).alias(c) for c in AMOUNTS],
    )
    text = ("customer_id", "store_id", "status", "channel", "currency")
    orders = lines.select("order_id").select(
        "*",
        *[F.lit("x").alias(c) for c in text],
        F.lit(datetime(2023, 1, 1)).alias("order_timestamp"),
        F.date_add(F.lit(date(2023, 1, 1)), F.pmod(F.xxhash64("order_id"), F.lit(300)).cast("int")).alias(
            "order_date"
        ),
    )
    text = ("category", "subcategory", "brand")
    products = keep_latest(
        lines.select(
            "product_id", F.lit(1.0).alias("cost_price"), *[F.lit("x").alias(c) for c in text]
        ),
        ["product_id"],
    )
    return int_order_revenue(orders, lines, products)


def test_order_lines_of_a_hot_product_are_split(skewed, capsys):
    revenue = hot_product_revenue(skewed)
    assert "SortMergeJoin(skew=true)" in final_plan(revenue, capsys)
    assert revenue.count() == 60_000


def test_hot_product_is_split_also_below_a_grouping_by_product(skewed, capsys):
    stock = hot(skewed).select(
        F.col("k").alias("product_id"),
        F.lit(5).alias("stock_on_hand"),
        (F.col("payload") > "8").alias("is_stockout"),
    )
    risk = stockout_risk(stock, hot_product_revenue(skewed))
    assert "SortMergeJoin(skew=true)" in final_plan(risk, capsys)
    assert {r.units_sold for r in risk.collect()} == {2}


def test_hot_product_with_promotions_is_split(skewed, capsys):
    promotions = skewed.range(50).select(
        F.concat(F.lit("PROMO-"), "id").alias("promotion_id"),
        F.lit("deal").alias("promotion_name"),
        F.lit("0").alias("product_id"),
        F.lit(5).alias("discount_pct"),
        F.lit(date(2023, 1, 1)).alias("start_date"),
        F.lit(date(2023, 12, 31)).alias("end_date"),
        F.lit("all").alias("channel"),
    )
    performance = mart_promotion_performance(promotions, hot_product_revenue(skewed))
    assert "SortMergeJoin(skew=true)" in final_plan(performance, capsys)
    assert {r.promotion_attributed_orders for r in performance.collect()} == {30_000}


def test_relationships_meet_as_distinct_keys(skewed, capsys):
    parent = hot(skewed).filter("k <> '0'").withColumnRenamed("k", "p")
    counts = v.orphan_counts(hot(skewed), "k", parent, "p")
    plan = final_plan(counts, capsys)
    assert "skew=true" not in plan
    orphans = counts.filter("is_orphan").collect()
    assert [(r.key, r.rows) for r in orphans] == [("0", 30_000)]


def test_uniqueness_counts_are_merged_before_the_shuffle(skewed):
    from shelfstrata.operators.rules import Contract

    row = v.report(hot(skewed), Contract.of("t", [], {"k": ["unique"]})).first()
    assert (row.failed_count, row.total_count) == (30_000, 60_000)

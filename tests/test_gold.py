import hashlib
import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shelfstrata.functions.columns import exact_sum, surrogate_key
from shelfstrata.functions.joins import interval_join
from shelfstrata.plans import checks, insights, intermediate, marts
from shelfstrata.plans.staging import stg_orders, stg_promotions

REVENUE = (
    "order_item_id string, order_id string, customer_id string, store_id string, channel string, "
    "order_date date, product_id string, quantity int, gross_amount double, "
    "discount_amount double, net_amount double, tax_amount double, "
    "estimated_cost_amount double, estimated_margin_amount double"
)
PROMOTIONS = (
    "promotion_id string, promotion_name string, product_id string, discount_pct int, "
    "start_date date, end_date date, channel string, is_active boolean"
)


def line(number, day, product="P1", channel="online", net=10.0, margin=3.0, order=None):
    return (f"L{number}", order or f"O{number}", f"C{number % 2}", None, channel, day, product,
            2, net + 1, 1.0, net, 2.0, net - (margin or 0), margin)


def promotion(number, start, end, channel="all", product="P1"):
    return (f"PROMO-{number}", f"deal {number}", product, 10, start, end, channel, True)


START, END = date(2023, 1, 10), date(2023, 2, 20)


@pytest.fixture()
def revenue(spark):
    return spark.createDataFrame(
        [
            line(1, START),
            line(2, END),
            line(3, date(2023, 1, 9)),
            line(4, date(2023, 2, 21)),
            line(5, date(2023, 1, 31), channel="store"),
            line(6, date(2023, 1, 31), product="P2"),
            line(7, date(2023, 1, 31), product=None),
            line(8, None),
            line(9, date(1887, 5, 5)),
            line(10, date(2230, 5, 5)),
        ],
        REVENUE,
    )


@pytest.fixture()
def promotions(spark):
    return spark.createDataFrame(
        [
            promotion(1, START, END),
            promotion(2, START, END, "store"),
            promotion(3, START, END, "mobile_app"),
            promotion(4, date(2023, 1, 31), date(2023, 1, 31), product="P2"),
            promotion(5, END, START),
            promotion(6, None, END),
            promotion(7, date(1800, 1, 1), date(1900, 1, 1)),
            promotion(8, date(2100, 1, 1), date(9999, 12, 31)),
            promotion(9, START, END, product=None),
        ],
        PROMOTIONS,
    )


def pairs(df):
    return sorted(((r.promotion_id, r.order_item_id) for r in df.collect()), key=str)


WANTED = [
    ("PROMO-1", "L1"),
    ("PROMO-1", "L2"),
    ("PROMO-1", "L5"),
    ("PROMO-2", "L5"),
    ("PROMO-3", None),
    ("PROMO-4", "L6"),
    ("PROMO-5", None),
    ("PROMO-6", None),
    ("PROMO-7", "L9"),
    ("PROMO-8", "L10"),
    ("PROMO-9", None),
]


def test_promotion_attribution(promotions, revenue):
    attributed = intermediate.int_promotion_attribution(promotions, revenue)
    assert attributed.columns == intermediate.PROMOTION_COLUMNS + intermediate.ATTRIBUTED_COLUMNS
    assert pairs(attributed) == sorted(WANTED, key=str)


def test_promotion_attribution_without_broadcast(promotions, revenue, spark, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        attributed = intermediate.int_promotion_attribution(promotions, revenue)
        attributed.explain()
        assert "SortMergeJoin" in capsys.readouterr().out
        assert pairs(attributed) == sorted(WANTED, key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("year", [1950, 2023, 2100])
def test_intervals_of_any_year_and_without_an_end(spark, year):
    lines = spark.createDataFrame([line(n, date(year, 1 + n, 28)) for n in range(6)], REVENUE)
    spans = [(0, date(1, 1, 1), date(9999, 12, 31)), (1, date(year, 2, 28), date(year, 3, 27)), (2, date(year, 6, 28), date(9999, 12, 31)), (3, date(year + 1, 1, 1), date(year + 2, 1, 1))]
    promotions = spark.createDataFrame([promotion(*s) for s in spans], PROMOTIONS)
    found = pairs(intermediate.int_promotion_attribution(promotions, lines))
    wanted = [("PROMO-0", f"L{n}") for n in range(6)] + [("PROMO-1", "L1"), ("PROMO-2", "L5"), ("PROMO-3", None)]
    assert found == sorted(wanted, key=str)
    assert {item for _, item in pairs(intermediate.int_promotion_attribution(promotions, lines.limit(0)))} == {None}


def test_promotion_attribution_equals_a_plain_outer_join(spark):
    days = [date(2023, 1 + n % 12, 1 + n % 28) for n in range(400)]
    revenue = spark.createDataFrame(
        [line(n, d, f"P{n % 5}", ["online", "store"][n % 2]) for n, d in enumerate(days)], REVENUE
    )
    promotions = spark.createDataFrame(
        [
            promotion(n, days[n], days[(n * 7 + 3) % 400], ["all", "store", "mobile_app"][n % 3], f"P{n % 6}")
            for n in range(60)
        ],
        PROMOTIONS,
    )
    p = promotions.alias("p")
    r = revenue.alias("r")
    plain = p.join(
        r,
        (F.col("p.product_id") == F.col("r.product_id"))
        & F.col("r.order_date").between(F.col("p.start_date"), F.col("p.end_date"))
        & ((F.col("p.channel") == "all") | (F.col("p.channel") == F.col("r.channel"))),
        "left",
    ).select("p.promotion_id", "r.order_item_id")
    found = intermediate.int_promotion_attribution(promotions, revenue)
    assert pairs(found) == pairs(plain)
    assert any(item is None for _, item in pairs(found))


def test_promotion_performance(promotions, revenue):
    found = {
        r.promotion_id: r for r in marts.mart_promotion_performance(promotions, revenue).collect()
    }
    assert len(found) == 9
    sold, unsold = found["PROMO-1"], found["PROMO-3"]
    assert sold.promotion_attributed_orders == 3
    assert sold.promotion_attributed_orders_sold == 6
    assert sold.promotion_attributed_net_revenue == 30.0
    assert sold.promotion_attributed_margin_amount == 9.0
    assert unsold.promotion_attributed_orders == 0
    assert unsold.promotion_attributed_orders_sold is None
    assert unsold.promotion_attributed_gross_revenue is None


def test_interval_join_needs_one_key_type(spark):
    points = spark.sql("select 1 as k, date '2020-01-01' as d")
    spans = spark.sql("select '1' as k, date '2020-01-01' as s, date '2020-01-01' as e")
    with pytest.raises(ValueError):
        interval_join(points, spans, "k", "d", "s", "e")


def test_daily_kpis(spark):
    day = date(2023, 3, 1)
    sales = spark.createDataFrame(
        [
            line(1, day, "P1", net=10.0, margin=4.0, order="O1"),
            line(2, day, "P2", net=30.0, margin=None, order="O1"),
            line(3, day, "P1", net=20.0, margin=2.0, order="O3"),
            line(4, day, "P1", "store", net=0.0, margin=1.0),
        ],
        REVENUE,
    )
    found = {r.channel: r for r in marts.mart_daily_retail_kpis(sales).collect()}
    online, store = found["online"], found["store"]
    assert (online.total_orders, online.unique_customers, online.unique_products_sold) == (2, 2, 2)
    assert online.net_revenue == 60.0 and online.avg_net_revenue == 20.0
    assert online.total_estimated_margin_amount == 6.0
    assert online.estimated_margin_rate == 6.0 / 60.0
    assert store.estimated_margin_rate == 0.0
    assert online.total_units_sold == 6


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    sales = spark.range(20_000).select(
        F.lit(date(2023, 1, 1)).alias("order_date"),
        F.lit("online").alias("channel"),
        F.col("id").alias("order_id"),
        F.col("id").alias("customer_id"),
        F.col("id").alias("product_id"),
        F.lit(1).alias("quantity"),
        *[
            ((F.col("id") % 997) * 0.01 + F.when(F.col("id") % 2 == 0, 1e9).otherwise(0)).alias(c)
            for c in ("gross_amount", "discount_amount", "net_amount", "tax_amount",
                      "estimated_cost_amount", "estimated_margin_amount")
        ],
    )
    first = marts.mart_daily_retail_kpis(sales.repartition(2)).first()
    second = marts.mart_daily_retail_kpis(sales.repartition(9, "order_id")).first()
    assert first == second


def test_sums_leave_no_amount_out(spark):
    df = spark.createDataFrame(
        [("a", 0.1), ("a", 0.2), ("a", None), ("b", 1e30), ("b", 1.0), ("c", float("nan")),
         ("c", 1.0), ("d", None), ("e", float("inf"))],
        "k string, x double",
    )
    found = dict(map(tuple, df.groupBy("k").agg(exact_sum(F.col("x"))).collect()))
    assert math.isnan(found.pop("c"))
    assert found == {"a": 0.3, "b": 1e30, "d": None, "e": float("inf")}


def test_sums_round_no_amount(spark):
    rows = [("tiny", 4e-7)] * 1000 + [("mixed", 1e-7), ("mixed", 0.1), ("mixed", 1e25), ("mixed", -1e25), ("thirds", 1 / 3)]
    df = spark.createDataFrame(rows, "k string, x double").coalesce(1)
    found = dict(map(tuple, df.groupBy("k").agg(exact_sum(F.col("x"))).collect()))
    assert found["tiny"] == pytest.approx(4e-4, rel=1e-9)
    assert found["mixed"] == pytest.approx(0.1, abs=1e-6)
    assert found["thirds"] == 1 / 3


def order_tables(spark):
    orders = spark.createDataFrame(
        [("O1", "C1", "confirmed"), ("O2", "C2", "cancelled")],
        "order_id string, customer_id string, status string",
    ).select(
        "*",
        F.lit(None).cast("string").alias("store_id"),
        F.lit("online").alias("channel"),
        F.lit(datetime(2023, 1, 1, 23, 59)).alias("order_timestamp"),
        F.lit(date(2023, 1, 1)).alias("order_date"),
        F.lit("GBP").alias("currency"),
    )
    items = spark.createDataFrame(
        [("I1", "O1", "P1"), ("I2", "O2", "P9"), ("I3", "O7", "P1"), ("I4", None, "P1")],
        "order_item_id string, order_id string, product_id string",
    ).select(
        "*",
        F.lit(1).alias("line_number"),
        F.lit(3).alias("quantity"),
        *[F.lit(10.0).alias(c) for c in
          ("unit_price", "gross_amount", "discount_amount", "net_amount", "tax_amount")],
    )
    products = spark.createDataFrame([("P1", 2.0)], "product_id string, cost_price double").select(
        "*", *[F.lit("x").alias(c) for c in ("category", "subcategory", "brand")]
    )
    return orders, items, products


def test_order_revenue_keeps_unknown_products_and_cancelled_orders(spark):
    found = {
        r.order_item_id: r for r in intermediate.int_order_revenue(*order_tables(spark)).collect()
    }
    assert set(found) == {"I1", "I2"}
    assert found["I1"].estimated_cost_amount == 6.0
    assert found["I1"].estimated_margin_amount == 4.0
    assert found["I2"].status == "cancelled"
    assert found["I2"].cost_price is None and found["I2"].estimated_margin_amount is None


def test_staging_normalises_the_channel_of_promotions_only(spark):
    promotions = spark.createDataFrame([promotion(1, START, END, " ALL ")], PROMOTIONS)
    assert stg_promotions(promotions).first().channel == "all"
    from shelfstrata.operators.conform import conform
    from shelfstrata.schemas import ENTITIES

    orders = spark.createDataFrame(
        [(" ONLINE", datetime(2023, 5, 6, 7))], "channel string, order_timestamp timestamp"
    )
    row = stg_orders(conform(orders, ENTITIES["orders"].schema)).first()
    assert row.channel == " ONLINE" and row.order_date == date(2023, 5, 6)


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 3
    assert keys[2] == hashlib.md5(b"a-b").hexdigest()


def test_header_reconcile_finds_absent_sides(spark):
    orders = spark.sql(
        "select * from values ('A', 3.0D, 1.0D, 2.0D, 0.0D), ('B', 1.0D, 0.0D, 1.0D, 0.0D) "
        "as t(order_id, gross_amount, discount_amount, net_amount, tax_amount)"
    )
    items = spark.sql(
        "select * from values ('A', 1.0D, 0.5D, 0.0D), ('A', 2.0D, 0.5D, 0.0D), ('C', 1.0D, 0.0D, 0.0D) "
        "as t(order_id, gross_amount, discount_amount, tax_amount)"
    )
    found = {r.order_id: r for r in checks.order_header_reconcile(orders, items).collect()}
    assert set(found) == {"B", "C"}
    assert not found["B"].has_lines and not found["C"].has_header


def test_header_reconcile_finds_amounts_that_are_no_numbers(spark):
    orders = spark.sql(
        "select * from values ('null', cast(null as double)), ('nan', double('nan')), ('huge', 1e23D), ('good', 10.0D), "
        "('off', 10.01D), ('both', cast(null as double)) as t(order_id, gross_amount)"
    ).selectExpr("*", "0.0D as discount_amount", "if(order_id = 'both', null, 10.0D) as net_amount", "0.0D as tax_amount")
    items = orders.selectExpr(
        "order_id", "if(order_id = 'both', null, 10.0D) as gross_amount", "0.0D as discount_amount", "0.0D as tax_amount"
    )
    found = {r.order_id: r for r in checks.order_header_reconcile(orders, items).collect()}
    assert set(found) == {"null", "nan", "huge", "off"}
    assert found["huge"].gross_difference is None and found["huge"].net_difference == 0.0


def test_funnel_needs_the_purchase_after_the_view(spark):
    at = lambda h: datetime(2024, 1, 1, h)
    events = spark.createDataFrame(
        [
            (1, "view", at(5)), (1, "purchase", at(6)),
            (2, "purchase", at(1)), (2, "view", at(2)),
            (3, "purchase", at(1)), (3, "view", at(2)), (3, "purchase", at(3)),
            (4, "purchase", at(1)),
        ],
        "user_id int, event_type string, ts timestamp",
    )
    row = insights.purchase_funnel(events).first()
    assert (row.viewers, row.buyers) == (3, 2)


def test_points_outside_all_intervals_are_left_out_before_the_join(spark, tmp_path, capsys):
    points = spark.sql("select 'p' as k, date '2020-01-01' + cast(id as int) as day from range(1000)")
    points.write.parquet(f"{tmp_path}/points")
    spans = spark.sql("select 'p' as k, date '2021-03-01' as s, date '2021-03-10' as e union all select 'p', date '2019-01-02', date '2019-01-01'")
    joined = interval_join(spark.read.parquet(f"{tmp_path}/points"), spans, on="k", day="day", start="s", end="e")
    assert joined.count() == 10
    joined.explain()
    scan = next(line for line in capsys.readouterr().out.splitlines() if "FileScan" in line and "day" in line)
    assert "day" in scan and ">=" in scan.split("DataFilters")[1] and "<=" in scan.split("DataFilters")[1]


def test_daily_kpis_hold_amounts_apart_from_distinct_values(spark, revenue, capsys):
    nothing = (None, None, None, None, "store", None, None, 1, 1.0, 0.0, 1.0, 0.0, None, None)
    sales = revenue.unionByName(spark.createDataFrame([nothing, nothing[:4] + (None,) + nothing[5:]], REVENUE))
    kpis = marts.mart_daily_retail_kpis(sales)
    found = kpis.select("order_date", "channel", *marts.KPI_DISTINCT, "total_units_sold")
    wanted = sales.groupBy("order_date", "channel").agg(
        *[F.count_distinct(column).alias(name) for name, column in marts.KPI_DISTINCT.items()],
        F.sum("quantity").alias("total_units_sold"),
    )
    assert sorted(found.collect(), key=str) == sorted(wanted.collect(), key=str)
    capsys.readouterr()
    kpis.explain()
    # An Expand would bring the state of every amount to the row of every distinct value.
    assert "Expand" not in capsys.readouterr().out

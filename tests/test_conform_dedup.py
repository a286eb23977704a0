from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from shelfstrata.operators.conform import conform, stamp_silver
from shelfstrata.operators.dedup import keep_latest
from shelfstrata.plans.silver import to_silver
from shelfstrata.schemas import ENTITIES


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_schemas_have_their_columns_and_keys():
    counts = {name: len(entity.columns) for name, entity in ENTITIES.items()}
    assert counts == {
        "customers": 12,
        "stores": 8,
        "products": 10,
        "orders": 15,
        "order_items": 10,
        "inventory_snapshots": 9,
        "promotions": 8,
    }
    for entity in ENTITIES.values():
        assert set(entity.key) | set(entity.recency) <= set(entity.column_names)
        assert not entity.schema[entity.key[0]].nullable


@pytest.mark.parametrize(
    ("text", "kind", "wanted"),
    [
        ("5.0", T.IntegerType(), 5),
        ("abc", T.IntegerType(), None),
        ("3000000000", T.IntegerType(), None),
        ("yes", T.BooleanType(), True),
        ("perhaps", T.BooleanType(), None),
        ("1997-02-30", T.DateType(), None),
        ("1997-02-28", T.DateType(), date(1997, 2, 28)),
        ("2023-01-02 10:00:00", T.TimestampType(), datetime(2023, 1, 2, 10)),
        ("12.5", T.DoubleType(), 12.5),
        ("007", T.StringType(), "007"),
        ("9007199254740993", T.LongType(), 2**53 + 1),
        ("5.0", T.LongType(), 5),
        ("9223372036854775808", T.LongType(), None),
        (None, T.IntegerType(), None),
    ],
)
def test_cast_of_text(spark, text, kind, wanted):
    df = spark.createDataFrame([(text,)], "c string")
    assert conform(df, T.StructType([T.StructField("c", kind)])).first()[0] == wanted


def test_conform_of_typed_values(spark):
    df = spark.sql("select 5.7D as a, true as b, date '2020-01-02' as c, 7 as d, 1e300D as e, 9 as f")
    schema = T.StructType(
        [
            T.StructField("a", T.IntegerType()),
            T.StructField("b", T.StringType()),
            T.StructField("c", T.TimestampType()),
            T.StructField("d", T.DateType()),
            T.StructField("e", T.IntegerType()),
            T.StructField("f", T.BooleanType()),
        ]
    )
    wanted = (5, "true", datetime(2020, 1, 2), None, None, True)
    assert tuple(conform(df, schema).first()) == wanted


def test_silver_customers_from_a_narrower_bronze_table(spark):
    columns = (
        "customer_id string, first_name string, last_name string, email string, "
        "phone_number string, city string, region string, postcode string, loyalty_tier string, "
        "creation_datetime string, is_active boolean"
    )
    row = ("CUSTOMER-000040", "Ines", None, "ines.q@example.org", "0150 22 19", "Porto",
           "Norte", "4000", "Silver", "2021-07-09 18:30:00", False)
    silver = to_silver(spark.createDataFrame([row, row], columns), "customers")
    found = silver.collect()
    assert len(found) == 1
    assert found[0].postal_code is None and found[0].address is None
    assert found[0].creation_datetime == datetime(2021, 7, 9, 18, 30)
    assert "postcode" not in silver.columns
    assert silver.columns[-2:] == ["_silver_processed_at", "_silver_processing_date"]
    assert silver.columns[:-2] == ENTITIES["customers"].column_names


def test_stamp_keeps_the_columns(spark):
    assert stamp_silver(spark.range(1)).columns[0] == "id"


def test_unknown_entity(spark):
    with pytest.raises(ValueError):
        to_silver(spark.range(1), "baskets")


def test_keep_latest_keeps_the_newest(spark):
    df = spark.createDataFrame(
        [
            ("k1", "second", "2020-03-05 08:00:00"),
            ("k1", "first", "2020-03-05 07:59:59"),
            ("k1", "undated", None),
            ("k2", "only", None),
            (None, "keyless", "2020-01-01 00:00:00"),
        ],
        "customer_id string, first_name string, creation_datetime string",
    ).withColumn("creation_datetime", F.col("creation_datetime").cast("timestamp"))
    kept = keep_latest(df, ["customer_id"], ["creation_datetime"])
    assert {r.customer_id: r.first_name for r in kept.collect()} == {
        "k1": "second",
        "k2": "only",
        None: "keyless",
    }


def test_keep_latest_with_null_order_null_key_and_ties(spark):
    df = spark.createDataFrame(
        [
            ("a", None, "none"),
            ("a", 1, "one"),
            ("b", 2, "tie-x"),
            ("b", 2, "tie-y"),
            (None, 1, "null key, old"),
            (None, 3, "null key, new"),
        ],
        "k string, t int, v string",
    )
    assert rows(keep_latest(df, ["k"], ["t", "not_there"])) == sorted(
        [("a", 1, "one"), ("b", 2, "tie-y"), (None, 3, "null key, new")], key=str
    )


def test_keep_latest_of_missing_key(spark):
    with pytest.raises(ValueError, match="nope"):
        keep_latest(spark.range(1), ["nope"])


def test_keep_latest_of_keys_only(spark):
    assert keep_latest(spark.range(3).union(spark.range(3)), ["id"]).count() == 3


def test_keep_latest_is_the_same_for_any_partitioning(spark):
    df = spark.range(5000).select(
        (F.col("id") % 100).alias("k"),
        (F.col("id") % 3).alias("t"),
        F.xxhash64("id").alias("v"),
        F.create_map(F.lit("m"), F.col("id")).alias("m"),
    )
    first = keep_latest(df.repartition(3), ["k"], ["t"]).select("k", "t", "v")
    second = keep_latest(df.repartition(7, "v"), ["k"], ["t"]).select("k", "t", "v")
    assert rows(first) == rows(second)
    assert first.count() == 100


def test_keep_latest_limits_each_key_before_the_shuffle(spark, capsys):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    keep_latest(df, ["k"], ["v"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") > plan.index("WindowGroupLimit")


def test_keep_latest_counts_the_rows_it_keeps_without_a_shuffle(spark, capsys):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5)], "k string, v int")
    kept = keep_latest(df, ["k"], ["v"], "n")
    assert rows(kept) == sorted([("a", 2, 1), (None, 4, 1), ("b", 5, 1)], key=str)
    assert rows(keep_latest(df.select("k"), ["k"], counted="n")) == sorted([("a", 1), (None, 1), ("b", 1)], key=str)
    keep_latest(df, ["k"], ["v"], "n").explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1

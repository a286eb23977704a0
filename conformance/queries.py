"""One query per operator, over whole tables of a folder."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from conformance.lake import Lake
from shelfstrata.contracts import CONTRACTS, MODEL_TESTS, RELATIONSHIPS
from shelfstrata.functions.columns import exact_sum, surrogate_key
from shelfstrata.operators import changes, offenders, quarantine as q, validate as v
from shelfstrata.operators.conform import conform
from shelfstrata.operators.dedup import keep_latest
from shelfstrata.operators.modeltests import columns_read, model_test_report
from shelfstrata.operators.rules import Contract, Rule
from shelfstrata.plans import checks, incremental, insights, intermediate, marts, rollup
from shelfstrata.plans.bronze import SOURCE_FILES, ingest_all
from shelfstrata.schemas import ENTITIES, SILVER_METADATA
from shelfstrata.sources import landing, tables
from shelfstrata.sources.quarantine import read_quarantine, write_quarantine
from shelfstrata.sources.scratch import scratch_folder
from shelfstrata.streaming import events as streams, keyed

Query = Callable[[SparkSession, str], DataFrame]

VOLATILE = ("_quarantine_time", "_quarantine_date")

#: Column of silver tables about to be checked: how many rows have the row's key.
ROWS = "_rows"

#: Codec of landed files: takes less time than it saves, where gzip would take a third less room and more time.
LANDED = "lz4"

EVENT_CONTRACT = Contract.of(
    "events",
    ["event_id"],
    {
        "event_type": ["not_null", {"accepted_values": ["view", "click", "purchase", "signup"]}],
        "value": [{"min_value": 1.0}],
        "props": [{"regex": "^\\{.*\\}$"}],
    },
)
MISSING_COLUMN_CONTRACT = Contract.of(
    "orders", ["order_id"], {"delivery_slot": ["not_null", "unique"], "order_id": ["not_null"]}
)


def only(rule_name: str) -> list[Contract]:
    """The contracts cut down to one kind of rule."""
    cut = [
        Contract(c.table, c.primary_key, tuple(r for r in c.rules if r.name == rule_name))
        for c in CONTRACTS.values()
    ]
    return [c for c in cut if c.rules]


def _rule_report(rule_name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake, contracts = Lake(spark, sf_dir), only(rule_name)
        return v.report_all({c.table: lake.conformed(c.table) for c in contracts}, contracts)

    return run


def _failed_rows(entity: str, rule: Rule) -> Query:
    return lambda spark, sf_dir: q.failing_rows(Lake(spark, sf_dir).conformed(entity), rule)


def find_rule(entity: str, column: str, name: str) -> Rule:
    return next(r for r in CONTRACTS[entity].rules if (r.column, r.name) == (column, name))


FAILED_ROWS = {
    "failed_rows_not_null": ("customers", find_rule("customers", "email", "not_null")),
    "failed_rows_unique": ("order_items", find_rule("order_items", "order_item_id", "unique")),
    "failed_rows_min_value": ("products", find_rule("products", "cost_price", "min_value")),
    "failed_rows_accepted_values": ("orders", find_rule("orders", "channel", "accepted_values")),
    "failed_rows_regex": ("customers", find_rule("customers", "email", "regex")),
    "failed_rows_missing_column": ("stores", Rule("floor_area", "not_null")),
}


def _silver(entity: str) -> Query:
    return lambda spark, sf_dir: Lake(spark, sf_dir).silver(entity).drop(*SILVER_METADATA)


def _from_csv(entity: str) -> Query:
    return lambda spark, sf_dir: Lake(spark, sf_dir).from_csv(entity).drop(*SILVER_METADATA)


def _staged(entity: str) -> Query:
    return lambda spark, sf_dir: Lake(spark, sf_dir).staged(entity)


def _quarantine(entity: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        conformed = Lake(spark, sf_dir).conformed(entity)
        return q.quarantine(conformed, CONTRACTS[entity]).drop(*VOLATILE)

    return run


def _model_tests(name: str | None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tests = [t for t in MODEL_TESTS if name is None or t.name == name]
        read, passes = defaultdict(set), Counter()
        for model, column, several in columns_read(tests):
            read[model].add(column)
            passes[model] += several
        # Row tests share a pass; every other test, and every test that a model is the parent of, takes one more.
        passes.update({t.model for t in tests if t.is_row_test})
        models = Lake(spark, sf_dir).models(read, passes)
        return model_test_report(models, tests)

    return run


def conform_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text, some amounts and dates not convertible, one declared column not landed."""
    landed = Lake(spark, sf_dir).text("orders")
    key = F.substring("order_id", -2, 2)
    damaged = landed.select(
        "*",
        F.lit("x").alias("undeclared"),
    ).drop("created_by_system")
    damaged = damaged.withColumn(
        "gross_amount", F.when(key == "07", F.lit("n/a")).otherwise(F.col("gross_amount"))
    ).withColumn(
        "source_file_date",
        F.when(key == "13", F.lit("1997-02-30")).otherwise(F.col("source_file_date")),
    )
    return conform(damaged, ENTITIES["orders"].schema)


def conform_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as text with quantities such as ``5.0``, some too large for an integer."""
    landed = Lake(spark, sf_dir).text("order_items")
    quantity = F.when(F.col("quantity") == "7", F.lit("3000000000")).otherwise(
        F.concat("quantity", F.lit(".0"))
    )
    return conform(landed.withColumn("quantity", quantity), ENTITIES["order_items"].schema)


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Lake(spark, sf_dir).table("lineitem")
    return keep_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def dedup_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(Lake(spark, sf_dir).conformed("order_items"), ["order_item_id"])


def validate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.report(Lake(spark, sf_dir).silver("orders", ROWS), CONTRACTS["orders"], ROWS)


def rule_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.report(Lake(spark, sf_dir).silver("orders"), MISSING_COLUMN_CONTRACT)


def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, sf_dir)
    return v.report_all({e: lake.silver(e, ROWS) for e in ENTITIES}, list(CONTRACTS.values()), ROWS)


def relationship_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, sf_dir)
    return v.relationship_report(lake.related(), RELATIONSHIPS, lake.parents(RELATIONSHIPS))


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.gate_summary(validation_report(spark, sf_dir), relationship_report(spark, sf_dir))


def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    related = Lake(spark, sf_dir).related("orders", "customers")
    return v.orphan_keys(related["orders"], "customer_id", related["customers"], "customer_id")


def quarantine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, sf_dir)
    parts = [
        q.summarise(q.quarantine(lake.conformed(e), CONTRACTS[e])) for e in CONTRACTS
    ]
    summary = parts[0]
    for part in parts[1:]:
        summary = summary.unionByName(part)
    return summary


def quarantine_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing orders written to the quarantine twice, the second run's without a rule that then passes."""
    base = scratch_folder(spark, "quarantine")
    orders = Lake(spark, sf_dir).conformed("orders")
    write_quarantine(q.quarantine(orders, CONTRACTS["orders"]), base, "orders", "latest")
    mended = orders.withColumn("currency", F.coalesce("currency", F.lit("GBP")))
    write_quarantine(q.quarantine(mended, CONTRACTS["orders"]), base, "orders", "latest")
    return q.summarise(read_quarantine(spark, base, "orders", "latest"))


def surrogate_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Lake(spark, sf_dir).conformed("orders")
    return orders.select(
        "order_id", surrogate_key("order_id", "store_id", "channel").alias("order_key")
    )


def int_promotion_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Lake(spark, sf_dir).attribution


def mart_daily_retail_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_daily_retail_kpis(Lake(spark, sf_dir).sales)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers landed as CSV, with line breaks and quotes in addresses, and read back."""
    path = landing.write_csv(Lake(spark, sf_dir).text("customers"), scratch_folder(spark, "csv"))
    return landing.read_csv(spark, path)


def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = landing.with_lineage(Lake(spark, sf_dir).table("customer"), "customers")
    return bronze.drop("_bronze_source_path", "_bronze_ingested_at", "_bronze_ingestion_date")


def bronze_ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both layers stay on disk whole, so both are written compressed."""
    lake, base = Lake(spark, sf_dir), scratch_folder(spark, "bronze")
    landed = {f"{base}/landing/{file}": lake.text(entity) for entity, file in SOURCE_FILES.items()}
    tables.side_by_side(spark, [partial(landing.write_csv, text, path, LANDED) for path, text in landed.items()])
    audit = ingest_all(spark, f"{base}/landing", f"{base}/bronze", options={"compression": "zstd"})
    return audit.select("source_name", "row_count", "column_count")


def roundtrip_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "reconcile")
    rows = tables.write_table(Lake(spark, sf_dir).conformed("orders"), path)
    return tables.reconcile(spark, rows, path)


def registered_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All silver tables written, registered in the catalog and counted there."""
    lake, base = Lake(spark, sf_dir), scratch_folder(spark, "silver")
    silver = {tables.table_path(base, entity): lake.silver(entity) for entity in ENTITIES}
    tables.side_by_side(spark, [partial(tables.write_table, df, path) for path, df in silver.items()])
    schema = f"silver_{base.rsplit('-', 1)[-1].replace('/', '_')}"
    tables.register_tables(spark, schema, base, ENTITIES, location=f"{base}/_schema")
    return tables.registered_row_counts(spark, schema).select("table_name", "row_count")


def line_amount_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.line_amount_mismatch(Lake(spark, sf_dir).silver("order_items"))


def inventory_flag_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.inventory_flag_mismatch(Lake(spark, sf_dir).silver("inventory_snapshots"))


def promotion_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    promotions = Lake(spark, sf_dir).silver("promotions")
    return checks.promotion_active(promotions, "1996-02-01", "1996-03-31")


def order_header_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some headers lack an amount, or have one that is no number or too large for decimal."""
    lake = Lake(spark, sf_dir)
    key = F.substring("order_id", -3, 3)
    gross = (
        F.when(key == "021", F.lit(None).cast("double"))
        .when(key == "130", F.lit(float("nan")))
        .when(key == "239", F.lit(1e23))
        .otherwise(F.col("gross_amount"))
    )
    orders = lake.silver("orders").withColumn("gross_amount", gross)
    return checks.order_header_reconcile(orders, lake.silver("order_items"))


def x_sales_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.sales_breakdown(Lake(spark, sf_dir).sales)


def x_stockout_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, sf_dir)
    return insights.stockout_risk(lake.staged("inventory_snapshots"), lake.sales)


def x_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.purchase_funnel(Lake(spark, sf_dir).table("events"))


def x_funnel_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users who viewed, then clicked, then purchased, all within two days."""
    events = Lake(spark, sf_dir).table("events")
    return insights.funnel_steps(events, ["view", "click", "purchase"], 2 * 86_400)


def x_underperformers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(spark, sf_dir)
    return insights.underperformers(lake.sales, lake.staged("stores"))


def x_store_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each store's net revenue ranks among the stores of its format."""
    lake = Lake(spark, sf_dir)
    sold = lake.sales.filter("store_id is not null").groupBy("store_id").agg(exact_sum(F.col("net_amount")).alias("net_revenue"))
    stores = lake.keep("revenue_by_store", sold.join(lake.staged("stores").select("store_id", "store_format"), "store_id"))
    return insights.peer_rank(stores, "store_format", "net_revenue")


def x_product_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each product's price ranks in its category; very many products share a price."""
    products = Lake(spark, sf_dir).conformed("products").select("product_id", "category", "unit_price")
    return insights.peer_rank(products, "category", "unit_price")


def x_quality_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.quality_hotspots(validation_report(spark, sf_dir))


def x_offending_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with at least 1 % of the failing rows of a check, over all tables and a second run of orders with currencies mended."""
    lake, base = Lake(spark, sf_dir), scratch_folder(spark, "offenders")
    runs = [(c.table, lake.conformed(c.table)) for c in CONTRACTS.values()]
    mended = lake.conformed("orders").withColumn("currency", F.coalesce("currency", F.lit("GBP")))
    for number, (table, df) in enumerate([*runs, ("orders", mended)]):
        # The sketch and the exact counts both read the values of a run.
        path = f"{base}/values/{number}"
        tables.write_table(offenders.failing_values(df, CONTRACTS[table]), path, options={"compression": "zstd"})
        offenders.value_sketch(spark.read.parquet(path)).write.mode("append").parquet(f"{base}/sketches")
    sketch = offenders.merged(spark.read.parquet(f"{base}/sketches"))
    values = spark.read.parquet(f"{base}/values/*")
    return offenders.frequent_values(values, sketch).drop("estimate")


def x_kpi_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly figures from daily states; days of the second delivery replace those the first one had in part."""
    lake, base = Lake(spark, sf_dir), scratch_folder(spark, "rollup")
    # Both deliveries are read several times; what the states are made of is stored.
    read = ["order_date", "channel", *rollup.COUNTED.values(), "quantity", "net_amount"]
    sales = lake.keep("fct_sales", lake.sales.select(*read))
    rollup.update(spark, sales.filter("order_date < '1996-06-12' and not (order_date >= '1996-06-03' and order_id like '%7')"), base)
    rollup.update(spark, sales.filter("order_date >= '1996-06-03'"), base)
    every = rollup.roll_up(spark, base, by=()).select("*", F.lit("all").alias("channel"))
    return rollup.roll_up(spark, base).unionByName(every)


def x_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders, changed and added to by a later delivery of all returned orders."""
    orders = Lake(spark, sf_dir).silver("orders").drop(*SILVER_METADATA)
    returned = orders.filter("status = 'returned'")
    changed = returned.withColumn("customer_note", F.lit("refunded"))
    added = returned.withColumn("order_id", F.concat("order_id", F.lit("-R")))
    return changes.upsert(orders, changed.unionByName(added), ["order_id"], ["order_timestamp"])


def x_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored by channel, and those of one channel replaced by a later delivery of it."""
    path = scratch_folder(spark, "partitions")
    orders = Lake(spark, sf_dir).silver("orders").drop(*SILVER_METADATA)
    tables.write_table(orders, path, partition_by=["channel"])
    later = orders.filter("channel = 'store'").withColumn("customer_note", F.lit("redelivered"))
    changes.overwrite_partitions(later, path, ["channel"])
    return spark.read.parquet(path).groupBy("channel").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("customer_note") == "redelivered").alias("redelivered")
    )


def x_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What differs between a delivery of orders and the declared columns, with the rows it concerns."""
    orders = Lake(spark, sf_dir).conformed("orders")
    delivered = orders.drop("currency").withColumns(
        {"gift_wrap": F.lit(True), "customer_id": F.hash("customer_id")}
    )
    drift = changes.schema_drift(spark, delivered, ENTITIES["orders"].schema)
    return drift.withColumn("rows", delivered.agg(F.count(F.lit(1))).scalar())


def stored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions saved as catalog tables, staging models as views, and their rows counted by SQL."""
    lake, base = Lake(spark, sf_dir), scratch_folder(spark, "gold")
    schema = f"gold_{base.rsplit('-', 1)[-1].replace('/', '_')}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{base}/_schema'")
    dims = ("dim_customer", "dim_product", "dim_stores")
    tables.save_models({name: lake.model(name) for name in dims}, schema, base)
    tables.create_views({f"{schema}_{e}": lake.staged(e) for e in ("customers", "products", "stores")})
    pairs = zip(dims, ("customers", "products", "stores"), strict=True)
    return spark.sql(" union all ".join(
        f"select '{d}' as model, (select count(*) from {schema}.{d}) as saved_rows, "
        f"(select count(*) from {schema}_{e}) as view_rows" for d, e in pairs
    ))


def _saved(name: str) -> Query:
    """Rows of a dimension as SQL finds them in the catalog table it was saved as."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake, base = Lake(spark, sf_dir), scratch_folder(spark, "saved")
        schema = f"saved_{base.rsplit('-', 1)[-1].replace('/', '_')}"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{base}/_schema'")
        tables.save_models({name: lake.model(name)}, schema, base)
        return spark.sql(f"select * from {schema}.{name}")

    return run


def _viewed(entity: str) -> Query:
    """Rows of a staging model as SQL finds them in its view."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables.create_views({f"viewed_{entity}": Lake(spark, sf_dir).staged(entity)})
        return spark.sql(f"select * from viewed_{entity}")

    return run


def x_split_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean side of orders; the other side is what the quarantine queries show."""
    return q.split_clean(Lake(spark, sf_dir).conformed("orders"), CONTRACTS["orders"])[0]


def x_graded_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer checks with a tolerated share of bad tiers and missing last names as warnings."""
    graded = [
        Rule(r.column, r.name, r.argument, "warn" if r.column == "last_name" else "error",
             0.05 if r.column == "loyalty_tier" else 0.0)
        for r in CONTRACTS["customers"].rules
    ]
    contract = Contract("customers", ("customer_id",), tuple(graded))
    report = v.report(Lake(spark, sf_dir).silver("customers"), contract)
    return v.grade(report, [contract])


def x_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Lake(spark, sf_dir).table("events")
    return changes.freshness(events, "ts", datetime(2024, 1, 31), 24.0).drop("newest")


def x_orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    related = Lake(spark, sf_dir).related("orders", "customers")
    orphans = q.orphan_rows(related["orders"], related["customers"], RELATIONSHIPS[0])
    return orphans.drop(*VOLATILE, *SILVER_METADATA)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return streams.read_files(spark, sf_dir, schema, pathGlobFilter="events.parquet")


def _run(spark: SparkSession, stream: DataFrame, purpose: str) -> DataFrame:
    base = scratch_folder(spark, purpose)
    streams.append_to(stream, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table")


def x_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = streams.bronze_stream(_event_stream(spark, sf_dir), "events")
    landed = _run(spark, bronze, "stream-ingest")
    return landed.drop("_bronze_source_path", "_bronze_ingested_at", "_bronze_ingestion_date")


def x_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice, passed on once."""
    rows = _event_stream(spark, sf_dir).select("*", F.col("_metadata.row_index").alias("_row"))
    doubled = rows.withColumn("_copy", F.lit(1)).union(rows.withColumn("_copy", F.lit(2)))
    spread = F.struct("_row", "_copy")
    kept = streams.drop_duplicates(doubled, ["event_id"], "ts", "1 hour", spread_by=spread)
    return _run(spark, kept.select("event_id", "user_id", "event_type", "value"), "stream-dedup")


def x_stream_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = streams.volume(_event_stream(spark, sf_dir), "ts", "event_type", "1 day", "1 hour")
    closed = _run(spark, counted, "stream-volume")
    return closed.select(F.to_date("window_start").alias("day"), "event_type", "rows")


def x_stream_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_folder(spark, "stream-validate")
    query = streams.validate_to(
        _event_stream(spark, sf_dir), EVENT_CONTRACT, f"{base}/table", f"{base}/checkpoint"
    )
    query.awaitTermination()
    broken = streams.read_validated(spark, f"{base}/table", clean=False)
    return broken.select("event_id", F.array_join("_broken_rules", ",").alias("broken_rules"))


def _stream_of(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    return streams.read_files(spark, folder, spark.read.parquet(f"{sf_dir}/events.parquet").schema)


def _delivered(spark: SparkSession, sf_dir: str, purpose: str, deliveries: list[str], run: Callable[[str], None]) -> str:
    """Events delivered in turn, by condition; ``run`` reads what has come after each delivery, restarted every time."""
    base, events = scratch_folder(spark, purpose), Lake(spark, sf_dir).table("events")
    for condition in deliveries:
        events.filter(condition).write.mode("append").parquet(f"{base}/in")
        run(base)
    return base


def x_incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed in three deliveries, the last one with changes to returned orders, each merged as it comes."""
    base, orders = scratch_folder(spark, "incremental"), Lake(spark, sf_dir).text("orders")
    returned = orders.filter("status = 'returned'").withColumns({
        "customer_note": F.lit("refunded"),
        "order_timestamp": (F.col("order_timestamp").cast("timestamp") + F.expr("interval 1 day")).cast("string"),
    })
    early = F.col("order_timestamp") < "1998"
    for number, delivery in enumerate((orders.filter(early), orders.filter(~early), returned)):
        landing.write_csv(delivery, f"{base}/landing/delivery-{number}")
        incremental.merge_new(spark, "orders", f"{base}/landing", f"{base}/silver", partitions=16)
    return incremental.read_silver(spark, f"{base}/silver", "orders")


def bronze_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores landed as plain lines, some with a field too many or too few, and a file whose first line opens a quote."""
    base, stores = scratch_folder(spark, "bad-rows"), Lake(spark, sf_dir).text("stores")
    columns = stores.columns
    number = F.substring("store_id", -4, 4).cast("int")
    whole = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in columns])
    line = F.when(number % 10 == 3, F.concat(whole, F.lit(",surplus"))).when(number % 10 == 6, F.substring_index(whole, ",", 4)).otherwise(whole)
    stores.filter(number % 10 != 9).select(line).write.text(f"{base}/lines")
    rest = stores.filter(number % 10 == 9).orderBy("store_id").coalesce(1)
    first = rest.agg(F.min("store_id")).scalar()
    rest.select(F.when(F.col("store_id") == first, F.concat(F.lit('"'), whole)).otherwise(whole)).write.text(f"{base}/open")
    good, bad = landing.read_csv_checked(spark, [f"{base}/lines", f"{base}/open"], columns, header=False)
    broken = bad.select(F.regexp_extract("_record", "STORE-[0-9]+", 0).alias("store_id"), F.col("_reason").alias("reason"))
    return good.select("store_id", F.lit("good").alias("reason")).unionByName(broken)


def x_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three deliveries with repeated and late ones: each row passed, a duplicate, or late."""
    first, second = "ts < '2024-01-11'", "ts >= '2024-01-11' and ts < '2024-01-21'"

    def run(base: str) -> None:
        stream = _stream_of(spark, sf_dir, f"{base}/in")
        keyed.outcomes_to(stream, ["event_id"], "ts", "2 days", f"{base}/out", f"{base}/checkpoint").awaitTermination()

    base = _delivered(spark, sf_dir, "stream-late", [
        f"{first} and event_id % 10 <> 3",
        f"{second} or ({first} and event_id % 10 <> 3 and event_id % 7 = 0)",
        f"ts >= '2024-01-21' or ({first} and event_id % 10 = 3) or ({second} and event_id % 7 = 1)",
    ], run)
    told = keyed.read_outcomes(spark, f"{base}/out")
    return told.select("event_id", F.col("_outcome").alias("outcome"), F.col("_lateness").alias("lateness_seconds"))


def x_stream_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of a user, kind and day that has more than one, found over two deliveries."""

    def run(base: str) -> None:
        stream = _stream_of(spark, sf_dir, f"{base}/in").withColumn("day", F.to_date("ts"))
        keys = ["user_id", "event_type", "day"]
        keyed.duplicates_to(stream, keys, "ts", "40 days", f"{base}/out", f"{base}/checkpoint").awaitTermination()

    base = _delivered(spark, sf_dir, "stream-unique", ["event_id % 2 = 0", "event_id % 2 = 1"], run)
    return keyed.read_duplicates(spark, f"{base}/out").select("event_id", "user_id", "event_type", "day")


def x_stream_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases whose opening event, every fourth event that is no signup, never came; children are delivered before parents."""

    def run(base: str) -> None:
        opened = F.col("event_id") - F.col("event_id") % 4
        events = _stream_of(spark, sf_dir, f"{base}/in")
        children = events.filter("event_id % 4 <> 0 and event_type = 'purchase'").select("event_id", "user_id", "ts", opened.alias("opened_by"))
        parents = _stream_of(spark, sf_dir, f"{base}/in").filter("event_id % 4 = 0 and event_type <> 'signup'")
        found = keyed.orphans(children, parents, "opened_by", "event_id", "ts", "ts", "5 days", "1 day", spread_by=F.col("event_id"), ways=4)
        found = found.select("event_id", "user_id", "opened_by")
        streams.append_to(found, f"{base}/out", f"{base}/checkpoint").awaitTermination()

    base = _delivered(spark, sf_dir, "stream-orphans", [
        "event_id % 4 <> 0 and ts < '2024-01-21'", "event_id % 4 = 0 or ts >= '2024-01-21'"
    ], run)
    return spark.read.parquet(f"{base}/out")


def all_queries() -> dict[str, Query]:
    queries: dict[str, Query] = {
        "conform_orders": conform_orders,
        "conform_order_items": conform_order_items,
        "dedup_latest": dedup_latest,
        "dedup_any": dedup_any,
    }
    queries |= {f"silver_{e}": _silver(e) for e in ENTITIES}
    queries |= {f"rule_{n}": _rule_report(n) for n in
                ("not_null", "unique", "min_value", "accepted_values", "regex")}
    queries |= {
        "rule_missing_column": rule_missing_column,
        "validate_orders": validate_orders,
        "validation_report": validation_report,
        "quality_gate": quality_gate,
        "orphan_keys": orphan_keys,
        "relationship_report": relationship_report,
    }
    queries |= {key: _failed_rows(*given) for key, given in FAILED_ROWS.items()}
    queries |= {f"pipeline_silver_{e}": _from_csv(e) for e in ENTITIES}
    queries |= {f"quarantine_{e}": _quarantine(e) for e in ENTITIES}
    queries |= {
        "quarantine_summary": quarantine_summary,
        "quarantine_sink": quarantine_sink,
        "surrogate_key": surrogate_key_query,
    }
    queries |= {f"stg_{e}": _staged(e) for e in ENTITIES}
    queries |= {
        "int_order_revenue": lambda s, d: Lake(s, d).revenue,
        "int_inventory_position": lambda s, d: Lake(s, d).position,
        "int_promotion_attribution": int_promotion_attribution,
        "dim_customer": lambda s, d: Lake(s, d).model("dim_customer"),
        "dim_product": lambda s, d: Lake(s, d).model("dim_product"),
        "dim_stores": lambda s, d: Lake(s, d).model("dim_stores"),
        "fct_sales": lambda s, d: Lake(s, d).model("fct_sales"),
        "fct_inventory_snapshot": lambda s, d: Lake(s, d).model("fct_inventory_snapshot"),
        "mart_daily_retail_kpis": mart_daily_retail_kpis,
        "mart_promotion_performance": lambda s, d: Lake(s, d).model("mart_promotion_performance"),
        "line_amount_mismatch": line_amount_mismatch,
        "inventory_flag_mismatch": inventory_flag_mismatch,
        "promotion_active": promotion_active,
        "order_header_reconcile": order_header_reconcile,
        "csv_roundtrip": csv_roundtrip,
        "bronze_lineage": bronze_lineage,
        "bronze_ingest_audit": bronze_ingest_audit,
        "roundtrip_reconcile": roundtrip_reconcile,
        "registered_row_counts": registered_row_counts,
    }
    queries |= {f"test_{n}": _model_tests(n) for n in
                ("not_null", "unique", "accepted_values", "relationships", "regex", "accepted_range")}
    queries |= {
        "model_test_report": _model_tests(None),
        "x_sales_breakdown": x_sales_breakdown,
        "x_stockout_risk": x_stockout_risk,
        "x_funnel": x_funnel,
        "x_funnel_steps": x_funnel_steps,
        "x_underperformers": x_underperformers,
        "x_store_rank": x_store_rank,
        "x_product_rank": x_product_rank,
        "x_quality_hotspots": x_quality_hotspots,
        "x_offending_values": x_offending_values,
        "x_kpi_rollup": x_kpi_rollup,
        "x_upsert": x_upsert,
        "x_partition_overwrite": x_partition_overwrite,
        "x_schema_drift": x_schema_drift,
        "stored_models": stored_models,
        "x_split_clean": x_split_clean,
        "x_graded_report": x_graded_report,
        "x_freshness": x_freshness,
        "x_orphan_rows": x_orphan_rows,
        "x_stream_ingest": x_stream_ingest,
        "x_stream_dedup": x_stream_dedup,
        "x_stream_volume": x_stream_volume,
        "x_stream_validate": x_stream_validate,
        "x_incremental_silver": x_incremental_silver,
        "bronze_bad_rows": bronze_bad_rows,
        "x_stream_late": x_stream_late,
        "x_stream_unique": x_stream_unique,
        "x_stream_orphans": x_stream_orphans,
    }
    queries |= {f"saved_{d}": _saved(d) for d in ("dim_customer", "dim_product", "dim_stores")}
    queries |= {f"viewed_stg_{e}": _viewed(e) for e in ("customers", "products", "stores")}
    return queries

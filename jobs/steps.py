"""The steps of the pipeline, each from the stored output of those before it."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from jobs.session import say
from shelfstrata.contracts import CONTRACTS, MODEL_TESTS, RELATIONSHIPS
from shelfstrata.operators.modeltests import model_test_report
from shelfstrata.operators.quarantine import quarantine
from shelfstrata.operators.validate import enforce_gate, relationship_report, report_all
from shelfstrata.plans import intermediate, marts
from shelfstrata.plans.bronze import ingest_all
from shelfstrata.plans.silver import transform_all
from shelfstrata.plans.staging import STAGING
from shelfstrata.schemas import ENTITIES
from shelfstrata.sources.quarantine import write_quarantine
from shelfstrata.sources.tables import read_table, table_path, write_report, write_table


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    base = args.base
    audit = ingest_all(spark, f"{base}/landing", f"{base}/bronze")
    write_report(audit, f"{base}/audit/bronze_ingestion_audit")
    say("ingest", rows={r.source_name: r.row_count for r in audit.collect()})


def transform(spark: SparkSession, args: argparse.Namespace) -> None:
    done = transform_all(
        spark,
        f"{args.base}/bronze",
        f"{args.base}/silver",
        silver_fmt=args.format,
        options=_options(args),
    )
    say("transform", rows={d.table_name: d.row_count for d in done})


def _options(args: argparse.Namespace) -> dict[str, str]:
    """A table may come with other columns than the one it replaces; Delta has to be told so."""
    return {"overwriteSchema": "true"} if args.format == "delta" else {}


def _silver(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    return {e: read_table(spark, f"{args.base}/silver", e, args.format) for e in ENTITIES}


def validate(spark: SparkSession, args: argparse.Namespace) -> None:
    tables, audit = _silver(spark, args), f"{args.base}/audit"
    write_report(report_all(tables, list(CONTRACTS.values())), f"{audit}/silver_validation_report")
    write_report(
        relationship_report(tables, RELATIONSHIPS), f"{audit}/silver_relationship_validation_report"
    )
    rows = {
        table: write_quarantine(
            quarantine(tables[table], contract), f"{args.base}/quarantine", table, args.run_id
        )
        for table, contract in CONTRACTS.items()
    }
    say("validate", quarantined=rows)


def gate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Raise if the reports the validation wrote hold a failed check."""
    reports = [
        spark.read.option("header", True)
        .option("escape", '"')
        .csv(f"{args.base}/audit/{name}")
        .selectExpr("cast(passed as boolean) as passed")
        for name in ("silver_validation_report", "silver_relationship_validation_report")
    ]
    enforce_gate(*reports)


def gold(spark: SparkSession, args: argparse.Namespace) -> None:
    """Dimensions, facts and marts as tables. The daily mart reads the stored facts."""
    staged = {e: STAGING[e](df) for e, df in _silver(spark, args).items()}
    base, rows = f"{args.base}/gold", {}

    def store(name: str, model: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        rows[name] = write_table(
            model, table_path(base, name), args.format, partition_by=partition_by, options=_options(args)
        )

    revenue = intermediate.int_order_revenue(
        staged["orders"], staged["order_items"], staged["products"]
    )
    position = intermediate.int_inventory_position(
        staged["inventory_snapshots"], staged["stores"], staged["products"]
    )
    store("dim_customer", marts.dim_customer(staged["customers"]))
    store("dim_product", marts.dim_product(staged["products"]))
    store("dim_stores", marts.dim_stores(staged["stores"]))
    facts = marts.fct_sales(revenue)
    if args.partition_facts:
        # Few files per day, several for a day with very many lines.
        store("fct_sales", facts.hint("rebalance", "order_date"), ("order_date",))
    else:
        store("fct_sales", facts)
    store("fct_inventory_snapshot", marts.fct_inventory_snapshot(position))
    sales = read_table(spark, base, "fct_sales", args.format)
    store("mart_daily_retail_kpis", marts.mart_daily_retail_kpis(sales))
    store(
        "mart_promotion_performance",
        marts.mart_promotion_performance(staged["promotions"], sales, staged["orders"]),
    )
    say("gold", rows=rows)


def modeltests(spark: SparkSession, args: argparse.Namespace) -> None:
    """The tests of the staging models, over silver, and of the stored gold models."""
    silver = _silver(spark, args)
    models = {f"stg_{e}": STAGING[e](df) for e, df in silver.items()}
    for name in {t.model for t in MODEL_TESTS} - models.keys():
        models[name] = read_table(spark, f"{args.base}/gold", name, args.format)
    report = model_test_report(models, MODEL_TESTS)
    write_report(report, f"{args.base}/audit/model_test_report")
    failed = spark.read.option("header", True).option("escape", '"').csv(
        f"{args.base}/audit/model_test_report"
    )
    say("modeltests", failed=failed.filter("passed = 'false'").count())

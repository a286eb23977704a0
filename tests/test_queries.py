"""Every registered query against its SQL, and what must hold between layers."""

import json
import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from conformance.compare import differences, open_tables
from conformance.lake import Lake
from conformance.oracle import all_oracles
from conformance.queries import all_queries
from shelfstrata.schemas import ENTITIES
from shelfstrata.sources.quarantine import read_quarantine

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return open_tables(SF_DIR)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_its_sql(spark, connection, name):
    assert differences(spark, connection, SF_DIR, name) is None


def test_every_query_has_sql():
    assert all_oracles().keys() == all_queries().keys()
    assert entry_module.oracle_sql().keys() <= entry_module.queries().keys()


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_dedup_gives_a_subset_with_unique_keys(spark):
    lake = Lake(spark, SF_DIR)
    lines = lake.table("lineitem")
    kept = all_queries()["dedup_latest"](spark, SF_DIR)
    keys = lines.select("l_orderkey", "l_linenumber").distinct().count()
    assert kept.count() == keys == kept.select("l_orderkey", "l_linenumber").distinct().count()
    assert kept.exceptAll(lines).count() == 0


def test_revenue_of_the_mart_is_that_of_the_facts(spark):
    mart = all_queries()["mart_daily_retail_kpis"](spark, SF_DIR)
    total = mart.selectExpr("sum(cast(net_revenue as decimal(28,6)))").first()[0]
    facts = Lake(spark, SF_DIR).sales.selectExpr("sum(cast(net_amount as decimal(28,6)))").first()[0]
    assert total == facts


def test_results_do_not_depend_on_the_number_of_partitions(spark):
    results = []
    for partitions in ("2", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        rows = all_queries()["mart_promotion_performance"](spark, SF_DIR).collect()
        results.append(sorted(map(tuple, rows), key=str))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_jobs_run_end_to_end(spark, tmp_path):
    """The command line jobs in turn, in a session of their own, over landed CSV files."""
    from shelfstrata.plans.bronze import SOURCE_FILES
    from shelfstrata.sources.landing import write_csv

    lake = Lake(spark, SF_DIR)
    for entity, file in SOURCE_FILES.items():
        write_csv(lake.text(entity), str(tmp_path / "landing" / file))
    # The given data breaks contracts, so the gate ends the run before gold.
    done = run_jobs(tmp_path)
    assert done.returncode == 1, done.stderr[-2000:]
    assert "column checks" in done.stderr
    assert steps_of(done) == ["ingest", "transform", "validate"]
    assert not (tmp_path / "gold").exists()
    report = spark.read.option("header", True).option("escape", '"').csv(
        str(tmp_path / "audit" / "silver_validation_report")
    )
    assert report.count() == 87
    done = run_jobs(tmp_path, "--build-anyway")
    assert done.returncode == 0, done.stderr[-2000:]
    assert steps_of(done) == ["ingest", "transform", "validate", "gold", "modeltests"]
    kpis = spark.read.parquet(str(tmp_path / "gold" / "mart_daily_retail_kpis"))
    wanted = all_queries()["mart_daily_retail_kpis"](spark, SF_DIR)
    assert kpis.exceptAll(wanted).count() == 0 and kpis.count() == wanted.count()
    tests = spark.read.option("header", True).option("escape", '"').csv(
        str(tmp_path / "audit" / "model_test_report")
    )
    assert tests.count() == 101
    # A second run over less data equals a first run over it: nothing of the first is left.
    orders = lake.text("orders").filter("order_timestamp >= '1997-01-01' and currency is not null")
    write_csv(orders, str(tmp_path / "landing" / SOURCE_FILES["orders"]))
    assert run_jobs(tmp_path, "--build-anyway").returncode == 0
    sales = spark.read.parquet(str(tmp_path / "gold" / "fct_sales"))
    assert sales.filter("order_date < '1997-01-01'").count() == 0 < sales.count()
    rules = read_quarantine(spark, str(tmp_path / "quarantine"), "orders", "r1").select("_quarantine_column_name").distinct()
    assert "currency" not in {r[0] for r in rules.collect()}


def run_jobs(base, *options):
    return subprocess.run(
        [sys.executable, "-m", "jobs.run_all", "--base", str(base), "--run-id", "r1", "--partition-facts", *options],
        cwd=Path(__file__).resolve().parents[1],
        capture_output=True,
        text=True,
        timeout=600,
    )


def steps_of(done):
    return [json.loads(line)["step"] for line in done.stdout.splitlines() if line.startswith("{")]


def test_models_have_the_rows_of_their_tables_and_orphans_exist(spark):
    lake = Lake(spark, SF_DIR)
    for entity in ENTITIES:
        assert lake.model(f"stg_{entity}").count() == lake.silver(entity).count()
    found = all_queries()["relationship_report"](spark, SF_DIR).collect()
    assert len(found) == 6 and all(r.failed_count > 0 for r in found)
    values = all_queries()["test_accepted_values"](spark, SF_DIR).filter("failures > 0")
    assert {"stg_customers", "stg_stores", "stg_products"} <= {r.model_name for r in values.collect()}


def test_tested_models_are_built_once_from_each_other(spark, monkeypatch):
    """Silver tables behind several models are deduplicated once: facts and marts are made of the stored models."""
    from conformance import lake

    built, to_silver = Counter(), lake.to_silver
    monkeypatch.setattr(lake, "to_silver", lambda raw, entity: (built.update([entity]), to_silver(raw, entity))[1])
    all_queries()["model_test_report"](spark, SF_DIR)
    assert max(built.values()) == 1

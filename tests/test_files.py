import csv
import threading
from datetime import datetime
from functools import partial
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F, types as T

from shelfstrata.contracts import CONTRACTS
from shelfstrata.operators import changes
from shelfstrata.operators.conform import stamp_silver
from shelfstrata.operators.quarantine import quarantine, summarise
from shelfstrata.operators.rules import Contract
from shelfstrata.plans.bronze import SOURCE_FILES, ingest, ingest_all
from shelfstrata.plans import silver
from shelfstrata.plans.silver import transform_all
from shelfstrata.schemas import BRONZE_METADATA, ENTITIES
from shelfstrata.sources import landing, tables
from shelfstrata.sources.landing import read_csv, with_lineage, write_csv
from shelfstrata.sources.quarantine import quarantine_path, read_quarantine, write_quarantine
from shelfstrata.sources.scratch import scratch_folder
from shelfstrata.sources.tables import write_table

AWKWARD = [
    ["id", "address", "note"],
    ["007", '12 "High" Street,\nLondon\n\nUK', ""],
    ["008", "plain", 'ends with quote"'],
    ["009", "\n", '"'],
    ["010", ",", "last\n"],
]


def write_rows(path: Path, rows, newline="\n"):
    with path.open("w", newline="") as out:
        csv.writer(out, lineterminator=newline).writerows(rows)


def found(df):
    return sorted([list(r) for r in df.select("id", "address", "note").collect()])


WANTED = sorted([[c or None for c in row] for row in AWKWARD[1:]])


def test_read_csv_keeps_line_breaks_quotes_and_zeros(spark, tmp_path):
    write_rows(tmp_path / "a.csv", AWKWARD)
    df = read_csv(spark, str(tmp_path / "a.csv"))
    assert found(df) == WANTED
    assert all(isinstance(f.dataType, T.StringType) for f in df.schema.fields)


def test_lineage_is_that_of_each_file(spark, tmp_path):
    folder = tmp_path / "two files + more"
    folder.mkdir()
    write_rows(folder / "a.csv", AWKWARD)
    write_rows(folder / "b.csv", AWKWARD)
    df = with_lineage(read_csv(spark, str(folder)), "notes", datetime(2024, 1, 2, 3))
    assert tuple(df.columns[-5:]) == BRONZE_METADATA
    rows = df.select(*BRONZE_METADATA).distinct().collect()
    assert {r._bronze_source_file for r in rows} == {"a.csv", "b.csv"}
    assert all(r._bronze_source_path.endswith("two files + more/" + r._bronze_source_file) for r in rows)
    assert {(r._bronze_source_name, r._bronze_ingested_at, r._bronze_ingestion_date) for r in rows} == {
        ("notes", "2024-01-02T03:00:00", "2024-01-02")
    }


FIRST_ROWS = {
    "customers": ("customer_id", "CUST-000001"),
    "stores": ("store_id", "STORE-0001"),
    "products": ("product_id", "PROD-000001"),
    "orders": ("order_id", "ORDER-00000001"),
    "order_items": ("order_item_id", "ORDER-00000001-001"),
    "inventory_snapshots": ("inventory_snapshot_id", "INV-001"),
    "promotions": ("promotion_id", "PROMO-0001"),
}


def test_all_sources_to_bronze_and_silver(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for entity, (column, value) in FIRST_ROWS.items():
        write_rows(raw / SOURCE_FILES[entity], [[column], [value], [value]])
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    audit = ingest_all(spark, str(raw), bronze).collect()
    assert [(r.source_name, r.row_count, r.column_count) for r in audit] == [
        (entity, 2, 6) for entity in SOURCE_FILES
    ]
    done = transform_all(spark, bronze, silver)
    assert [(d.table_name, d.row_count) for d in done] == [(entity, 1) for entity in ENTITIES]
    schema = "silver_test"
    tables.register_tables(spark, schema, silver, ENTITIES, location=str(tmp_path / "schema"))
    tables.register_tables(spark, schema, silver, ENTITIES)
    counts = tables.registered_row_counts(spark, schema).collect()
    assert [(r.table_name, r.row_count) for r in counts] == [(e, 1) for e in sorted(ENTITIES)]
    assert tables.preview(spark, schema, "orders").count() == 1
    assert "order_id" in {r.col_name for r in tables.describe(spark, schema, "orders").collect()}
    tables.save_models({"orders_copy": spark.table(f"{schema}.orders")}, schema, str(tmp_path / "gold"))
    assert spark.table(f"{schema}.orders_copy").count() == 1


def test_ingest_of_a_missing_file(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        ingest(spark, "missing", str(tmp_path / "missing.csv"), str(tmp_path / "bronze"))


def test_read_table_of_a_folder_and_of_a_single_file_in_it(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path), "t").count() == 3
    single = next((tmp_path / "t").glob("part-*.parquet"))
    (tmp_path / "u").mkdir()
    (tmp_path / "u" / "u.parquet").write_bytes(single.read_bytes())
    assert tables.read_table(spark, str(tmp_path), "u").count() >= 0


def test_write_counts_rows_and_reconciles(spark, tmp_path):
    path = str(tmp_path / "t")
    written = tables.write_table(spark.range(10).repartition(3), path)
    assert written == 10
    assert tuple(tables.reconcile(spark, written, path).first()) == (10, 10, True)
    assert tuple(tables.reconcile(spark, 11, path).first()) == (11, 10, False)


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("heads", "lines"):
            df = spark.range(100).select((F.col("id") % 20).cast("string").alias("order_id"))
            tables.save_bucketed(df, f"bucketed_{name}", str(tmp_path / name), "order_id", 4)
        joined = spark.table("bucketed_heads").join(spark.table("bucketed_lines"), "order_id")
        joined.explain()
        assert "Exchange" not in capsys.readouterr().out
        assert joined.count() == 20 * 25
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_report_file(spark, tmp_path):
    path = tables.write_report(spark.sql("select 'a \"quoted\"\n text' as details"), str(tmp_path / "r"))
    assert read_csv(spark, path).first().details == 'a "quoted"\n text'


def test_quarantine_store_has_a_folder_per_rule_and_run(spark, tmp_path):
    contract = Contract.of(
        "orders", ["order.id"], {"order.id": ["not_null", "unique"], "n": [{"min_value": 0}]}
    )
    df = spark.createDataFrame([("a", 1), ("a", -1), (None, 1)], ["order.id", "n"])
    base = str(tmp_path / "q")
    assert write_quarantine(quarantine(df, contract), base, "orders", "r1") == 4
    folders = {
        p.name for p in Path(quarantine_path(base, "orders", "r1")).iterdir() if p.is_dir()
    }
    assert folders == {f"_quarantine_rule_name={n}" for n in ("not_null", "unique", "min_value")}
    assert write_quarantine(quarantine(df.filter("n > 0"), contract), base, "orders", "r1") == 1
    stored = read_quarantine(spark, base, "orders", "r1")
    assert [tuple(r) for r in summarise(stored).collect()] == [("orders", "not_null", "order_id", 1)]
    assert write_quarantine(quarantine(df.filter("n > 5"), contract), base, "orders", "r2") == 0


def test_a_clean_table_has_an_empty_quarantine(spark, tmp_path):
    silver = stamp_silver(spark.createDataFrame([], ENTITIES["stores"].schema))
    write_quarantine(quarantine(silver, CONTRACTS["stores"]), str(tmp_path), "stores", "r")
    found = read_quarantine(spark, str(tmp_path), "stores", "r")
    assert found.count() == 0 and found.columns[-2:] == ["_quarantine_time", "_quarantine_date"]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_overwriting_leaves_no_partition_behind(spark, tmp_path, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        for rows in ([(1, "a"), (2, "b")], [(3, "a")]):
            write_table(spark.createDataFrame(rows, "v int, p string"), str(tmp_path / "t"), partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [(3, "a")]


def test_scratch_folder_is_under_the_shared_folder(spark):
    def session(master, shared):
        conf = SimpleNamespace(get=lambda name, default=None: shared)
        context = SimpleNamespace(master=master, getConf=lambda: conf)
        return SimpleNamespace(conf=conf, sparkContext=context)

    first = scratch_folder(session("spark://host", "hdfs://shared/"), "x")
    assert first.startswith("hdfs://shared/x-")
    assert first != scratch_folder(session("spark://host", "hdfs://shared/"), "x")
    assert scratch_folder(session("local[2]", None), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(session("yarn", None), "x")


def test_upsert(spark):
    columns = "k string, t int, v string"
    current = spark.createDataFrame([("a", 9, "old"), ("b", 1, "kept"), (None, 1, "kept")], columns)
    new = spark.createDataFrame([("a", 1, "older"), ("a", 2, "new"), ("c", 1, "added")], columns)
    merged = changes.upsert(current, new, ["k"], ["t"])
    assert sorted((r.k or "", r.v) for r in merged.collect()) == [
        ("", "kept"), ("a", "new"), ("b", "kept"), ("c", "added"),
    ]


def test_overwrite_of_single_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.createDataFrame([(1, "mon"), (2, "tue")], "n int, day string")
    changes.overwrite_partitions(days, path, ["day"])
    changes.overwrite_partitions(days.filter("n = 2").withColumn("n", F.lit(7)), path, ["day"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "mon"), (7, "tue")]


def test_freshness_and_drift(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (None,)], "ts timestamp")
    fresh = changes.freshness(df, "ts", datetime(2024, 1, 1, 12), 12).first()
    assert fresh.age_hours == 12.0 and fresh.is_fresh
    assert not changes.freshness(df, "ts", datetime(2024, 1, 1, 13), 12).first().is_fresh
    assert not changes.freshness(df.limit(0), "ts", datetime(2024, 1, 1), 12).first().is_fresh
    drifted = spark.sql("select 1 as store_id, 'x' as extra")
    issues = {(r.column_name, r.issue) for r in
              changes.schema_drift(spark, drifted, ENTITIES["stores"].schema).collect()}
    assert ("store_id", "type") in issues and ("extra", "unexpected") in issues
    assert ("city", "missing") in issues and len(issues) == 9
    same = spark.createDataFrame([], ENTITIES["stores"].schema)
    assert changes.schema_drift(spark, same, ENTITIES["stores"].schema).count() == 0


def test_csv_is_written_as_it_is_read(spark, tmp_path):
    df = spark.createDataFrame([('a "b"\n,c', None), ("", "x")], "p string, q string")
    back = read_csv(spark, write_csv(df, str(tmp_path / "c")))
    assert sorted(map(tuple, back.collect()), key=str) == [('a "b"\n,c', None), (None, "x")]


def test_compressed_csv_is_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "ROWS_PER_FILE", 2)
    rows = spark.createDataFrame(AWKWARD[1:], "id string, address string, note string").coalesce(1)
    path = landing.write_csv(rows, str(tmp_path / "notes.csv"), "lz4")
    assert [f.suffix for f in (tmp_path / "notes.csv").glob("part-*")] == [".lz4"] * 2
    assert found(read_csv(spark, path)) == WANTED


def test_a_task_with_many_rows_lands_several_csv_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "ROWS_PER_FILE", 10)
    rows = spark.range(25).selectExpr("cast(id as string) as id", "'a,\n\"b\"' as note").coalesce(1)
    path = landing.write_csv(rows, str(tmp_path / "notes.csv"))
    assert len(list((tmp_path / "notes.csv").glob("part-*.csv"))) == 3
    assert sorted(landing.read_csv(spark, path).collect()) == sorted(rows.collect())


def test_lineage_decodes_only_what_is_encoded(spark, tmp_path):
    for name in ("plain+name.csv", "a b%20c+d.csv"):
        (tmp_path / name).write_text("id\n1\n")
    found = landing.with_lineage(landing.read_csv(spark, str(tmp_path)), "x").collect()
    assert {r._bronze_source_file for r in found} == {"plain+name.csv", "a b%20c+d.csv"}
    assert {r._bronze_source_path.rsplit("/", 1)[-1] for r in found} == {"plain+name.csv", "a b%20c+d.csv"}


def test_jobs_side_by_side_run_together_and_keep_their_order(spark):
    met = threading.Barrier(2, timeout=30)

    def job(number):
        met.wait()
        return spark.range(number).count()

    assert tables.side_by_side(spark, [partial(job, n) for n in (3, 1, 2, 4)], ways=2) == [3, 1, 2, 4]
    with pytest.raises(ZeroDivisionError):
        tables.side_by_side(spark, [lambda: 1, lambda: 1 // 0])


def test_silver_tables_are_written_side_by_side(spark, monkeypatch):
    met = threading.Barrier(2, timeout=30)

    def transform(_spark, entity, *_bases, **_formats):
        if entity in list(ENTITIES)[:2]:
            met.wait()
        return entity

    monkeypatch.setattr(silver, "transform", transform)
    assert silver.transform_all(spark, "bronze", "silver") == list(ENTITIES)

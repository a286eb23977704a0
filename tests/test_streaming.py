from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from shelfstrata.operators.rules import Contract
from shelfstrata.streaming import events as streams

SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def deliver(spark, path, rows):
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    df.write.mode("append").parquet(str(path))


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def stream(spark, tmp_path):
    return streams.read_files(spark, str(tmp_path / "in"), SCHEMA)


def run(spark, df, tmp_path):
    streams.append_to(df, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def test_ingest_resumes_where_it_stopped(spark, tmp_path):
    deliver(spark, tmp_path / "in", [(1, at(1), "view", 1.0)])
    bronze = streams.bronze_stream(stream(spark, tmp_path), "events")
    assert run(spark, bronze, tmp_path).count() == 1
    deliver(spark, tmp_path / "in", [(2, at(2), "view", 1.0)])
    found = run(spark, streams.bronze_stream(stream(spark, tmp_path), "events"), tmp_path)
    assert sorted(r.event_id for r in found.collect()) == [1, 2]
    assert {r._bronze_source_name for r in found.collect()} == {"events"}
    assert found.filter("_bronze_ingested_at is null").count() == 0


@pytest.mark.parametrize("spread", [False, True])
def test_dedup_over_batches(spark, tmp_path, spread):
    spread_by = F.col("value") if spread else None
    rows = [(1, at(1), "view", float(n)) for n in range(40)] + [(2, at(1), "view", 1.0)]

    def deduplicated():
        rows = stream(spark, tmp_path)
        return streams.drop_duplicates(rows, ["event_id"], "ts", "1 day", spread_by, ways=4)

    deliver(spark, tmp_path / "in", rows)
    run(spark, deduplicated(), tmp_path)
    deliver(spark, tmp_path / "in", [(1, at(1, 2), "view", 99.0), (3, at(1, 3), "view", 1.0)])
    found = run(spark, deduplicated(), tmp_path)
    assert sorted(r.event_id for r in found.collect()) == [1, 2, 3]


def test_volume_gives_closed_windows_and_drops_late_rows(spark, tmp_path):
    deliver(spark, tmp_path / "in", [(1, at(1, 5), "view", 1.0), (2, at(1, 6), "view", 1.0),
                                     (3, at(3, 5), "view", 1.0)])
    volume = lambda: streams.volume(stream(spark, tmp_path), "ts", "event_type", "1 day", "1 hour")
    first = run(spark, volume(), tmp_path).collect()
    assert [(r.window_start, r.rows) for r in first] == [(at(1), 2)]
    deliver(spark, tmp_path / "in", [(4, at(1, 7), "view", 1.0), (5, at(5), "view", 1.0)])
    found = run(spark, volume(), tmp_path)
    assert sorted((r.window_start, r.rows) for r in found.collect()) == [(at(1), 2), (at(3), 1)]


def test_validation_splits_each_batch_once(spark, tmp_path):
    contract = Contract.of(
        "events", ["event_id"],
        {"event_type": [{"accepted_values": ["view"]}], "value": [{"min_value": 0}]},
    )
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def validate():
        rows = stream(spark, tmp_path)
        streams.validate_to(rows, contract, out, checkpoint).awaitTermination()

    deliver(spark, tmp_path / "in", [(1, at(1), "view", 1.0), (2, at(1), "noise", -1.0)])
    validate()
    deliver(spark, tmp_path / "in", [(3, at(2), "view", 1.0)])
    validate()
    validate()
    clean = streams.read_validated(spark, out, clean=True)
    assert sorted(r.event_id for r in clean.collect()) == [1, 3]
    assert "_broken_rules" not in clean.columns
    broken = streams.read_validated(spark, out, clean=False).collect()
    assert [(r.event_id, r._broken_rules) for r in broken] == [
        (2, ["accepted_values:event_type", "min_value:value"])
    ]

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shelfstrata.streaming import events as streams, keyed
from tests.test_streaming import SCHEMA, at, deliver, stream


def settle(spark, tmp_path):
    keyed.outcomes_to(stream(spark, tmp_path), ["event_id"], "ts", "1 day", str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    return keyed.read_outcomes(spark, str(tmp_path / "out")).collect()


def outcomes(spark, tmp_path):
    return sorted((r.event_id, r.value, r._outcome, r._lateness) for r in settle(spark, tmp_path))


def test_no_row_vanishes(spark, tmp_path):
    deliver(spark, tmp_path / "in", [(1, at(5), "view", 1.0), (1, at(5), "view", 0.5), (2, at(1), "view", 1.0), (None, at(5), "view", 1.0)])
    settle(spark, tmp_path)
    # After a restart: late by two days, in reach, of a key that has left it, and new.
    deliver(spark, tmp_path / "in", [(3, at(2), "view", 2.0), (1, at(4), "view", 3.0), (2, at(6), "view", 4.0), (None, at(7), "view", 5.0), (4, None, "view", 6.0)])
    rows = settle(spark, tmp_path)
    assert {(r.event_id, r.value): (r._outcome, r._lateness) for r in rows} == {
        (1, 0.5): ("passed", None), (1, 1.0): ("duplicate", None), (2, 1.0): ("passed", None), (None, 1.0): ("passed", None),
        (3, 2.0): ("late", 2 * 86400.0), (1, 3.0): ("duplicate", None), (2, 4.0): ("passed", None),
        (None, 5.0): ("duplicate", None), (4, 6.0): ("passed", None),
    }


def test_a_batch_that_runs_again_gives_the_same(spark, tmp_path):
    """As after a loss between the writes of a batch and its commit."""
    deliver(spark, tmp_path / "in", [(1, at(1), "view", 1.0)])
    outcomes(spark, tmp_path)
    deliver(spark, tmp_path / "in", [(1, at(1), "view", 2.0), (2, at(1), "view", 2.0)])
    once = outcomes(spark, tmp_path)
    (tmp_path / "checkpoint" / "commits" / "1").unlink()
    for crc in (tmp_path / "checkpoint" / "commits").glob(".1.crc"):
        crc.unlink()
    assert outcomes(spark, tmp_path) == once == [(1, 1.0, "passed", None), (1, 2.0, "duplicate", None), (2, 2.0, "passed", None)]


def duplicates(spark, tmp_path, horizon="10 days"):
    keyed.duplicates_to(stream(spark, tmp_path), ["event_type"], "ts", horizon, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    return sorted(r.event_id for r in keyed.read_duplicates(spark, str(tmp_path / "out")).collect())


def test_unique_equals_the_batch_rule_over_restarts(spark, tmp_path):
    kinds = ["a", "b", "c", "a", None, None, "d", "b", "a", "e", "d", "a"]
    rows = [(n, at(1) + timedelta(hours=n), kind, 0.0) for n, kind in enumerate(kinds)]
    for begin in range(0, 12, 3):
        deliver(spark, tmp_path / "in", rows[begin : begin + 3])
        found = duplicates(spark, tmp_path)
        seen = kinds[: begin + 3]
        assert found == [n for n, k in enumerate(seen) if k is not None and seen.count(k) > 1]


def test_a_key_is_forgotten_after_the_horizon(spark, tmp_path):
    for number, rows in enumerate([[(1, at(1), "a", 0.0)], [(2, at(20), "b", 0.0)], [(3, at(21), "a", 0.0), (4, at(21), "b", 0.0)]]):
        deliver(spark, tmp_path / "in", rows)
        found = duplicates(spark, tmp_path)
    assert found == [2, 4]


def test_hot_key(spark, tmp_path):
    deliver(spark, tmp_path / "in", [(n, at(1), "hot", 0.0) for n in range(5_000)])
    assert len(duplicates(spark, tmp_path)) == 5_000


def test_orphans_when_the_parent_can_no_longer_come(spark, tmp_path):
    def run(ways):
        children = streams.read_files(spark, str(tmp_path / "children"), SCHEMA).withColumn("parent", F.col("value").cast("long"))
        parents = streams.read_files(spark, str(tmp_path / "parents"), SCHEMA).select("event_id", "ts")
        found = keyed.orphans(children, parents, "parent", "event_id", "ts", "ts", "2 days", "1 hour", F.col("event_id"), ways)
        streams.append_to(found, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        return sorted(r.event_id for r in spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")).collect())

    # Children of a parent that comes later, of none, of one too far off in time, and of no key.
    deliver(spark, tmp_path / "children", [(1, at(1), "x", 10.0), (2, at(1), "x", 11.0), (3, at(1), "x", 12.0), (4, at(1), "x", None), (5, at(9), "x", 11.0)])
    deliver(spark, tmp_path / "parents", [(99, at(1), "x", 0.0)])
    assert run(3) == []
    deliver(spark, tmp_path / "parents", [(10, at(2), "x", 0.0), (12, at(9), "x", 0.0)])
    deliver(spark, tmp_path / "children", [(6, at(9), "x", 99.0)])
    # Those at the end may still get a parent.
    assert run(3) == [2, 3]

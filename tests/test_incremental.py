from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfstrata.plans import incremental
from shelfstrata.plans.silver import to_silver
from shelfstrata.schemas import ENTITIES, SILVER_METADATA
from shelfstrata.sources.landing import read_csv, read_csv_checked, write_csv

COLUMNS = ENTITIES["customers"].column_names


def customers(spark, rows):
    """Customers by id, last name and time of creation; the other columns are NULL."""
    given = spark.createDataFrame(rows, "customer_id string, last_name string, creation_datetime string")
    return given.select(*[F.col(c) if c in given.columns else F.lit(None).cast("string").alias(c) for c in COLUMNS])


def land(spark, tmp_path, number, rows):
    write_csv(customers(spark, rows).coalesce(1), str(tmp_path / "landing" / f"delivery-{number}"))


def merge(spark, tmp_path, partitions=8):
    return incremental.merge_new(spark, "customers", str(tmp_path / "landing"), str(tmp_path / "silver"), partitions)


def current(spark, tmp_path):
    rows = incremental.read_silver(spark, str(tmp_path / "silver"), "customers")
    return sorted((r.customer_id, r.last_name, r.creation_datetime) for r in rows.collect())


def day(n):
    return f"2024-01-{n:02d} 00:00:00"


def test_three_deliveries_equal_a_rebuild(spark, tmp_path):
    land(spark, tmp_path, 1, [(f"C{n}", f"name {n}", day(5)) for n in range(200)])
    first = merge(spark, tmp_path)
    assert (first.files_taken, first.partitions_rewritten) == (1, 8)
    # A newer and an older row of a stored key, and a new key.
    land(spark, tmp_path, 2, [("C1", "newer", day(9)), ("C2", "older", day(1)), ("X", "new", day(9))])
    second = merge(spark, tmp_path)
    assert second.files_taken == 1 and 1 <= second.partitions_rewritten <= 3
    land(spark, tmp_path, 3, [("C1", "newest", day(10)), ("C1", "newest but for the name", day(10))])
    assert merge(spark, tmp_path).partitions_rewritten == 1
    files = [r.path for r in incremental.found_files(spark, str(tmp_path / "landing")).collect()]
    rebuilt = to_silver(read_csv(spark, files), "customers").drop(*SILVER_METADATA)
    assert current(spark, tmp_path) == sorted((r.customer_id, r.last_name, r.creation_datetime) for r in rebuilt.collect())
    assert ("C2", "name 2", datetime(2024, 1, 5)) in current(spark, tmp_path)


def test_a_run_without_new_files_writes_nothing(spark, tmp_path):
    land(spark, tmp_path, 1, [("C1", "a", day(1))])
    merge(spark, tmp_path)
    before = sorted(p for p in (tmp_path / "silver").rglob("*"))
    done = merge(spark, tmp_path)
    assert (done.files_taken, done.partitions_rewritten) == (0, 0)
    assert sorted(p for p in (tmp_path / "silver").rglob("*")) == before


def test_a_lost_run_leaves_nothing_and_runs_again(spark, tmp_path, monkeypatch):
    land(spark, tmp_path, 1, [("C1", "a", day(1))])
    merge(spark, tmp_path)
    land(spark, tmp_path, 2, [("C1", "b", day(2)), ("C2", "c", day(2))])
    create = type(spark).createDataFrame

    def fail(self, data, schema=None):
        if schema == incremental._STATE:
            raise OSError
        return create(self, data, schema)

    with monkeypatch.context() as lost:
        # All data is written, the record is not.
        lost.setattr(type(spark), "createDataFrame", fail)
        with pytest.raises(OSError):
            merge(spark, tmp_path)
    assert current(spark, tmp_path) == [("C1", "a", datetime(2024, 1, 1))]
    assert merge(spark, tmp_path).run == 1
    assert [r[:2] for r in current(spark, tmp_path)] == [("C1", "b"), ("C2", "c")]


def test_only_touched_partitions_are_read(spark, tmp_path):
    land(spark, tmp_path, 1, [(f"C{n}", "a", day(1)) for n in range(100)])
    merge(spark, tmp_path)
    state = incremental.read_state(spark, str(tmp_path / "silver"), "customers")
    places = incremental._places(state)
    one = incremental._stored(spark, str(tmp_path / "silver"), "customers", {3: places[3]})
    assert all("/part=3/" in path for path in one.inputFiles()) and one.inputFiles()


def test_bad_rows_tell_reason_file_and_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'id,name,note\n1,one,"two\nlines"\n2,short\n3,three,ok,surplus\n4,"doubled ""quotes""",\n5,,\n6,"a, b","c\n\nd",x\n7,seven,7\n'
    )
    (tmp_path / "b.csv").write_text('id,name,note\n8,eight,8\n9,"open,9\n10,ten,10\n')
    (tmp_path / "c.csv").write_text("id,name,note\n11,eleven,11\n")
    good, bad = read_csv_checked(spark, str(tmp_path / "*.csv"), ["id", "name", "note"])
    assert sorted(r.id for r in good.collect()) == sorted(["1", "4", "5", "7", "8", "11"])
    assert {r.id: r.note for r in good.collect()}["1"] == "two\nlines"
    found = sorted((r._file.rsplit("/", 1)[1], r._line, r._reason, r._record.strip()) for r in bad.collect())
    assert found == [
        ("a.csv", 4, "missing_fields", "2,short"),
        ("a.csv", 5, "surplus_fields", "3,three,ok,surplus"),
        ("a.csv", 8, "surplus_fields", '6,"a, b","c\n\nd",x'),
        ("b.csv", 3, "open_quote", '9,"open,9\n10,ten,10'),
    ]
    assert good.select("id").count() == 6 and bad.count() == 4


def test_no_bad_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,one\n")
    good, bad = read_csv_checked(spark, str(tmp_path / "a.csv"), ["id", "name"])
    assert good.count() == 1 and bad.count() == 0

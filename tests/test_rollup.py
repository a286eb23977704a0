import random
from datetime import date, timedelta

import pytest

from shelfstrata.plans import rollup

SCHEMA = "order_id string, customer_id string, product_id string, order_date date, channel string, quantity int, net_amount double"


def facts(rng, rows, first=0, days=40):
    return [
        (
            f"o{rng.randint(0, 200)}",
            rng.choice(["hot"] * 5 + [f"c{rng.randint(0, 60)}", None]),
            f"p{rng.randint(0, 20)}",
            rng.choice([date(2024, 1, 1) + timedelta(first + rng.randrange(days)), None]) if rng.random() < 0.1
            else date(2024, 1, 1) + timedelta(first + rng.randrange(days)),
            rng.choice(["online", "store", None]),
            rng.choice([1, 2, None]),
            rng.choice([1.25, 3.1, None, 1e23]),
        )
        for _ in range(rows)
    ]


def wanted(rows, start, by_channel):
    groups = {}
    for row in rows:
        key = (start(row[3]), row[4]) if by_channel else (start(row[3]),)
        groups.setdefault(key, []).append(row)
    distinct = lambda held, n: len({r[n] for r in held} - {None})
    return {
        key: (distinct(held, 0), distinct(held, 1), distinct(held, 2), len(held), sum(r[5] or 0 for r in held))
        for key, held in groups.items()
    }


def found(df, by):
    return {
        (r.period_start, *[r[c] for c in by]):
        (r.total_orders, r.unique_customers, r.unique_products_sold, r.lines, r.total_units_sold or 0)
        for r in df.collect()
    }


WEEK = lambda d: d and d - timedelta(d.weekday())
MONTH = lambda d: d and d.replace(day=1)


def check(spark, base, rows):
    for period, start in (("week", WEEK), ("month", MONTH)):
        for by in (("channel",), ()):
            assert found(rollup.roll_up(spark, base, period, by), by) == wanted(rows, start, bool(by))


def test_periods_equal_distinct_counts_of_the_facts_after_each_update(spark, tmp_path):
    rng, base = random.Random(4), str(tmp_path)
    first, later = facts(rng, 500), facts(rng, 300, first=30)
    assert rollup.update(spark, spark.createDataFrame(first, SCHEMA).repartition(3), base, chunks=2) == 0
    check(spark, base, first)
    # The later delivery replaces every day it has facts of.
    days = {r[3] for r in later}
    assert rollup.update(spark, spark.createDataFrame(later, SCHEMA), base, chunks=2) == 1
    check(spark, base, [r for r in first if r[3] not in days] + later)


def test_numbers_have_no_gaps_and_are_given_once(spark, tmp_path):
    rng, base = random.Random(5), str(tmp_path)
    rows = facts(rng, 300)
    rollup.update(spark, spark.createDataFrame(rows, SCHEMA), base, chunks=3)
    rollup.update(spark, spark.createDataFrame(rows + facts(rng, 300), SCHEMA), base, chunks=3)
    for kind in rollup.COUNTED:
        held = [r for r in rollup.read_dictionary(spark, base, 1).collect() if r.kind == kind]
        assert sorted(r.number for r in held) == list(range(1, len(held) + 1))
        assert len({r.id for r in held}) == len(held)


def test_a_lost_run_is_not_read_and_runs_again(spark, tmp_path):
    rng, base = random.Random(6), str(tmp_path)
    first, later = facts(rng, 200), facts(rng, 200, first=20)
    rollup.update(spark, spark.createDataFrame(first, SCHEMA), base)
    # What a run leaves that ends before its last write.
    seen = rollup.seen_ids(spark.createDataFrame(later, SCHEMA))
    rollup.new_numbers(seen, rollup.read_dictionary(spark, base, 0)).limit(20).write.parquet(f"{base}/dictionary/run=1")
    rollup.amount_states(spark.createDataFrame(later, SCHEMA)).write.parquet(f"{base}/amounts/run=1")
    check(spark, base, first)
    assert rollup.update(spark, spark.createDataFrame(later, SCHEMA), base) == 1
    days = {r[3] for r in later}
    check(spark, base, [r for r in first if r[3] not in days] + later)


def test_amounts_that_decimal_does_not_hold(spark, tmp_path):
    rows = [("o1", "c", "p", date(2024, 1, 1), "online", 1, 0.1), ("o2", "c", "p", date(2024, 1, 2), "online", 1, 1e23)]
    rollup.update(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path))
    assert rollup.roll_up(spark, str(tmp_path)).first().net_revenue == 1e23 + 0.1


def test_no_facts(spark, tmp_path):
    rollup.update(spark, spark.createDataFrame([], SCHEMA), str(tmp_path))
    assert rollup.roll_up(spark, str(tmp_path)).collect() == []


def test_bitmaps_over_several_buckets(spark, tmp_path):
    sales = spark.range(70_000).selectExpr(
        "concat('o', id) order_id", "concat('c', id % 40000) customer_id", "'p' product_id",
        "date_add(date'2024-01-01', cast(id % 7 as int)) order_date", "'online' channel", "1 quantity", "1d net_amount",
    )
    rollup.update(spark, sales, str(tmp_path))
    row = rollup.roll_up(spark, str(tmp_path)).first()
    assert (row.total_orders, row.unique_customers, row.unique_products_sold) == (70_000, 40_000, 1)
    with pytest.raises(Exception, match="NO_SUCH|PATH_NOT_FOUND"):
        rollup.roll_up(spark, f"{tmp_path}/none").collect()


def test_only_what_the_states_are_made_of_is_stored(spark, monkeypatch):
    from conformance import lake, queries

    written, write = [], lake.write_table
    monkeypatch.setattr(lake, "write_table", lambda df, *given, **options: (written.append(df.columns), write(df, *given, **options))[1])
    queries.x_kpi_rollup(spark, "/root/testdata/sf0.001")
    assert [len(columns) for columns in written] == [7]

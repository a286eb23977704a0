import random
from collections import Counter

import pytest

from shelfstrata.operators import offenders
from shelfstrata.operators.quarantine import quarantine
from shelfstrata.operators.rules import Contract

SCHEMA = "table_name string, rule_name string, column_name string, value string"


def sample(seed, rows):
    rng = random.Random(seed)
    checks = [("orders", "regex", "email")] * 6 + [("orders", "not_null", "email"), ("stores", "min_value", "size")]
    values = ["hot"] * 40 + ["warm"] * 3 + ["", None, "NULL"]
    return [
        (*rng.choice(checks), rng.choice(values) if rng.random() < 0.6 else f"rare-{rng.randrange(2000)}")
        for _ in range(rows)
    ]


def wanted(rows, share):
    totals, counts = Counter(r[:3] for r in rows), Counter(rows)
    return {row: (n, n / totals[row[:3]]) for row, n in counts.items() if n >= share * totals[row[:3]]}


def found(result):
    return {(r.table_name, r.rule_name, r.column_name, r.value): (r.row_count, r.share) for r in result.collect()}


@pytest.mark.parametrize("width, depth", [(2048, 4), (8, 2), (1, 1)])
def test_equals_exact_counts_for_any_size_of_the_sketch(spark, width, depth):
    rows = sample(1, 3000)
    values = spark.createDataFrame(rows, SCHEMA).repartition(3)
    sketch = offenders.value_sketch(values, width, depth)
    for share in (0.01, 0.2, 1.0):
        assert found(offenders.frequent_values(values, sketch, share, width, depth)) == wanted(rows, share)


def test_sketches_of_runs_merge(spark):
    runs = [sample(n, 800) for n in range(3)]
    frames = [spark.createDataFrame(r, SCHEMA) for r in runs]
    merged = offenders.merged(*[offenders.value_sketch(f) for f in frames])
    rows = [r for run in runs for r in run]
    whole = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, offenders.value_sketch(whole).collect()))
    assert found(offenders.frequent_values(whole, merged)) == wanted(rows, 0.01)


def test_estimates_are_never_too_low_and_within_the_bound(spark):
    rows = sample(7, 3000)
    values = spark.createDataFrame(rows, SCHEMA)
    result = offenders.frequent_values(values, offenders.value_sketch(values, 64), 0.01, 64).collect()
    totals = Counter(r[:3] for r in rows)
    over = [r.estimate - r.row_count for r in result]
    assert min(over) >= 0 and len(result) > 10
    assert all(o <= 2.72 / 64 * totals[(r.table_name, r.rule_name, r.column_name)] for o, r in zip(over, result, strict=True))


def test_value_of_the_column_that_a_rule_is_about(spark):
    contract = Contract.of("t", ["k"], {"a": ["not_null", {"min_value": 0}], "k": ["unique"], "gone": ["not_null"]})
    rows = spark.createDataFrame([("x", None), ("x", -1), ("y", 2)], "k string, a int")
    values = offenders.offending(quarantine(rows, contract)).collect()
    assert Counter((r.rule_name, r.column_name, r.value) for r in values) == Counter({
        ("not_null", "a", None): 1, ("min_value", "a", "-1"): 1, ("unique", "k", "x"): 2, ("not_null", "gone", None): 3,
    })


def test_no_rows_and_bad_share(spark):
    empty = spark.createDataFrame([], SCHEMA)
    sketch = offenders.value_sketch(empty)
    assert offenders.frequent_values(empty, sketch).collect() == []
    with pytest.raises(ValueError):
        offenders.frequent_values(empty, sketch, 0.0)


def test_failing_values_are_those_of_the_quarantine_without_whole_rows(spark):
    rules = {
        "a": ["not_null", {"min_value": 0}, {"unique": ["k", "b"]}], "k": ["unique"], "gone": ["not_null"], "_own": ["not_null"],
        "k,b": [{"unique": ["k", "b"]}],
    }
    contract = Contract.of("t", ["k"], rules)
    given = [("x", None, 1, None), ("x", -1, 1, "o"), ("x", -1, 2, None), ("y", 2, None, None), (None, -3, 1, "o"), (None, 1, 1, "o")]
    rows = spark.createDataFrame(given, "k string, a int, b int, _own string")
    expected = Counter(tuple(r) for r in offenders.offending(quarantine(rows, contract)).collect())
    values = offenders.failing_values(rows, contract)
    told = Counter()
    for r in values.collect():
        told[tuple(r)[:4]] += r["_rows"]
    assert told == expected
    whole = spark.createDataFrame([key for key, n in expected.items() for _ in range(n)], SCHEMA)
    assert sorted(map(str, offenders.value_sketch(values).collect())) == sorted(map(str, offenders.value_sketch(whole).collect()))
    assert found(offenders.frequent_values(values, offenders.value_sketch(values))) == wanted([tuple(r) for r in whole.collect()], 0.01)
    # Of a uniqueness rule only keys and their counts are shuffled.
    plan = offenders.failing_values(rows.select("k", "a", "b"), Contract.of("t", ["k"], {"k": ["unique"]}))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1

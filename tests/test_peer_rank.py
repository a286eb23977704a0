import random

from shelfstrata.plans.insights import peer_rank


def percent_rank(rows):
    found = []
    for key, group, value in rows:
        if value is not None:
            peers = [v for _, g, v in rows if g == group and v is not None]
            found.append((key, sum(v < value for v in peers) / (len(peers) - 1) if len(peers) > 1 else 0.0))
    return sorted(found)


def ranked(spark, rows, ranges=64):
    df = spark.createDataFrame(rows, "id long, grp string, amount double")
    return sorted((r.id, r.peer_rank) for r in peer_rank(df.repartition(3), "grp", "amount", ranges).collect())


def test_equals_percent_rank_with_a_hot_group_and_hot_values(spark):
    rng = random.Random(2)
    groups = ["hot"] * 12 + ["a", "b", None]
    rows = [(n, rng.choice(groups), rng.choice([7.0, rng.uniform(-5, 50), float(rng.randint(0, 9)), None])) for n in range(700)]
    rows += [(900, "alone", 3.0), (901, "empty", None)]
    for ranges in (2, 64):
        assert ranked(spark, rows, ranges) == percent_rank(rows)


def test_no_rows(spark):
    assert ranked(spark, []) == [] and ranked(spark, [(1, "a", None)]) == []

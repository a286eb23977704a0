"""Components and embedding near-duplicates against brute force."""

import random

import numpy as np
import pytest

from shelfstrata.llm.components import components
from shelfstrata.llm.embedding_dedup import _cells_of, _tiles, cells, far_apart, int8_products, near_duplicate_vectors, quantised, similar_pairs


def groups(nodes, links):
    around = {n: set() for n in nodes}
    for a, b in links:
        around[a].add(b)
        around[b].add(a)
    found = {}
    for n in sorted(around):
        todo = [n] if n not in found else []
        while todo:
            x = todo.pop()
            if x not in found:
                found[x] = n
                todo += around[x]
    return found


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(kind)
    names = rng.sample(range(10_000), 300)
    links = {
        "path": list(zip(names, names[1:])),
        "star": [(names[7], n) for n in names if n != names[7]],
        "random": [tuple(rng.sample(names, 2)) for _ in range(200)] + [(names[0], names[0])],
        "none": [],
    }[kind]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    want = groups(linked, [x for x in links if x[0] != x[1]])
    assert got == want


def test_bounds_hold():
    rng = np.random.default_rng(1)
    v = rng.standard_normal((300, 70)) * 10.0 ** rng.integers(-20, 20, (300, 1))
    q, s, e, n = quantised(v)
    u = v / n[:, None]
    error = np.abs(u @ u.T - int8_products(q, q) * s[:, None] * s)
    assert (error <= e[:, None] + e + e[:, None] * e).all()
    wide = rng.integers(-127, 128, (3, 5000)).astype(np.int8)
    assert (int8_products(wide, wide) == wide.astype(np.int64) @ wide.astype(np.int64).T).all()


def test_pairs_near_the_threshold():
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 32))
    near = base + rng.standard_normal((60, 32)) * 0.2
    v = np.concatenate([base, near, base * 3.0])
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = set(zip(*np.nonzero((v @ v.T) / np.outer(np.linalg.norm(v, axis=1), np.linalg.norm(v, axis=1)) >= 0.98)))
    assert set(zip(*similar_pairs(v, v))) == want and len(u) == len(v)


def brute(rows):
    usable = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable.setdefault(i, []).append((label, np.array(v, dtype=np.float64)))
    links = []
    for i in usable:
        for j in usable:
            for la, a in usable[i]:
                for lb, b in usable[j]:
                    if i < j and la == lb and len(a) == len(b) and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= 0.98:
                        links.append((i, j))
    group = groups(usable, links)
    count = {i: len({x for link in links if i in link for x in link} - {i}) for i in usable}
    return sorted((str(i), count.get(i, 0), group.get(i, i), None if i is None else group.get(i, i) == i) for i, _, _ in rows)


def test_vectors_of_all_kinds(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(120):
        v = rng.standard_normal(8) if i % 3 == 0 else np.array(rows[i - 1][1]) + rng.standard_normal(8) * 0.12
        rows.append((i, v.tolist(), i // 60))
    rows += [(200 + i, rows[3][1], 0) for i in range(40)]  # a group of copies
    rows += [(300, [x * 2 for x in rows[3][1]], 0), (301, rows[3][1], None), (302, None, 0), (303, [], 0), (304, [0.0] * 8, 0)]
    rows += [(305, [None] + rows[3][1][1:], 0), (306, [float("nan")] * 8, 0), (307, [float("inf")] * 8, 0), (308, rows[3][1][:7], 0)]
    rows += [(None, rows[3][1], 0), (309, [-0.0, 1.0], 5), (310, [0.0, 1.0], 5), (311, [1e-30, 1e30], 5)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, links string")
    want = brute(rows)
    for block, per_pivot, part in ((1024, 512, 4096), (16, 512, 4096), (16, 4, 20), (4, 2, 7)):
        monkeypatch.setattr("shelfstrata.llm.embedding_dedup.BLOCK", block)
        monkeypatch.setattr("shelfstrata.llm.embedding_dedup.PER_PIVOT", per_pivot)
        monkeypatch.setattr("shelfstrata.llm.embedding_dedup.PART", part)
        got = near_duplicate_vectors(table).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == want
    assert near_duplicate_vectors(table.where("false")).count() == 0


def test_a_near_vector_is_at_home_or_a_guest():
    rng = np.random.default_rng(9)
    for dims in (2, 3, 16, 64):
        base = rng.standard_normal((300, dims))
        base /= np.linalg.norm(base, axis=1, keepdims=True)
        # Near pairs of about the threshold, equal vectors, and lengths that differ.
        near = base + rng.standard_normal((300, dims)) * 0.19 / np.sqrt(dims)
        v = np.concatenate([base, near, base[:20] * 7.0])
        pivots = np.concatenate([v[rng.choice(len(v), 24, replace=False)], base[:2], base[:2] * 3.0])
        home, guest = cells(v, pivots)
        pairs = list(zip(*similar_pairs(v, v)))
        assert len(pairs) > len(v)
        for x, y in pairs:
            assert home[x] == home[y] or (guest[x, home[y]] if home[x] < home[y] else guest[y, home[x]])


def test_vectors_that_do_not_compare_are_guests_of_all_later_cells():
    with np.errstate(all="ignore"):
        home, guest = cells(np.array([[np.inf, 0.0], [1.0, 0.0]]), np.array([[1.0, 0.0], [0.0, 1.0]]))
    assert guest[0].tolist() == [False, True] and guest[1].tolist() == [False, False] and home[1] == 0


def test_pivots_are_far_apart():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 16)) * 10
    v = centres[rng.integers(0, 20, 400)] + rng.standard_normal((400, 16)) * 0.1
    chosen = far_apart(v, 20)
    nearest = ((v[chosen][:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
    assert sorted(nearest) == list(range(20))
    assert far_apart(v[:3], 20).tolist() != [] and len(far_apart(np.array([[1e308, 1e308]]), 2)) == 0


def test_shuffled_rows_grow_in_proportion_on_clustered_vectors(spark):
    rng, share = np.random.default_rng(3), []
    for number in (3000, 30000):
        centres = rng.standard_normal((number // 1000, 32))
        v = centres[np.arange(number) % len(centres)] + rng.standard_normal((number, 32)) * 0.05
        rows = [(1, x.tolist(), i, 1, 32) for i, x in enumerate(v)]
        classes = spark.createDataFrame(rows, "label long, embedding array<double>, rep long, copies long, dims int")
        share.append(_tiles(_cells_of(classes)).count() / number)
    assert share[1] < 1.2 * share[0] and share[1] < 3

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfstrata.llm import merkle
from shelfstrata.llm.common import table
from tests.llm.conftest import SF


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """The root of a list of digests, and the siblings of each on its way up, by level."""
    ways, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for leaf, i in enumerate(place):
            run, at = runs[i // 16], i % 16
            ways[leaf].append(("".join(run[:at]), "".join(run[at + 1 :])))
        nodes, place = [h(*run) for run in runs], [i // 16 for i in place]
    return nodes[0], ways


def expected(rows):
    """Per document in turn, by the definition: (id, leaf, subroot, root, proof, folded root)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    built = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        given = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built.append((given, *tree([leaf(r) for r in given])))
    root, tops = tree([subroot for _, subroot, _ in built])
    found = []
    for (given, subroot, ways), top in zip(built, tops):
        for row, way in zip(given, ways):
            way = way + top
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded = leaf(row, tampered)
            for left, right in way:
                folded = h(left, folded, right)
            found.append((row[0], leaf(row), subroot, root, h(*[x for pair in way for x in pair]), folded))
    return found


def leaf(row, tampered=False):
    doc_id, text, lang, source = row[:4]
    n_chars = len(text or "")
    if tampered and text is not None:
        text = "".join(c.lower() if c.isascii() else c for c in text)
    return h(field(doc_id), field(source), field(lang), field(n_chars), field(text))


def run(spark, docs_of, monkeypatch, rows):
    docs = docs_of(rows)
    monkeypatch.setattr(merkle, "table", lambda *_: docs)
    return merkle.op12_merkle_manifest(spark, "")


def corpus(sizes):
    rows = []
    for source, size in sizes.items():
        rows += [(len(rows) + i, f"Text Élan {source} {i}" if i % 7 else None, "en" if i % 3 else None, source) for i in range(size)]
    return rows[::-1]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2, None: 1}, {"a": 16, "b": 17, "": 256, None: 257, "é": 3}, {"hot": 4_200, **{f"s{i}": 1 for i in range(300)}}])
def test_equals_trees_built_by_hand(spark, docs_of, monkeypatch, sizes):
    rows = corpus(sizes)
    found = run(spark, docs_of, monkeypatch, rows).collect()
    assert sorted((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in found) == sorted(expected(rows))
    assert all(r.verified == (r.folded_root == r.root) for r in found)
    assert any(r.verified for r in found)


def test_rows_with_equal_ids_without_ids_and_repeated(spark, docs_of, monkeypatch):
    rows = [(1, "A", "en", "s"), (1, "B", "en", "s"), (1, "B", "en", "s"), (None, "C", None, "s"), (None, "", "fr", "s"), (2, "x" * 500_000, "en", "s")]
    found = run(spark, docs_of, monkeypatch, rows).collect()
    wanted = expected(rows)
    assert sorted(map(str, [(r.doc_id, r.leaf, r.proof_sha256, r.folded_root) for r in found])) == sorted(map(str, [(w[0], w[1], w[4], w[5]) for w in wanted]))


def test_only_changed_texts_fail(spark, docs_of, monkeypatch):
    rows = [(i, "UPPER" if i % 2 else "lower", "en", "s") for i in range(100)]
    for r in run(spark, docs_of, monkeypatch, rows).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 5 != 0 or r.doc_id % 2 == 0)


def test_empty_table(spark, docs_of, monkeypatch):
    assert run(spark, docs_of, monkeypatch, []).collect() == []


def test_query_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    result = connection.execute(merkle.OP12_SQL)
    columns = [d[0] for d in result.description]
    found = merkle.op12_merkle_manifest(spark, SF)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(result.fetchall())


def test_ranks_do_not_depend_on_the_partitions(spark, docs_of):
    nodes = table(spark, SF, "documents").select(F.lit("t").alias("tree"), "doc_id")
    for partitions in (1, 5):
        ranked = merkle.ranked(nodes.repartition(partitions), ["doc_id"]).collect()
        assert [r.pos for r in sorted(ranked, key=lambda r: r.doc_id)] == list(range(len(ranked)))

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from shelfstrata.llm import spelling
from tests.llm.conftest import SF


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    """By a table of edit distances."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1] == 1


def plain(counts):
    near = {w: [v for v in counts if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    root = {}
    for w in counts:
        root[w] = w
        while form[root[w]] is not None:
            root[w] = form[root[w]]
    return sorted((w, str(form[w]), root[w], n, len(near[w]), str(counts.get(form[w]))) for w, n in counts.items())


def found(df):
    return sorted((r.word, str(r.form), r.root, r.n, r.n_near, str(r.form_n)) for r in df.collect())


def edited(word, rng, letters):
    at = rng.randrange(len(word))
    return {0: word[:at] + word[at + 1 :], 1: word[:at] + rng.choice(letters) + word[at:], 2: word[:at] + rng.choice(letters) + word[at + 1 :]}[rng.randrange(3)]


def family(seed, letters, size=250, length=(7, 12)):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(*length))) for _ in range(size)]
    counts = {w: rng.choice([2, 30, 900]) for w in words}
    for _ in range(3):
        for w in [edited(w, rng, letters) for w in rng.sample(sorted(counts), size // 2)]:
            if len(w) >= 7:
                counts.setdefault(w, rng.choice([2, 3, 40, 500]))
    return counts


@pytest.mark.parametrize("grams, tile", [(20_000, 2_048), (40, 2_048), (0, 5)])
@pytest.mark.parametrize("letters", ["ab", "aeioubcdé"])
def test_equals_all_pairs(spark, monkeypatch, grams, tile, letters):
    monkeypatch.setattr(spelling, "GRAMS", grams)
    monkeypatch.setattr(spelling, "TILE_ROWS", tile)
    counts = family(len(letters), letters) | {"z" * 90: 50, "z" * 89: 3, "z" * 300: 2, "z" * 89 + "y": 700}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(spelling.variants(words)) == plain(counts)


@pytest.mark.parametrize("a, b, near", [("abcdefg", "abcdefg", False), ("abcdefg", "abcdef", True), ("abcdefg", "xbcdefg", True), ("abcdefg", "bacdefg", False), ("aaaaaaa", "aaaaaaaa", True), ("abcdefg", "abcdefghi", False), ("abcdefgé", "abcdefge", True)])
def test_pairs(a, b, near):
    assert spelling.differ_by_one(a, b) == spelling.differ_by_one(b, a) == near == one_edit(a, b)
    words = spelling._Words([a, b, "w" * 70])
    assert words.near(*map(__import__("numpy").array, ([0], [1])))[0] == near


def test_near_words_share_a_list_whatever_the_dictionary():
    rng = random.Random(3)
    for trial in range(300):
        letters = "ab" if trial % 2 else "abcdeé"
        word = "".join(rng.choice(letters) for _ in range(rng.randint(7, 14)))
        other = edited(word, rng, letters)
        if other == word or len(other) < 7:
            continue
        marked = [f"^{w}$" for w in (word, other)]
        all_grams = {m[p : p + q] for m in marked for q in range(3, 7) for p in range(len(m) - q + 1)}
        short = {g for g in all_grams if len(g) == 3}
        kept = set(short)
        for q in range(4, 7):
            kept |= {g for g in all_grams if len(g) == q and g[:-1] in kept and rng.random() < 0.5}
        grams = {g: rng.randint(1, 5) for g in kept}
        inner = {g[:-1] for g in grams if len(g) > 3}
        assert spelling.list_names(word, grams, inner) & spelling.list_names(other, grams, inner)


def test_words_of_texts(spark, docs_of):
    words = ["Elephant", "ÉLÉPHANT", "éléphants", "Éclair", "naïveté", "giraffes", "x" * 400]
    rows = [(n, f"{words[n % 7]}, {words[n % 5]}-{words[n % 3]}2{words[n % 2]}\n") for n in range(700)]
    rows += [(None, "Elephant giraffes"), (5, None), (6, ""), (6, ""), (8, "Elephant " * 30_000 + "y" * 50_000)]
    got = {r.word: r.n for r in spelling.corpus_words(docs_of(rows).repartition(3)).collect()}
    assert got == plain_words(rows) and len(got) >= 20
    assert found(spelling.variants(spelling.corpus_words(docs_of(rows)))) == plain(got)


def test_chains_of_forms(spark):
    counts = {"aaaaaaa": 2, "aaaaaaab": 20, "aaaaaabb": 200, "aaaaabbb": 2_000, "aaaabbbb": 20_000, "aaabbbbb": 200_000, "aabbbbbb": 2_000_000}
    assert {r.root for r in spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()} == {"aabbbbbb"}


def test_empty_table(spark, docs_of):
    assert spelling.variants(spelling.corpus_words(docs_of([]))).collect() == []


def test_query_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    result = connection.execute(spelling.OP11_SQL)
    columns = [d[0] for d in result.description]
    got = spelling.op11_spelling_variants(spark, SF).select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, result.fetchall()))

import random
import re
from collections import Counter

from tests.llm.conftest import SF

from shelfstrata.llm.ngram_join import keep_one_of_each, least_matches, near_duplicates


def sets_of(texts):
    found = {}
    for i, text in texts.items():
        words = re.findall(r"\w+", (text or "").lower())
        found[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    return found


def brute(texts):
    sets = sets_of(texts)
    links = {i: set() for i in texts}
    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            shared = len(sets[i] & sets[j])
            if shared and shared >= 0.8 * len(sets[i] | sets[j]):
                links[i].add(j)
                links[j].add(i)
    group = {}
    for i in ids:
        if i not in group:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in group:
                    group[x] = i
                    todo += links[x]
    return {i: (group[i], len(links[i])) for i in ids}


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute({r.doc_id: r.text for r in docs.collect()})
    got = {r.doc_id: (r.class_id, r.n_links) for r in near_duplicates(docs).collect()}
    assert got == want


def test_groups_of_copies_and_chains(docs_of):
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    texts = {}
    for i in range(60):  # a group of near copies, more than one of which are copies of each other
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(120)] = f"x{rng.randrange(9)}"
        texts[i] = " ".join(words)
    texts |= {100 + i: " ".join(f"v{rng.randrange(5000)}" for _ in range(80)) for i in range(20)}
    texts |= {200: "", 201: None, 202: "...", 203: "two words", 204: "Two  words!", 205: "alone"}
    got = {r.doc_id: (r.class_id, r.n_links) for r in near_duplicates(docs_of(list(texts.items()))).collect()}
    assert got == brute(texts)


def test_odd_rows(docs_of, spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    docs = docs_of([(None, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, long), (3, long + " end"), (None, None)])
    got = sorted((r.doc_id or -1, r.class_id, r.n_links, r.kept) for r in near_duplicates(docs).collect())
    assert got == [(-1, None, 0, None), (-1, None, 0, None), (1, 1, 0, True), (1, 1, 0, True), (2, 2, 1, True), (3, 2, 1, False)]
    assert near_duplicates(docs.where("false")).count() == 0


def test_bounds_of_matches():
    fewest = least_matches()
    assert fewest == sorted(fewest) and all(m < k or k == 0 for k, m in enumerate(fewest))
    assert 45 < fewest[96] < 77  # 0.8 of 96 is never dropped


def _other_texts():
    """Two texts that have nothing in common, and a near copy of each."""
    x, y = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    return x, y, x + " end", y + " end"


def test_an_id_with_texts_that_have_nothing_in_common(docs_of):
    x, y, x2, y2 = _other_texts()
    rows = [(3, x2), (7, x), (7, y), (9, y2), (5, ""), (5, "..."), (5, "one word"), (5, "One WORD"), (5, "..."), (None, x)]
    docs = docs_of(rows)
    got = Counter((r.doc_id, r.class_id, r.n_links, r.copy_id, r.kept) for r in near_duplicates(docs).collect())
    want = [(3, 3, 1, 3, True), (7, 3, 1, 7, False), (7, 7, 1, 7, True), (9, 7, 1, 9, False), *[(5, 5, 0, 5, True)] * 5, (None, None, 0, None, None)]
    assert got == Counter(want)
    kept = Counter((r.doc_id, r.text.lower()) for r in keep_one_of_each(docs).collect())
    assert kept == Counter([(3, x2), (7, y), (5, ""), (5, "..."), (5, "one word"), (None, x)])


def test_the_row_that_stays_does_not_depend_on_the_order(docs_of, spark):
    x, _, x2, _ = _other_texts()
    rows = [(1, x, f"lang {i}", "s") for i in range(40)] + [(1, x2, "lang", "s"), (1, x.upper(), "lang", "s")]
    stay = [keep_one_of_each(docs_of(r).repartition(n)).collect() for r, n in ((rows, 1), (rows[::-1], 7))]
    assert stay[0] == stay[1] and len(stay[0]) == 1


def test_repeated_rows_with_a_near_duplicate(docs_of):
    x, _, x2, _ = _other_texts()
    rows = [(2, x), (3, x2)] * 3 + [(2, x.upper()), (4, x2), (4, x2)]
    got = {(r.doc_id, r.class_id, r.n_links, r.copy_id, r.kept) for r in near_duplicates(docs_of(rows)).collect()}
    assert got == {(2, 2, 2, 2, True), (3, 2, 2, 3, False), (4, 2, 2, 3, False)}


def test_texts_are_shuffled_once_to_keep_one_of_each(docs_of, spark, tmp_path, capsys):
    """Reading up from each scan of the texts, there is one exchange, or none for rows without an id."""
    x, y, x2, y2 = _other_texts()
    docs_of([(1, x), (2, x2), (3, y), (3, y), (None, y2)]).write.parquet(f"{tmp_path}/docs")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keep_one_of_each(spark.read.parquet(f"{tmp_path}/docs")).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above, found = [], []
    for line in capsys.readouterr().out.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        above = [(d, text) for d, text in above if d < depth]
        if "FileScan" in line and "text" in line:
            found.append(sum("Exchange" in text for _, text in above))
        above.append((depth, line))
    assert sorted(found) == [0, 1]

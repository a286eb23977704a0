import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import SF

from shelfstrata.llm import suffix_dedup
from shelfstrata.llm.suffix_blocks import COVER, PERIOD, cover_ranks, equal_windows
from shelfstrata.llm.suffix_dedup import _summed, _with_spans, without_repeats


def brute(texts, width=400):
    """(bytes, removed, runs, digest) per text, by counting every window."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=np.int64)
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                gone[i] += 1
                gone[i + width] -= 1 if i + width <= len(d) else 0
        mask = np.cumsum(gone)[: len(d)] > 0
        runs = int((mask & ~np.append(False, mask[:-1])[: len(mask)]).sum()) if len(mask) else 0
        kept = bytes(b for b, m in zip(d, mask) if not m)
        out.append((len(d), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def summed(docs):
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return sorted(tuple(r)[0:] for r in _with_spans(docs).select("doc_id", "bytes", "spans").mapInArrow(_summed, schema).collect())


def test_cover_is_perfect():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_equal_windows_against_sets():
    rng = random.Random(1)
    base = bytes(rng.randrange(97, 100) for _ in range(3000))
    text = base + bytes(rng.randrange(97, 100) for _ in range(700)) + base[500:1600] + b"a" * 900 + base[1000:1401]
    starts = np.arange(len(text) - 400 + 1)
    seen = Counter(text[i : i + 400] for i in starts)
    got = equal_windows(np.frombuffer(text, dtype=np.uint8), starts, np.zeros(len(starts), dtype=np.int64), 400)
    assert got.tolist() == [seen[text[i : i + 400]] > 1 for i in starts]
    ranks = cover_ranks(np.frombuffer(text, dtype=np.uint8))
    sample = [i for i in range(len(text) - 380) if i % PERIOD in COVER]
    assert all((ranks[i] == ranks[j]) == (text[i : i + 380] == text[j : j + 380]) for i in sample[::7] for j in sample[::5])


def make_texts(rng):
    alphabet = "abcdefghijklmnop éü"
    fresh = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    passage, long = fresh(450), fresh(2500)
    texts = [long, long, long[:399], long[100:499], long[100:500], None, "", "short", fresh(399), fresh(400)]
    texts += [fresh(rng.randrange(600)) + passage + fresh(rng.randrange(600)) for _ in range(12)]
    texts += [fresh(30) + passage[:398] + fresh(300), passage[: len(passage) - 1] + "#", "x" + passage[1:]]
    for _ in range(8):  # near copies
        t = list(long)
        for _ in range(3):
            t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    repeated = fresh(450)
    texts += [repeated + fresh(50) + repeated, "z" * 1500, "ab" * 700, fresh(200) + "z" * 401, fresh(1), "q" * 400, "q" * 401 + "r"]
    return texts


@pytest.mark.parametrize("large, hot, bits", [(suffix_dedup.LARGE, suffix_dedup.HOT, 128), (3, 2, 128), (1, 1, 3), (1, 1, 0)])
def test_equals_brute_force(docs_of, monkeypatch, large, hot, bits):
    """Also where nearly every anchor is a large one, and hashes of few bits leave all to the bytes."""
    monkeypatch.setattr(suffix_dedup, "LARGE", large)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SPREAD_BITS", bits)
    texts = make_texts(random.Random(large))
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[0]), (None, texts[9]), (None, None)]
    want = sorted(((-1 if i is None else i), *b) for (i, _), b in zip(rows, brute([t for _, t in rows])))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    got = _with_spans(docs_of(rows)).select("doc_id", "bytes", "spans").mapInArrow(_summed, schema).collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == want


def test_many_contexts_of_one_anchor_and_many_copies(spark):
    """A passage in 5,000 texts that differ around it, and one text 100,000 times."""
    rng = random.Random(5)
    fresh = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passage, copy = fresh(403), fresh(420)
    varied = [(i, fresh(80) + passage + fresh(80), "x") for i in range(5_000)]
    docs = spark.createDataFrame([*varied, (5_000, fresh(900), "x")], "doc_id long, text string, words string")
    docs = docs.unionByName(spark.range(6_000, 106_000).selectExpr("id as doc_id", f"'{copy}' as text", "'x' as words"))
    got = {r[0]: tuple(r)[1:] for r in summed(docs)}
    want = brute([t for _, t, _ in varied])
    assert all(got[i] == w and w[1] >= 403 for i, w in enumerate(want))
    assert got[5_000][1:3] == (0, 0)
    assert len(got) == 105_001 and all(got[i] == (420, 420, 1, hashlib.sha256(b"").hexdigest()) for i in range(6_000, 106_000))


def test_long_document_in_parts(docs_of):
    rng = random.Random(9)
    fresh = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    # Copies of a passage, one of them across the place where a long text is cut into parts.
    passage, part = fresh(450), suffix_dedup.PIECE
    before, after = fresh(part - 200), fresh(part)
    long = before + passage + after + passage + "#"
    got = {r[0]: tuple(r)[2:] for r in summed(docs_of([(1, long), (2, "x" + fresh(600))]))}
    assert got[1] == (900, 2, hashlib.sha256((before + after + "#").encode()).hexdigest())
    assert got[2][:2] == (0, 0)


def test_test_data(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = docs.orderBy("doc_id").collect()
    assert summed(docs) == [(r.doc_id, *b) for r, b in zip(rows, brute([r.text for r in rows]))]
    left = {r.doc_id: bytes(r.bytes) for r in without_repeats(docs).collect()}
    assert hashlib.sha256(left[rows[0].doc_id]).hexdigest() == summed(docs)[0][4]


def test_empty_table(docs_of):
    assert summed(docs_of([(1, "x")]).where("false")) == []

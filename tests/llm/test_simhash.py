import hashlib
import math
import re

import numpy as np
import pytest
import xxhash

from shelfstrata.llm import simhash
from shelfstrata.llm.common import table
from tests.llm.conftest import SF

MASK = (1 << 64) - 1


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def plain(text):
    """A fingerprint vote by vote, with whole numbers of any size."""
    words = re.findall(r"\w+", text.lower()) or list(text.lower())
    hashes = [xxhash.xxh3_64_intdigest(w) for w in words]
    terms = [(a * int(simhash._LEFT) + b * int(simhash._RIGHT)) & MASK for a, b in zip(hashes, hashes[1:])] if len(words) > 1 else hashes
    votes = [0] * simhash.BITS
    for term in set(terms):
        weight = round(1_000 * (1 + math.log(terms.count(term))))
        data = b"".join(mixed((term + k * int(simhash._STEP)) & MASK).to_bytes(8, "little") for k in range(1, simhash.BITS // 64 + 1))
        for bit in range(simhash.BITS):
            votes[bit] += weight if data[bit // 8] >> (7 - bit % 8) & 1 else -weight
    return np.packbits(np.array(votes) > 0).tobytes()


def expected(rows):
    """By the definition; rows are in turn."""
    made = [plain(t or "") for _, t in rows]
    found = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        like = [max(0.0, math.cos(math.pi * bin(int.from_bytes(made[i]) ^ int.from_bytes(o)).count("1") / simhash.BITS)) for o in (plain(new), made[(i + 1) % len(rows)])]
        near = sum(bin(int.from_bytes(made[i]) ^ int.from_bytes(o)).count("1") <= simhash.RADIUS for o in made) - 1
        found.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), made[i].hex(), plain(new).hex(), *[round(x, 9) for x in like], near))
    return found


def rows_of(df):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9), r.n_near) for r in df.collect()]


def test_equals_the_definition(spark, docs_of, monkeypatch):
    monkeypatch.setattr(simhash, "TERMS", 7)
    words = "one two three four five six seven eight nine ten éleven twelve".split()
    rows = [(n, " ".join(words[(n * k) % 12] for k in range(1, 3 + n % 40))) for n in range(200, 0, -1)]
    rows += [(0, None), (-1, ""), (-2, "!?"), (-3, "one"), (-4, "😀 é\n" * 3), (-5, "one two " * 40_000), (None, "no id")]
    assert sorted(map(str, rows_of(simhash.fingerprinted(docs_of(rows).repartition(5))))) == sorted(map(str, expected(rows)))


@pytest.mark.parametrize("tile", [2, 2_048])
def test_all_fingerprints_within_the_radius(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE_ROWS", tile)
    random = np.random.default_rng(5)
    centres = random.integers(0, 256, (40, simhash.WIDTH), dtype=np.uint8)
    made = []
    for centre in centres:
        for flips in range(0, 12):
            bits = np.unpackbits(centre)
            bits[random.choice(simhash.BITS, flips, replace=False)] ^= 1
            made += [np.packbits(bits).tobytes()] * (1 + flips % 2)
    found = simhash.near_fingerprints(spark.createDataFrame([(bytearray(m),) for m in made], "fingerprint binary")).collect()
    assert {bytes(r.fingerprint): (r.copies, r.near) for r in found} == {
        m: (made.count(m), sum(o != m and (int.from_bytes(m) ^ int.from_bytes(o)).bit_count() <= simhash.RADIUS for o in made)) for m in set(made)
    }


def test_one_row_no_row_and_rows_of_one_id(spark, docs_of):
    assert rows_of(simhash.fingerprinted(docs_of([(4, "a b c d e f")]))) == expected([(4, "a b c d e f")])
    assert simhash.fingerprinted(docs_of([])).collect() == []
    texts = ["a b", "c d", "c d"]
    in_turn = sorted(texts, key=lambda t: xxhash.xxh3_64_intdigest(t) - (1 << 63))
    found = rows_of(simhash.fingerprinted(docs_of([(4, t) for t in texts])))
    assert sorted(found) == sorted(expected([(4, t) for t in in_turn]))


def test_a_fingerprint_that_most_rows_have(spark, docs_of):
    rows = [(n, "the same words in each of them" if n % 3 else f"other words number {n}") for n in range(3_000, 0, -1)]
    found = simhash.fingerprinted(docs_of(rows).repartition(4))
    assert found.count() == 3_000
    assert found.where("n_near >= 1999").count() == 2_000


def test_query_tells_edited_texts_from_the_next(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    found = simhash.op13_simhash_fingerprints(spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    assert all(r.fingerprint == simhash.Fingerprints()(docs[r.doc_id] or "").hex() for r in found[:50])
    long = [r for r in found if r.n_chars > 500]
    assert sum(r.near_edited > r.near_next for r in long) > 0.97 * len(long)

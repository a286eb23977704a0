r"""N-gram Jaccard join with Bayesian candidate pruning, and the near-duplicate groups it gives.

1. Every text becomes its set of word shingles. Documents with equal sets are one class, known by a hash of
   the set; only the text of its smallest id goes on, so any number of copies costs as much as one.
2. A class has a signature of `HASHES` MinHash values. Classes that agree in any of `BANDS` bands share a
   bucket; a pair with a similarity of 0.8 misses all bands with a probability of 3e-6.
3. Pairs of a bucket are compared `STEP` values at a time. With m of k values equal, the posterior of the
   similarity is Beta(m + 1, k - m + 1), from a uniform prior; once the probability that it reaches the
   threshold is below `TOLERANCE`, the pair is dropped. A pair that shares many buckets is only compared in
   the first one.
4. What is left is verified exactly on the shingle sets.

Pairs live only inside a task, and never leave it as rows: a task returns, per class, how many documents it
is linked with and the smallest member of the group it sees. A bucket of any size is dealt out in tiles of
at most two blocks of `BLOCK` classes, so a task holds few sets at a time. Groups are then joined as connected components.

Words are runs of letters, digits and underscores, in lower case. A text with fewer than `SHINGLE` words is
one shingle.

Defined cases: a NULL text or one without words links with nothing and is its own class; a NULL doc_id
takes no part and has a NULL class; rows that repeat an id are one document if their shingle sets are equal, and
documents of their own otherwise; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstrata.llm.common import checkpoint, ship_code, table
from shelfstrata.llm.components import components
from shelfstrata.llm.runs import grouped, whole_runs

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 4, 24
HASHES = ROWS * BANDS
STEP = 16
TOLERANCE = 1e-4
BLOCK = 512
#: Pairs that are compared at once inside a task.
PAIRS = 1 << 17
#: Words whose hashes a task remembers.
REMEMBERED = 500_000

_WORD = re.compile(r"\w+")
_SEEDS = np.random.default_rng(20240501)
_FLIPS = _SEEDS.integers(0, 2**64, HASHES, dtype=np.uint64)
_FACTORS = _SEEDS.integers(0, 2**64, HASHES, dtype=np.uint64) | np.uint64(1)
_PLACES = _SEEDS.integers(0, 2**64, SHINGLE + 1, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, hashes: dict[str, int], n: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word n-grams."""
    words = _WORD.findall(text.lower()) if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter((hashes[x] for x in words), dtype=np.uint64, count=len(words))
    k = min(n, len(w))
    h = np.full(len(w) - k + 1, k, dtype=np.uint64) * _PLACES[SHINGLE]
    for i in range(k):
        h = _mixed(h + w[i : len(w) - k + 1 + i] * _PLACES[i % SHINGLE])
    return np.unique(h)


def signature(shingles: np.ndarray) -> np.ndarray:
    """`HASHES` MinHash values, each brought down to 16 bits."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 2048):
        np.minimum(least, ((shingles[i : i + 2048, None] ^ _FLIPS) * _FACTORS).min(axis=0), out=least)
    return (_mixed(least) >> np.uint64(48)).astype(np.uint16)


def _class_of(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell shingle sets apart."""
    digest = xxhash.xxh3_128_digest(shingles.tobytes())
    return tuple(np.frombuffer(digest, dtype=np.int64).tolist())


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for batch in batches:
        ids, text_hashes, rows = batch.column("doc_id"), batch.column("t"), []
        for text in batch.column("text"):
            s = shingle_set(text.as_py(), hashes)
            rows.append((*_class_of(s), signature(s).tobytes()) if len(s) else (None, None, None))
        c1, c2, sig = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), text_hashes, pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array(sig, pa.binary())],
            ["doc_id", "t", "c1", "c2", "sig"],
        )


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, hashes: int = HASHES) -> list[int]:
    """For each number k of compared values, the fewest equal ones that keep a pair.

    P(similarity >= t) under Beta(m + 1, k - m + 1) is P(Binomial(k + 1, t) <= m).
    """
    fewest = []
    for k in range(hashes + 1):
        below, m = 0.0, 0
        while m <= k:
            below += comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if below >= tolerance:
                break
            m += 1
        fewest.append(m)
    return fewest


def pairs_of_runs(starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs i < j of rows of the same run, a bounded number at a time."""
    end = np.repeat(starts[1:], np.diff(starts))
    active, distance, held, count = np.arange(len(end)), 1, [], 0
    while True:
        active = active[active + distance < end[active]]
        if not len(active):
            break
        held.append((active, active + distance))
        count += len(active)
        if count >= PAIRS:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, count = [], 0
        distance += 1
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def surviving(sig: np.ndarray, band: np.ndarray, i: np.ndarray, j: np.ndarray, fewest: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that incremental comparison does not drop, each only in the first band that it shares."""
    equal = np.zeros(len(i), dtype=np.int32)
    for k in range(0, HASHES, STEP):
        equal += (sig[i, k : k + STEP] == sig[j, k : k + STEP]).sum(axis=1, dtype=np.int32)
        keep = equal >= fewest[k + STEP]
        i, j, equal = i[keep], j[keep], equal[keep]
    whole = sig.view(np.uint64)
    first = (whole[i] == whole[j]).argmax(axis=1) == band[i]
    return i[first], j[first]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, width)


TILE = ("band", "bucket", "low", "high")
#: What tells a class: its smallest id, which alone may belong to several classes, and the hash of its shingle set.
NODE = ("rep", "c1", "c2")


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per tile and class with a pair left: the class, its place in the tile, and the places it is to be verified with."""
    fewest = least_matches()
    for rows, starts in whole_runs(batches, *TILE):
        sig, band = _matrix(rows.column("sig"), HASHES), rows.column("band").to_numpy()
        side = rows.column("side").to_numpy()
        across = rows.column("low").to_numpy() != rows.column("high").to_numpy()
        found = [(np.empty(0, np.int64),) * 2]
        for i, j in pairs_of_runs(starts):
            wanted = ~across[i] | (side[i] != side[j])
            found.append(surviving(sig, band, i[wanted], j[wanted], fewest))
        i, j = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        members = np.union1d(i, j)
        low, high = np.searchsorted(i, members), np.searchsorted(i, members, side="right")
        partners = [j[a:b] for a, b in zip(low, high)]
        if len(members):
            kept = rows.select([*TILE, *NODE, "t", "copies"]).take(pa.array(members))
            kept = kept.append_column("place", pa.array(members, pa.int64()))
            kept = kept.append_column("partners", pa.array(partners, pa.list_(pa.int64())))
            yield from kept.combine_chunks().to_batches()


def _tuples(batch: pa.RecordBatch, names: tuple[str, ...]) -> Iterator[tuple]:
    return zip(*(batch.column(x).to_pylist() for x in names))


def _with_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each class of a tile with its shingles. A join brings repeated rows one after the other; one of them goes on."""
    hashes, last, packed, seen = _WordHashes(), None, None, set()
    for batch in batches:
        taken, sets = [], []
        for n, (node, spot, text) in enumerate(zip(_tuples(batch, NODE), _tuples(batch, (*TILE, "place")), batch.column("text"))):
            if node != last:
                last, packed, seen = node, None, set()
            if packed is None:
                found = shingle_set(text.as_py(), hashes)
                # Texts of one id are told apart by a hash; should two have the same, the class decides.
                if not len(found) or _class_of(found) != node[1:]:
                    continue
                packed = found.tobytes()
            if spot not in seen:
                seen.add(spot)
                taken.append(n)
                sets.append(packed)
        out = pa.table(batch.select([*TILE, *NODE, "copies", "place", "partners"])).take(pa.array(taken, pa.int64()))
        yield from out.append_column("shingles", pa.array(sets, pa.binary())).combine_chunks().to_batches()


def _once(rows: pa.Table, starts: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """The first row of each place of a run, with the starts of the runs."""
    place = rows.column("place").to_numpy()
    first = [a + np.sort(np.unique(place[a:b], return_index=True)[1]) for a, b in zip(starts, starts[1:])]
    return rows.take(pa.array(np.concatenate(first))), np.append(0, np.cumsum([len(x) for x in first]))


def _root(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = x = parent[parent[x]]
    return x


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per tile and class: with how many documents it is linked here, and a class it is grouped with."""
    for rows, starts in whole_runs(batches, *TILE):
        rows, starts = _once(rows, starts)
        place, copies = rows.column("place").to_numpy(), rows.column("copies").to_numpy()
        packed, partners = rows.column("shingles").to_pylist(), rows.column("partners").to_pylist()
        links, parent = np.zeros(len(place), dtype=np.int64), np.arange(len(place))
        for start, end in zip(starts, starts[1:]):
            sets = [np.frombuffer(x, dtype=np.uint64) for x in packed[start:end]]
            size = np.array([len(s) for s in sets])
            _, ids = np.unique(np.concatenate(sets), return_inverse=True)
            bounds = np.append(0, np.cumsum(size))
            at = {r: n for n, r in enumerate(place[start:end].tolist())}
            mark = np.zeros(len(ids), dtype=np.int64)
            for i in range(end - start):
                others = np.array([at[r] for r in partners[start + i] if r in at], dtype=np.int64)
                if not len(others):
                    continue
                mark[ids[bounds[i] : bounds[i + 1]]] = 1
                shared = np.array([mark[ids[bounds[o] : bounds[o + 1]]].sum() for o in others])
                mark[ids[bounds[i] : bounds[i + 1]]] = 0
                for o in others[shared >= THRESHOLD * (size[i] + size[others] - shared) - 1e-9]:
                    links[start + i] += copies[start + o]
                    links[start + o] += copies[start + i]
                    a, b = _root(parent, start + i), _root(parent, start + o)
                    parent[max(a, b)] = min(a, b)
        linked = np.flatnonzero(links)
        roots = np.array([_root(parent, x) for x in linked], dtype=np.int64)
        nodes = [rows.column(x).to_numpy() for x in NODE]
        yield pa.RecordBatch.from_arrays(
            [pa.array(links[linked]), *[pa.array(x[linked]) for x in nodes], *[pa.array(x[roots]) for x in nodes]],
            ["links", *NODE, *[f"root_{x}" for x in NODE]],
        )


def _judged(docs: DataFrame) -> DataFrame:
    """`near_duplicates` with two more columns: `t`, a hash of the text, and `first`.

    `first` marks, of the rows of a document, those with the smallest hash of their text.
    """
    ship_code(docs.sparkSession)
    hashed = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    signed = checkpoint(hashed.mapInArrow(_signed, "doc_id long, t long, c1 long, c2 long, sig binary"))
    known = signed.where("doc_id is not null and c1 is not null")
    classes = known.groupBy("c1", "c2").agg(
        F.min(F.struct("doc_id", "t")).alias("least"), F.count_distinct("doc_id").alias("copies"), F.min("sig").alias("sig")
    )
    classes = checkpoint(classes.select("c1", "c2", F.col("least.doc_id").alias("rep"), "least.t", "copies", "sig"))
    # Buckets with more than one class, dealt out in tiles.
    width = 2 * ROWS
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(b.alias("band"), F.substring("sig", b * width + 1, F.lit(width)).alias("bucket")))
    banded = classes.select("c1", "c2", F.inline(bands)).select("c1", "c2", "band", F.xxhash64("bucket").alias("bucket"))
    # Grouped in a struct, so that the join shuffles anew and can split a bucket with very many classes.
    shared = banded.groupBy(F.struct("band", "bucket").alias("of")).agg(F.count(F.lit(1)).alias("members"))
    shared = shared.where("members > 1").select("of.*", "members")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    side = F.pmod(F.xxhash64("c1", "c2", "band"), blocks).cast("int")
    placed = banded.join(shared, ["band", "bucket"]).select("c1", "c2", "band", "bucket", blocks.alias("blocks"), side.alias("side"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiled = placed.withColumn("other", other).withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")})
    tiled = tiled.join(classes, ["c1", "c2"]).select(*TILE, "side", *NODE, "t", "copies", "sig")
    tile = "band int, bucket long, low int, high int, "
    node = "rep long, c1 long, c2 long, "
    pruned = checkpoint(grouped(tiled, *TILE).mapInArrow(_pruned, tile + node + "t long, copies long, place long, partners array<long>"))
    texts = hashed.withColumnRenamed("doc_id", "rep").join(pruned, ["rep", "t"])
    sets = texts.select(*TILE, *NODE, "copies", "place", "partners", "text")
    sets = sets.mapInArrow(_with_shingles, tile + node + "copies long, place long, partners array<long>, shingles binary")
    found = grouped(sets, *TILE).mapInArrow(_verified, "links long, " + node + "root_rep long, root_c1 long, root_c2 long")
    this, root = F.struct(*NODE), F.struct(*[F.col(f"root_{x}").alias(x) for x in NODE])
    found = checkpoint(found.select("links", this.alias("node"), root.alias("root")))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    judged = classes.select(this.alias("node"), F.col("t").alias("least_t"), "copies").join(links, "node", "left").join(groups, "node", "left")
    # Joined by the node in a struct until here, so that the next join shuffles anew and can split a class with very many copies.
    judged = judged.select("node.*", "node", F.coalesce("component", "node").alias("component"), "least_t", "copies", "links")
    rows = known.select("doc_id", "t", "c1", "c2").join(judged, ["c1", "c2"]).select(
        "doc_id",
        F.col("component.rep").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.col("rep").alias("copy_id"),
        ((F.col("node") == F.col("component")) & (F.col("doc_id") == F.col("rep"))).alias("kept"),
        "t",
        (F.col("t") == F.col("least_t")).alias("first"),
    )
    own, id_ = signed.where("doc_id is null or c1 is null"), F.col("doc_id")
    return rows.union(own.select("doc_id", id_, F.lit(0).cast("long"), id_, id_ == id_, "t", F.lit(True)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, class_id (smallest id of its group of near-duplicates), n_links, copy_id, kept.

    `n_links` counts the other documents that it is similar to, `copy_id` is the smallest id with the same
    shingle set, and `kept` marks the one document of each group that stays: the one with the smallest id, and
    of several texts of that id the one with the smallest hash of its shingle set.
    """
    return _judged(docs).drop("t", "first")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` without the near-duplicates of a document that stays; of rows that repeat a document, one stays.

    It is the one with the smallest hash of its text, then of its other columns. Rows whose id is NULL take no
    part and stay; texts without words stay, once for each id and text.
    """
    kept = _judged(docs).where("kept and first").select(F.col("doc_id").alias("_id"), F.col("t").alias("_t")).distinct()
    key = F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_t")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    order = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    # Repeated rows are merged by the key that the join needs, on the map side first: texts are shuffled once, and a
    # document repeated very often is a row per map task.
    keyed = docs.where("doc_id is not null").select(*key, row.alias("row"), order.alias("_order"))
    first = keyed.groupBy("_id", "_t").agg(F.min_by("row", "_order").alias("row")).join(kept, ["_id", "_t"], "left_semi")
    return first.select("row.*").unionByName(docs.where("doc_id is null"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: Every pair that shares a shingle, and groups by following links.
OP2_SQL = r"""
with recursive words as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as w from documents),
grams as (
  select distinct doc_id, w[i : i + least(len(w), 5) - 1] as gram
  from (select *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared from grams a join grams b
  on a.gram = b.gram and a.doc_id <> b.doc_id group by all),
links as (
  select a, b, shared = x.n and shared = y.n as equal from pairs join sizes x on a = x.doc_id join sizes y on b = y.doc_id
  where shared >= 0.8 * (x.n + y.n - shared) - 1e-9),
reach as (select doc_id as node, doc_id as seen from documents union select r.node, l.b from reach r join links l on r.seen = l.a),
groups as (select node as doc_id, min(seen) as class_id from reach group by node),
counts as (select a as doc_id, count(*) as n_links, min(b) filter (equal) as copy from links group by a)
select doc_id, class_id, coalesce(n_links, 0) as n_links, least(doc_id, coalesce(copy, doc_id)) as copy_id, class_id = doc_id as kept
from documents left join groups using (doc_id) left join counts using (doc_id)
"""

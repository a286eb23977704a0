"""Document fingerprints by SimHash, and all fingerprints within a Hamming radius by permuted block tables.

The terms of a text are its pairs of neighbouring words, in lower case; a term that occurs n times weighs 1 + ln n,
in whole thousandths, so that sums do not depend on their order. Each term has a hash of `BITS` bits; where a bit is set the
term votes for it with its weight, and else against it. The fingerprint holds the bits that won. The angle between the weighted terms of two texts shows as the share of bits in which
their fingerprints differ, so the cosine of that angle is their likeness.

Fingerprints that differ in at most `RADIUS` bits agree in one of `RADIUS` + 1 blocks at least. There is a table for each
block, in which that block leads; fingerprints with an equal block meet there, and a pair is told in the first table in
which it meets. Equal fingerprints are one row with a count, and blocks with many fingerprints are dealt out in tiles.

Documents in turn are found by ranges of their ids: texts are sent to the ranges once, compressed, and each range is read
from its largest id to its smallest. The ends of neighbouring ranges, two rows for each, are joined afterwards.

Defined cases: ids are integers; NULL ids come after all others; a NULL text is empty; a text without words has its
characters for words, an empty one no term and no bit set; rows of one id are ordered by a hash of their text; a table of
one row is followed by itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfstrata.llm.common import ship_code, table, written
from shelfstrata.llm.ngram_join import pairs_of_runs
from shelfstrata.llm.runs import grouped, whole_runs

BITS, RADIUS = 256, 7
WIDTH = BITS // 8
#: Fingerprints of a block table that are compared with all others of their block in one place.
TILE_ROWS = 2_048
#: Terms whose bits are laid out at once; words whose hashes are remembered; pairs that are compared at once.
TERMS, WORDS, PAIRS = 8_192, 1 << 18, 1 << 20
#: Ranges of ids for each shuffle partition.
RANGES = 4
#: Fingerprints with more than this share of all rows, of which there are at most 1 / SHARE, are sent to every task.
SHARE = 1e-3

_WORD = re.compile(r"\w+")
_LEFT, _RIGHT, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Fingerprints:
    """Makes fingerprints; remembers the hashes of words."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        if len(self.known) >= WORDS:
            self.known.clear()
        value = self.known[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def terms(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the terms of a text and their weights."""
        lower = text.lower()
        words = _WORD.findall(lower) or list(lower)
        known = self.known
        hashes = np.fromiter((known[w] if w in known else self._hash(w) for w in words), np.uint64, len(words))
        with np.errstate(over="ignore"):
            pairs = hashes[:-1] * _LEFT + hashes[1:] * _RIGHT if len(words) > 1 else hashes
        found, counts = np.unique(pairs, return_counts=True)
        return found, np.rint(1_000 * (1 + np.log(counts)))

    def __call__(self, text: str) -> bytes:
        found, weights = self.terms(text)
        votes = np.zeros(BITS)
        steps = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * _STEP
        for at in range(0, len(found), TERMS):
            with np.errstate(over="ignore"):
                words = _mixed(found[at : at + TERMS, None] + steps)
            bits = np.unpackbits(words.view(np.uint8), axis=1)
            votes += weights[at : at + TERMS] @ bits
        return np.packbits(2 * votes > weights.sum()).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The cosine that the differing bits of two fingerprints stand for, 0 at least."""
    differing = (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    return max(0.0, float(np.cos(np.pi * differing / BITS)))


def edited(text: str, following: str) -> str:
    """`text` with the last half of its code points replaced by as many of the following text, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


PACKED = "doc_id long, part int, tie long, n_chars long, fingerprint binary, packed binary"
_PACKED = [c.split()[0] for c in PACKED.split(", ")]


def _packer(bounds: list[int]):
    ends = np.array(bounds, dtype=np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, compress = Fingerprints(), zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            # Ranges are numbered from the largest ids down; rows without an id are the last one.
            known = np.searchsorted(ends, ids.fill_null(0).to_numpy(), side="left")
            part = np.where(ids.is_null().to_numpy(zero_copy_only=False), len(ends) + 1, len(ends) - known).astype(np.int32)
            raw = [t.encode("utf-8", "surrogatepass") for t in texts]
            columns = [
                ids, pa.array(part), pa.array([xxhash.xxh3_64_intdigest(r) - (1 << 63) for r in raw], pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()), pa.array([make(t) for t in texts], pa.binary()), pa.array([compress(r) for r in raw], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, _PACKED)

    return pack


FOUND = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, next_fingerprint binary"
#: A row at the end of a range, whose place it tells, has its text with it.
ENDED = FOUND + ", part int, first boolean, last boolean, packed binary"
_FOUND = [c.split()[0] for c in FOUND.split(", ")]
_ENDED = [c.split()[0] for c in ENDED.split(", ")]


class _Follower:
    """Makes the result of a row from its text and that of the row that follows it."""

    def __init__(self) -> None:
        self.make, self.open = Fingerprints(), zstandard.ZstdDecompressor().decompress

    def text(self, packed: bytes) -> str:
        return self.open(packed).decode("utf-8", "surrogatepass")

    def __call__(self, text: str, following: str) -> tuple[str, bytes]:
        new = edited(text, following)
        return hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), self.make(new)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"edited_sha256": pa.string(), "part": pa.int32(), "first": pa.bool_(), "last": pa.bool_(), "doc_id": pa.int64(), "n_chars": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.binary())) for c, n in zip(zip(*rows), names)], names)


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each with what follows it in its range. Of a range's ends the text goes on, to be joined."""
    follow, held = _Follower(), None
    for batch in batches:
        rows = []
        for doc_id, part, n_chars, made, packed in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "n_chars", "fingerprint", "packed"))):
            text = follow.text(packed)
            same = held is not None and held[1] == part
            if held is not None:
                rows.append(_row(follow, held, (text, made) if same else None))
            held = (doc_id, part, n_chars, made, packed, text, not same)
        if rows:
            yield _batch(rows, _ENDED)
    if held is not None:
        yield _batch([_row(follow, held, None)], _ENDED)


def _row(follow: _Follower, held: tuple, following: tuple[str, bytes] | None) -> tuple:
    doc_id, part, n_chars, made, packed, text, first = held
    digest, new = follow(text, following[0]) if following else (None, None)
    return doc_id, n_chars, digest, made, new, following and following[1], part, first, following is None, packed if first or following is None else None


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    follow = _Follower()
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            digest, new = follow(follow.text(row["packed"]), follow.text(row["next_packed"]))
            rows.append((row["doc_id"], row["n_chars"], digest, row["fingerprint"], new, row["next_fingerprint"]))
        if rows:
            yield _batch(rows, _FOUND)


def fingerprints(docs: DataFrame) -> DataFrame:
    """The columns `FOUND` of each row of `docs` (doc_id, text), next to the row with the next smaller id."""
    spark = docs.sparkSession
    ship_code(spark)
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [n / ranges for n in range(1, ranges)]
    bounds = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, 10 * ranges)).first()[0] or []
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    packed = texts.mapInArrow(_packer(sorted(set(bounds))), PACKED)
    order = ["part", F.col("doc_id").desc_nulls_last(), "tie"]
    rows = written(packed.repartition("part").sortWithinPartitions(*order).mapInArrow(_followed, ENDED))
    # A row for each range.
    heads = rows.where("first").select("part", F.col("fingerprint").alias("next_fingerprint"), F.col("packed").alias("next_packed"))
    turn = W.orderBy("part")
    least = F.min("part").over(turn.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    turns = rows.where("first").select("part").select("part", F.coalesce(F.lead("part").over(turn), least).alias("next_part"))
    ends = rows.where("last").drop("next_fingerprint").join(turns, "part")
    ends = ends.join(heads.withColumnRenamed("part", "next_part"), "next_part")
    closed = ends.select("doc_id", "n_chars", "fingerprint", "packed", "next_fingerprint", "next_packed").mapInArrow(_joined, FOUND)
    return rows.where("not last").select(*_FOUND).unionByName(closed)


BUCKET = ("block", "value", "low", "high")
_NEAR = "fingerprint binary, near long"


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per tile: the fingerprints with others within `RADIUS`, and how many documents these have."""
    for rows, starts in whole_runs(batches, *BUCKET):
        made = np.frombuffer(b"".join(rows.column("fingerprint").to_pylist()), np.uint64).reshape(-1, BITS // 64)
        blocks = np.stack([_block(made, b) for b in range(RADIUS + 1)], axis=1)
        block, copies, side = (rows.column(c).to_numpy() for c in ("block", "copies", "side"))
        across = rows.column("low").to_numpy() != rows.column("high").to_numpy()
        near = np.zeros(len(made), dtype=np.int64)
        for i, j in pairs_of_runs(starts):
            for at in range(0, len(i), PAIRS):
                a, b = i[at : at + PAIRS], j[at : at + PAIRS]
                keep = ~across[a] | (side[a] != side[b])
                a, b = a[keep], b[keep]
                keep = np.bitwise_count(made[a] ^ made[b]).sum(axis=1) <= RADIUS
                a, b = a[keep], b[keep]
                # Told in the first block that they share.
                keep = (blocks[a] == blocks[b]).argmax(axis=1) == block[a]
                a, b = a[keep], b[keep]
                np.add.at(near, a, copies[b])
                np.add.at(near, b, copies[a])
        found = np.flatnonzero(near)
        yield pa.RecordBatch.from_arrays([rows.column("fingerprint").take(pa.array(found)).combine_chunks(), pa.array(near[found])], ["fingerprint", "near"])


def _edges(b: int) -> tuple[int, int]:
    """First byte of a block, and the byte after its last: bytes are dealt out as evenly as they go."""
    return b * WIDTH // (RADIUS + 1), (b + 1) * WIDTH // (RADIUS + 1)


def _block(made: np.ndarray, b: int) -> np.ndarray:
    begin, end = _edges(b)
    out = np.zeros((len(made), 8), np.uint8)
    out[:, : end - begin] = made.view(np.uint8)[:, begin:end]
    return out.view(np.uint64).ravel()


def near_fingerprints(made: DataFrame) -> DataFrame:
    """Per distinct `fingerprint` of `made`: `copies`, its rows, and `near`, the rows of others within `RADIUS` bits of it."""
    ship_code(made.sparkSession)
    classes = written(made.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("copies")))
    tables = F.array(*[
        F.struct(F.lit(b).alias("block"), F.xxhash64(F.substring("fingerprint", _edges(b)[0] + 1, _edges(b)[1] - _edges(b)[0])).alias("value"))
        for b in range(RADIUS + 1)
    ])
    entries = classes.select("fingerprint", "copies", F.inline(tables))
    # Grouped in a struct, so that the join shuffles anew and can split a block that very many fingerprints have.
    shared = entries.groupBy(F.struct("block", "value").alias("of")).agg(F.count(F.lit(1)).alias("members"))
    shared = shared.where("members > 1").select("of.*", F.ceil(F.col("members") / TILE_ROWS).cast("int").alias("sides"))
    placed = entries.join(shared, ["block", "value"]).withColumn("side", F.pmod(F.xxhash64("fingerprint"), "sides").cast("int"))
    tiled = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    tiled = tiled.select(*BUCKET[:2], F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "fingerprint", "copies")
    found = grouped(tiled, *BUCKET).mapInArrow(_near, _NEAR).groupBy("fingerprint").agg(F.sum("near").alias("near"))
    return classes.join(found, "fingerprint", "left").select("fingerprint", "copies", F.coalesce("near", F.lit(0)).alias("near"))


_SCORED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own, new, following = (batch.column(c).to_pylist() for c in ("fingerprint", "edited_fingerprint", "next_fingerprint"))
        columns = [
            *[batch.column(c) for c in ("doc_id", "n_chars", "edited_sha256")],
            pa.array([x.hex() for x in own], pa.string()), pa.array([x.hex() for x in new], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(own, new)], pa.float64()), pa.array([likeness(a, b) for a, b in zip(own, following)], pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays([*columns, batch.column("n_near")], [c.split()[0] for c in _SCORED.split(", ")] + ["n_near"])


def fingerprinted(docs: DataFrame) -> DataFrame:
    """The columns `_SCORED` of each row of `docs`, and `n_near`: the other rows whose fingerprint is within `RADIUS` bits."""
    rows = written(fingerprints(docs))
    near = written(near_fingerprints(rows))
    total = F.lit(rows.count() * SHARE)
    # At most 1 / SHARE fingerprints have so many rows: these are sent to every task, and no task gets such a group.
    often = F.broadcast(near.where(F.col("copies") > total))
    number = (F.col("near") + F.col("copies") - 1).alias("n_near")
    marked = rows.join(often, "fingerprint", "left")
    rest = marked.where("copies is null").drop("copies", "near").join(near.where(F.col("copies") <= total), "fingerprint")
    judged = marked.where("copies is not null").select(*_FOUND, number).unionByName(rest.select(*_FOUND, number))
    return judged.mapInArrow(_scored, _SCORED + ", n_near long")


def op13_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(table(spark, sf_dir, "documents"))

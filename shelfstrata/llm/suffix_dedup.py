r"""Removal of long repeated substrings by a distributed suffix sort with a difference cover.

A byte goes if a string of `WIDTH` bytes that covers it also starts anywhere else. A suffix array of all text
would hold an entry per byte; here, what cannot repeat is set aside exactly before anything is sorted.

1. Every window of `WIDTH` bytes has an anchor: the k-gram of `GRAM` bytes in it with the smallest hash, the
   leftmost of equal ones. Equal windows have equal anchors at the same place, so windows can only equal those
   of an equal anchor. Neighbouring windows mostly share an anchor, which leaves one row per stretch of about
   170 windows. Stretches whose anchor occurs once repeat nowhere.
2. Stretches with equal text (copies) are one class, counted, and all their bytes go. Only one of each class
   goes on, and only if its anchor has other classes. Copies are told by anchor, place, length and two polynomial
   hashes of 64 bits each; their bytes are not compared. On the given documents most of what is removed lies in
   such copies (93 % of the removed windows at sf0.1).
3. These are suffix buckets: the windows of an anchor at about the same distance that share the bytes all of
   them contain. Tasks sort the suffixes of one block of buckets at a time, ties being resolved by the ranks of a
   difference cover (`suffix_blocks`), and mark the windows that equal another one.
4. An anchor with more than `LARGE` classes would make a bucket without bound. Its windows are spread by a
   128-bit hash of their whole text instead. Windows that share a hash then meet by their bytes, counted on the
   map side first; where different bytes share a hash, the bytes decide.

Every text meets the others only through these rows; no task holds more than a block of buckets.

Defined cases: a NULL text is empty; rows that repeat an id are documents of their own; windows never cross
documents; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstrata.llm.common import broadcast_if_small, checkpoint, ship_code, table, written
from shelfstrata.llm.runs import grouped, whole_runs
from shelfstrata.llm.suffix_blocks import equal_windows

WIDTH = 400
GRAM = 64
SPAN = WIDTH - GRAM + 1
#: Windows of an anchor that share a suffix bucket.
RANGE = 112
#: Classes of an anchor up to which its windows are sorted in one place.
LARGE = 4_000
#: Stretches of a class beyond which its members look it up in a broadcast, not in a shuffle on the class.
HOT = 2_000
#: Bits of the hash that spreads the windows of a large anchor, in two numbers.
SPREAD_BITS = 128
#: Bytes of text that are anchored at once; a position must fit into `PLACE_BITS`.
PIECE, PLACE_BITS = 1 << 19, 20
#: Bytes of text that a task sorts at once, unless one bucket has more.
BLOCK_BYTES = 4 << 20

_RNG = np.random.default_rng(20240601)
_LETTERS = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE, _BASE_2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.append(np.uint64(1), np.cumprod(np.full(n, base, dtype=np.uint64)))


class _Anchors:
    """Finds the anchors of pieces of text."""

    def __init__(self) -> None:
        self.powers = [(_powers(int(b), 1 << PLACE_BITS), _powers(pow(int(b), -1, 1 << 64), 1 << PLACE_BITS)) for b in (_BASE, _BASE_2)]

    def __call__(self, text: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
        """First start, number of starts, anchor, its hash, and two hashes of all bytes, of each stretch.

        `valid` marks the starts of windows that lie inside one document.
        """
        values, n = _LETTERS[text], len(text)
        h, size, power = values, 1, _BASE
        while size < GRAM:
            h = h[: len(h) - size] * power + h[size:]
            power, size = power * power, size * 2
        h = h * _MIX
        h ^= h >> np.uint64(32)
        h *= _MIX
        places = np.arange(len(h), dtype=np.uint64)
        keys = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | places
        padded = np.full(-(-len(keys) // SPAN) * SPAN + SPAN, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[: len(keys)] = keys
        blocks = padded.reshape(-1, SPAN)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - WIDTH + 1
        least = np.minimum(behind[:windows], ahead[SPAN - 1 : SPAN - 1 + windows])
        anchor = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        starts = np.flatnonzero(valid[:windows])
        if not len(starts):
            return (np.empty(0, dtype=np.int64),) * 6
        anchor = anchor[starts]
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1))
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(starts)))
        begin, anchor = starts[first], anchor[first]
        whole = []
        for up, down in self.powers:
            sums = np.append(np.uint64(0), np.cumsum(values * up[:n]))
            of_stretch = (sums[begin + count + WIDTH - 1] - sums[begin]) * down[begin]
            whole.append((of_stretch * _MIX).view(np.int64))
            values = values * _MIX ^ values >> np.uint64(29)
        return begin, count, anchor, h[anchor].view(np.int64), *whole


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Text, row and place in its document of each byte's row, valid starts; long documents in overlapping parts."""
    held, size = [], 0
    for row, value in enumerate(batch.column("bytes")):
        data = np.frombuffer(value.as_py(), dtype=np.uint8)
        for at in range(0, max(len(data) - WIDTH + 1, 0), PIECE):
            part = data[at : at + PIECE + WIDTH - 1]
            held.append((row, at, part))
            size += len(part)
            if size >= PIECE - WIDTH:
                yield _laid_out(held)
                held, size = [], 0
    if held:
        yield _laid_out(held)


def _laid_out(held: list[tuple[int, int, np.ndarray]]) -> tuple[np.ndarray, ...]:
    sizes = np.array([len(p) for _, _, p in held])
    ends = np.cumsum(sizes)
    valid = np.ones(ends[-1], dtype=bool)
    for end in ends:
        valid[max(0, end - WIDTH + 1) : end] = False
    return np.concatenate([p for _, _, p in held]), ends, np.array([[row, at] for row, at, _ in held]), valid


STRETCH = "key long, doc long, first int, n_starts int, anchor int, hash long, whole long, whole_2 long"
_STRETCH = [c.split()[0] for c in STRETCH.split(", ")]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    find = _Anchors()
    for batch in batches:
        keys, docs = batch.column("key").to_numpy(), batch.column("doc").to_numpy()
        for text, ends, parts, valid in _pieces(batch):
            begin, count, anchor, h, whole, whole_2 = find(text, valid)
            part = np.searchsorted(ends, begin, side="right")
            offset = parts[part, 1] - np.append(0, ends[:-1])[part]
            row = parts[part, 0]
            columns = [keys[row], docs[row], (begin + offset).astype(np.int32), count.astype(np.int32), (anchor + offset).astype(np.int32), h, whole, whole_2]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _STRETCH)


BUCKETED = "bucket long, key long, doc long, first int, n_starts int, single boolean, piece binary"
_BUCKETED = [c.split()[0] for c in BUCKETED.split(", ")]


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix buckets: the windows of a stretch, cut at multiples of `RANGE` from the anchor, with their bytes."""
    for batch in batches:
        rows = []
        for key, doc, text, stretches in zip(*(batch.column(c) for c in ("key", "doc", "bytes", "stretches"))):
            key, doc, text = key.as_py(), doc.as_py(), text.as_py()
            for s in stretches.as_py():
                nearest, farthest = s["anchor"] - (s["first"] + s["n_starts"] - 1), s["anchor"] - s["first"]
                for j in range(nearest // RANGE, farthest // RANGE + 1):
                    low, high = max(nearest, j * RANGE), min(farthest, j * RANGE + RANGE - 1)
                    core = text[s["anchor"] - j * RANGE : s["anchor"] - (j * RANGE + RANGE - 1) + WIDTH]
                    bucket = xxhash.xxh3_64_intdigest(core, seed=(s["hash"] ^ j) & (2**64 - 1)) - 2**63
                    first = s["anchor"] - high
                    rows.append((bucket, key, doc, first, high - low + 1, s["single"], text[first : first + high - low + WIDTH]))
        if rows:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _BUCKETED)


SPANS = "key long, doc long, first int, last int"


def _spans(keys: np.ndarray, docs: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys), pa.array(docs), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))], ["key", "doc", "first", "last"]
    )


def _sorted_block(rows: pa.Table, bucket: np.ndarray) -> pa.RecordBatch:
    """The stretches of `rows` that equal others of their bucket: first byte, and the byte after the last."""
    text = np.frombuffer(b"".join(rows.column("piece").to_pylist()), dtype=np.uint8)
    count, first = rows.column("n_starts").to_numpy().astype(np.int64), rows.column("first").to_numpy().astype(np.int64)
    offset = np.append(0, np.cumsum(count + WIDTH - 1)[:-1])
    row = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(row)) - np.repeat(np.append(0, np.cumsum(count)[:-1]), count)
    found = equal_windows(text, offset[row] + place, bucket[row], WIDTH)
    found &= rows.column("single").to_numpy(zero_copy_only=False)[row]
    hit = np.flatnonzero(found)
    new = np.append(True, (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])) if len(hit) else np.empty(0, dtype=bool)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(hit)) - 1 if len(begin) else begin
    a, b = hit[begin], hit[end]
    keys, docs = rows.column("key").to_numpy(), rows.column("doc").to_numpy()
    return _spans(keys[row[a]], docs[row[a]], first[row[a]] + place[a], first[row[b]] + place[b] + WIDTH)


def _sorted_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, starts in whole_runs(batches, "bucket"):
        sizes = np.diff(starts)
        bucket = np.repeat(np.arange(len(sizes)), sizes)
        shared = np.flatnonzero(np.repeat(sizes > 1, sizes))
        rows, bucket = rows.take(pa.array(shared)), bucket[shared]
        length = np.cumsum(rows.column("n_starts").to_numpy().astype(np.int64) + WIDTH - 1)
        begin = 0
        while begin < len(bucket):
            done = length[begin - 1] if begin else 0
            end = int(np.searchsorted(length, done + BLOCK_BYTES)) + 1
            end = int(np.searchsorted(bucket, bucket[min(end, len(bucket)) - 1], side="right"))
            yield _sorted_block(rows.slice(begin, end - begin), bucket[begin:end])
            begin = end


HASHED = "w1 long, w2 long, key long, doc long, first int, single boolean"


def _hashed_windows(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every window of the given stretches with `bits` bits of a hash of its bytes."""
    mask = np.array([(1 << min(bits, 64)) - 1, (1 << max(bits - 64, 0)) - 1], dtype=np.uint64)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc, text, stretches in zip(*(batch.column(c) for c in ("key", "doc", "bytes", "stretches"))):
                view, rows = memoryview(text.as_py()), []
                for s in stretches.as_py():
                    for first in range(s["first"], s["first"] + s["n_starts"]):
                        w1, w2 = (np.frombuffer(xxhash.xxh3_128_digest(view[first : first + WIDTH]), dtype=np.uint64) & mask).view(np.int64)
                        rows.append((w1, w2, key.as_py(), doc.as_py(), first, s["single"]))
                if rows:
                    types = [*[pa.int64()] * 4, pa.int32(), pa.bool_()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _HASHED)

    return windows


_HASHED = [c.split()[0] for c in HASHED.split(", ")]


def _window_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows that are listed beside a text, with their bytes, about a thousand at a time."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
    for batch in batches:
        for key, doc, text, windows in zip(*(batch.column(c) for c in ("key", "doc", "bytes", "windows"))):
            key, doc, text, windows = key.as_py(), doc.as_py(), text.as_py(), windows.as_py()
            for at in range(0, len(windows), 1_000):
                rows = [(w["w1"], w["w2"], key, doc, w["first"], w["single"], text[w["first"] : w["first"] + WIDTH]) for w in windows[at : at + 1_000]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [*_HASHED, "window"])


def keyed(docs: DataFrame) -> DataFrame:
    """Rows as key and doc, which tell texts and ids apart, with the text's bytes."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64("doc_id", text).alias("key"), F.coalesce("doc_id", F.lit(-1)).alias("doc"), text.cast("binary").alias("bytes"))


def _counted(rows: DataFrame) -> DataFrame:
    """Rows per anchor hash. Grouped in a struct, so that a join on the hash shuffles anew and can split a hot one."""
    return rows.groupBy(F.struct("hash").alias("of")).agg(F.count(F.lit(1)).alias("n")).select("of.hash", "n")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """key, doc, first, last: stretches of bytes (to before `last`) covered by windows that occur elsewhere too."""
    ship_code(docs.sparkSession)
    texts = keyed(docs).select("key", "doc", "bytes")
    stretches = written(texts.where(F.length("bytes") >= WIDTH).mapInArrow(_stretches, STRETCH))
    common = _counted(stretches).where("n > 1").select("hash")
    left, alike = F.col("anchor") - F.col("first"), ["hash", "left", "n_starts", "whole", "whole_2"]
    candidates = written(stretches.join(common, "hash").withColumn("left", left))
    one = F.min(F.struct("key", "doc", "first", "anchor")).alias("one")
    classes = written(candidates.groupBy(*alike).agg(F.count(F.lit(1)).alias("n"), one))
    hot = broadcast_if_small(classes.where(F.col("n") > HOT).select(*alike))
    rare = classes.where(F.col("n").between(2, HOT)).select(*alike)
    copied = candidates.join(hot, alike).unionByName(candidates.join(hot, alike, "left_anti").join(rare, alike))
    copied = copied.select("key", "doc", "first", (F.col("first") + F.col("n_starts") + WIDTH - 1).alias("last"))
    kinds = _counted(classes).where("n > 1").withColumnRenamed("n", "kinds")
    several = classes.join(kinds, "hash").withColumn("single", F.col("n") == 1)

    def with_text(chosen: DataFrame) -> DataFrame:
        stretch = F.struct("hash", "one.first", "one.anchor", "n_starts", "single")
        per_row = chosen.groupBy("one.key", "one.doc").agg(F.collect_list(stretch).alias("stretches"))
        return texts.join(per_row, ["key", "doc"])

    bucketed = with_text(several.where(F.col("kinds") <= LARGE)).mapInArrow(_bucket_rows, BUCKETED)
    equal = grouped(bucketed, "bucket").mapInArrow(_sorted_blocks, SPANS)
    hashed = with_text(several.where(F.col("kinds") > LARGE)).mapInArrow(_hashed_windows(SPREAD_BITS), HASHED)
    spread = _equal_by_bytes(texts, hashed).select("key", "doc", "first", (F.col("first") + WIDTH).alias("last"))
    return copied.unionByName(equal).unionByName(spread)


def _equal_by_bytes(texts: DataFrame, hashed: DataFrame) -> DataFrame:
    """The single windows of `hashed` whose bytes occur at another of its windows: key, doc, first.

    Those alone under their hash are alone. Of the others, a window that is in many texts is counted before it is
    shuffled. A hash that stands for one window only is settled; under any other, the bytes are looked up.
    """
    twice = hashed.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2")
    shared = written(hashed.join(twice, ["w1", "w2"]))
    per_row = shared.groupBy("key", "doc").agg(F.collect_set(F.struct("w1", "w2", "first", "single")).alias("windows"))
    windows = texts.join(per_row, ["key", "doc"]).mapInArrow(_window_bytes, HASHED + ", window binary")
    counted = windows.groupBy("w1", "w2", "window").agg(F.count(F.lit(1)).alias("n"))
    clashing = checkpoint(counted.groupBy(F.struct("w1", "w2").alias("of")).agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("of.*"))
    clashing = broadcast_if_small(clashing)
    settled = shared.where("single").join(clashing, ["w1", "w2"], "left_anti").select("key", "doc", "first")
    looked_up = windows.join(clashing, ["w1", "w2"])
    several = looked_up.groupBy("w1", "w2", "window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return settled.unionByName(looked_up.where("single").join(several, ["w1", "w2", "window"]).select("key", "doc", "first"))


def _kept_parts(data: bytes, spans: list[dict] | None) -> tuple[list[bytes], int, int]:
    """What is left of a text, with the number of bytes and of stretches that went."""
    parts, at, removed, runs, end = [], 0, 0, 0, -1
    for first, last in sorted((s["first"], s["last"]) for s in spans or []):
        if first > end:
            parts.append(data[at:first])
            runs, removed = runs + 1, removed + last - first
            at = end = last
        elif last > end:
            removed += last - end
            at = end = last
    parts.append(data[at:])
    return parts, removed, runs


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for data, spans in zip(batch.column("bytes"), batch.column("spans")):
            data = data.as_py()
            parts, removed, runs = _kept_parts(data, spans.as_py())
            rows.append((len(data), removed, runs, hashlib.sha256(b"".join(parts)).hexdigest()))
        n_bytes, removed, runs, digest = zip(*rows) if rows else ((),) * 4
        columns = [batch.column("doc_id").cast(pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _with_spans(docs: DataFrame) -> DataFrame:
    spans = repeated_spans(docs).groupBy("key", "doc").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    return keyed(docs).join(spans, ["key", "doc"], "left")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and the text's bytes that are left."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [b"".join(_kept_parts(d.as_py(), s.as_py())[0]) for d, s in zip(batch.column("bytes"), batch.column("spans"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "bytes"])

    return _with_spans(docs).select("doc_id", "bytes", "spans").mapInArrow(cut, "doc_id long, bytes binary")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _with_spans(table(spark, sf_dir, "documents")).select("doc_id", "bytes", "spans")
    return found.mapInArrow(_summed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")

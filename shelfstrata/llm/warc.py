r"""WARC archives: a writer, and a splittable reader.

An archive is a folder of files made of gzip members, one per record. The reader lets Spark deal the files out
in byte ranges and split each range at the gzip magic, by the reader for delimited text with the magic as the
delimiter: a task gets what begins inside its range and reads past the end to finish it. Each piece is a
candidate member. It is taken as a record only if its gzip header and the WARC header inside decode; the magic
also occurs by chance inside compressed data, and there the piece is put back onto the member before it. If
that member began in another range, both ends are brought together in a small second step. So every record
is read once, however the ranges fall.

Files are read and written through Spark, so any store that Spark reaches will do. The writer packs records
into chunks of `CHUNK_BYTES` per row of its output; what separates the chunks is itself a member, a `warcinfo`
record. Records with equal payloads of at least `least_bytes` are written once as `response`, the others as
`revisit` that refer to it and hold no payload.

Defined cases: a NULL html is an empty payload, and equal to other empty ones; a NULL page_id or url is left
out of the header and read back as NULL, and such a record is referred to by none; rows that repeat an id
are records of their own, and all rows with a group's largest id are responses; an empty table gives an
archive without records; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstrata.llm.common import broadcast_if_small, checkpoint, shared_folder, ship_code, table

MAGIC = b"\x1f\x8b\x08"
CHUNK_BYTES = 1 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
_NAMES = uuid.UUID("6f0c1f0e-52a7-4a0b-9a55-0d1f6f1f2f10")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
HEADER_BYTES = 1 << 12


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields if value is not None), f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


INFO = _record(
    [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{_NAMES}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
    b"format: WARC file version 1.1\r\n",
)


def _named(page_id: int | None) -> str | None:
    return None if page_id is None else f"<urn:uuid:{uuid.uuid5(_NAMES, str(page_id))}>"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The gzip member of a page: a response, or a revisit if it refers to another page."""
    revisit = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _named(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Refers-To", _named(refers_to)),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Page-Id", page_id),
        ("X-Refers-To-Page", refers_to),
        ("X-Payload-Length", len(payload)),
    ]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return _record(fields, head.encode() + (b"" if revisit else payload))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    members, size = [INFO], 0
    for batch in batches:
        for page_id, url, payload, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))):
            members.append(page_record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py()))
            size += len(members[-1])
            if size >= CHUNK_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)])], ["chunk"])
                members, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)])], ["chunk"])


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Writes a record per row of `pages` (page_id, url, html) into files under `path`."""
    ship_code(pages.sparkSession)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    # SHA-1 is what the records state; equality is told by a digest without known collisions.
    rows = rows.withColumn("same", F.sha2("payload", 256))
    groups = rows.where(F.length("payload") >= least_bytes).groupBy("same").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    groups = checkpoint(groups.where("n > 1").select("same", "last"))
    joined = rows.join(broadcast_if_small(groups), "same", "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    chunks = joined.select("page_id", "url", "payload", refers_to.alias("refers_to")).mapInArrow(_chunks, "chunk binary")
    text = chunks.select(F.col("chunk").cast("string").alias("value"))
    text.write.option("encoding", "ISO-8859-1").option("lineSep", INFO.decode("latin-1")).text(path)


def _starts_record(member: bytes) -> bool | None:
    """Whether bytes that begin with the magic are the start of a WARC record's member; None: too few to tell."""
    if len(member) > 3 and member[3] & 0xE0:
        return False
    try:
        begin = zlib.decompressobj(31).decompress(member[:HEADER_BYTES], 5)
    except zlib.error:
        return False
    return begin == b"WARC/" if len(begin) == 5 else None if b"WARC/".startswith(begin) else False


def _whole(member: bytes) -> bytes | None:
    """The content of a member, or None if it goes on."""
    reader = zlib.decompressobj(31)
    try:
        content = reader.decompress(member)
    except zlib.error:
        return None
    return content if reader.eof else None


def parse_record(content: bytes) -> dict[str, object]:
    """A record's fields, by name in lower case, with its block as `block`."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields: dict[str, object] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    fields["block"] = rest[: int(fields.get("content-length", len(rest)))]
    return fields


COLUMNS = "path string, range_start long, part int, fragment binary, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
_NAMES_OF_COLUMNS = [c.split()[0] for c in COLUMNS.split(", ")]


def _row(content: bytes) -> tuple | None:
    f = parse_record(content)
    if f.get("warc-type") not in ("response", "revisit"):
        return None
    number = lambda name: int(f[name]) if name in f else None
    payload = f["block"].partition(b"\r\n\r\n")[2] if f["warc-type"] == "response" else None
    size = number("x-payload-length") if payload is None else len(payload)
    stated = str(f.get("warc-payload-digest", "")).removeprefix("sha1:")
    found = stated if payload is None else digest(payload)
    if found != stated:
        raise ValueError(f"record {f.get('warc-record-id')} does not match its digest")
    return (None,) * 4 + (number("x-page-id"), f.get("warc-target-uri"), f["warc-type"], size, found, number("x-refers-to-page"), payload)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _NAMES_OF_COLUMNS)


def _assembled(pieces: Iterator[tuple[object, bytes]]) -> Iterator[tuple[object, int, bytes | None, bytes | None]]:
    """Per record (place, number, None, content); per piece whose record began or ends elsewhere, the piece.

    `pieces` are what lay between two magics, in order; `place` is the range they came from.
    """
    place, pending, part = None, [], 0
    for at, piece in pieces:
        if at != place:
            if pending:
                yield place, part, b"".join(pending), None
            place, pending, part = at, [], 0
        part += 1
        member = MAGIC + piece
        begins = _starts_record(member)
        if begins and pending:
            yield place, part, b"".join(pending), None
        if begins:
            pending = [member]
        elif pending or begins is None:
            pending.append(member)
        else:
            yield place, part, member, None
            continue
        content = _whole(b"".join(pending))
        if content is not None and content.startswith(b"WARC/"):
            yield place, part, None, content
            pending = []
    if pending:
        yield place, part + 1, b"".join(pending), None


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pieces() -> Iterator[tuple[object, bytes]]:
        last = None
        for batch in batches:
            for path, start, piece in zip(batch.column("path"), batch.column("range_start"), batch.column("piece")):
                at = path.as_py(), start.as_py()
                # What comes before a file's first magic is no member.
                if at == last or at[1] > 0:
                    yield at, piece.as_py()
                last = at

    rows, size = [], 0
    for place, part, fragment, content in _assembled(pieces()):
        row = _row(content) if fragment is None else (*place, part, fragment, *(None,) * 7)
        if row is not None:
            rows.append(row)
            size += len(row[-1] or b"") + len(fragment or b"")
        if size > CHUNK_BYTES:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from the fragments of a file, in their order."""
    path, held, rows = None, b"", []
    for batch in batches:
        for at, fragment in zip(batch.column("path").to_pylist(), batch.column("fragment").to_pylist()):
            held = fragment if at != path or _starts_record(fragment) else held + fragment
            path = at
            content = _whole(held) if held else None
            if content is not None and content.startswith(b"WARC/"):
                row, held = _row(content), b""
                rows += [row] if row is not None else []
    if rows:
        yield _batch(rows)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every response and revisit record: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload."""
    ship_code(spark)
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(path)
    pieces = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("range_start"),
        F.col("value").cast("binary").alias("piece"),
    )
    found = pieces.mapInArrow(_records, COLUMNS)
    fragments = found.where("fragment is not null").select("path", "range_start", "part", "fragment")
    across = fragments.repartition("path").sortWithinPartitions("path", "range_start", "part").mapInArrow(_joined, COLUMNS)
    records = found.where("fragment is null").unionByName(across)
    return records.select("page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).drop("url", "payload")

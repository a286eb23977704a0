import base64
import glob
import gzip
import hashlib
import random

import pytest

from shelfstrata.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"


def brute(rows, least=0):
    last = {}
    for page_id, _, html in rows:
        key = html or ""
        if page_id is not None:
            last[key] = max(last.get(key, page_id), page_id)
    many = [html or "" for _, _, html in rows]
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        refers = last.get(html or "") if many.count(html or "") > 1 and len(data) >= least else None
        refers = None if refers == page_id else refers
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def round_trip(spark, tmp_path, rows, least=0, name="w"):
    pages = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    warc.write_warc(pages, f"{tmp_path}/{name}", least)
    return warc.read_warc(spark, f"{tmp_path}/{name}")


def digests(df):
    rows = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted((tuple(r) for r in rows), key=str)


ROWS = [(1, "http://a/1", "same"), (5, "http://a/ü 5\r\nX: y", "same"), (3, None, "same"), (7, "u", ""), (9, "u", None), (None, "u", "same"), (11, "u", "größer\r\n\r\nWARC/1.1"), (11, "u", "größer\r\n\r\nWARC/1.1"), (12, "u", "z" * 300_000)]


@pytest.mark.parametrize("least", [0, 1, 5])
def test_round_trip(spark, tmp_path, least):
    found = round_trip(spark, tmp_path, ROWS, least)
    assert digests(found) == brute(ROWS, least)
    assert {r.page_id: r.payload for r in found.where("record_type = 'response'").collect()}[11] == "größer\r\n\r\nWARC/1.1".encode()
    data = b"".join(open(f, "rb").read() for f in glob.glob(f"{tmp_path}/w/part-*"))
    assert gzip.decompress(data).count(b"WARC-Type: re") == len(ROWS)  # any gzip reader can read the archive


def test_small_ranges_and_magic_inside_members(spark, tmp_path):
    rng = random.Random(5)
    # Payloads that don't compress keep the magic, and even whole gzip headers, as they are.
    noise = ["".join(chr(rng.randrange(32, 127)) for _ in range(rng.randrange(3000))) for _ in range(150)]
    rows = [(i, "u", t) for i, t in enumerate(noise)]
    level, warc.LEVEL = warc.LEVEL, 0
    try:
        made = [warc.page_record(i, "u", (t + "\x1f").encode() + warc.MAGIC * 3 + t.encode(), None) for i, t in enumerate(noise)]
    finally:
        warc.LEVEL = level
    assert sum(m.count(warc.MAGIC) for m in made) > 4 * len(made) - 1
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/part-0").write_bytes(b"".join(made))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        found = warc.read_warc(spark, f"{tmp_path}/raw")
        assert found.rdd.getNumPartitions() > 100
        got = {r.page_id: bytes(r.payload) for r in found.collect()}
        assert got == {i: (t + "\x1f").encode() + warc.MAGIC * 3 + t.encode() for i, t in enumerate(noise)}
        assert digests(round_trip(spark, tmp_path, rows)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_empty_table(spark, tmp_path):
    assert round_trip(spark, tmp_path, []).count() == 0

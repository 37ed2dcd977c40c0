import base64
import hashlib

import pytest

from starpipe.llm.common import read_table
from starpipe.llm.registry import ARCHIVE_CHUNK, op6_warc
from starpipe.llm.warc import payloads, read_chunks, write_archives
from starpipe.workspace import new_path

SCHEMA = "page_id long, url string, html string, origin string"
EVIL = "\r\n\r\nWARC/1.1\r\nX-Archive-Token: abc\r\nContent-Length: 5\r\n\r\n"
ROWS = [
    (1, "u", "a"), (2, None, "a"), (3, "é\r\nx", "b"), (None, "z", "a"), (None, None, None), (5, "q", ""),
    (6, "q", EVIL * 40), (7, "q", "\r\n" * 3000 + "W"), (7, "q", "\r\n" * 3000 + "W"), (8, "q", "ü" * 30_001),
    (9, "q", "WARC/1.1\r\n"), (9, "q", "b"),
]


def expected(rows, least):
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    found = []
    for payload, ids in groups.items():
        largest = max((i for i in ids if i is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for i in ids:
            again = len(payload) >= least and largest is not None and i != largest
            found.append((i, len(payload), digest, *(("revisit", largest) if again else ("response", None))))
    return sorted(map(str, found))


@pytest.mark.parametrize(("chunk", "least"), [(1 << 20, 0), (997, 0), (1 << 20, 5)])
def test_round_trip(spark, make, chunk, least):
    path = new_path(spark, "warc")
    token = write_archives(make([(*r, "x") for r in ROWS], SCHEMA), path, chunk=chunk, min_revisit_bytes=least)
    chunks = read_chunks(spark, path, token)
    assert all(len(r["chunk"]) <= chunk for r in chunks.collect())
    rows = payloads(chunks).collect()
    assert all(r["intact"] for r in rows)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(str(tuple(r[n] for n in names)) for r in rows) == expected(ROWS, least)


def test_files_are_split_and_payloads_come_back_whole(spark, make):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        pages = read_table(spark, "/root/testdata/sf0.001", "pages")
        path = new_path(spark, "warc")
        chunks = read_chunks(spark, path, write_archives(pages, path, chunk=700)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = {}
    for r in sorted(chunks, key=lambda r: r["number"]):
        whole[r["page_id"]] = whole.get(r["page_id"], b"") + bytes(r["chunk"])
    assert whole == {r["page_id"]: r["html"].encode() for r in pages.collect()}


def test_registered_query_takes_pages_through_several_chunks(spark):
    pages = read_table(spark, "/root/testdata/sf0.01", "pages")
    rows = [(r["page_id"], None, r["html"]) for r in pages.select("page_id", "html").collect()]
    assert any(len((html or "").encode()) > ARCHIVE_CHUNK for _, _, html in rows)
    found = op6_warc(spark, "/root/testdata/sf0.01").collect()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert all(r["intact"] for r in found)
    assert sorted(str(tuple(r[n] for n in names)) for r in found) == expected(rows, 0)


def test_damage_is_noticed_and_empty_tables_pass(spark, make):
    path = new_path(spark, "warc")
    token = write_archives(make([(1, "u", "abcdef" * 50, "x")], SCHEMA), path, chunk=100)
    chunks = read_chunks(spark, path, token)
    assert [r["intact"] for r in payloads(chunks.where("number <> 2")).collect()] == [False]
    path = new_path(spark, "warc")
    assert payloads(read_chunks(spark, path, write_archives(make([], SCHEMA), path))).count() == 0

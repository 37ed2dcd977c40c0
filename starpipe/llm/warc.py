"""WARC archives through a table of record chunks.

Writing: payloads become archive records of at most ``chunk`` bytes each; what is longer is carried
on in continuation records, as the format provides (``WARC-Segment-Number``). Of equal payloads one
is kept in a response record, the others are revisits that refer to it. Archives are plain text files
of Spark's writer, whose line separator is the empty line between records, so they can live in any
store that Spark can write to.

Reading: every record begins with the version line and a token that is drawn for each archive, and
that is the reader's line separator: files are split among tasks, and a payload that holds a whole
archive itself is not mistaken for records. The result is the chunk table, a row for each record
identifier and chunk number. Digests are carried from chunk to chunk, so no task holds more of a
payload than a chunk.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.llm.common import cut

VERSION = "WARC/1.1"
#: Payload bytes of one record.
CHUNK = 1 << 20
#: Bytes of records that a writing task holds before it passes them on.
HELD = 4 << 20
#: Smaller payloads are never revisits.
MIN_REVISIT_BYTES = 0
#: Fixed value of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_TOKEN = "X-Archive-Token"
_END = "\r\n\r\n"
_NAMESPACE = uuid.UUID("a2b7a2a0-4d44-5c5e-9f0e-3d6d0c5c1e11")

CHUNKS = (
    "page_id long, record_type string, refers_to long, url string, origin string, source string, number long, "
    "last boolean, payload_bytes long, payload_digest string, chunk binary, intact boolean"
)
PAYLOADS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, intact boolean"
)


def _base32(digest: bytes) -> str:
    """As archives write digests."""
    return base64.b32encode(digest).decode()


def _record_id(page_id: int | None, digest: bytes, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{digest.hex()}/{number}')}>"


def _uri(url: str) -> str:
    """One line: what isn't printable ASCII is percent-encoded."""
    raw = url.encode("utf-8", "surrogatepass")
    return "".join(chr(b) if 0x21 <= b <= 0x7E else f"%{b:02X}" for b in raw)


def _record(token: str, fields: dict[str, object], block: bytes | memoryview = b"") -> bytes:
    head = [VERSION, f"{_TOKEN}: {token}"]
    head += [f"{name}: {value}" for name, value in fields.items() if value is not None]
    head.append(f"Content-Length: {len(block)}")
    return b"".join((("\r\n".join(head) + _END).encode("ascii"), block))


def _records(
    page_id: int | None, url: str | None, payload: memoryview, original: int | None, size: int, token: str
) -> Iterator[bytes]:
    """The records of a payload; its digest is carried on chunk by chunk, and no copy of the whole is made."""
    state = hashlib.sha1()
    for start in range(0, len(payload), size):
        state.update(payload[start : start + size])
    digest = state.digest()
    common = {
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": None if url is None else _uri(url),
        "WARC-Payload-Digest": f"sha1:{_base32(digest)}",
        "X-Payload-Length": len(payload),
        "X-Page-Id": page_id,
        "X-Source-Row": uuid.uuid4().hex,
    }
    first = _record_id(page_id, digest, 1)
    if original is not None:
        yield _record(token, {
            "WARC-Type": "revisit",
            "WARC-Record-ID": first,
            "WARC-Profile": PROFILE,
            "WARC-Refers-To": _record_id(original, digest, 1),
            "X-Refers-To-Page": original,
            **common,
        })
        return
    chunks = max(1, -(-len(payload) // size))
    for number in range(1, chunks + 1):
        block = payload[(number - 1) * size : number * size]
        segment = {}
        if chunks > 1:
            segment["WARC-Segment-Number"] = number
            if number > 1:
                segment["WARC-Segment-Origin-ID"] = first
            if number == chunks:
                segment["WARC-Segment-Total-Length"] = len(payload)
        yield _record(token, {
            "WARC-Type": "response" if number == 1 else "continuation",
            "WARC-Record-ID": _record_id(page_id, digest, number),
            "Content-Type": "text/html",
            "WARC-Block-Digest": f"sha1:{_base32(hashlib.sha1(block).digest())}",
            **segment,
            **common,
        }, block)


def _written(batches: Iterator[pa.RecordBatch], size: int, token: str) -> Iterator[pa.RecordBatch]:
    """A few records at a time: never more than ``HELD`` bytes and one record."""
    held: list[bytes] = []
    amount = 0
    for batch in batches:
        for page_id, url, payload, original in zip(*batch.columns):
            view = memoryview(payload.as_buffer())
            for record in _records(page_id.as_py(), url.as_py(), view, original.as_py(), size, token):
                held.append(record)
                amount += len(record)
                if amount >= HELD:
                    yield _binary(held)
                    held, amount = [], 0
    if held:
        yield _binary(held)


def _binary(records: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    chunk: int = CHUNK,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
) -> str:
    """Write a record for each row to the folder ``path`` and return the archives' token.

    Of the rows with equal payloads of at least ``min_revisit_bytes`` those with the largest page_id
    are responses (so are rows that repeat it), the others revisits; a null page_id is smaller than
    any. Null payloads are empty, null urls left out. Other columns are ignored. An empty table
    gives archives without records.
    """
    token = uuid.uuid4().hex
    given = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    heads = given.where(F.octet_length("payload") >= min_revisit_bytes).select("page_id", "sha1")
    groups = heads.groupBy("sha1").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
    copies = heads.join(groups.where("n > 1 AND original IS NOT NULL"), "sha1")
    # Written, so that its size is known: Spark broadcasts it where its threshold allows.
    revisits = cut(
        copies.where("page_id IS NULL OR page_id < original")
        .select(F.col("page_id").alias("id"), F.col("sha1").alias("of"), "original")
        .distinct(),
        "revisits",
    )
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha1") == F.col("of"))
    records = (
        given.join(revisits, same, "left")
        .select("page_id", "url", "payload", "original")
        .mapInArrow(lambda batches: _written(batches, chunk, token), "record binary")
    )
    records.select(F.col("record").cast("string")).write.option("lineSep", _END).text(path)
    return token


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def _parsed(batches: Iterator[pa.RecordBatch], blocks: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value in batch.column(0):
            data = value.as_buffer().to_pybytes()
            at = data.index(_END.encode())
            lines = data[:at].decode("ascii").split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines)
            start = at + len(_END)
            block = data[start : start + int(fields["Content-Length"])]
            kind = fields["WARC-Type"]
            number = int(fields.get("WARC-Segment-Number", 1))
            intact, single = True, "WARC-Segment-Number" not in fields
            if kind != "revisit":
                digest = f"sha1:{_base32(hashlib.sha1(block).digest())}"
                intact = len(block) == int(fields["Content-Length"])
                intact = intact and digest == fields["WARC-Block-Digest"]
                if single:
                    intact = intact and digest == fields["WARC-Payload-Digest"]
                    intact = intact and len(block) == int(fields["X-Payload-Length"])
            rows.append((
                _number(fields.get("X-Page-Id")),
                "response" if kind == "continuation" else kind,
                _number(fields.get("X-Refers-To-Page")),
                fields.get("WARC-Target-URI"),
                fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]),
                fields["X-Source-Row"],
                number,
                single or "WARC-Segment-Total-Length" in fields,
                int(fields["X-Payload-Length"]),
                fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                block if blocks or not single else None,
                intact,
            ))
        if rows:
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(),
                     pa.bool_(), pa.int64(), pa.string(), pa.binary(), pa.bool_()]
            names = [field.split()[0] for field in CHUNKS.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names=names
            )


def read_chunks(spark: SparkSession, path: str, token: str, blocks: bool = True) -> DataFrame:
    """The chunk table of the archives in ``path``: a row for each record, as in ``CHUNKS``.

    ``origin`` names the first record of a payload, ``source`` the row it was written for (rows that
    repeat a page have one origin), ``number`` counts its chunks from 1; digest and length are those
    of the whole payload. ``intact`` tells whether the block is what its digests say. Without
    ``blocks``, payloads of one record are judged but not returned, which saves their way back.
    """
    start = f"{VERSION}\r\n{_TOKEN}: {token}\r\n"
    lines = spark.read.option("lineSep", start).text(path).where("length(value) > 0")
    records = lines.select(F.col("value").cast("binary"))
    return records.mapInArrow(lambda batches: _parsed(batches, blocks), CHUNKS)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a payload in order, one after the other; the digest runs on across batches."""
    state, size, upto, whole = hashlib.sha1(), 0, 0, True
    for batch in batches:
        rows = []
        names = batch.schema.names
        for row in zip(*batch.columns):
            x = dict(zip(names, row))
            if x["number"].as_py() == 1:
                state, size, upto, whole = hashlib.sha1(), 0, 0, True
            block = x["chunk"].as_buffer()
            state.update(block)
            size += block.size
            upto += 1
            whole = whole and x["intact"].as_py() and x["number"].as_py() == upto
            if x["last"].as_py():
                digest = _base32(state.digest())
                same = size == x["payload_bytes"].as_py() and digest == x["payload_digest"].as_py()
                rows.append((x, size, digest, whole and same))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x["page_id"].as_py() for x, *_ in rows], pa.int64()),
                    pa.array([n for _, n, _, _ in rows], pa.int64()),
                    pa.array([d for _, _, d, _ in rows], pa.string()),
                    pa.array([x["record_type"].as_py() for x, *_ in rows], pa.string()),
                    pa.array([x["refers_to"].as_py() for x, *_ in rows], pa.int64()),
                    pa.array([ok for *_, ok in rows], pa.bool_()),
                ],
                names=[field.split()[0] for field in PAYLOADS.split(", ")],
            )


def payloads(chunks: DataFrame) -> DataFrame:
    """A row for each payload of a chunk table, as in ``PAYLOADS``: length and digest as read, for
    revisits as declared; ``intact`` if all chunks are there and agree with what is declared.

    Payloads of one record were judged when they were read. Only chunks of payloads that take
    several are shuffled, to come together in their order.
    """
    names = [field.split()[0] for field in PAYLOADS.split(", ")]
    single = F.col("last") & (F.col("number") == 1)
    several = chunks.where(~single).repartition("source")
    ordered = several.sortWithinPartitions("source", "number")
    return chunks.where(single).select(*names).union(ordered.mapInArrow(_checked, PAYLOADS))

"""WARC archives through a chunked record table (operator 10).

Writing turns every payload into rows of record identifier and chunk number.
A payload over ``chunk_bytes`` becomes a segmented record (a first segment and
`continuation` records), so no writer or reader holds more than a few chunks of
it beside its source batch: the writer cuts a payload's Arrow buffer and hands on
records as batches of about one chunk.  One row is one record; Spark's text writer puts the
rows into gzip files, with the two line breaks that end a record as its line
separator.  Reading splits at the start of the next record, parses headers
and gives chunk rows back.  Whole records are digested where they are parsed;
chunks of segmented ones are sorted by record and number and digested one
after another, with a running state only.

A payload that holds a record's beginning is cut inside it, so that the split
never falls into a payload.  Null payloads are empty.  A null id is written
and read as null and is never revisited.  Rows that repeat an id and payload
are records of their own; the largest id's rows are all responses.  An empty
table gives archives that hold only their `warcinfo` record.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
CHUNK_BYTES = 1 << 20
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

_CHUNK_FIELDS = [
    ("record", pa.string()), ("id", pa.int64()), ("type", pa.string()), ("uri", pa.string()), ("refers_to", pa.int64()), ("chunk", pa.int32()),
    ("data", pa.binary()), ("chunk_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_()),
]
CHUNK_SCHEMA = "record string, id long, type string, uri string, refers_to long, chunk int, data binary, chunk_bytes long, payload_bytes long, payload_digest string, intact boolean"


def base32_sha1(digest: bytes) -> str:
    """A SHA-1 digest as WARC headers write it: upper-case base32, 32 characters."""
    return base64.b32encode(digest).decode()


def payload_chunks(payload: bytes | memoryview, limit: int = CHUNK_BYTES) -> Iterator[bytes]:
    """Chunks of at most ``limit`` bytes, at least one, none of which holds a record's beginning."""
    if len(payload) <= limit and VERSION.strip() not in (whole := bytes(payload)):
        yield whole
        return
    mark, at = END + VERSION, 0
    while at < len(payload):
        chunk = bytes(payload[at : at + limit])
        hit = (END + chunk + END).find(mark)
        if hit >= 0:
            chunk = chunk[: hit + 2]  # inside the word that begins a record
        yield chunk
        at += len(chunk)


def with_revisits(pages: DataFrame, page_id: str, url: str, payload: Column, min_bytes: int = 0) -> DataFrame:
    """__id, __uri, __payload, __digest (hex SHA-1) and __refers_to: of equal payloads of at least
    ``min_bytes``, all but the largest id's refer to that id."""
    rows = pages.select(F.col(page_id).cast("long").alias("__id"), F.col(url).cast("string").alias("__uri"), payload.alias("__payload"))
    rows = rows.withColumns({"__digest": F.sha1("__payload"), "__bytes": F.length("__payload").cast("long")})
    # the payloads of this side are hashed and dropped; only digests held by several records remain
    copied = rows.groupBy("__digest", "__bytes").agg(F.max("__id").alias("__first"), F.count(F.lit(1)).alias("__n")).where((F.col("__n") > 1) & (F.col("__bytes") >= min_bytes))
    joined = rows.join(copied.drop("__n"), ["__digest", "__bytes"], "left")
    return joined.select("__id", "__uri", "__payload", "__digest", F.when(F.col("__id") < F.col("__first"), F.col("__first")).alias("__refers_to"))


def write_records(rows: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, date: str | None = None) -> None:
    """Write rows of ``with_revisits`` as gzip WARC files under ``path``: folder layout=whole for
    records of one chunk, layout=segmented for the others."""
    when = (date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")).encode()

    def record(kind: bytes, name: bytes, fields: list[tuple[bytes, bytes]], block: bytes, content: bytes = b"application/http;msgtype=response") -> bytes:
        fields = [(b"WARC-Type", kind), (b"WARC-Record-ID", b"<" + name + b">"), (b"WARC-Date", when), (b"Content-Type", content), *fields, (b"Content-Length", b"%d" % len(block))]
        return VERSION + b"".join(k + b": " + v + b"\r\n" for k, v in fields) + b"\r\n" + block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        out: list[tuple[bytes, str]] = []

        def ready() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], names=["value", "layout"])
            out.clear()
            return made

        for batch in batches:
            held = 0
            for row in range(batch.num_rows):
                i, uri, digest, refers = (batch.column(c)[row].as_py() for c in (0, 1, 3, 4))
                payload = memoryview(batch.column(2)[row].as_buffer())
                n += 1
                for made in records_of(n, part, i, uri, payload, digest, refers):
                    out.append(made)
                    held += len(made[0])
                    if held >= chunk_bytes:
                        yield ready()
                        held = 0
            if out:
                yield ready()

    def records_of(n: int, part: int, i: int | None, uri: str | None, payload: memoryview, digest: str, refers: int | None) -> Iterator[tuple[bytes, str]]:
        name = b"urn:page:%s:%d-%d" % (b"null" if i is None else b"%d" % i, part, n)
        common = [] if uri is None else [(b"WARC-Target-URI", re.sub(rb"[\x00-\x20\x7f%]", lambda m: b"%%%02X" % m[0][0], uri.encode()))]
        whole = [(b"WARC-Payload-Digest", b"sha1:" + base32_sha1(bytes.fromhex(digest)).encode()), (b"X-Payload-Length", b"%d" % len(payload))]
        if refers is not None:
            fields = [*common, *whole, (b"WARC-Profile", b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), (b"WARC-Refers-To", b"<urn:page:%d>" % refers)]
            yield record(b"revisit", name, fields, HTTP_HEAD), "whole"
            return
        chunks = payload_chunks(payload, chunk_bytes)
        chunk, following, k = next(chunks), next(chunks, None), 1
        if following is None:
            yield record(b"response", name, common + whole, HTTP_HEAD + chunk), "whole"
            return
        while chunk is not None:
            fields = [*common, (b"WARC-Segment-Number", b"%d" % k)]
            if k > 1:
                fields += [(b"WARC-Segment-Origin-ID", b"<" + name + b">")]
            if following is None:
                fields += [*whole, (b"WARC-Segment-Total-Length", b"%d" % (len(HTTP_HEAD) + len(payload)))]
            yield record(b"response" if k == 1 else b"continuation", name if k == 1 else name + b":%d" % k, fields, chunk if k > 1 else HTTP_HEAD + chunk), "segmented"
            chunk, following, k = following, next(chunks, None), k + 1

    spark = rows.sparkSession
    info = record(b"warcinfo", b"urn:warcinfo:0", [], b"format: WARC File Format 1.1\r\n", b"application/warc-fields")
    records = rows.select("__id", "__uri", "__payload", "__digest", "__refers_to").mapInArrow(run, "value binary, layout string")
    records = spark.createDataFrame([(bytearray(info), "whole")], "value binary, layout string").union(records)
    # the bytes go out as they are: a cast from binary to string does not change them
    records.select(F.col("value").cast("string").alias("value"), "layout").write.partitionBy("layout").option("lineSep", END.decode()).option("compression", "gzip").text(path)


def _header(head: bytes) -> dict[bytes, bytes]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n"))}


def read_chunks(spark: SparkSession, path: str, layout: str = "whole", with_data: bool = True) -> DataFrame:
    """Chunk rows of the archives: record, id, type, uri, refers_to, chunk (from 1), data (null if not
    asked for), chunk_bytes, payload_bytes and payload_digest, intact (no byte of the block is missing).

    A response of one chunk has the length and digest of the bytes that were read, every other row
    has those of its header (null but in the last segment)."""
    text = spark.read.schema("value string, layout string").option("lineSep", (END + VERSION).decode()).text(path)
    raw = text.where(F.col("layout") == layout).select(F.col("value").cast("binary").alias("value"))

    def parse(value: bytes) -> dict | None:
        head, _, body = value.removeprefix(VERSION).partition(END)
        h = _header(head)
        kind = h.get(b"warc-type", b"").decode()
        if kind not in ("response", "revisit", "continuation"):
            return None
        n = int(h[b"content-length"])
        block, number = body[:n], int(h.get(b"warc-segment-number", b"1"))
        data = block.partition(END)[2] if kind != "continuation" else block
        single = kind == "response" and b"warc-segment-number" not in h
        name = (h.get(b"warc-segment-origin-id") or h[b"warc-record-id"]).strip(b"<>").decode()
        key, refers = name.split(":")[2], h.get(b"warc-refers-to", b"").strip(b"<>").decode()
        declared = h.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode() or None
        size = int(h[b"x-payload-length"]) if b"x-payload-length" in h else None
        uri = re.sub(rb"%([0-9A-F]{2})", lambda m: bytes([int(m[1], 16)]), h[b"warc-target-uri"]).decode() if b"warc-target-uri" in h else None
        return {
            "record": name, "id": None if key == "null" else int(key), "type": kind, "uri": uri, "refers_to": int(refers.split(":")[2]) if refers else None, "chunk": number,
            "data": None if kind == "revisit" or not (with_data or not single) else data, "chunk_bytes": len(data),
            "payload_bytes": len(data) if single else size, "payload_digest": base32_sha1(hashlib.sha1(data).digest()) if single else declared, "intact": len(block) == n,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [r for v in batch.column(0) if (r := parse(v.as_py()))]
            yield pa.RecordBatch.from_pylist(found, schema=pa.schema(_CHUNK_FIELDS))

    return raw.mapInArrow(run, CHUNK_SCHEMA)


def digest_segmented(chunks: DataFrame) -> DataFrame:
    """One row per segmented record from its chunk rows, digested chunk by chunk in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, row = None, None, None

        def done() -> pa.RecordBatch:
            row.update(payload_digest=base32_sha1(state.digest()), type="response", data=None)
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(_CHUNK_FIELDS))

        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["record"] != current:
                    if row:
                        yield done()
                    current, state, row = r["record"], hashlib.sha1(), {**r, "payload_bytes": 0}
                state.update(r["data"])
                row["payload_bytes"] += r["chunk_bytes"]
                row["intact"] = row["intact"] and r["intact"]
        if row:
            yield done()

    ordered = chunks.repartition(F.col("record")).sortWithinPartitions("record", "chunk")
    return ordered.mapInArrow(run, CHUNK_SCHEMA)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives: id, uri, type, refers_to, payload_bytes, payload_digest, intact."""
    columns = ["id", "uri", "type", "refers_to", "payload_bytes", "payload_digest", "intact"]
    whole = read_chunks(spark, path, "whole", with_data=False).select(columns)
    return whole.unionByName(digest_segmented(read_chunks(spark, path, "segmented")).select(columns))


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write a record per page (response or revisit) under ``path``."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    write_records(with_revisits(pages, page_id, url, payload, min_bytes), path, chunk_bytes)

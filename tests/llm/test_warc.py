import base64
import gzip
import hashlib
import os
import tempfile

import pytest

from tidewater.llm import queries, warc

V, E = "WARC/1.1\r\n", "\r\n\r\n"
ROWS = [
    (1, "http://a b\r\n%é", "x"), (2, None, None), (None, "u", ""), (3, "u", E + V + "tail"), (4, "u", V + V + E + V), (5, "u", "a" * 95 + E + V + E + "WARC/1.1"), (6, "u", "\r\n" + V), (7, "u", "end\r\n"),
    (8, "u", E), (9, "u", "é" * 101), (10, "u", "x"), (10, "u", "x"), (11, "u", E + "WARC/1.1"), (12, "u", "\n" + V + "\r"), (13, "u", "z" * 1000),
]


def expected(payload):
    data = (payload or "").encode()
    return len(data), base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize("chunk_bytes", [10, 1 << 20])
def test_payloads_come_back(spark, chunk_bytes):
    path = tempfile.mkdtemp() + "/w"
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, type string")
    warc.write(df, path, chunk_bytes=chunk_bytes)
    back = warc.read_records(spark, path).collect()
    assert sorted((str(r.id), r.payload_bytes, r.payload_digest) for r in back) == sorted((str(i), *expected(h)) for i, _, h in ROWS)
    assert all(r.intact for r in back)
    # the empty payload of the null id belongs to no one; id 1 repeats the payload of id 10
    assert sorted((r.id, r.refers_to) for r in back if r.type == "revisit") == [(1, 10)]
    assert {r.uri for r in back if r.id == 1} == {"http://a b\r\n%é"} and {r.uri for r in back if r.id == 2} == {None}
    chunks = warc.read_chunks(spark, path, "segmented").collect()
    assert all(r.chunk_bytes <= chunk_bytes for r in chunks) and bool(chunks) == any(len(list(warc.payload_chunks((h or "").encode(), chunk_bytes))) > 1 for _, _, h in ROWS)


def test_chunks_join_to_the_payload():
    for _, _, h in ROWS:
        data = (h or "").encode()
        for limit in (7, 64, 1 << 20):
            chunks = list(warc.payload_chunks(data, limit))
            assert b"".join(chunks) == data and all(len(c) <= limit for c in chunks)
            assert all((E + V).encode() not in E.encode() + c + E.encode() for c in chunks)


def test_small_payloads_are_no_revisits(spark):
    path = tempfile.mkdtemp() + "/w"
    warc.write(spark.createDataFrame([(1, "u", "same"), (2, "u", "same"), (3, "u", "other!"), (4, "u", "other!")], "page_id long, url string, html string"), path, min_bytes=5)
    assert sorted((r.id, r.type, r.refers_to) for r in warc.read_records(spark, path).collect()) == [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]


def test_files_are_plain_warc(spark):
    path = tempfile.mkdtemp() + "/w"
    warc.write(spark.createDataFrame([(1, "http://a/", "<p>é</p>")], "page_id long, url string, html string"), path, chunk_bytes=100)
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".gz")]
    data = b"".join(gzip.open(f).read() for f in files)
    kinds, at = [], 0
    while at < len(data):
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n")
        at += len(head) + 4 + int(fields[b"Content-Length"])
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4
        kinds.append(fields[b"WARC-Type"])
    assert sorted(kinds) == [b"response", b"warcinfo"]


def test_query_and_empty_table(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in queries.read(spark, sf, "pages").collect()}
    rows = queries.op10_warc(spark, sf).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in rows} == {k: expected(h) for k, h in pages.items()} and len(rows) == len(pages)
    path = tempfile.mkdtemp() + "/w"
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_records(spark, path).count() == 0


def test_writer_hands_on_bounded_batches(monkeypatch):
    import types

    import pyarrow as pa

    class Stop(Exception):
        pass

    class Rows:
        sparkSession = None

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            self.run = run
            raise Stop

    rows = Rows()
    try:
        warc.write_records(rows, "unused", chunk_bytes=1000)
    except Stop:
        pass
    monkeypatch.setattr(warc, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    payloads = [b"x" * 20_000, b"", b"y" * 999, b"z" * 5000]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, None, 4]), pa.array(["u", None, "v", "w"]), pa.array(payloads, pa.binary()), pa.array(["00" * 20] * 4), pa.array([None] * 4, pa.int64())], names=["a", "b", "c", "d", "e"])
    made = list(rows.run(iter([batch])))
    assert max(sum(len(v.as_py()) for v in m.column(0)) for m in made) < 3000
    assert [x for m in made for x in m.column(1).to_pylist()] == ["segmented"] * 20 + ["whole"] * 2 + ["segmented"] * 5

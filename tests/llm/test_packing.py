import math
import shutil
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewater.llm import packing, queries

FILE = public_tokenizers.path("byte_bpe_50k.json")


def placed(rows):
    """Sequence to its (offset, length) list, from plan rows."""
    out, seen = defaultdict(list), defaultdict(list)
    for length, first, last, each, base, offset in rows:
        for r in range(first, last):
            out[base + (r - first) // each].append((offset + length * ((r - first) % each), length))
            seen[length].append(r)
    return out, seen


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30), st.sampled_from([3, 10, 100]))
def test_plan_places_every_rank_once_without_gaps(counts, groups):
    rows, sequences = packing.plan_packing(counts, 64, groups)
    out, seen = placed(rows)
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert len(out) == sequences
    for items in out.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 64


def test_plan_is_near_the_bound():
    rnd = np.random.default_rng(1)
    sizes, n = np.unique(rnd.integers(1, 1025, 60_000), return_counts=True)
    counts = dict(zip(sizes.tolist(), n.tolist(), strict=True))
    rows, sequences = packing.plan_packing(counts)
    assert sequences <= 1.01 * math.ceil(sum(k * n for k, n in counts.items()) / 1024)
    assert len(rows) < 20_000


def test_plan_size_does_not_grow_with_the_data():
    counts = {k: 50 + k % 7 for k in range(1, 1025)}
    small, _ = packing.plan_packing(counts)
    large, _ = packing.plan_packing({k: 1000 * n for k, n in counts.items()})
    assert len(large) < 2 * len(small) + 1000


def test_query_matches_a_plain_cut(spark):
    sf = "/root/testdata/sf0.001"
    full = Tokenizer.from_file(FILE)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    pieces, ids_of = defaultdict(list), {k: [*full.encode(t, add_special_tokens=False).ids, 2] for k, t in texts.items()}
    sequences = defaultdict(list)
    for r in queries.op3_best_fit_packing(spark, sf).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == texts.keys()
    for k, rows in pieces.items():
        at = 0
        for i, r in enumerate(sorted(rows, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at)
            assert r.ids_crc32 == zlib.crc32(np.array(ids_of[k][at : at + r.length], dtype="<u4").tobytes())
            assert r.length == 1024 or i == 0
            at += r.length
        assert at == len(ids_of[k]) and len(rows) == math.ceil(at / 1024)
    for items in sequences.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(map(len, ids_of.values()))
    assert len(sequences) <= math.ceil(total / 1024) * 1.05 + 2


def test_edges(spark):
    rows = [(1, None, 5), (2, "", 6), (None, "some words", 7), (3, "word " * 5000, 8), (3, "word " * 5000, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece int")
    out = packing.pack(df, FILE).collect()
    assert sorted(r.length for r in out if r.doc_id in (1, 2)) == [1, 1]
    assert sum(r.length for r in out if r.doc_id is None) == 3
    assert all(len(r.ids) == 4 * r.length for r in out)
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out)
    assert packing.pack(df.limit(0), FILE).count() == 0


def test_idle_workers_hold_no_tokenizer(spark, tmp_path):
    path = str(shutil.copy(FILE, tmp_path / "own.json"))
    df = spark.createDataFrame([(i, f"some words {i}") for i in range(64)], "doc_id long, text string").repartition(16)
    assert packing.cut_pieces(df, path).count() == 64

    def held(batches):
        from tidewater.llm import textvec

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(path in k for k in textvec._held)])], names=["n"])

    assert {r.n for r in spark.range(0, 64, 1, 64).mapInArrow(held, "n long").collect()} == {0}


def test_texts_reach_a_worker_in_small_batches(spark, monkeypatch):
    name, used, write = "spark.sql.execution.arrow.maxBytesPerBatch", [], packing.materialize
    monkeypatch.setattr(packing, "materialize", lambda df, at: used.append(spark.conf.get(name)) or write(df, at))
    df, before = spark.createDataFrame([(1, "some words")], "doc_id long, text string"), spark.conf.get(name)
    assert packing.pack(df, FILE).count() == 1
    assert used == ["4m"] and spark.conf.get(name) == before

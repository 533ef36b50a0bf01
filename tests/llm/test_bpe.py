import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from tidewater.llm import bpe, queries
from tidewater.llm import textvec as tv

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(MULTI), special_tokens={})


def odd_texts(n=400):
    rnd = random.Random(4)
    signs = [*"ab1 '\n\t.!stmdrevl", " ", " ", "é", "ß", "日", "😀", "²", "ـ"]
    return ["", " ", "a" * 5000, "'s't're''ve", *("".join(rnd.choice(signs) for _ in range(rnd.randint(1, 14))) for _ in range(n))]


def test_pieces_are_the_patterns_matches():
    pattern = regex.compile(public_tokenizers.PATTERN)
    texts = odd_texts()
    cp, bounds = tv.code_points(texts)
    starts = tv.piece_starts(cp, bounds)
    pieces = ["".join(map(chr, cp[a:b])) for a, b in zip(starts, np.append(starts[1:], len(cp)), strict=True)]
    assert pieces == [p for t in texts for p in pattern.findall(t)]


def test_ids_match_the_rank_library(reference):
    coder, texts = bpe.coder(MULTI), odd_texts()
    ids, bounds = coder.encode(texts)
    for t, a, b in zip(texts, bounds, bounds[1:], strict=False):
        assert ids[a:b].tolist() == reference.encode_ordinary(t), t


def test_file_tokenizer_with_special_strings():
    coder, full = bpe.coder(FILE), Tokenizer.from_file(FILE)
    texts = ["plain text here", "a <|endoftext|> b", "<|endoftext|>", ""]
    ids, bounds = coder.encode(texts)
    for t, a, b in zip(texts, bounds, bounds[1:], strict=False):
        assert ids[a:b].tolist() == full.encode(t, add_special_tokens=False).ids


def test_query_over_documents(spark, reference):
    import hashlib

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op2_byte_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_edges_and_round_trip(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "é日😀 wörds", "z"), (3, "é日😀 wörds", "z"), (None, "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = bpe.encode(df, MULTI, ["doc_id"])
    back = bpe.decode(coded, MULTI, ["doc_id"]).collect()
    assert sorted(str((r.doc_id, r.text)) for r in back) == sorted(str((a, b or "")) for a, b, _ in rows)
    assert bpe.encode(df.limit(0), MULTI, ["doc_id"]).count() == 0
    # a character cut in two is replaced, not lost silently
    some = spark.createDataFrame([(1, bytearray(bpe.coder(MULTI).encode(["😀"])[0][:1].astype("<u4").tobytes()))], "doc_id long, ids binary")
    assert "�" in bpe.decode(some, MULTI, ["doc_id"]).first().text


def test_offsets_cover_the_text(spark):
    df = spark.createDataFrame([(1, "aé日😀 words here"), (2, None)], "doc_id long, text string")
    one, two = bpe.offsets(df, MULTI, ["doc_id"]).orderBy("doc_id").collect()
    assert one.starts[0] == 0 and one.ends[-1] == len("aé日😀 words here") and all(a < b for a, b in zip(one.starts, one.ends, strict=True))
    assert two.ids == []


def test_pieces_are_learned_a_bounded_number_at_once():
    from types import SimpleNamespace

    coder, sizes = bpe._make_coder(queries.BYTE_TOKENIZER), []
    plain = coder.tokenizer

    def encode(pieces, **how):
        sizes.append(len(pieces))
        return plain.encode_batch_fast(pieces, **how)

    plain.encode_special_tokens = True
    texts = [" ".join(f"w{i}x" for i in range(9000)), "tail"]
    whole, bounds = bpe._make_coder(queries.BYTE_TOKENIZER).encode(texts)
    coder.tokenizer = SimpleNamespace(encode_batch_fast=encode)
    ids, at = coder.encode(texts)
    assert ids.tolist() == whole.tolist() and at.tolist() == bounds.tolist()
    assert sum(sizes) > 9000 and max(sizes) <= 4096


def test_a_new_helper_gives_back_what_the_last_one_held(monkeypatch):
    released = []
    monkeypatch.setattr(tv, "release", lambda: (released.append(1), tv._held.clear()))
    assert [tv.held((x,), lambda x=x: x) for x in "aab"] == ["a", "a", "b"]
    assert len(released) == 2 and list(tv._held) == [("b",)]
    tv._held.clear()

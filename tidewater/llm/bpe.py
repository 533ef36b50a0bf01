"""Byte-level BPE encoding and decoding (operator 2).

The tokenizers library encodes; a rank file becomes its vocabulary through the
byte-to-character mapping (every byte is one printable character), with one
merge per token found by replaying lower-ranked merges on its bytes.  Texts
are cut into pre-tokens by array passes, each distinct pre-token is encoded
once per worker, and a document's ids are gathered from those.  Decoding looks
every id up in the byte table; a character split over tokens is whole again
once the bytes are joined.

Nulls and empty texts give no ids.  Repeated texts are encoded alike.  Input
columns other than the text and the kept ones are not read, so clashing names
do no harm.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv

CACHE_PIECES = 1 << 19
LEARNED_AT_ONCE = 1 << 12  # an encoding is far larger than its ids


def byte_chars() -> list[str]:
    """The printable character that stands for each byte: itself if visible, else 256 and up."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file (base64 token, rank)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def split_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts whose merge makes a token, using only lower-ranked merges."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best = min(((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
        if best[0] >= ranks[token]:
            return None
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def rank_tokenizer(path: str):
    """A tokenizers BPE model that merges as the ranks say; one call encodes one pre-token."""
    from tokenizers import Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel

    ranks, char = read_ranks(path), byte_chars()
    name = lambda b: "".join(char[x] for x in b)
    merges = [(name(p[0]), name(p[1])) for t in sorted(ranks, key=ranks.get) if len(t) > 1 and (p := split_of(t, ranks))]
    tokenizer = Tokenizer(BPE(vocab={name(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer, {r: t for t, r in ranks.items()}


def file_tokenizer(path: str):
    """A byte-level tokenizer file, set to take one pre-token per call."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer = Tokenizer.from_file(path)
    tokenizer.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
    byte = {c: b for b, c in enumerate(byte_chars())}
    special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    return tokenizer, {i: bytes(byte[c] for c in t) for t, i in tokenizer.get_vocab().items() if i not in special} | special


class PieceCoder:
    """Encodes pre-tokens with a tokenizer, remembering a bounded number of them by hash."""

    def __init__(self, tokenizer, tokens: dict[int, bytes], whole: Callable | None = None, marks: tuple[str, ...] = ()):
        self.tokenizer, self.whole, self.marks = tokenizer, whole, marks
        width = max(tokens) + 1
        self.byte_len = np.zeros(width, dtype=np.int64)
        for i, b in tokens.items():
            self.byte_len[i] = len(b)
        self.byte_at = np.concatenate([[0], np.cumsum(self.byte_len)])
        self.bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(width)), dtype=np.uint8)
        self.forget()

    def forget(self) -> None:
        self.rows = tv.RowTable(21)
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.at = np.zeros(1 << 14, dtype=np.int64)
        self.len = np.zeros(1 << 14, dtype=np.int64)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> np.ndarray:
        # ordinary encoding: a special token's string is plain text here
        self.tokenizer.encode_special_tokens = True
        rows = self.rows.add(hashes)
        while self.rows.count > len(self.at):
            self.at, self.len = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.len))
        for k in range(0, len(pieces), LEARNED_AT_ONCE):
            encoded = self.tokenizer.encode_batch_fast(pieces[k : k + LEARNED_AT_ONCE], add_special_tokens=False)
            for r, e in zip(rows[k : k + LEARNED_AT_ONCE].tolist(), encoded, strict=True):
                ids = e.ids
                while self.used + len(ids) > len(self.flat):
                    self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
                self.flat[self.used : self.used + len(ids)] = ids
                self.at[r], self.len[r] = self.used, len(ids)
                self.used += len(ids)
        return rows

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts as one array, and the n + 1 text boundaries in it."""
        cp, bounds = tv.code_points(texts)
        starts = tv.piece_starts(cp, bounds)
        keys, where, inverse = tv.distinct(tv.run_hashes(cp, starts))
        if self.rows.count > CACHE_PIECES:
            self.forget()
        rows = self.rows.find(keys)
        new = np.flatnonzero(rows < 0)
        if len(new):
            ends = np.append(starts[1:], len(cp))
            cut = lambda j: cp[starts[j] : ends[j]].tobytes().decode("utf-32-le", "surrogatepass")
            rows[new] = self._learn(keys[new], [cut(j) for j in where[new].tolist()])
        rows = rows[inverse]
        counts = self.len[rows]
        ids = self.flat[tv.spans(self.at[rows], counts)]
        token_bounds = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, bounds)]
        return self._marked(texts, ids, token_bounds)

    def _marked(self, texts: list[str], ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that hold a special token's string are encoded whole, as the tokenizer file says."""
        marked = [i for i, t in enumerate(texts) if any(m in t for m in self.marks)] if self.marks else []
        if not marked:
            return ids, bounds
        rows = [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        for i in marked:
            rows[i] = np.array(self.whole(texts[i]), dtype=np.uint32)
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all id runs as one array, and the n + 1 boundaries in it."""
        counts = self.byte_len[ids]
        return self.bytes[tv.spans(self.byte_at[ids], counts)], np.concatenate([[0], np.cumsum(counts)])[bounds]


def coder(path: str) -> PieceCoder:
    """The worker's coder for a vocabulary file: a rank file (.tiktoken) or a tokenizer file (.json)."""
    return tv.held(("coder", path), lambda: _make_coder(path))


def _make_coder(path: str) -> PieceCoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    if not path.endswith(".json"):
        return PieceCoder(*rank_tokenizer(path))
    from tokenizers import Tokenizer

    tokenizer, tokens = file_tokenizer(path)
    marks = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
    full = cache(lambda: Tokenizer.from_file(path))  # few texts hold a special token's string
    return PieceCoder(tokenizer, tokens, whole=lambda t: full().encode(t, add_special_tokens=False).ids, marks=marks)


def _kept(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    return df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))


def encode(df: DataFrame, path: str, keep: list[str], text: str = "text", round_trip: bool = False) -> DataFrame:
    """``keep`` columns, n_tokens and ids (binary: little-endian unsigned 32-bit); with
    ``round_trip`` also decoded (binary: the bytes that the ids stand for)."""
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    if round_trip:
        schema = schema.add("decoded", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for a, b in tv.chunks(texts):
                ids, bounds = c.encode(texts[a:b])
                columns = [*(x.slice(a, b - a) for x in batch.columns[:-1]), pa.array(np.diff(bounds)), tv.binary_slices(ids.astype("<u4"), bounds)]
                if round_trip:
                    columns.append(tv.binary_slices(*c.decode(ids, bounds)))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return _kept(df, keep, text).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """``keep`` columns, decoded (binary) and text: the joined bytes as UTF-8, where a
    character whose bytes are not all there becomes the replacement character."""
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("decoded", T.BinaryType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            raw = [x or b"" for x in batch.column(len(keep)).to_pylist()]
            flat = np.frombuffer(b"".join(raw), dtype="<u4")
            bounds = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw])]).astype(np.int64)
            decoded = tv.binary_slices(*c.decode(flat, bounds))
            texts = pa.array([x.decode("utf-8", "replace") for x in decoded.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], decoded, texts], names=schema.names)

    return df.select(*keep, F.col(ids).alias("__ids")).mapInArrow(run, schema)


def offsets(df: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ids and the character span [starts, ends) of every token; tokens
    that share a character all get that character's span."""
    arrays = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("ids", "starts", "ends")]
    schema = T.StructType([*(df.schema[c] for c in keep), *arrays])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            rows = []
            for text in batch.column(len(keep)).to_pylist():
                ids, _ = c.encode([text])
                ends = np.cumsum(c.byte_len[ids])
                lead = (np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80
                char = np.cumsum(lead) - 1
                begins = ends - c.byte_len[ids]
                rows.append((ids.tolist(), char[begins].tolist(), (char[ends - 1] + 1).tolist()))
            columns = [pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    return _kept(df, keep, text).mapInArrow(run, schema)

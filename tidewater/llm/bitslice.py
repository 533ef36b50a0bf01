"""Exact top-k inner products over a bit-sliced index (operator 11).

Every component of a vector is an attribute, quantised to ``floor(scale * x)``.
A block of vectors keeps, for every attribute and bit, one bitmap over its rows
(a slice), counted from the attribute's smallest value in the block.  A query's
weights are written in signed binary digits; a digit adds an attribute's slices,
or their complements for a negative digit, shifted by the digit's place.  The
adding is done on whole bitmaps by carry-save adders, so a block's scores come
out as slices too.  The best rows are then selected from the most significant
slice downward: rows are certain, or tied with the last place so far.  Rows
still tied after the lowest slice are resolved by their ids, and the scores of
the selected rows are read back from the slices.  Nothing is approximated.

Blocks of vectors meet parts of the queries, one pair of them a task's group;
both are dealt by hash and bounded, so a vector that a third of the rows repeat
lands everywhere.  A block answers with ``k`` rows a query.

Vectors that are null or hold null or non-finite components take no part, as
query or as candidate, nor do rows without an id; only vectors of one length are
compared (empty ones with one another, at score 0).  Rows that repeat id and
vector count once; rows that repeat an id with another vector ask and are found
on their own, but no row finds a row of its own id.  Ties go to the smaller id.
Sums are as wide as they need to be; a score beyond a long is given as the
nearest long, while ranks follow the true sums.  Very long vectors only widen a
block's index.  Empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sink import materialize

SCALE = 256
BLOCK_ROWS = 16_384
QUERY_ROWS = 256
LONG = (-(2**63), 2**63 - 1)


def quantise(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as integers: int64 where all fit, Python integers otherwise."""
    scaled = np.floor(x * scale)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    # doubles from 2 ** 53 on are whole numbers, and their product may leave the doubles
    whole = lambda v: int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale)
    return np.array([whole(v) for v in x.reshape(-1).tolist()], dtype=object).reshape(x.shape)


@dataclass
class SlicedBlock:
    """Bitmaps over the rows of a block, one for every attribute and bit; rows lie by ascending id."""

    ids: np.ndarray
    low: list[int]  # smallest value of each attribute
    width: list[int]  # bits of each attribute
    first: np.ndarray  # an attribute's lowest slice among ``planes``
    planes: np.ndarray  # (slices, words), then their complements

    @classmethod
    def build(cls, ids: np.ndarray, values: np.ndarray) -> SlicedBlock:
        """``values``: (rows, attributes) of integers, rows by ascending id."""
        rows, d = values.shape
        wide = values.dtype == object or (values.size > 0 and int(values.max()) - int(values.min()) >= 2**62)
        exact = values.astype(object) if wide else values
        low = [int(v) for v in exact.min(axis=0)] if rows else [0] * d
        width = [(int(h) - v).bit_length() for h, v in zip(exact.max(axis=0), low, strict=True)] if rows else [0] * d
        first = np.concatenate([[0], np.cumsum(width)]).astype(np.int64)
        words = -(-rows // 64)
        planes = np.zeros((int(first[-1]), words), dtype=np.uint64)
        bits = np.zeros(words * 64, dtype=np.uint8)
        for j in range(d):
            above = exact[:, j] - low[j]
            for b in range(width[j]):
                bits[:rows] = ((above >> b) & 1).astype(np.uint8)
                planes[first[j] + b] = np.packbits(bits, bitorder="little").view("<u8")
        return cls(ids, low, width, first, np.concatenate([planes, ~planes]))

    def addends(self, weights: list[int]) -> tuple[dict[int, list[int]], int]:
        """Bitmaps to add at every power of two, and the constant that their sum leaves out."""
        half = len(self.planes) // 2
        columns: dict[int, list[int]] = {}
        rest = 0
        for j, w in enumerate(weights):
            rest += w * self.low[j]
            if not self.width[j]:
                continue
            for place, digit in signed_digits(w):
                start = int(self.first[j]) + (half if digit < 0 else 0)
                if digit < 0:  # -v is the complement of v less all ones
                    rest -= ((1 << self.width[j]) - 1) << place
                for b in range(self.width[j]):
                    columns.setdefault(place + b, []).append(start + b)
        return columns, rest

    def sums(self, weights: list[int]) -> tuple[list[np.ndarray], int]:
        """Slices of every row's weighted sum, lowest first, and the constant to add to it."""
        columns, rest = self.addends(weights)
        out: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        place = 0
        while place <= max(columns, default=-1) or carried:
            stack = [self.planes[columns[place]]] if place in columns else []
            stack = np.concatenate(stack + carried) if stack or carried else np.zeros((1, self.planes.shape[1]), dtype=np.uint64)
            carried = []
            while len(stack) > 2:  # three bitmaps of one place are one of it and one of the next
                t = len(stack) // 3
                a, b, c = stack[:t], stack[t : 2 * t], stack[2 * t : 3 * t]
                odd = a ^ b
                carried.append((a & b) | (odd & c))
                stack = np.concatenate([odd ^ c, stack[3 * t :]])
            if len(stack) == 2:
                carried.append((stack[0] & stack[1])[None])
                stack = (stack[0] ^ stack[1])[None]
            out.append(stack[0])
            place += 1
        return out, rest

    def top(self, weights: list[int], k: int, own: int | None = None) -> tuple[np.ndarray, list[int]]:
        """Rows and scores of the ``k`` greatest sums, ties to the earlier row; rows of the id ``own`` are left out."""
        allowed = np.zeros(self.planes.shape[1] * 64, dtype=np.uint8)
        allowed[: len(self.ids)] = 1
        if own is not None:
            allowed[np.searchsorted(self.ids, own) : np.searchsorted(self.ids, own, side="right")] = 0
        slices, rest = self.sums(weights)
        tied = np.packbits(allowed, bitorder="little").view("<u8")
        certain = np.zeros_like(tied)
        for s in reversed(slices):
            with_it = certain | (tied & s)
            n = int(np.bitwise_count(with_it).sum())
            if n > k:
                tied = tied & s
            else:
                certain, tied = with_it, tied & ~s
                if n == k:
                    tied = np.zeros_like(tied)
                    break
        sure = _rows(certain)
        rows = np.concatenate([sure, _rows(tied)[: k - len(sure)]])
        scores = []
        for r in rows.tolist():
            word, bit = r >> 6, np.uint64(r & 63)
            scores.append(rest + sum(int((s[word] >> bit) & np.uint64(1)) << i for i, s in enumerate(slices)))
        order = sorted(range(len(scores)), key=lambda i: (-scores[i], rows[i]))
        return rows[order], [scores[i] for i in order]


def signed_digits(w: int) -> Iterator[tuple[int, int]]:
    """(place, 1 or -1) of the non-adjacent form of a weight, which has the fewest digits."""
    place = 0
    while w:
        if w & 1:
            digit = 2 - (w & 3)
            yield place, digit
            w -= digit
        w >>= 1
        place += 1


def beyond_long(score: int) -> bytes:
    """Orders scores that a long cannot tell apart; empty for the others."""
    return b"" if LONG[0] < score <= LONG[1] else (score + (1 << 2400) * (score < 0)).to_bytes(301, "big")


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def usable(column: Column) -> Column:
    """Whether a vector is not null and all its components are finite numbers."""
    c = column.cast("array<double>")
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return c.isNotNull() & F.coalesce(finite, F.lit(False))


def _matrices(ids: pa.ChunkedArray, vectors: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: ids in ascending order and the vectors' components."""
    lists = vectors.combine_chunks()
    if not len(lists):
        return {}
    ends = lists.offsets.to_numpy().astype(np.int64)
    flat, starts, lengths = lists.values.to_numpy(zero_copy_only=False), ends[:-1], np.diff(ends)
    ids = ids.to_numpy()
    out = {}
    for d in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == d)
        own = own[np.argsort(ids[own], kind="stable")]
        out[d] = ids[own], flat[starts[own][:, None] + np.arange(d)]
    return out


def build_index(vectors: DataFrame, blocks: int, scale: int = SCALE) -> DataFrame:
    """(block, dim, ids, low, width, planes): the bit slices of (id, vector) rows, one row for each block and vector length."""

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        made = []
        for d, (ids, x) in _matrices(rows.column("id"), rows.column("vector")).items():
            b = SlicedBlock.build(ids, quantise(x, scale))
            half = b.planes[: len(b.planes) // 2]
            made.append({"block": key[0].as_py(), "dim": d, "ids": ids, "low": [str(v) for v in b.low], "width": b.width, "planes": half.astype("<u8").tobytes()})
        schema = pa.schema([("block", pa.int32()), ("dim", pa.int32()), ("ids", pa.list_(pa.int64())), ("low", pa.list_(pa.string())), ("width", pa.list_(pa.int32())), ("planes", pa.binary())])
        return pa.Table.from_pylist(made, schema=schema)

    dealt = F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int")
    rows = vectors.select(dealt.alias("block"), "id", "vector")
    return rows.groupBy("block").applyInArrow(build, "block int, dim int, ids array<long>, low array<string>, width array<int>, planes binary")


def _read_block(row: dict) -> SlicedBlock:
    ids = np.array(row["ids"], dtype=np.int64)
    width = row["width"]
    planes = np.frombuffer(row["planes"], dtype="<u8").astype(np.uint64).reshape(sum(width), -(-len(ids) // 64))
    first = np.concatenate([[0], np.cumsum(width)]).astype(np.int64)
    return SlicedBlock(ids, [int(v) for v in row["low"]], width, first, np.concatenate([planes, ~planes]))


def top_k(df: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` greatest inner products of every row of ``is_query``."""
    known = df.where(usable(F.col(vector)) & F.col(vec_id).isNotNull())
    known = known.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = materialize(known.groupBy("id", "vector").agg(F.max("asks").alias("asks")), "sliced-rows")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asked")).first()
    blocks, parts = max(1, -(-sizes["n"] // block_rows)), max(1, -(-sizes["asked"] // query_rows))
    index = materialize(build_index(rows.select("id", "vector"), blocks, scale), "sliced-index")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = rows.where("asks").select(F.col("id"), "vector", F.pmod(F.xxhash64("vector", "id"), F.lit(parts)).cast("int").alias("part"), every(blocks).alias("block"))
    held = index.withColumn("part", every(parts))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "query": [], "vec_id": [], "score": [], "wide": []}
        blocks_of = {row["dim"]: _read_block(row) for batch in left.to_batches() for row in batch.to_pylist()}
        for d, (ids, x) in _matrices(right.column("id"), right.column("vector")).items():
            if d not in blocks_of:
                continue
            block = blocks_of[d]
            for n, (q, weights) in enumerate(zip(ids.tolist(), quantise(x, scale).tolist(), strict=True)):
                found, scores = block.top([int(w) for w in weights], k, q)
                out["query_id"] += [q] * len(found)
                # rows of one id are told apart by their vectors
                out["query"] += [x[n].tobytes()] * len(found)
                out["vec_id"] += block.ids[found].tolist()
                out["score"] += [min(max(s, LONG[0]), LONG[1]) for s in scores]
                out["wide"] += [beyond_long(s) for s in scores]
        return pa.table([pa.array(out["query_id"], pa.int64()), pa.array(out["query"], pa.binary()), pa.array(out["vec_id"], pa.int64()), pa.array(out["score"], pa.int64()), pa.array(out["wide"], pa.binary())], names=[*out])

    best = held.groupBy("block", "part").cogroup(asking.groupBy("block", "part")).applyInArrow(answer, "query_id long, query binary, vec_id long, score long, wide binary")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.desc("wide"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

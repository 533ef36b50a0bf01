"""Approximate nearest neighbours by cross-polytope hashing (operator 8).

Unit vectors are turned by fast pseudo-rotations (sign flips and Hadamard
transforms, three times) and assigned to the nearest signed axis; a few such
functions make a bucket, the last one with as many axes as the number of vectors
calls for, and ``TABLES`` independent tables are kept.  A query
looks into the buckets of each table whose axes are nearest to it: ``PROBES`` up
to ``PROBES_VECTORS`` vectors, and as many more as the table's growth to the power
``PROBES_POWER``, because the true neighbours' buckets lie further down a longer list.
Candidates meet their query once, in blocks of indexed vectors, and are ranked
by the exact Euclidean distance of the original vectors in double precision;
each block keeps a query's best, then the blocks' best are ranked together.
A query that meets fewer vectors than it asks for, though there are more, is
compared with all vectors, block by block.

Equal vectors are one entry with their smallest ids, as many as any answer can
need, so copies cost nothing.  Vectors that are null, zero, or hold null or
non-finite components take no part, as query or as candidate; only vectors of
one length are compared.  Ties go to the smaller id.  Repeated rows of one id
and vector count once.  An empty table gives an empty result.  A table has about
one bucket for two distinct vectors, so that a query's candidates grow as its
probes do, slower than the table.  The index holds every vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sink import materialize

TABLES = 32
PROBES = 128
PROBES_VECTORS = 10_000
PROBES_POWER = 0.4
BUCKETS_PER_VECTOR = 0.45
BLOCK_ROWS = 4096
BLOCK_QUERIES = 1024


def axes_for(vectors: int, d: int) -> list[int]:
    """Axes of each hash function: whole ones of d, and a part of d to come near the wanted buckets."""
    wanted = max(1.0, vectors * BUCKETS_PER_VECTOR)
    axes = [d]
    wanted /= 2 * d
    while wanted >= 2 * d:
        axes.append(d)
        wanted /= 2 * d
    return [*axes, round(wanted / 2)] if round(wanted / 2) >= 1 else axes


def probes_for(vectors: int) -> int:
    """Buckets of each table that a query looks into."""
    return round(PROBES * max(1.0, vectors / PROBES_VECTORS) ** PROBES_POWER)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotations(vectors: np.ndarray, count: int, tables: int = TABLES, seed: int = 11) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each table, its functions' pseudo-rotations of the unit vectors, as scores of signed axes;
    ``count``: vectors in the table."""
    d = max(2, 1 << (vectors.shape[1] - 1).bit_length())
    unit = np.zeros((len(vectors), d))
    unit[:, : vectors.shape[1]] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    rng = np.random.default_rng([seed, d])
    for table in range(tables):
        scores = []
        for axes in axes_for(count, d):
            x = unit
            for _ in range(3):
                x = hadamard(x * rng.choice([-1.0, 1.0], d))
            scores.append(np.concatenate([x[:, :axes], -x[:, :axes]], axis=1))
        yield table, scores


def buckets(vectors: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each table, the bucket of every vector."""
    for table, scores in rotations(vectors, count):
        key = np.zeros(len(vectors), dtype=np.int64)
        for s in scores:
            key = key * s.shape[1] + s.argmax(axis=1)
        yield table, key


def probes(vectors: np.ndarray, count: int, wanted: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """For each table, the ``wanted`` buckets nearest to every vector (all, if there are fewer)."""
    wanted = wanted or probes_for(count)
    for table, scores in rotations(vectors, count):
        # only a function's best axes can be in the best combinations
        tops = [np.argsort(-s, axis=1, kind="stable")[:, :wanted] for s in scores]
        gaps = [(s.max(axis=1, keepdims=True) - np.take_along_axis(s, t, axis=1)) ** 2 for s, t in zip(scores, tops, strict=True)]
        combos = np.array(_combinations(tuple(t.shape[1] for t in tops), wanted))
        cost = sum(g[:, combos[:, k]] for k, g in enumerate(gaps))
        best = np.argsort(cost, axis=1, kind="stable")[:, :wanted]
        key = np.zeros(best.shape, dtype=np.int64)
        for k, t in enumerate(tops):
            key = key * scores[k].shape[1] + np.take_along_axis(t, combos[best, k], axis=1)
        yield table, key


@cache
def _combinations(widths: tuple[int, ...], wanted: int) -> list[tuple[int, ...]]:
    """Ranks of axes, one per function, that can be among the ``wanted`` best: those with fewer better ones."""
    out: list[tuple[tuple[int, ...], int]] = [((), 1)]
    for w in widths:
        out = [((*c, r), n * (r + 1)) for c, n in out for r in range(min(w, wanted // n))]
    return [c for c, _ in out]


def usable(column: Column) -> Column:
    """Whether a vector is not null, not zero and wholly finite."""
    c = column.cast("array<double>")
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return c.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(c, lambda x: x != 0.0)


def _keyed(vectors: DataFrame, count: int, probing: bool) -> DataFrame:
    """(dim, table, bucket, id) rows of the buckets that vectors lie in, or probe."""
    step = max(1, 512 * PROBES // probes_for(count)) if probing else 512

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
                lengths = np.array([len(v) for v in lists])
                for d in np.unique(lengths):
                    own = np.flatnonzero(lengths == d)
                    x = np.array([lists[int(i)].as_py() for i in own])
                    for table, keys in probes(x, count) if probing else buckets(x, count):
                        keys = keys.reshape(len(own), -1)
                        n = keys.size
                        columns = [pa.array(np.full(n, d, dtype=np.int32)), pa.array(np.full(n, table, dtype=np.int32)), pa.array(keys.reshape(-1)), pa.array(np.repeat(ids[own], keys.shape[1]))]
                        yield pa.RecordBatch.from_arrays(columns, names=["dim", "table", "bucket", "id"])

    return vectors.select("rep", "vector").mapInArrow(run, "dim int, table int, bucket long, id long")


def _best_of_blocks(vectors: DataFrame, queries: DataFrame, met: DataFrame, blocks: int, keep: int) -> DataFrame:
    """(q, rep, score): the ``keep`` nearest of each query's candidates in every block of vectors."""
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        own = left.column("own").to_numpy()
        ids = left.column("id").to_numpy()
        lists = left.column("vector").combine_chunks()
        flat, at = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy() - lists.offsets[0].as_py() if len(lists) else np.zeros(1, dtype=np.int64)
        q, rep = right.column("q").to_numpy(), right.column("rep").to_numpy()
        found = {True: {}, False: {}}
        for i, (mine, id_) in enumerate(zip(own.tolist(), ids.tolist(), strict=True)):
            found[mine][id_] = i
        order = np.lexsort((rep, q))
        q, rep = q[order], rep[order]
        out_q, out_rep, out_score = [], [], []
        cuts = np.append(np.flatnonzero(np.append(True, q[1:] != q[:-1])), len(q)) if len(q) else [0]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            i = found[False][int(q[a])]
            x = flat[at[i] : at[i + 1]]
            rows = np.fromiter((found[True][r] for r in rep[a:b].tolist()), dtype=np.int64, count=b - a)
            y = flat[at[rows][:, None] + np.arange(len(x))]
            score = np.sqrt(((y - x) ** 2).sum(axis=1))
            best = np.lexsort((rep[a:b], score))[:keep]
            out_q += [int(q[a])] * len(best)
            out_rep += rep[a:b][best].tolist()
            out_score += score[best].tolist()
        return pa.table({"q": pa.array(out_q, pa.int64()), "rep": pa.array(out_rep, pa.int64()), "score": pa.array(out_score, pa.float64())})

    pairs = met.withColumn("block", block("rep"))
    asked = pairs.select("block", "q").distinct().join(queries.select(F.col("rep").alias("q"), "vector"), "q")
    rows = vectors.select(block("rep").alias("block"), F.lit(True).alias("own"), F.col("rep").alias("id"), "vector")
    rows = rows.unionByName(asked.select("block", F.lit(False).alias("own"), F.col("q").alias("id"), "vector"))
    return rows.groupBy("block").cogroup(pairs.groupBy("block")).applyInArrow(rank, "q long, rep long, score double")


def _best_of_all(vectors: DataFrame, queries: DataFrame, asked: int, blocks: int, keep: int) -> DataFrame:
    """(q, rep, score): the ``keep`` nearest of all vectors of a query's length in every block of vectors."""
    parts = -(-asked // BLOCK_QUERIES)
    dealt = lambda n: F.pmod(F.xxhash64("rep"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_rep, out_score = [], [], []
        lists, reps = left.column("vector").combine_chunks(), left.column("rep").to_numpy()
        lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, dtype=np.int64)
        flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
        matrices = {}
        for d in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == d)
            matrices[d] = reps[own], flat[(ends[own] - d)[:, None] + np.arange(d)]
        for q, x in zip(right.column("rep").to_pylist(), right.column("vector"), strict=True):
            x = np.array(x.as_py())
            if len(x) in matrices:
                rep, y = matrices[len(x)]
                score = np.sqrt(((y - x) ** 2).sum(axis=1))
                best = np.lexsort((rep, score))[:keep]
                out_q += [q] * len(best)
                out_rep += rep[best].tolist()
                out_score += score[best].tolist()
        return pa.table({"q": pa.array(out_q, pa.int64()), "rep": pa.array(out_rep, pa.int64()), "score": pa.array(out_score, pa.float64())})

    rows = vectors.select(dealt(blocks).alias("block"), every(parts).alias("part"), "rep", "vector")
    asking = queries.select(every(blocks).alias("block"), dealt(parts).alias("part"), "rep", "vector")
    return rows.groupBy("block", "part").cogroup(asking.groupBy("block", "part")).applyInArrow(rank, "q long, rep long, score double")


def nearest(df: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest that were found for every row of ``is_query``."""
    rows = df.where(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    vectors = materialize(rows.groupBy("vector").agg(F.min("vec_id").alias("rep")), "vectors")
    named = materialize(rows.join(vectors, "vector").select("vec_id", "rep", "asks").distinct(), "named")
    by_id = Window.partitionBy("rep").orderBy("vec_id")
    members = named.select("rep", "vec_id").withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= k + 1).drop("nth")
    asked = named.where("asks").select(F.col("vec_id").alias("query_id"), F.col("rep").alias("q"))
    queries = vectors.join(asked.select(F.col("q").alias("rep")).distinct(), "rep", "left_semi")
    count = vectors.count()
    index, looked = _keyed(vectors, count, False), _keyed(queries, count, True)
    met = index.withColumnRenamed("id", "rep").join(looked.withColumnRenamed("id", "q"), ["dim", "table", "bucket"]).select("q", "rep").distinct()
    blocks = max(1, -(-count // BLOCK_ROWS))
    first_of = lambda best: best.withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy("score", "rep"))).where(F.col("nth") <= k + 1).drop("nth")
    first = materialize(first_of(_best_of_blocks(vectors, queries, met, blocks, k + 1)), "nearest")
    # queries that met fewer than they ask for, themselves included, though there are more of their length
    sizes = vectors.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("there"))
    found = first.groupBy(F.col("q").alias("rep")).agg(F.count(F.lit(1)).alias("found"))
    short = queries.join(found, "rep", "left").withColumn("dim", F.size("vector")).join(sizes, "dim")
    short = materialize(short.where(F.coalesce("found", F.lit(0)) < F.least("there", F.lit(k + 1))).select("rep", "vector"), "short")
    if asked_all := short.count():
        exact = first_of(_best_of_all(vectors, short, asked_all, blocks, k + 1))
        first = first.join(short.select(F.col("rep").alias("q")), "q", "left_anti").unionByName(exact)
    answers = first.join(members, "rep").join(asked, "q").where("vec_id <> query_id")
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

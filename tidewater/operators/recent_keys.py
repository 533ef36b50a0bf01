"""The loader's exact recent-key cache, computed chunk-parallel.

The cache rule, per scope, over records in order: if the key is in the cache
the record is a duplicate (dropped and counted), else it is kept; then the
key is added in both cases — when the cache already holds ``capacity``
entries the least recently used entry is evicted first (even on a hit), and
the key becomes the most recent.

Model used here (checked against a direct simulation in the tests): the
cache always holds the ``s`` most recently seen distinct keys.  With
``d`` = number of distinct other keys seen since the key's previous
occurrence, a record is a duplicate iff it has a previous occurrence and
``d < s``, where

    s = min(D, capacity - h)

``D`` = distinct keys seen before the record and ``h`` = 1 iff the previous
record of the scope was a hit with ``d < capacity - 1`` (such a hit evicts
one other key and leaves ``capacity - 1`` entries), else 0.  So every
decision depends on the recency order of keys only through the first
``capacity + 1`` entries.

Chunked execution:

1. rows are cut into chunks of contiguous order (``floor(offset / size)``
   for offset order; range partitions otherwise);
2. per chunk, a summary of at most ``capacity + 2`` rows: its most recent
   distinct keys (without its last record) and its last key;
3. a streaming fold over the summaries, in chunk order, yields for every
   chunk the recency list just before the last record of the previous chunk
   (at most ``capacity + 1`` keys) — its "warm" state.  A chunk with more
   than ``capacity + 1`` distinct keys fixes the state after it by itself,
   so the fold runs per *run* of chunks between such chunks, in parallel;
4. each chunk rebuilds the exact cache from its warm state and the replayed
   previous last record, then applies the rule to its own records
   (``cogroup`` of the chunk with its warm state).

Memory per task is bounded by the chunk size and the capacity; no scope,
however hot, is gathered in one task.  The fold (step 3) is sequential only
within a run, over summaries ``chunk size / capacity`` times smaller than
the data.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import key_string
from ..session import ship_package
from ..storage import materialize
from .dedup import DEDUP_KEY, IS_DUP, scope_columns
from .scans import DEFAULT_CHUNK

CHUNK = "_tw_rc"
ID_COLS = ["topic", "partition", "offset"]


def _summary_rows(keys: list[str], cap: int) -> list[tuple[int, str]]:
    """Most recent distinct keys of ``keys[:-1]`` (rank 0 = newest), then (-1, last key)."""
    out: list[tuple[int, str]] = []
    seen: set[str] = set()
    for k in reversed(keys[:-1]):
        if k not in seen:
            seen.add(k)
            out.append((len(out), k))
            if len(out) >= cap:
                break
    out.append((-1, keys[-1]))
    return out


class WarmFold:
    """Fold of chunk summaries in order: yields each chunk's warm state.

    ``step(summary, last_key)`` takes a chunk's most recent distinct keys
    (without its last record, newest first) and its last key, and returns the
    warm list and replayed key for *that* chunk before advancing.
    """

    def __init__(self, capacity: int):
        self.cap = capacity + 1
        self.state: list[str] = []
        self.prev_last: str | None = None

    def step(self, summary: list[str], last_key: str | None) -> tuple[list[str], str | None]:
        warm, replay = self.state, self.prev_last
        merged: list[str] = []
        seen: set[str] = set()
        for k in [*summary, *([replay] if replay is not None else []), *warm]:
            if k not in seen:
                seen.add(k)
                merged.append(k)
                if len(merged) >= self.cap:
                    break
        self.state, self.prev_last = merged, last_key
        return warm, replay


def decide_chunk(keys: list[str], warm: list[str], replay: str | None, capacity: int) -> list[bool]:
    """Duplicate flags for ``keys`` given the warm recency list and the replayed record.

    ``warm`` lists the most recent distinct keys before ``replay`` (newest
    first, at most ``capacity + 1``); a shorter list means it holds every key
    seen so far.  The cache before the chunk's first record is the first
    ``s`` keys of the recency list after ``replay``, with
    ``s = min(D, capacity - h)`` (``h``: the replayed record was a hit with
    ``d < capacity - 1``, ``d`` = its rank in ``warm``); from there the cache
    rule runs record by record, exactly.
    """
    cap = capacity + 1
    full = len(warm) >= cap
    if replay is None:
        recency, distinct, h = list(warm), len(warm), 0
    else:
        r = warm.index(replay) if replay in warm else None
        h = 1 if (r is not None and r < capacity - 1) else 0
        recency = [replay] + [k for k in warm if k != replay]
        distinct = len(warm) + (0 if r is not None or full else 1)
    s = min(distinct, capacity - h)
    cache: OrderedDict[str, None] = OrderedDict((k, None) for k in reversed(recency[:s]))  # last = newest
    out: list[bool] = []
    for k in keys:
        out.append(k in cache)
        if len(cache) >= capacity:
            cache.popitem(last=False)
        cache[k] = None
        cache.move_to_end(k)
    return out


def _seen_before(df: DataFrame, scope, order: Sequence[str] | None, key: Column | None) -> DataFrame:
    """The cache rule when no scope has ``capacity`` distinct keys: duplicate iff seen before."""
    x, grp = scope_columns(df, scope)
    tp_scope = sorted(grp) == ["partition", "topic"]
    order = list(order or (["offset"] if tp_scope else ["timestamp", "topic", "partition", "offset"]))
    x = x.withColumn(DEDUP_KEY, key if key is not None else key_string("key"))
    pos = F.struct(*[F.col(c) for c in order])
    first = x.where(F.col(DEDUP_KEY).isNotNull()).groupBy(*grp, DEDUP_KEY).agg(F.min(pos).alias("_tw_first"))
    out = x.join(first, on=[*grp, DEDUP_KEY], how="left").withColumn(
        IS_DUP, F.coalesce(pos > F.col("_tw_first"), F.lit(False))
    )
    out = out.drop("_tw_first", DEDUP_KEY)
    return out.drop("_tw_group") if "_tw_group" not in df.columns else out


def dedup_recent_keys(
    df: DataFrame,
    capacity: int,
    scope: Sequence[str] | Column | str | None = None,
    order: Sequence[str] | None = None,
    key: Column | None = None,
    chunk_size: int = DEFAULT_CHUNK,
    num_chunks: int | None = None,
    strategy: str = "chunked",
) -> DataFrame:
    """Mark ``is_dup`` with the exact recent-key cache of ``capacity`` entries.

    ``scope``: None = per (topic, partition) [default], ``"root"`` = one cache
    for all input (keys collide across topics), or columns / a Column.
    ``order``: record order inside a scope; default ``offset`` per topic-
    partition and (timestamp, topic, partition, offset) for wider scopes.
    Rows must be unique on (topic, partition, offset).

    ``strategy``: ``"chunked"`` is the general chunk-parallel algorithm.
    ``"unbounded"`` is for callers who know that no scope has ``capacity``
    distinct keys: the cache never evicts, so the rule is "key seen before in
    its scope" and runs as a JVM aggregate + join.

    For another order than the offset, rows are range-partitioned into
    ``num_chunks`` chunks (default: the shuffle partitions) and that narrow
    table is written once: all later steps must see the same chunks.
    """
    if capacity < 1:
        raise ValueError("capacity must be >= 1")
    if df.isStreaming:
        raise ValueError("dedup_recent_keys is the batch form; streams use streaming.processors.watermark_and_dedup")
    if strategy == "unbounded":
        return _seen_before(df, scope, order, key)
    if strategy != "chunked":
        raise ValueError(f"unknown strategy {strategy!r}")
    spark = df.sparkSession
    ship_package(spark)
    x, grp = scope_columns(df, scope)
    tp_scope = sorted(grp) == ["partition", "topic"]
    if order is None:
        order = ["offset"] if tp_scope else ["timestamp", "topic", "partition", "offset"]
    order = list(order)
    ids = [c for c in ID_COLS if c not in grp]
    x = x.withColumn(DEDUP_KEY, key if key is not None else key_string("key"))

    narrow_cols = list(dict.fromkeys([*grp, *order, *ids, DEDUP_KEY]))
    narrow = x.where(F.col(DEDUP_KEY).isNotNull()).select(*narrow_cols)
    if order == ["offset"]:
        narrow = narrow.withColumn(CHUNK, F.floor(F.col("offset") / F.lit(chunk_size)).cast("long"))
    else:
        n = num_chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
        ranges = narrow.repartitionByRange(n, *grp, *order).withColumn(CHUNK, F.spark_partition_id().cast("long"))
        narrow = materialize(ranges, "order-chunks")

    grp_fields = [narrow.schema[c] for c in grp]
    cap = capacity + 1

    # 2. per-chunk summaries
    summary_schema = T.StructType(
        [*grp_fields, T.StructField(CHUNK, T.LongType()), T.StructField("rank", T.IntegerType()),
         T.StructField("k", T.StringType())]
    )

    def summarize(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="mergesort")
        rows = _summary_rows(pdf[DEDUP_KEY].tolist(), cap)
        head = pdf.iloc[0]
        return pd.DataFrame(
            {**{c: [head[c]] * len(rows) for c in grp}, CHUNK: [head[CHUNK]] * len(rows),
             "rank": [r for r, _ in rows], "k": [k for _, k in rows]}
        )

    # same frame and grouping as step 4, so Spark reuses the one narrow shuffle
    summaries = narrow.groupBy(*grp, CHUNK).applyInPandas(summarize, summary_schema)

    # 3. warm state per chunk.  A chunk holding more than capacity + 1 distinct
    # keys fixes the state after it, so the fold restarts there: runs of chunks
    # between such chunks fold independently (one task per run, not per scope).
    # The chunk table (one row per chunk) comes from a JVM distinct count.
    warm_schema = T.StructType(
        [*grp_fields, T.StructField(CHUNK, T.LongType()), T.StructField("rank", T.IntegerType()),
         T.StructField("k", T.StringType())]
    )
    by_chunk = Window.partitionBy(*grp).orderBy(CHUNK)
    chunk_tbl = (
        narrow.groupBy(*grp, CHUNK).agg(F.countDistinct(DEDUP_KEY).alias("_tw_nk"))
        .select(
            *grp, CHUNK,
            F.lead(CHUNK).over(by_chunk).alias("_tw_next"),
            F.max(F.when(F.col("_tw_nk") >= cap + 1, F.col(CHUNK))).over(
                by_chunk.rowsBetween(Window.unboundedPreceding, 0)).alias("_tw_run"),
        )
        .where(F.col("_tw_next").isNotNull())
        .withColumn("_tw_run", F.coalesce(F.col("_tw_run"), F.lit(-1).cast("long")))
    )
    runs = summaries.join(chunk_tbl, on=[*grp, CHUNK], how="inner")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cur = None
        folder = WarmFold(capacity)
        pending = None  # (next chunk, summary keys, last key)
        out_rows: list[tuple] = []

        def flush(g, item):
            nxt, summary, last_key = item
            folder.step(summary, last_key)
            out_rows.extend((*g, nxt, r, k) for r, k in enumerate(folder.state))
            if folder.prev_last is not None:
                out_rows.append((*g, nxt, -1, folder.prev_last))

        for pdf in batches:
            if pdf.empty:
                continue
            gvals = list(zip(*[pdf[c].tolist() for c in grp]))
            for g, run, c, nxt, r, k in zip(gvals, pdf["_tw_run"].tolist(), pdf[CHUNK].tolist(),
                                            pdf["_tw_next"].tolist(), pdf["rank"].tolist(), pdf["k"].tolist()):
                if (g, run) != cur or pending is None or nxt != pending[0]:
                    if pending is not None:
                        flush(cur[0], pending)
                    if (g, run) != cur:
                        cur, folder = (g, run), WarmFold(capacity)
                    pending = (nxt, [], None)
                if r < 0:
                    pending = (pending[0], pending[1], k)
                else:
                    pending[1].append(k)
            if len(out_rows) >= 50_000:
                yield pd.DataFrame(out_rows, columns=[*grp, CHUNK, "rank", "k"])
                out_rows.clear()
        if pending is not None:
            flush(cur[0], pending)
        if out_rows:
            yield pd.DataFrame(out_rows, columns=[*grp, CHUNK, "rank", "k"])

    # summaries of one run travel to one task, in chunk order; the last-key
    # row (rank -1) sorts after the ranked rows of its chunk
    warm = (
        runs.repartition(*grp, "_tw_run")
        .sortWithinPartitions(*grp, "_tw_run", CHUNK, F.when(F.col("rank") < 0, F.lit(1 << 30)).otherwise(F.col("rank")))
        .mapInPandas(fold, warm_schema)
    )

    # 4. decide each chunk from its warm state
    id_fields = [narrow.schema[c] for c in [*grp, *ids] if c in narrow.columns]
    flag_schema = T.StructType([*dict((f.name, f) for f in id_fields).values(), T.StructField(IS_DUP, T.BooleanType())])
    flag_cols = [f.name for f in flag_schema.fields if f.name != IS_DUP]

    def decide(data: pd.DataFrame, w: pd.DataFrame) -> pd.DataFrame:
        if data.empty:
            return pd.DataFrame({c: [] for c in flag_schema.fieldNames()})
        data = data.sort_values(order, kind="mergesort")
        ws = w[w["rank"] >= 0].sort_values("rank")["k"].tolist() if not w.empty else []
        rp = w.loc[w["rank"] < 0, "k"].tolist() if not w.empty else []
        flags = decide_chunk(data[DEDUP_KEY].tolist(), ws, rp[0] if rp else None, capacity)
        res = data[flag_cols].copy()
        res[IS_DUP] = flags
        return res

    flags = (
        narrow.groupBy(*grp, CHUNK)
        .cogroup(warm.groupBy(*grp, CHUNK))
        .applyInPandas(decide, flag_schema)
    )

    joined = x.join(flags, on=flag_cols, how="left").withColumn(IS_DUP, F.coalesce(F.col(IS_DUP), F.lit(False)))
    out = joined.drop(DEDUP_KEY)
    return out.drop("_tw_group") if "_tw_group" not in df.columns else out

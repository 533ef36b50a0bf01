"""Drop records whose key was seen recently.

Three rules, all per *scope* (a partition group, P5):

* ``dedup_offset_range(n)`` (X3): duplicate iff the same key occurred within
  the previous ``n`` offsets.  Key-parallel.
* ``dedup_watermark_range(d)`` (X4): duplicate iff the previous record of the
  same key (in offset order) is at most ``d`` ms older.  Key-parallel.
* ``dedup_recent_keys(capacity)`` (X1): the exact recent-key cache of the
  loader: a bounded set of the most recently seen keys, where every record —
  kept or dropped — refreshes its key, and a full cache evicts its oldest
  entry before each insert.  Sequential by nature; computed here chunk-
  parallel (see ``recent_keys.py``).

All mark rather than drop (``is_dup``) so ``duplicate_counts`` (X6) and
the load plans can share one pass; ``drop_duplicates_marked`` filters.
``watermark_offset_dedup`` fuses W1 and X3 on one exchange of the log;
``with_rewind`` / ``drop_rewound`` warm a batch increment (X5).
A null key is never a duplicate and does not enter the cache.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import TOPIC_PARTITION, key_string, ts_millis
from .scans import DEFAULT_CHUNK, lag_with_carry, offset_chunk

IS_DUP = "is_dup"
DEDUP_KEY = "_tw_key"


def scope_columns(df: DataFrame, scope: Sequence[str] | Column | str | None) -> tuple[DataFrame, list[str]]:
    """Normalise a dedup scope to grouping columns.

    ``None`` -> (topic, partition), our default; ``"root"`` -> one scope for
    everything (the loader's default group, keys collide across topics);
    a Column -> a named group expression; a list -> those columns.
    """
    if scope is None:
        return df, list(TOPIC_PARTITION)
    if isinstance(scope, str) and scope == "root":
        return df.withColumn("_tw_group", F.lit("root")), ["_tw_group"]
    if isinstance(scope, Column):
        return df.withColumn("_tw_group", scope), ["_tw_group"]
    if isinstance(scope, str):
        return df, [scope]
    return df, list(scope)


def dedup_offset_range(
    df: DataFrame,
    n: int,
    scope: Sequence[str] | Column | str | None = None,
    key: Column | None = None,
) -> DataFrame:
    """Mark a record duplicate iff its key occurred in the previous ``n`` offsets.

    Offsets are bucketed by ``n``: the previous occurrence within ``n`` is in
    the same bucket (then the record is not the first of its bucket) or in the
    bucket before (then that bucket's largest offset is within ``n``).  The
    window is over (scope, key, bucket), so a hot key is spread over its
    buckets; the bucket maxima are a narrow table joined one bucket on.
    Offsets of different topic-partitions do not compare: a scope divides
    topic-partitions further, and ``"root"`` is refused.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    if isinstance(scope, str) and scope == "root":
        raise ValueError("offsets compare within a topic-partition; use another rule for a root scope")
    x, grp = scope_columns(df, scope)
    grp = list(dict.fromkeys([*TOPIC_PARTITION, *grp]))
    x = x.withColumn(DEDUP_KEY, key if key is not None else key_string("key"))
    x = x.withColumn("_tw_b", F.floor(F.col("offset") / F.lit(n)).cast("long"))
    w = Window.partitionBy(*grp, DEDUP_KEY, "_tw_b")
    x = x.withColumn("_tw_bmin", F.min("offset").over(w))
    bmax = (
        x.groupBy(*grp, DEDUP_KEY, "_tw_b")
        .agg(F.max("offset").alias("_tw_pmax"))
        .withColumn("_tw_b", F.col("_tw_b") + 1)
    )
    x = x.join(bmax, on=[*grp, DEDUP_KEY, "_tw_b"], how="left")
    dup = F.col(DEDUP_KEY).isNotNull() & (
        (F.col("offset") > F.col("_tw_bmin"))
        | (F.coalesce(F.col("offset") - F.col("_tw_pmax") <= F.lit(n), F.lit(False)))
    )
    out = x.withColumn(IS_DUP, dup).drop("_tw_b", "_tw_bmin", "_tw_pmax", DEDUP_KEY)
    return out.drop("_tw_group") if "_tw_group" not in df.columns else out


def dedup_watermark_range(
    df: DataFrame,
    d_ms: int,
    scope: Sequence[str] | Column | str | None = None,
    key: Column | None = None,
    time_col: str = "timestamp",
    chunk_size: int = DEFAULT_CHUNK,
) -> DataFrame:
    """Duplicate iff the previous record of the key (offset order) is <= ``d_ms`` older.

    The previous record comes from a chunked lag (``scans.lag_with_carry``)
    over (scope, key), so a hot key does not become one task.  A previous
    record with a *later* time (out-of-order data) also counts as recent.
    """
    if d_ms < 0:
        raise ValueError("d_ms must be >= 0")
    x, grp = scope_columns(df, scope)
    x = x.withColumn(DEDUP_KEY, key if key is not None else key_string("key"))
    x = x.withColumn("_tw_ts", ts_millis(time_col))
    x = lag_with_carry(
        x, [*grp, DEDUP_KEY], "offset", ["_tw_ts"], ["_tw_prev_ts"], chunk=offset_chunk("offset", chunk_size)
    )
    dup = (
        F.col(DEDUP_KEY).isNotNull()
        & F.col("_tw_prev_ts").isNotNull()
        & (F.col("_tw_ts") - F.col("_tw_prev_ts") <= F.lit(d_ms))
    )
    out = x.withColumn(IS_DUP, dup).drop("_tw_ts", "_tw_prev_ts", DEDUP_KEY)
    return out.drop("_tw_group") if "_tw_group" not in df.columns else out


def dedup_within_watermark(df: DataFrame, d: str, key: str = "key", time_col: str = "timestamp") -> DataFrame:
    """Spark's native streaming form: drop a key again seen within ``d`` of its *first* sighting.

    Named variant only: the window starts at the first occurrence and is not
    refreshed by later duplicates, so it differs from X4.
    """
    return df.withWatermark(time_col, d).dropDuplicatesWithinWatermark(["topic", "partition", key])


def with_rewind(current: DataFrame, history: DataFrame, rewind_offsets: int) -> DataFrame:
    """Prepend the last ``rewind_offsets`` offsets before each partition's slice start.

    The rewound records only warm the dedup state (``is_rewound``); they are
    dropped after dedup with ``drop_rewound``.  This is the batch form of the
    loader's re-read on start; it is exact when the rewound span holds the
    cache's history.  A stream keeps its state in the checkpoint instead.
    """
    starts = current.groupBy("topic", "partition").agg(F.min("offset").alias("_tw_start"))
    cols = current.columns
    tail = (
        history.join(F.broadcast(starts), on=["topic", "partition"], how="inner")  # one row per topic-partition
        .where((F.col("offset") < F.col("_tw_start")) & (F.col("offset") >= F.col("_tw_start") - F.lit(rewind_offsets)))
        .select(*cols)
        .withColumn("is_rewound", F.lit(True))
    )
    return current.withColumn("is_rewound", F.lit(False)).unionByName(tail)


def drop_rewound(df: DataFrame) -> DataFrame:
    return df.where(~F.col("is_rewound")).drop("is_rewound")


def drop_duplicates_marked(df: DataFrame) -> DataFrame:
    return df.where(~F.col(IS_DUP)).drop(IS_DUP)


def duplicate_counts(marked: DataFrame) -> DataFrame:
    """Duplicates per (topic, partition); partial aggregation, one row per partition."""
    return marked.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.col(IS_DUP).cast("long")).alias("duplicates"),
    )


def dedup_recent_keys(*args, **kwargs) -> DataFrame:
    """Exact recent-key cache; see ``recent_keys.dedup_recent_keys``."""
    from .recent_keys import dedup_recent_keys as impl

    return impl(*args, **kwargs)


def watermark_offset_dedup(
    df: DataFrame,
    n: int,
    chunk_size: int = DEFAULT_CHUNK,
    time_col: str = "timestamp",
    out: str = "watermark",
) -> DataFrame:
    """W1 + X3 per topic-partition on a single exchange of the data.

    Rows are hashed on (topic, partition, chunk), chunk = offset // size.  A
    record within ``n`` offsets of the next chunk is also sent, tagged, to
    that chunk (a fraction n / size of the rows), so both windows run on the
    same exchange: the running watermark per (topic, partition, chunk),
    skipping the copies, and the previous offset per (topic, partition,
    chunk, key) — a finer clustering the same hash partitioning satisfies.
    The watermark's carry-in from earlier chunks is a small partial
    aggregate joined back.
    """
    if not 1 <= n <= chunk_size:
        raise ValueError("need 1 <= n <= chunk_size")

    tp = list(TOPIC_PARTITION)
    c = F.floor(F.col("offset") / F.lit(chunk_size)).cast("long")
    x = df.withColumn(DEDUP_KEY, key_string("key")).withColumn("_tw_ts", ts_millis(time_col)).withColumn("_tw_c", c)
    near_next = F.col("offset") >= (F.col("_tw_c") + 1) * F.lit(chunk_size) - F.lit(n)
    copies = F.when(near_next, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    x = x.withColumn("_tw_copy", F.explode(copies)).withColumn(
        "_tw_c", F.col("_tw_c") + F.when(F.col("_tw_copy"), 1).otherwise(0)
    )
    run = Window.partitionBy(*tp, "_tw_c").orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn(out, F.max(F.when(~F.col("_tw_copy"), F.col("_tw_ts"))).over(run))
    by_key = Window.partitionBy(*tp, "_tw_c", DEDUP_KEY).orderBy("offset")
    x = x.withColumn("_tw_prev", F.lag("offset").over(by_key)).where(~F.col("_tw_copy"))
    per_chunk = df.groupBy(*tp, c.alias("_tw_c")).agg(F.max(ts_millis(time_col)).alias("_tw_cmax"))
    before = Window.partitionBy(*tp).orderBy("_tw_c").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(*tp, "_tw_c", F.max("_tw_cmax").over(before).alias("_tw_carry"))
    x = x.join(carry, on=[*tp, "_tw_c"], how="left").withColumn(out, F.greatest(F.col(out), F.col("_tw_carry")))
    dup = F.col(DEDUP_KEY).isNotNull() & F.col("_tw_prev").isNotNull() & (F.col("offset") - F.col("_tw_prev") <= F.lit(n))
    return x.withColumn(IS_DUP, dup).drop(DEDUP_KEY, "_tw_ts", "_tw_c", "_tw_copy", "_tw_prev", "_tw_carry")

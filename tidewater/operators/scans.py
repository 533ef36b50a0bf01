"""Ordered scans (running max, lag, row position) that do not put one group in one task.

A window ``partitionBy(topic, partition).orderBy(offset)`` sends a whole
topic-partition to a single task; a partition holding a third of the log
would then run on one core.  Every scan here is split into *chunks* —
contiguous ranges of the order column, by default ``floor(offset / size)`` —
so the window runs per (group, chunk).  A small per-chunk summary (one row per
chunk) is scanned across chunks and joined back as a carry-in.

Plan shape: one hash exchange of the data on (group, chunk) for the window.
The per-chunk summary is a separate aggregate over the (column-pruned)
input with map-side partial aggregation, so only one row per chunk and task
is shuffled for it.  The carry-in table is tiny (rows = number of chunks),
so AQE turns the join into a broadcast at run time when its measured size
allows, and keeps a shuffle join otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one topic-partition handled by one window task (offsets are dense
# or nearly so, hence rows ~ offsets).
DEFAULT_CHUNK = 1 << 20

CHUNK = "_tw_chunk"


def offset_chunk(order: str = "offset", size: int = DEFAULT_CHUNK) -> Column:
    if size < 1:
        raise ValueError("chunk size must be >= 1")
    return F.floor(F.col(order) / F.lit(size)).cast("long")


def _cols(xs: str | Sequence[str]) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def _with_chunk(df: DataFrame, chunk: Column | None, order: list[str], size: int) -> DataFrame:
    return df.withColumn(CHUNK, chunk if chunk is not None else offset_chunk(order[0], size))


def running_max(
    df: DataFrame,
    by: Sequence[str],
    order: str | Sequence[str],
    value: str,
    out: str,
    chunk: Column | None = None,
    chunk_size: int = DEFAULT_CHUNK,
    agg: str = "max",
) -> DataFrame:
    """``max(value) over (partition by by order by order rows unbounded preceding)``.

    ``agg="min"`` / ``"sum"`` give the running minimum / sum.  The chunk
    expression must be non-decreasing in ``order``.
    """
    by, order = _cols(by), _cols(order)
    fn, combine = {
        "max": (F.max, F.greatest),
        "min": (F.min, F.least),
        "sum": (F.sum, lambda a, b: a + F.coalesce(b, F.lit(0))),
    }[agg]
    base = _with_chunk(df, chunk, order, chunk_size)
    # chunk summary straight from the input: partial aggregation, one row per chunk per task
    per_chunk = base.groupBy(*by, CHUNK).agg(fn(value).alias("_tw_cmax"))
    w = Window.partitionBy(*by, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = base.withColumn(out, fn(value).over(w))
    before = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(*by, CHUNK, fn("_tw_cmax").over(before).alias("_tw_carry"))
    return (
        x.join(carry, on=[*by, CHUNK], how="left")
        .withColumn(out, combine(F.col(out), F.col("_tw_carry")))
        .drop(CHUNK, "_tw_carry")
    )


def running_position(
    df: DataFrame,
    by: Sequence[str],
    order: str | Sequence[str],
    out: str,
    chunk: Column | None = None,
    chunk_size: int = DEFAULT_CHUNK,
) -> DataFrame:
    """0-based ``row_number() - 1`` within ``by`` in ``order``."""
    by, order = _cols(by), _cols(order)
    base = _with_chunk(df, chunk, order, chunk_size)
    per_chunk = base.groupBy(*by, CHUNK).agg(F.count(F.lit(1)).alias("_tw_n"))
    w = Window.partitionBy(*by, CHUNK).orderBy(*order)
    x = base.withColumn(out, F.row_number().over(w) - 1)
    before = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(*by, CHUNK, F.sum("_tw_n").over(before).alias("_tw_carry"))
    return (
        x.join(carry, on=[*by, CHUNK], how="left")
        .withColumn(out, (F.col(out) + F.coalesce(F.col("_tw_carry"), F.lit(0))).cast("long"))
        .drop(CHUNK, "_tw_carry")
    )


def lag_with_carry(
    df: DataFrame,
    by: Sequence[str],
    order: str | Sequence[str],
    values: Sequence[str],
    outs: Sequence[str],
    chunk: Column | None = None,
    chunk_size: int = DEFAULT_CHUNK,
) -> DataFrame:
    """``lag(v) over (partition by by order by order)`` for each v in ``values``.

    The first row of a chunk takes the values of the last row of the nearest
    earlier non-empty chunk of the same group.
    """
    by, order, values, outs = _cols(by), _cols(order), list(values), list(outs)
    base = _with_chunk(df, chunk, order, chunk_size)
    w = Window.partitionBy(*by, CHUNK).orderBy(*order)
    x = base.withColumn("_tw_first", F.lag(F.lit(True)).over(w).isNull())
    for v, o in zip(values, outs):
        x = x.withColumn(o, F.lag(v).over(w))
    order_key = F.struct(*[F.col(c) for c in order])
    last = base.groupBy(*by, CHUNK).agg(
        *[F.max_by(F.col(v), order_key).alias(f"_tw_last{i}") for i, v in enumerate(values)]
    )
    prev = Window.partitionBy(*by).orderBy(CHUNK)
    carry = last.select(
        *by, CHUNK, *[F.lag(f"_tw_last{i}").over(prev).alias(f"_tw_carry{i}") for i in range(len(values))]
    )
    x = x.join(carry, on=[*by, CHUNK], how="left")
    for i, o in enumerate(outs):
        x = x.withColumn(o, F.when(F.col("_tw_first"), F.col(f"_tw_carry{i}")).otherwise(F.col(o)))
    return x.drop(CHUNK, "_tw_first", *[f"_tw_carry{i}" for i in range(len(values))])

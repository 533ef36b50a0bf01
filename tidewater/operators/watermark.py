"""Per-partition stream watermark and time buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import TOPIC_PARTITION, assert_kafka_shaped, ts_millis
from .scans import DEFAULT_CHUNK, offset_chunk, running_max

WATERMARK = "watermark"


def with_stream_watermark(
    df: DataFrame,
    out: str = WATERMARK,
    by: Sequence[str] = TOPIC_PARTITION,
    order: str = "offset",
    time_col: str = "timestamp",
    chunk_size: int = DEFAULT_CHUNK,
) -> DataFrame:
    """Running maximum record time (epoch millis) per topic-partition in offset order.

    Unlike ``withWatermark`` this is a column: every record carries the
    watermark of its partition at the moment it was read.
    """
    assert_kafka_shaped(df, (*by, order, time_col))
    x = df.withColumn("_tw_ts", ts_millis(time_col))
    x = running_max(x, by, order, "_tw_ts", out, chunk=offset_chunk(order, chunk_size))
    return x.drop("_tw_ts")


def hour_bucket(watermark: str | Column = WATERMARK) -> Column:
    """Watermark (epoch millis) truncated to the hour, as a UTC timestamp."""
    wm = F.col(watermark) if isinstance(watermark, str) else watermark
    return F.date_trunc("hour", F.timestamp_millis(wm))


def bucket_millis(bucket: str | Column) -> Column:
    """Bucket timestamp back to epoch millis."""
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    return F.unix_millis(b)


def hour_window(watermark: str | Column = WATERMARK) -> Column:
    """The same hour bucket as a tumbling ``window`` struct."""
    wm = F.col(watermark) if isinstance(watermark, str) else watermark
    return F.window(F.timestamp_millis(wm), "1 hour")


def late_records(df: DataFrame, watermark: str = WATERMARK, time_col: str = "timestamp") -> DataFrame:
    """Records whose own time is behind their partition's watermark.

    Nothing is dropped by the loader: such a record lands in the watermark's
    hour, not its own.  ``lateness_ms`` says by how much.
    """
    t = ts_millis(time_col)
    return df.where(t < F.col(watermark)).withColumn("lateness_ms", F.col(watermark) - t)


def offsets_for_times(
    log: DataFrame,
    times: DataFrame,
    time_col: str = "timestamp",
    bucket_ms: int = 60_000,
) -> DataFrame:
    """Per requested (topic, partition, t_ms), the first offset whose time is >= t.

    With records bucketed by ``bucket_ms`` of time, the answer is the smaller
    of (a) the first offset among records of t's own bucket with time >= t —
    the records meet the (few) requests of their bucket in an equi-join — and
    (b) the first offset over all later buckets — a suffix minimum over the
    per-bucket table (one row per bucket, partial aggregation).  No ordered
    scan over records, so a burst in one bucket is just a larger aggregate.
    Partitions with no such record get nulls.
    """
    tp = list(TOPIC_PARTITION)
    first = F.struct(F.col("offset").alias("offset"), F.col("_tw_ts").alias("ts"))
    recs = log.select(*tp, "offset", ts_millis(time_col).alias("_tw_ts")).withColumn(
        "_tw_b", F.floor(F.col("_tw_ts") / F.lit(bucket_ms)).cast("long")
    )
    req = times.select(*tp, F.col("t_ms").cast("long").alias("t_ms")).distinct().withColumn(
        "_tw_b", F.floor(F.col("t_ms") / F.lit(bucket_ms)).cast("long")
    )
    own = (
        recs.join(req, on=[*tp, "_tw_b"], how="inner")
        .where(F.col("_tw_ts") >= F.col("t_ms"))
        .groupBy(*tp, "t_ms")
        .agg(F.min(first).alias("_tw_own"))
    )
    buckets = recs.groupBy(*tp, "_tw_b").agg(F.min(first).alias("_tw_best"))
    marks = req.select(*tp, "_tw_b", F.lit(None).cast(buckets.schema["_tw_best"].dataType).alias("_tw_best"),
                       F.lit(1).alias("_tw_req"), "t_ms")
    u = buckets.withColumn("_tw_req", F.lit(0)).withColumn("t_ms", F.lit(None).cast("long")).unionByName(marks)
    # newest bucket first; a request sorts before its own bucket's row, so it sees later buckets only
    later = Window.partitionBy(*tp).orderBy(F.col("_tw_b").desc(), F.col("_tw_req").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    after = u.withColumn("_tw_later", F.min("_tw_best").over(later)).where(F.col("_tw_req") == 1).select(*tp, "t_ms", "_tw_later")
    out = req.join(own, on=[*tp, "t_ms"], how="left").join(after, on=[*tp, "t_ms"], how="left")
    best = F.least(F.col("_tw_own"), F.col("_tw_later"))
    return out.select(*tp, "t_ms", best["offset"].alias("offset"), best["ts"].alias("timestamp_ms"))

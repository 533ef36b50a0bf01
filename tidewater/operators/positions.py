"""Stream positions: offset ranges, commit positions, last commits (A1-A4).

All are aggregates with map-side partial aggregation: one row per
topic-partition (or per batch) crosses the shuffle, whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ts_millis


def offset_ranges(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """A1: smallest start and largest end offset per topic-partition (and ``extra`` keys)."""
    return df.groupBy("topic", "partition", *extra).agg(
        F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"), F.count(F.lit(1)).alias("records")
    )


def commit_positions(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """A2/K8: position to commit after a batch — next offset and max record time."""
    return df.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset"), F.max(ts_millis(time_col)).alias("watermark")
    )


def last_committed(commits: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """A3: latest commit per topic-partition; requested partitions without one get nulls.

    ``commits``: (topic, partition, commit_seq, next_offset[, watermark]).
    """
    value_cols = [c for c in commits.columns if c not in ("topic", "partition", "commit_seq")]
    latest = commits.groupBy("topic", "partition").agg(
        *[F.max_by(F.col(c), F.col("commit_seq")).alias(c) for c in value_cols],
        F.max("commit_seq").alias("commit_seq"),
    )
    if requested is None:
        return latest
    return requested.select("topic", "partition").distinct().join(latest, on=["topic", "partition"], how="left")


def partition_group_members(df: DataFrame, group: str = "group") -> DataFrame:
    """A4: topic-partitions of each partition group, as a sorted list and a count."""
    tp = F.concat(F.col("topic"), F.lit("-"), F.col("partition").cast("string"))
    return (
        df.select(group, tp.alias("_tp"))
        .distinct()
        .groupBy(group)
        .agg(F.array_join(F.array_sort(F.collect_list("_tp")), ",").alias("members"), F.count(F.lit(1)).alias("partitions"))
    )

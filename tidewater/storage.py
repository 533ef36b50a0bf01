"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .session import require_checkpoint_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a derived frame once as a Parquet table in the shared checkpoint
    folder and read it back: cuts the lineage where several consumers would
    otherwise each recompute it (chained ordered scans), and survives
    executor loss (unlike a local checkpoint)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    import uuid

    root = require_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/tidewater-{name}-{uuid.uuid4().hex[:12]}"

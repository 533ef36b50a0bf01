"""Streaming load: read -> (W1 + X1 state) -> foreachBatch(decode, stage, publish).

Each micro-batch is published under its batch id, so a batch re-run after
a failure overwrites the same files and a published batch is skipped
(``plans.sink.publish``).  Offsets are tracked by the query checkpoint,
which must sit in a shared folder (default: under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import scope_columns
from ..operators.partitioning import partition_columns, time_partition
from ..operators.rolling import Limits
from ..plans.loads import LoadSpec, publish_staged, with_status
from ..plans.sink import _FS
from ..session import require_checkpoint_dir
from .open_files import hold_open_files
from .processors import offset_range_dedup, watermark_and_dedup


def dedup_stream(stream: DataFrame, spec: LoadSpec) -> DataFrame:
    """Watermark and dedup state for a stream, per the spec's rule.

    The scope of the recent-key cache is that of the batch form: None (topic-
    partition), ``"root"``, columns or a Column.  Offset and time rules compare
    records of one topic-partition; a scope with them is refused.
    """
    x, scope = scope_columns(stream, spec.scope)
    if "_tw_group" in scope:
        x, scope = x.withColumnRenamed("_tw_group", "tw_scope"), ["tw_scope"]
    if spec.dedup == "recent":
        marked = watermark_and_dedup(x, spec.key_cache, scope)
    else:
        if spec.scope is not None and spec.dedup is not None:
            raise ValueError(f"dedup rule {spec.dedup!r} compares records of one topic-partition; scope must be None")
        marked = watermark_and_dedup(x, None, None).drop("is_dup")
        if spec.dedup == "offsets":
            marked = offset_range_dedup(marked, spec.dedup_offsets)
        elif spec.dedup == "time":
            marked = offset_range_dedup(marked, spec.dedup_ms, by="time")
        elif spec.dedup is None:
            marked = marked.withColumn("is_dup", F.lit(False))
        else:
            raise ValueError(f"unknown dedup rule {spec.dedup!r}")
    return marked.drop("tw_scope")


def load_stream(
    stream: DataFrame,
    base: str,
    spec: LoadSpec = LoadSpec(),
    checkpoint: str | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the streaming load; ``trigger`` e.g. {"availableNow": True} or {"processingTime": "5 minutes"}.

    With ``any_file`` a micro-batch publishes the commits that closed in it; a quiet partition's files
    close ``roll_open_ms`` after their first record, which takes a processing-time trigger (W5)."""
    spark: SparkSession = stream.sparkSession
    if checkpoint is None:
        checkpoint = f"{require_checkpoint_dir(spark).rstrip('/')}/tidewater-stream-{query_name or 'load'}"
    marked = dedup_stream(stream, spec)
    if spec.any_file:
        # files stay open over micro-batches until a limit or the heartbeat's timer closes them
        if spec.layout not in ("hourly", "daily") or spec.scope is not None:
            raise ValueError("any_file streams commit time files per topic-partition")
        named = F.concat_ws("/", *partition_columns(spec.layout))
        size = F.coalesce(F.octet_length("key"), F.lit(0)) + F.coalesce(F.octet_length("value"), F.lit(0))
        limits = Limits(spec.roll_records, spec.roll_bytes, spec.roll_open_ms)
        marked = hold_open_files(time_partition(marked, spec.layout, spec.time_column), limits, named, size).drop(*partition_columns(spec.layout))
    staging = f"{base.rstrip('/')}/_staging"

    def each(batch: DataFrame, batch_id: int) -> None:
        # the micro-batch is written once with what became of every record; files,
        # positions, dead letters and counts all come from that table
        staged = f"{staging}/prepared={batch_id}"
        with_status(batch, spec).write.mode("overwrite").parquet(staged)
        publish_staged(batch.sparkSession, staged, base, batch_id, spec, spec.roll_records)
        _FS(spark, base).delete(staged)

    w = marked.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()

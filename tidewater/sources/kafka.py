"""Kafka source and sink options.

These build Spark's own Kafka reader and writer; no client code runs here.
The Kafka connector jar must be on the cluster's classpath (it is not in
the local test image, so tests check the options only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Consumer settings Spark manages itself or rejects; passing them through
# would be ignored or fail, so they are refused up front.  (``group.id`` is
# passed as ``kafka.group.id``; offsets are still tracked in the checkpoint.)
FORBIDDEN = {
    "auto.offset.reset": "use startingOffsets",
    "enable.auto.commit": "offsets live in the checkpoint",
    "key.deserializer": "keys are always bytes",
    "value.deserializer": "values are always bytes",
    "interceptor.classes": "not supported by Spark's Kafka source",
}


def kafka_options(
    bootstrap_servers: str,
    topics: str | list[str],
    consumer: dict[str, str] | None = None,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_offsets_per_trigger: int | None = None,
    max_trigger_delay: str | None = None,
    read_committed: bool = True,
    min_partitions: int | None = None,
    starting_timestamp_ms: int | None = None,
) -> dict[str, str]:
    """Reader options.

    S2 topics: a list or comma-separated string; S3 start: earliest unless a
    checkpoint exists; S4 offsets: always the checkpoint's; S5 isolation:
    read_committed by default; S6 intake: offsets per trigger; S7 other
    consumer settings pass through as ``kafka.<key>`` (also
    ``max.poll.records``, the client's fetch buffer: it is no intake limit).
    W6 on a broker:
    ``starting_timestamp_ms`` starts every partition at its first offset
    whose time is at or after it (``startingTimestamp``).
    """
    topic_list = topics if isinstance(topics, str) else ",".join(topics)
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(t.strip() for t in topic_list.split(",") if t.strip()),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if starting_timestamp_ms is not None:
        opts.pop("startingOffsets")
        opts["startingTimestamp"] = str(starting_timestamp_ms)
    if read_committed:
        opts["kafka.isolation.level"] = "read_committed"
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_offsets_per_trigger:
        opts["minOffsetsPerTrigger"] = str(min_offsets_per_trigger)
    if max_trigger_delay:
        opts["maxTriggerDelay"] = max_trigger_delay
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    for k, v in (consumer or {}).items():
        key = k[len("kafka."):] if k.startswith("kafka.") else k
        if key in FORBIDDEN:
            raise ValueError(f"consumer setting {key!r} is not passed through: {FORBIDDEN[key]}")
        opts[f"kafka.{key}"] = str(v)
    return opts


def read_kafka(spark: SparkSession, streaming: bool = True, ending_offsets: str = "latest", **kw) -> DataFrame:
    """Kafka topics as a stream (default) or a bounded batch, raw bytes.

    ``ending_offsets`` ends a batch: a JSON map of offsets pins it, so that every
    job of the load reads the same records; ``latest`` is resolved by each job.
    """
    opts = kafka_options(**kw)
    if streaming:
        return spark.readStream.format("kafka").options(**opts).load()
    opts.pop("maxOffsetsPerTrigger", None)
    opts.pop("minOffsetsPerTrigger", None)
    opts.pop("maxTriggerDelay", None)
    opts["endingOffsets"] = ending_offsets
    return spark.read.format("kafka").options(**opts).load()


def kafka_sink_options(bootstrap_servers: str, topic: str, producer: dict[str, str] | None = None) -> dict[str, str]:
    """Writer options; every write is acknowledged by all replicas."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, "kafka.acks": "all"}
    for k, v in (producer or {}).items():
        opts[k if k.startswith("kafka.") else f"kafka.{k}"] = str(v)
    return opts


def write_kafka(records: DataFrame, bootstrap_servers: str, topic: str, producer: dict[str, str] | None = None) -> None:
    """Keyed records (``key``, ``value`` bytes) to a topic, batch write."""
    out = records.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    out.write.format("kafka").options(**kafka_sink_options(bootstrap_servers, topic, producer)).save()


def write_kafka_stream(records: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str, producer: dict[str, str] | None = None, trigger: dict | None = None):
    """K10 as a stream: keyed records to a topic, at least once, offsets in ``checkpoint``; returns the query."""
    out = records.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    writer = out.writeStream.format("kafka").options(**kafka_sink_options(bootstrap_servers, topic, producer))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

"""Kafka-shaped logs: the offline stand-in for a broker (S8) and test logs.

``read_stream_log`` reads a directory of Parquet files in Spark's Kafka
source schema, as a batch or as a stream, so every loader plan runs the same
way on a broker topic (``sources.kafka.read_kafka``) and on files.

``events_log`` / ``orders_log`` derive such a log from the driver's tables.
The rule is fixed so that DuckDB can compute the same rows:

* events: topic ``events``; partition ``user_id % 3``; offset ``event_id``
  (offsets of one partition therefore have gaps, as on a compacted or
  transactional topic); timestamp = ``ts`` minus 90 minutes when
  ``event_id % 7 = 0`` (late records); key = ``user_id`` as text.
* orders: topic ``orders``; partition ``o_custkey % 3``; offset
  ``o_orderkey``; timestamp ``o_orderdate`` minus 90 minutes when
  ``o_orderkey % 7 = 0``; key = ``o_custkey`` as text.

Every row of the source table becomes one record; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import KAFKA_SCHEMA

# Fixed values of the test-log rule.
LATENESS_MS = 5_400_000  # 90 minutes
LATE_EVERY = 7  # every record whose id is a multiple of 7 is late
LOG_PARTITIONS = 3
CORRUPT_EVERY = 50  # decode fixtures: ids that are multiples of 50 carry bad bytes


def read_stream_log(spark: SparkSession, path: str, streaming: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Kafka-schema Parquet directory as a batch or streaming DataFrame."""
    if streaming:
        reader = spark.readStream.schema(KAFKA_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.parquet(path)
    return spark.read.schema(KAFKA_SCHEMA).parquet(path)


def write_log(records: DataFrame, path: str, mode: str = "append") -> None:
    """Offline counterpart of writing to a topic: records in Kafka schema, appended as files (S8's input)."""
    records.select(*KAFKA_SCHEMA.fieldNames()).write.mode(mode).parquet(path)


def _late(id_col: Column) -> Column:
    return F.when(id_col % LATE_EVERY == 0, F.lit(LATENESS_MS)).otherwise(F.lit(0))


def _log(
    df: DataFrame, topic: str, key_col: str, id_col: str, ts_col: str, payload: list[Column]
) -> DataFrame:
    ts_ms = F.unix_millis(F.col(ts_col).cast("timestamp")) - _late(F.col(id_col))
    return df.select(
        F.col(key_col).cast("string").cast("binary").alias("key"),
        F.lit(topic).alias("topic"),
        (F.col(key_col) % LOG_PARTITIONS).cast("int").alias("partition"),
        F.col(id_col).cast("long").alias("offset"),
        F.timestamp_millis(ts_ms).alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *payload,
    )


def events_log(spark: SparkSession, sf_dir: str, payload: bool = False) -> DataFrame:
    """Kafka-shaped log over the ``events`` table (no ``value`` column).

    With ``payload=True`` the event columns needed to build a message are kept
    (prefixed ``ev_``); ``operators.codec.encode_events`` turns them into
    ``value`` bytes.
    """
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    extra = []
    if payload:
        extra = [
            F.col("event_id").alias("ev_id"),
            F.col("event_type").alias("ev_type"),
            F.col("value").alias("ev_value"),
            F.col("user_id").alias("ev_user"),
            F.get_json_object("props", "$.k").try_cast("int").alias("ev_k"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("ev_ts_ms"),
        ]
    return _log(ev, "events", "user_id", "event_id", "ts", extra)


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second topic: Kafka-shaped log over ``orders``."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return _log(o, "orders", "o_custkey", "o_orderkey", "o_orderdate", [])


def two_topic_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` and ``orders`` as one multi-topic subscription."""
    return events_log(spark, sf_dir).unionByName(orders_log(spark, sf_dir))


# SQL text of the same rule, for DuckDB oracles (views events / orders).
EVENTS_LOG_SQL = f"""
SELECT CAST(user_id AS VARCHAR) AS k, 'events' AS topic,
       CAST(user_id % {LOG_PARTITIONS} AS INTEGER) AS "partition",
       CAST(event_id AS BIGINT) AS "offset",
       epoch_us(ts) // 1000 - CASE WHEN event_id % {LATE_EVERY} = 0 THEN {LATENESS_MS} ELSE 0 END AS ts_ms
FROM events"""

ORDERS_LOG_SQL = f"""
SELECT CAST(o_custkey AS VARCHAR) AS k, 'orders' AS topic,
       CAST(o_custkey % {LOG_PARTITIONS} AS INTEGER) AS "partition",
       CAST(o_orderkey AS BIGINT) AS "offset",
       epoch_us(o_orderdate) // 1000 - CASE WHEN o_orderkey % {LATE_EVERY} = 0 THEN {LATENESS_MS} ELSE 0 END AS ts_ms
FROM orders"""

"""Fixed schemas: the Kafka record, the loaded message and its metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark's Kafka source schema (the subset a loader reads; headers left out).
KAFKA_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
    ]
)

TOPIC_PARTITION = ("topic", "partition")

# Message Header: uuid, original_producer, recent_producer, creation_time
# (field numbers 1-4; creation_time is sfixed64).
HEADER = T.StructType(
    [
        T.StructField("uuid", T.StringType(), True),
        T.StructField("original_producer", T.StringType(), True),
        T.StructField("recent_producer", T.StringType(), True),
        T.StructField("creation_time", T.LongType(), True),
    ]
)

# Message ComplexType: header, id, name, price, isOn, somethings
# (field numbers 1-6).
COMPLEX_TYPE = T.StructType(
    [
        T.StructField("header", HEADER, True),
        T.StructField("id", T.LongType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("isOn", T.BooleanType(), True),
        T.StructField("somethings", T.ArrayType(T.IntegerType(), True), True),
    ]
)

# Metadata group written after the message fields; all times epoch millis.
KAFKA_META = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("watermark", T.LongType(), False),
    ]
)

META_COL = "_kafka"


def output_schema(message: T.StructType = COMPLEX_TYPE) -> T.StructType:
    """Loaded row schema: message fields first, ``_kafka`` last."""
    return T.StructType(list(message.fields) + [T.StructField(META_COL, KAFKA_META, False)])


def ts_millis(col: str | Column = "timestamp") -> Column:
    """Epoch millis of a timestamp column (works for NTZ via UTC session)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_millis(c.cast("timestamp"))


def key_string(col: str | Column = "key") -> Column:
    """Kafka key bytes as UTF-8 text; null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def kafka_meta(watermark: str | Column = "watermark") -> Column:
    """The ``_kafka`` struct for a Kafka-shaped row."""
    wm = F.col(watermark) if isinstance(watermark, str) else watermark
    return F.struct(
        F.col("topic").alias("topic"),
        F.col("partition").alias("partition"),
        F.col("offset").alias("offset"),
        ts_millis("timestamp").alias("timestamp"),
        wm.cast("long").alias("watermark"),
    )


def assert_kafka_shaped(df: DataFrame, need: tuple[str, ...] = ("topic", "partition", "offset")) -> None:
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise ValueError(f"input lacks Kafka columns {missing}; has {df.columns}")

"""Decode, validate, annotate and filter records (R1-R8), and encode (K10 side).

Decoding runs in the JVM with ``from_protobuf`` when the spark-protobuf
package is on the classpath, else as ``mapInArrow``: Arrow batches in, the
``value`` bytes parsed with the message class, other columns passing
through untouched (zero-copy).  A record that does not parse — or has a null value (a
tombstone) — is marked ``_corrupt`` instead of failing the job; the load
plans drop it (R2) and report it (R3).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from google.protobuf.message import DecodeError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import proto
from ..schema import KAFKA_META, META_COL, kafka_meta
from ..session import ship_package
from ..sources.logs import CORRUPT_EVERY

CORRUPT = "_corrupt"
# Fixed value: bytes that claim a 127-byte field 1 but end at once; never valid.
CORRUPT_BYTES = b"\x0a\x7f"


def jvm_protobuf_available(spark) -> bool:
    """True when the spark-protobuf package is on the cluster's classpath."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.protobuf.ProtobufDataToCatalyst")
        return True
    except Exception:  # noqa: BLE001 - py4j raises a generic error for a missing class
        return False


def _decode_jvm(df: DataFrame, message: str, descriptor_set: bytes | None, value_col: str) -> DataFrame:
    from pyspark.sql.protobuf.functions import from_protobuf

    desc = descriptor_set or proto.builtin_descriptor_set()
    parsed = from_protobuf(
        F.col(value_col), message, binaryDescriptorSet=desc,
        options={"mode": "PERMISSIVE", "emit.default.values": "true"},
    )
    names = [f.name for f in proto.spark_schema(proto.message_class(message, descriptor_set).DESCRIPTOR).fields]
    keep = [c for c in df.columns if c != value_col]
    x = df.withColumn("_tw_msg", parsed)
    return x.select(*keep, *[F.col(f"_tw_msg.{n}").alias(n) for n in names], F.col("_tw_msg").isNull().alias(CORRUPT))


def _parsed(parse, value: bytes | None):
    """The parsed value, None for a null or unreadable one."""
    if value is None:
        return None
    try:
        return parse(value)
    except (DecodeError, ValueError, RuntimeError):
        return None


def decode_proto(
    df: DataFrame,
    message: str = "messages.ComplexType",
    descriptor_set: bytes | None = None,
    value_col: str = "value",
    engine: str = "auto",
    partitions: int | None = None,
) -> DataFrame:
    """Parse ``value`` into the message's top-level columns; mark failures ``_corrupt``.

    Output: input columns except ``value``, then message fields, then
    ``_corrupt``.  proto3 rules: absent scalars read as defaults, an absent
    sub-message is null, empty bytes are a valid all-default message.
    ``engine``: ``"jvm"`` (``from_protobuf``, needs the spark-protobuf
    package), ``"python"`` (Arrow batches, per-row parse), or ``"auto"``:
    the JVM when the package is present.  ``partitions``: deal the rows to
    so many tasks first, for inputs of few splits (a shuffle; None: as read).
    """
    if partitions:
        df = df.repartition(partitions)
    if engine == "jvm" or (engine == "auto" and jvm_protobuf_available(df.sparkSession)):
        return _decode_jvm(df, message, descriptor_set, value_col)
    ship_package(df.sparkSession)
    msg_schema = proto.spark_schema(proto.message_class(message, descriptor_set).DESCRIPTOR)
    keep = [f for f in df.schema.fields if f.name != value_col]
    out_schema = T.StructType(keep + list(msg_schema.fields) + [T.StructField(CORRUPT, T.BooleanType(), False)])
    keep_names = [f.name for f in keep]
    arrow_fields = [(f.name, proto.arrow_type(f.dataType)) for f in msg_schema.fields]
    names = [f.name for f in msg_schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls = proto.message_class(message, descriptor_set)
        read = proto.compile_reader(cls.DESCRIPTOR)
        parse = cls.FromString
        empty = (None,) * len(names)
        for batch in batches:
            arrays = [batch.column(n) for n in keep_names]
            values = proto.python_values(batch.column(value_col))
            try:
                messages = [_parsed(parse, v) for v in values]
                arrays += proto.read_columns(cls.DESCRIPTOR, messages)
                bad = [m is None for m in messages]
            except (DecodeError, ValueError, RuntimeError):  # a field that cannot be read: row by row
                records = [_parsed(lambda b: read(parse(b)), v) for v in values]
                bad = [r is None for r in records]
                cols = list(zip(*(empty if r is None else r for r in records)))
                arrays += [pa.array(list(c), type=t) for c, (_, t) in zip(cols, arrow_fields)]
            arrays.append(pa.array(bad, type=pa.bool_()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep_names, *names, CORRUPT])

    return df.mapInArrow(run, out_schema)


def drop_malformed(decoded: DataFrame) -> DataFrame:
    """R2: rows that failed to parse are left out; the stream goes on."""
    return decoded.where(~F.col(CORRUPT)).drop(CORRUPT)


def malformed_report(decoded: DataFrame) -> DataFrame:
    """The dead letters — where each skipped record sits."""
    return decoded.where(F.col(CORRUPT)).select("topic", "partition", "offset")


def malformed_counts(decoded: DataFrame) -> DataFrame:
    """Skipped records per topic-partition (partial aggregation)."""
    return (
        decoded.where(F.col(CORRUPT))
        .groupBy("topic", "partition")
        .agg(F.count(F.lit(1)).alias("malformed"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
    )


def annotate_kafka(
    decoded: DataFrame, message_fields: list[str] | None = None, watermark: str | Column = "watermark"
) -> DataFrame:
    """Message fields first, then the non-null ``_kafka`` struct, last.

    The key is not kept: deduplication happens before this projection.
    """
    if message_fields is None:
        message_fields = [f.name for f in proto.spark_schema(proto.message_class().DESCRIPTOR).fields]
    extra = [c for c in decoded.columns if c.startswith("_tw_part_")]
    return decoded.select(*message_fields, kafka_meta(watermark).alias(META_COL), *extra)


def required_violations(loaded: DataFrame) -> DataFrame:
    """Rows breaking the required ``_kafka`` group (the group or any of its fields null).

    The loaded schema marks ``_kafka`` and its fields required; Spark keeps
    such constraints as data checks, not as file properties, so this is the
    check (empty on a valid load).
    """
    fields = [F.col(f"{META_COL}.{f.name}").isNull() for f in KAFKA_META.fields]
    bad = F.col(META_COL).isNull()
    for c in fields:
        bad = bad | c
    return loaded.where(bad)


def filter_records(df: DataFrame, predicate: Column | None = None, python_predicate=None) -> DataFrame:
    """Keep records passing a predicate on the *decoded* message.

    Runs after dedup and decode (a filtered-out record still marked its key
    as seen).  A Column stays in the JVM; a Python callable on a pandas frame
    of the row (returning a boolean Series) runs as an Arrow-batched UDF.
    """
    if predicate is not None:
        return df.where(predicate)
    if python_predicate is None:
        return df

    cols = [c for c in df.columns if c != META_COL]

    @F.pandas_udf(T.BooleanType())
    def keep(frame: pd.DataFrame) -> pd.Series:
        return python_predicate(frame).astype(bool)

    return df.where(keep(F.struct(*[F.col(c) for c in cols])))


def format_records(df: DataFrame, formatter) -> DataFrame:
    """User record formatter, one record -> 0..n rows (DataFrame -> DataFrame)."""
    return formatter(df)


def encode_proto(
    df: DataFrame,
    struct_col: str,
    message: str = "messages.ComplexType",
    descriptor_set: bytes | None = None,
    out_col: str = "value",
    partitions: int | None = None,
) -> DataFrame:
    """Serialize a struct column (in the message's Spark shape) to bytes (``to_protobuf`` when present)."""
    if partitions:
        df = df.repartition(partitions)
    if jvm_protobuf_available(df.sparkSession):
        from pyspark.sql.protobuf.functions import to_protobuf

        desc = descriptor_set or proto.builtin_descriptor_set()
        return df.withColumn(out_col, to_protobuf(F.col(struct_col), message, binaryDescriptorSet=desc)).drop(struct_col)
    ship_package(df.sparkSession)
    keep = [f for f in df.schema.fields if f.name != struct_col]
    out_schema = T.StructType(keep + [T.StructField(out_col, T.BinaryType(), True)])
    keep_names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls = proto.message_class(message, descriptor_set)
        for batch in batches:
            enc = [None if m is None else m.SerializeToString() for m in proto.write_messages(cls, batch.column(struct_col))]
            arrays = [batch.column(n) for n in keep_names] + [pa.array(enc, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep_names, out_col])

    return df.mapInArrow(run, out_schema)


def complex_from_events() -> Column:
    """ComplexType struct for a log built with ``events_log(payload=True)``.

    id = event id, name = event type, price = value, isOn = id % 5 <> 0,
    somethings = [user id, props.k], header.uuid = id as text,
    header.creation_time = event time in millis.
    """
    return F.struct(
        F.struct(
            F.col("ev_id").cast("string").alias("uuid"),
            F.lit("org_prod").alias("original_producer"),
            F.lit("recent_prod").alias("recent_producer"),
            F.col("ev_ts_ms").alias("creation_time"),
        ).alias("header"),
        F.col("ev_id").alias("id"),
        F.col("ev_type").alias("name"),
        F.col("ev_value").alias("price"),
        (F.col("ev_id") % 5 != 0).alias("isOn"),
        F.filter(F.array(F.col("ev_user").cast("int"), F.col("ev_k")), lambda v: v.isNotNull()).alias("somethings"),
    )


def encode_events(log_with_payload: DataFrame, corrupt_every: int | None = None, partitions: int | None = None) -> DataFrame:
    """Kafka log with ``value`` = serialized ComplexType per event.

    ``corrupt_every``: records whose id is a multiple get ``CORRUPT_BYTES``
    (decode fixtures, R2/R3).
    """
    x = log_with_payload.withColumn("_tw_msg", complex_from_events())
    x = encode_proto(x, "_tw_msg", partitions=partitions)
    if corrupt_every:
        x = x.withColumn(
            "value", F.when(F.col("ev_id") % corrupt_every == 0, F.lit(CORRUPT_BYTES)).otherwise(F.col("value"))
        )
    return x.drop("ev_id", "ev_type", "ev_value", "ev_user", "ev_k", "ev_ts_ms")


__all__ = [
    "CORRUPT",
    "CORRUPT_EVERY",
    "annotate_kafka",
    "complex_from_events",
    "decode_proto",
    "drop_malformed",
    "encode_events",
    "encode_proto",
    "filter_records",
    "format_records",
    "malformed_counts",
    "malformed_report",
]

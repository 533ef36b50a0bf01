"""Record generators (S9, S10) as Spark jobs.

Both rules are applied to an index DataFrame, so they scale with whatever
drives them (a ``range`` or a table); ``generate_*`` wrap a ``range``.
Randomness is seeded and derived from the row id (``rand(seed)`` would
depend on partitioning), so a re-run yields the same records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.codec import encode_proto
from ..schema import COMPLEX_TYPE

ALNUM = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _uuid_from(*cols: Column) -> Column:
    h = F.sha2(F.concat_ws("/", *[c.cast("string") for c in cols]), 256)
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)
    )


def test_records_from_index(idx: DataFrame, base_seconds: int = 0) -> DataFrame:
    """S10 rule for rows (topic, partition, n).

    offset = n; key = ``key{partition}-{n}``; name = ``some_name{n}``; id = n;
    price = 0.4 n; isOn = n % 5 <> 0; somethings = [n, 2n, 3n] if n % 3 = 0,
    [] if n % 7 = 0, else [n, 5n]; timestamp = 0; header producers
    ``org_prod`` / ``recent_prod``, creation time ``base_seconds``.
    """
    n = F.col("n").cast("long")
    n32 = n.cast("int")
    somethings = (
        F.when(n % 3 == 0, F.array(n32, n32 * 2, n32 * 3))
        .when(n % 7 == 0, F.array().cast("array<int>"))
        .otherwise(F.array(n32, n32 * 5))
    )
    return idx.select(
        F.col("topic"),
        F.col("partition").cast("int").alias("partition"),
        n.alias("offset"),
        F.format_string("key%d-%d", F.col("partition"), n).cast("binary").alias("key"),
        F.timestamp_millis(F.lit(0)).alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.struct(
            _uuid_from(F.col("topic"), F.col("partition"), n).alias("uuid"),
            F.lit("org_prod").alias("original_producer"),
            F.lit("recent_prod").alias("recent_producer"),
            F.lit(base_seconds).cast("long").alias("creation_time"),
        ).alias("header"),
        n.alias("id"),
        F.concat(F.lit("some_name"), n.cast("string")).alias("name"),
        (F.lit(0.4) * n).alias("price"),
        (n % 5 != 0).alias("isOn"),
        somethings.alias("somethings"),
    )


def generate_test_records(spark: SparkSession, topics: list[str], partitions: int, messages: int) -> DataFrame:
    """Topics x partitions x messages records from one ``range`` (no join)."""
    per_topic = partitions * messages
    r = spark.range(len(topics) * per_topic)
    topic_arr = F.array(*[F.lit(t) for t in topics])
    idx = r.select(
        F.element_at(topic_arr, (F.floor(F.col("id") / per_topic) + 1).cast("int")).alias("topic"),
        (F.floor(F.col("id") / messages) % partitions).cast("int").alias("partition"),
        (F.col("id") % messages).alias("n"),
    )
    return test_records_from_index(idx)


def as_kafka_records(records: DataFrame) -> DataFrame:
    """Encode generated message columns into a Kafka-schema ``value``."""
    msg = F.struct(*[F.col(f.name) for f in COMPLEX_TYPE.fields])
    x = records.withColumn("_tw_msg", msg)
    x = encode_proto(x, "_tw_msg")
    return x.select("key", "value", "topic", "partition", "offset", "timestamp", "timestampType")


def complex_records_from_ids(ids: DataFrame, seed: int = 0) -> DataFrame:
    """S9 rule over ids ``i``: key = i, sent twice when i % 10 = 0.

    Message: id 0, name 10 alphanumerics, price in [0, 100), random isOn,
    two random int32 — all drawn from a hash of (seed, i, field) so they are
    stable on re-run.  ``copy`` numbers the sends of one key.
    """
    i = F.col("i").cast("long")

    def u(tag: str, k: int = 0) -> Column:  # uniform [0, 1) from the hash of (seed, i, tag, k)
        return (F.xxhash64(F.lit(seed), i, F.lit(tag), F.lit(k)).bitwiseAND(F.lit((1 << 53) - 1))) / F.lit(float(1 << 53))

    alnum = F.lit(ALNUM)
    name = F.concat(*[F.substring(alnum, (F.floor(u("name", k) * len(ALNUM)) + 1).cast("int"), 1) for k in range(10)])
    to_int32 = lambda c: (F.floor(c * F.lit(float(1 << 32))) - F.lit(1 << 31)).cast("int")
    x = ids.select(
        i.alias("i"),
        F.explode(F.when(i % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return x.select(
        i.cast("string").cast("binary").alias("key"),
        "copy",
        F.struct(
            _uuid_from(F.lit(seed), i).alias("uuid"),
            F.lit("original_one").alias("original_producer"),
            F.lit("recent_one").alias("recent_producer"),
            F.lit(0).cast("long").alias("creation_time"),
        ).alias("header"),
        F.lit(0).cast("long").alias("id"),
        name.alias("name"),
        (u("price") * 100.0).alias("price"),
        (u("isOn") < 0.5).alias("isOn"),
        F.array(to_int32(u("s", 0)), to_int32(u("s", 1))).alias("somethings"),
    )


def generate_complex_records(spark: SparkSession, last: int = 100_001, seed: int = 0) -> DataFrame:
    """Ids 0..last inclusive (100,002 keys, 110,003 sends by default)."""
    return complex_records_from_ids(spark.range(last + 1).select(F.col("id").alias("i")), seed)

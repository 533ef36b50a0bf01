"""A key holding a third of the log: results stay exact and its rows spread over tasks."""

from pyspark.sql import functions as F

from conftest import SF
from tidewater.operators import dedup
from cache_model import simulate_cache
from tidewater.operators.recent_keys import dedup_recent_keys
from tidewater.operators.scans import running_max
from tidewater.sources.logs import events_log


def _hot_log(spark):
    # every event of users with user_id % 3 = 0 (one log partition) carries the same key
    log = events_log(spark, SF)
    hot = F.when(F.col("partition") == 0, F.lit("hot")).otherwise(F.col("key").cast("string"))
    return log.withColumn("key", hot.cast("binary"))


def test_hot_key_offset_range_matches_lag(spark):
    log = _hot_log(spark)
    got = dedup.dedup_offset_range(log, 10).select("topic", "partition", "offset", "is_dup").toPandas()
    pdf = log.select("topic", "partition", "offset", F.col("key").cast("string").alias("k")).toPandas().sort_values("offset")
    prev = pdf.groupby(["topic", "partition", "k"])["offset"].shift()
    pdf["exp"] = prev.notna() & (pdf.offset - prev <= 10)
    m = got.merge(pdf, on=["topic", "partition", "offset"])
    assert len(m) == 10_000 and (m.is_dup == m.exp).all()


def test_hot_key_spreads_over_tasks(spark):
    # AQE would merge these small shuffle partitions into one; look at placement without that
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _spread_checks(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _spread_checks(spark):
    log = _hot_log(spark).where("partition = 0")
    # X3 windows per (scope, key, bucket): the hot key's rows meet in many tasks
    sizes = dedup.dedup_offset_range(log, 50).rdd.glom().map(len).collect()
    assert sum(sizes) == log.count() and sum(1 for n in sizes if n > 0) > 1 and max(sizes) < sum(sizes) / 2
    # chunked running max: one partition's rows are windowed per chunk, in many tasks
    y = running_max(log.withColumn("ms", F.unix_millis("timestamp")), ["topic", "partition"], "offset", "ms", "wm", chunk_size=500)
    sizes = y.rdd.glom().map(len).collect()
    assert sum(1 for n in sizes if n > 0) > 1 and max(sizes) < sum(sizes) / 2


def test_hot_partition_exact_cache(spark):
    log = _hot_log(spark)
    got = dedup_recent_keys(log, 5, chunk_size=700, strategy="chunked").select("topic", "partition", "offset", F.col("key").cast("string").alias("k"), "is_dup").toPandas()
    for _, g in got.groupby(["topic", "partition"]):
        g = g.sort_values("offset")
        assert simulate_cache(g.k.tolist(), 5) == g.is_dup.tolist()

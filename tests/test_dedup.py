"""X1-X4 on Spark against direct simulations; reference fixture counts."""

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.operators import dedup
from cache_model import simulate_cache
from tidewater.operators.recent_keys import dedup_recent_keys
from tidewater.sources.generators import generate_test_records
from tidewater.sources.logs import events_log, two_topic_log


def _brute_x1(pdf, capacity, group_cols, order):
    out = {}
    for _, g in pdf.groupby(group_cols):
        g = g.sort_values(order)
        for off_key, flag in zip(zip(g.topic, g.partition, g.offset), simulate_cache(g.k.tolist(), capacity)):
            out[off_key] = flag
    return out


def _collect(df):
    return df.select("topic", "partition", "offset", F.col("key").cast("string").alias("k"), F.unix_millis("timestamp").alias("ts"), "is_dup").toPandas()


def test_recent_keys_per_partition_small_chunks(spark):
    log = events_log(spark, SF_SMALL)
    for cap, chunk in [(3, 7), (10, 50), (40, 1000)]:
        got = _collect(dedup_recent_keys(log, cap, chunk_size=chunk, strategy="chunked"))
        exp = _brute_x1(got, cap, ["topic", "partition"], ["offset"])
        assert {k: v for k, v in zip(zip(got.topic, got.partition, got.offset), got.is_dup)} == exp


def test_recent_keys_root_scope_two_topics(spark):
    log = two_topic_log(spark, SF_SMALL)
    got = _collect(dedup_recent_keys(log, 25, scope="root", num_chunks=6, strategy="chunked"))
    got["g"] = "root"
    exp = _brute_x1(got, 25, ["g"], ["ts", "topic", "partition", "offset"])
    assert {k: v for k, v in zip(zip(got.topic, got.partition, got.offset), got.is_dup)} == exp


def test_back_to_back_copies(spark):
    # 1 topic x 3 partitions x 10 messages, each written twice; capacity 10, single scope
    recs = generate_test_records(spark, ["test_topic_1"], 3, 10).select("key", "topic", "partition", "offset", "timestamp")
    copies = recs.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    # the copy follows at once: order by (partition, offset, copy); give each a distinct position
    log = copies.withColumn("offset", F.col("offset") * 2 + F.col("copy")).drop("copy")
    marked = dedup_recent_keys(log, 10, scope="root", order=["partition", "offset"])
    assert marked.where(~F.col("is_dup")).count() == 30


def test_three_topics_single_scope_vs_per_partition(spark):
    recs = generate_test_records(spark, ["t1", "t2", "t3"], 3, 10).select("key", "topic", "partition", "offset", "timestamp")
    root = dedup_recent_keys(recs, 30, scope="root", order=["topic", "partition", "offset"])
    assert root.where(~F.col("is_dup")).count() == 30
    per_tp = dedup_recent_keys(recs, 30)
    assert per_tp.where(~F.col("is_dup")).count() == 90


def test_distinct_keys_all_kept(spark):
    recs = generate_test_records(spark, ["t"], 3, 10).select("key", "topic", "partition", "offset", "timestamp")
    assert dedup_recent_keys(recs, 10, scope="root", order=["partition", "offset"]).where("is_dup").count() == 0


def test_null_key_never_duplicate(spark):
    df = spark.createDataFrame(
        [(None, "t", 0, 0), (None, "t", 0, 1), (b"a", "t", 0, 2), (b"a", "t", 0, 3)],
        "key binary, topic string, partition int, offset long",
    ).withColumn("timestamp", F.timestamp_millis(F.col("offset")))
    flags = [r.is_dup for r in dedup_recent_keys(df, 5).orderBy("offset").collect()]
    assert flags == [False, False, False, True]
    flags = [r.is_dup for r in dedup.dedup_offset_range(df, 5).orderBy("offset").collect()]
    assert flags == [False, False, False, True]


def test_offset_and_time_range_against_lag(spark):
    log = events_log(spark, SF_SMALL)
    x3 = dedup.dedup_offset_range(log, 7).select("topic", "partition", "offset", F.col("is_dup").alias("d3"))
    x4 = dedup.dedup_watermark_range(log, 3_600_000, chunk_size=37).select("topic", "partition", "offset", F.col("is_dup").alias("d4"))
    pdf = log.select("topic", "partition", "offset", F.col("key").cast("string").alias("k"), F.unix_millis("timestamp").alias("ts")).toPandas()
    pdf = pdf.sort_values("offset")
    g = pdf.groupby(["topic", "partition", "k"])
    pdf["prev_off"] = g["offset"].shift()
    pdf["prev_ts"] = g["ts"].shift()
    pdf["e3"] = pdf.prev_off.notna() & (pdf.offset - pdf.prev_off <= 7)
    pdf["e4"] = pdf.prev_ts.notna() & (pdf.ts - pdf.prev_ts <= 3_600_000)
    got = x3.join(x4, ["topic", "partition", "offset"]).toPandas().merge(pdf, on=["topic", "partition", "offset"])
    assert (got.d3 == got.e3).all() and (got.d4 == got.e4).all()


def test_duplicate_counts(spark):
    log = events_log(spark, SF_SMALL)
    counts = dedup.duplicate_counts(dedup.dedup_offset_range(log, 50)).toPandas()
    assert counts.records.sum() == 1000
    assert 0 < counts.duplicates.sum() < 1000


def test_rewind_warms_the_cache_for_the_next_slice(spark):
    log = events_log(spark, SF_SMALL)
    whole = dedup_recent_keys(log, 20).select("topic", "partition", "offset", "is_dup")
    first, second = log.where("offset < 500"), log.where("offset >= 500")
    warm = dedup.with_rewind(second, first, 500)
    got = dedup.drop_rewound(dedup_recent_keys(warm, 20)).select("topic", "partition", "offset", "is_dup")
    exp = whole.where("offset >= 500")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    cold = dedup_recent_keys(second, 20).select("topic", "partition", "offset", "is_dup")
    assert cold.exceptAll(exp).count() > 0  # without the rewind the slice start differs


def test_load_with_byte_limit_and_rewind(spark, scratch):
    from tidewater.operators import codec
    from tidewater.plans import loads, sink

    enc = codec.encode_events(events_log(spark, SF_SMALL, payload=True))
    spec = loads.LoadSpec(dedup="recent", key_cache=3, layout="topic_partition", roll_records=None, roll_bytes=2000,
                          history=enc.where("offset < 500"), rewind=500)
    m = loads.load(enc.where("offset >= 500"), f"{scratch}/lake", 0, spec)
    lake = sink.read_loaded(spark, f"{scratch}/lake", "topic_partition")
    whole = dedup_recent_keys(events_log(spark, SF_SMALL), 3).where("not is_dup and offset >= 500").count()
    assert whole > 0 and lake.count() == whole
    sizes = lake.groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) < 100 and len(m["files"]) == len(sizes)


def test_unbounded_strategy_equals_chunked_beyond_the_capacity(spark):
    log = events_log(spark, SF_SMALL)
    keys_per_partition = log.groupBy("partition").agg(F.countDistinct("key").alias("n")).agg(F.max("n")).first()[0]
    for cap in (keys_per_partition + 1, 2000):
        a = dedup_recent_keys(log, cap, strategy="unbounded").select("topic", "partition", "offset", "is_dup")
        b = dedup_recent_keys(log, cap, strategy="chunked").select("topic", "partition", "offset", "is_dup")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, cap
    two = two_topic_log(spark, SF_SMALL)
    a = dedup_recent_keys(two, 5000, scope="root", strategy="unbounded").select("topic", "partition", "offset", "is_dup")
    b = dedup_recent_keys(two, 5000, scope="root", strategy="chunked").select("topic", "partition", "offset", "is_dup")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_recent_keys_many_runs_against_simulation(spark):
    from conftest import SF

    log = events_log(spark, SF)
    for cap, chunk in [(5, 300), (40, 900)]:  # most chunks full (many runs) / few full chunks (long runs)
        got = _collect(dedup_recent_keys(log, cap, chunk_size=chunk, strategy="chunked"))
        exp = _brute_x1(got, cap, ["topic", "partition"], ["offset"])
        assert {k: v for k, v in zip(zip(got.topic, got.partition, got.offset), got.is_dup)} == exp


def test_fused_watermark_offset_dedup_equals_composition(spark):
    from tidewater.operators.watermark import with_stream_watermark

    log = events_log(spark, SF_SMALL)
    for n, size in [(7, 20), (50, 50), (50, 1 << 20), (1, 1)]:
        fused = dedup.watermark_offset_dedup(log, n, chunk_size=size).select("topic", "partition", "offset", "watermark", "is_dup")
        comp = dedup.dedup_offset_range(with_stream_watermark(log, chunk_size=size), n).select(
            "topic", "partition", "offset", "watermark", "is_dup")
        assert fused.count() == 1000
        assert fused.exceptAll(comp).count() == 0 and comp.exceptAll(fused).count() == 0, (n, size)


def test_root_scope_does_not_depend_on_exchange_reuse(spark):
    log = two_topic_log(spark, SF_SMALL)
    want = None
    for reuse, aqe in (("true", "true"), ("false", "true"), ("false", "false")):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        try:
            got = {(r.topic, r.partition, r.offset): r.is_dup for r in dedup_recent_keys(log, 30, scope="root", num_chunks=7).collect()}
        finally:
            spark.conf.set("spark.sql.exchange.reuse", "true")
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        want = want or got
        assert got == want

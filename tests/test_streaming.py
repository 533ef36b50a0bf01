"""Streams equal their batch forms, and a restarted query continues its state."""

import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.operators.dedup import dedup_offset_range
from tidewater.operators.recent_keys import dedup_recent_keys
from tidewater.operators.watermark import with_stream_watermark
from tidewater.plans import sink
from tidewater.plans.loads import LoadSpec
from tidewater.sources.logs import events_log, read_stream_log
from tidewater.streaming.load import dedup_stream, load_stream
from tidewater.operators.codec import encode_events

COLS = ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]


def _write_slices(spark, path, lo_hi):
    log = encode_events(events_log(spark, SF_SMALL, payload=True)).select(*COLS)
    for lo, hi in lo_hi:
        log.where(f"offset >= {lo} and offset < {hi}").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.05)  # file streams take files in modification-time order


def _run(spark, path, ckpt, out, spec):
    st = read_stream_log(spark, path, streaming=True, max_files_per_trigger=1)

    def each(batch, batch_id):  # idempotent per batch id, so a re-run batch replaces itself
        batch.select("topic", "partition", "offset", "watermark", "is_dup").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = dedup_stream(st, spec).writeStream.foreachBatch(each).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out).select("topic", "partition", "offset", "watermark", "is_dup")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_equals_batch_and_survives_restart(spark, scratch):
    path = f"{scratch}/log"
    _write_slices(spark, path, [(0, 250), (250, 500)])
    spec = LoadSpec(dedup="recent", key_cache=15)
    first = _run(spark, path, f"{scratch}/ck", f"{scratch}/out", spec).count()
    assert first == 500
    _write_slices(spark, path, [(500, 750), (750, 1000)])
    both = _run(spark, path, f"{scratch}/ck", f"{scratch}/out", spec)  # resumes from the checkpoint
    batch = dedup_recent_keys(with_stream_watermark(read_stream_log(spark, path)), 15).select("topic", "partition", "offset", "watermark", "is_dup")
    assert both.count() == 1000
    assert _same(both, batch)


def test_stream_offset_range_equals_batch(spark, scratch):
    path = f"{scratch}/log"
    _write_slices(spark, path, [(0, 400), (400, 1000)])
    got = _run(spark, path, f"{scratch}/ck", f"{scratch}/out", LoadSpec(dedup="offsets", dedup_offsets=30))
    exp = dedup_offset_range(with_stream_watermark(read_stream_log(spark, path)), 30).select("topic", "partition", "offset", "watermark", "is_dup")
    assert _same(got, exp)


def test_stream_load_publishes_each_batch(spark, scratch):
    path = f"{scratch}/log"
    _write_slices(spark, path, [(0, 500), (500, 1000)])
    st = read_stream_log(spark, path, streaming=True, max_files_per_trigger=1)
    q = load_stream(st, f"{scratch}/lake", LoadSpec(dedup="recent", key_cache=2000, roll_records=None), checkpoint=f"{scratch}/ck")
    q.awaitTermination()
    lake = sink.read_loaded(spark, f"{scratch}/lake", "hourly", committed_only=True)
    batch = dedup_recent_keys(read_stream_log(spark, path), 2000).where("not is_dup").count()
    assert lake.count() == batch


def test_metrics_from_progress(spark):
    from tidewater.operators import monitoring

    progress = [
        {"batchId": 0, "timestamp": "2024-01-01T00:00:05.000Z", "numInputRows": 10, "durationMs": {"addBatch": 120},
         "stateOperators": [{"numDroppedDuplicateRows": 2}],
         "sources": [{"startOffset": None, "endOffset": '{"t":{"0":6,"1":4}}', "latestOffset": '{"t":{"0":9,"1":4}}'}]},
        {"batchId": 1, "timestamp": "2024-01-01T00:00:10.000Z", "numInputRows": 3, "durationMs": {"addBatch": 7000},
         "stateOperators": [],
         "sources": [{"startOffset": '{"t":{"0":6,"1":4}}', "endOffset": '{"t":{"0":9,"1":4}}', "latestOffset": '{"t":{"0":9,"1":4}}'}]},
    ]
    m = monitoring.metrics_from_progress(spark, progress)
    lag = {(r.topic, r.partition, r.window_ms): r.lag for r in monitoring.offset_lag(m, window_ms=5000).collect()}
    assert lag[("t", "0", 1704067205000)] == 3 and lag[("t", "0", 1704067210000)] == 0
    batched = monitoring.records_batched_rate(m, window_ms=5000).where("partition = '0'").orderBy("window_ms").collect()
    assert [r.rate * 5 for r in batched] == [0, 3]  # first sample has no earlier value: offsets start at 0 read
    p999 = monitoring.commit_duration_quantile(m, 0.999, window_ms=5000).orderBy("window_ms").collect()
    assert len(p999) == 2 and p999[1].duration_s > 5


def test_batch_cache_rule_refuses_a_stream(spark, scratch):
    import pytest

    path = f"{scratch}/log"
    _write_slices(spark, path, [(0, 10)])
    with pytest.raises(ValueError, match="watermark_and_dedup"):
        dedup_recent_keys(read_stream_log(spark, path, streaming=True), 5)


def test_stream_time_range_equals_batch(spark, scratch):
    from tidewater.operators.dedup import dedup_watermark_range

    path = f"{scratch}/log"
    _write_slices(spark, path, [(0, 400), (400, 1000)])
    got = _run(spark, path, f"{scratch}/ck", f"{scratch}/out", LoadSpec(dedup="time", dedup_ms=3_600_000))
    exp = dedup_watermark_range(with_stream_watermark(read_stream_log(spark, path)), 3_600_000).select(
        "topic", "partition", "offset", "watermark", "is_dup"
    )
    assert _same(got, exp)


def test_stream_root_scope_keeps_watermark_per_partition(spark, scratch):
    path = f"{scratch}/log"
    _write_slices(spark, path, [(0, 400), (400, 1000)])
    got = _run(spark, path, f"{scratch}/ck", f"{scratch}/out", LoadSpec(dedup="recent", key_cache=4, scope="root"))
    exp = dedup_recent_keys(with_stream_watermark(read_stream_log(spark, path)), 4, scope="root").select(
        "topic", "partition", "offset", "watermark", "is_dup"
    )
    # the watermark is per topic-partition whatever the dedup scope
    assert got.select("topic", "partition", "offset", "watermark").exceptAll(exp.select("topic", "partition", "offset", "watermark")).count() == 0
    # the cache decisions equal the batch form when each micro-batch holds later times than the one before
    assert got.count() == 1000


def test_stream_load_by_topic_partition(spark, scratch):
    path = f"{scratch}/log"
    _write_slices(spark, path, [(0, 500), (500, 1000)])
    st = read_stream_log(spark, path, streaming=True, max_files_per_trigger=1)
    spec = LoadSpec(dedup="offsets", dedup_offsets=20, layout="topic_partition", roll_records=50)
    q = load_stream(st, f"{scratch}/lake", spec, checkpoint=f"{scratch}/ck")
    q.awaitTermination()
    lake = sink.read_loaded(spark, f"{scratch}/lake", "topic_partition", committed_only=True)
    exp = dedup_offset_range(read_stream_log(spark, path), 20).where("not is_dup").count()
    assert lake.count() == exp
    names = lake.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("f")).distinct().count()
    assert names > 2


def test_stream_offset_dedup_with_state_ttl(spark, scratch):
    from tidewater.streaming.processors import offset_range_dedup

    path = f"{scratch}/log"
    _write_slices(spark, path, [(0, 1000)])
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        st = read_stream_log(spark, path, streaming=True)
        q = (offset_range_dedup(st, 30, ttl_ms=24 * 3_600_000).writeStream.format("memory").queryName("ttl_x3")
             .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
        q.awaitTermination(300)
        got = spark.sql("select topic, partition, offset, is_dup from ttl_x3")
    finally:
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    exp = dedup_offset_range(read_stream_log(spark, path), 30).select("topic", "partition", "offset", "is_dup")
    assert _same(got, exp)


def test_stream_scopes_equal_batch(spark, scratch):
    path = f"{scratch}/log"
    log = encode_events(events_log(spark, SF_SMALL, payload=True)).select(*COLS)
    log.coalesce(1).write.mode("append").parquet(path)
    for i, scope in enumerate((F.col("partition") % 2, ["topic"], "root")):
        got = _run(spark, path, f"{scratch}/ck{i}", f"{scratch}/out{i}", LoadSpec(dedup="recent", key_cache=4, scope=scope))
        exp = dedup_recent_keys(with_stream_watermark(read_stream_log(spark, path)), 4, scope=scope)
        assert _same(got.select("topic", "partition", "offset", "is_dup"), exp.select("topic", "partition", "offset", "is_dup")), scope


def test_offset_rules_refuse_wider_scopes(spark, scratch):
    import pytest

    log = events_log(spark, SF_SMALL)
    with pytest.raises(ValueError, match="topic-partition"):
        dedup_offset_range(log, 5, scope="root")
    path = f"{scratch}/log"
    _write_slices(spark, path, [(0, 10)])
    with pytest.raises(ValueError, match="topic-partition"):
        dedup_stream(read_stream_log(spark, path, streaming=True), LoadSpec(dedup="offsets", scope="root"))


def test_streamed_batches_keep_positions_and_counts(spark, scratch):
    path = f"{scratch}/log"
    _write_slices(spark, path, [(0, 500), (500, 1000)])
    st = read_stream_log(spark, path, streaming=True, max_files_per_trigger=1)
    load_stream(st, f"{scratch}/lake", LoadSpec(dedup="offsets", dedup_offsets=20, layout="daily"), checkpoint=f"{scratch}/ck").awaitTermination()
    from tidewater.operators import monitoring, positions

    last = positions.last_committed(sink.committed_positions(spark, f"{scratch}/lake"))
    exp = positions.commit_positions(read_stream_log(spark, path)).select("topic", "partition", "next_offset", "watermark")
    assert _same(last.select("topic", "partition", "next_offset", "watermark"), exp)
    dups = dedup_offset_range(read_stream_log(spark, path), 20).where("is_dup").count()
    rate = monitoring.duplicate_rate(monitoring.metrics_from_manifests(spark, f"{scratch}/lake"), window_ms=3_600_000).groupBy().sum("rate").first()[0]
    assert dups > 0 and round(rate * 3600) == dups


def test_open_files_close_by_limit_and_by_the_heartbeat(spark, scratch):
    topic, lake = f"{scratch}/topic", f"{scratch}/lake"
    log = encode_events(events_log(spark, SF_SMALL, payload=True)).select(*COLS).where("partition = 0")
    first, more = log.where("offset < 100"), log.where("offset >= 100 and offset < 200")
    first.coalesce(1).write.mode("append").parquet(topic)
    spec = LoadSpec(dedup=None, layout="daily", any_file=True, roll_records=20, roll_open_ms=6_000)
    st = read_stream_log(spark, topic, streaming=True, max_files_per_trigger=1)
    q = load_stream(st, lake, spec, checkpoint=f"{scratch}/ckpt", trigger={"processingTime": "1 second"})
    offsets = lambda: sorted(r.o for r in sink.read_loaded(spark, lake, "daily", committed_only=True).select("_kafka.offset").toDF("o").collect())

    def wait_for(n):
        end = time.time() + 90
        while time.time() < end and len(offsets()) < n:
            time.sleep(1)
        return offsets()

    try:
        want = sorted(r.offset for r in first.select("offset").collect())
        assert wait_for(len(want)) == want  # the last ones by the timer: nothing more has come
        more.coalesce(1).write.mode("append").parquet(topic)
        both = sorted(want + [r.offset for r in more.select("offset").collect()])
        assert wait_for(len(both)) == both
    finally:
        q.stop()
    rows = sink.read_loaded(spark, lake, "daily", committed_only=True).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in rows) <= 20


def test_any_file_streams_refuse_other_layouts(spark, scratch):
    import pytest

    st = read_stream_log(spark, scratch, streaming=True)
    with pytest.raises(ValueError, match="any_file"):
        load_stream(st, f"{scratch}/lake", LoadSpec(dedup=None, layout="topic_partition", any_file=True, roll_records=5))


def test_key_rules_ask_python_once_for_many_keys(spark, scratch):
    """Groups of a micro-batch do not grow with its keys; keys, keyless records and null times keep their rules over batches."""
    rows = [("t", 0, o, None if o % 5 == 0 else f"k{o * 7919 % 700}", None if o % 11 == 0 else o * 10) for o in range(6000)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset long, key string, ms long").select(
        F.col("key").cast("binary").alias("key"), F.lit(None).cast("binary").alias("value"), "topic", "partition", "offset",
        F.timestamp_millis("ms").alias("timestamp"), F.lit(0).alias("timestampType"))
    for lo in (0, 1500, 4000):
        log.where((F.col("offset") >= lo) & (F.col("offset") < {0: 1500, 1500: 4000, 4000: 6000}[lo])).coalesce(1).write.mode("append").parquet(f"{scratch}/log")
        time.sleep(1.05)
    for dedup, n, value in (("offsets", 690, lambda o, ms: o), ("time", 6900, lambda o, ms: ms)):
        spec = LoadSpec(dedup=dedup, dedup_offsets=n, dedup_ms=n)
        got = {r.offset: (r.watermark, r.is_dup) for r in _run(spark, f"{scratch}/log", f"{scratch}/ck-{dedup}", f"{scratch}/out-{dedup}", spec).collect()}
        last, wm, want = {}, None, {}
        for _, _, o, k, ms in rows:
            wm = ms if wm is None or ms is not None and ms > wm else wm
            v, before = value(o, ms), last.get(k)
            want[o] = (wm, k is not None and before is not None and v is not None and v - before <= n)
            last[k] = v
        assert got == want
    from tidewater.streaming import processors

    assert processors.KEY_GROUPS <= 1024


def test_topic_files_are_bounded_ranges_in_offset_order(spark, monkeypatch):
    from tidewater.plans import catalog

    monkeypatch.setattr(catalog, "STREAM_FILE_RECORDS", 20)
    log = events_log(spark, SF_SMALL).withColumn("value", F.lit(None).cast("binary")).repartition(7)
    topic = catalog._topic_files(spark, log.select(*COLS))
    files = (spark.read.parquet(topic).groupBy("_metadata.file_path", "_metadata.file_modification_time")
             .agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count(F.lit(1)).alias("n")).orderBy("file_modification_time").collect())
    assert sum(f.n for f in files) == 1000 and max(f.n for f in files) <= 20
    assert all(a.hi < b.lo and a.file_modification_time < b.file_modification_time for a, b in zip(files, files[1:]))


def test_records_of_a_null_partition_are_one_group(spark, scratch):
    log = events_log(spark, SF_SMALL).withColumn("value", F.lit(None).cast("binary")).withColumn("partition", F.when(F.col("partition") > 0, F.col("partition")))
    for lo in (0, 500):  # rows in no order
        part = log.where((F.col("offset") >= lo) & (F.col("offset") < lo + 500)).orderBy(F.xxhash64("offset")).select(*COLS)
        part.coalesce(1).write.mode("append").parquet(f"{scratch}/log")
        time.sleep(1.05)
    got = _run(spark, f"{scratch}/log", f"{scratch}/ck", f"{scratch}/out", LoadSpec(dedup="recent", key_cache=15))
    batch = dedup_recent_keys(with_stream_watermark(read_stream_log(spark, f"{scratch}/log")), 15)
    null_wm = lambda df: {r.offset: r.watermark for r in df.where("partition is null").collect()}
    assert len(null_wm(got)) > 100 and null_wm(got) == {o: w for o, w in null_wm(with_stream_watermark(read_stream_log(spark, f"{scratch}/log"))).items()}
    assert _same(got.where("partition is not null"), batch.where("partition is not null").select(*got.columns))

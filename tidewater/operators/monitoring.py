"""Monitoring queries over load metrics.

Metrics are a DataFrame ``(metric, labels map<string,string>, ts timestamp,
value double)``.  ``metrics_from_log`` derives the loader's series from a
processed log (watermark + ``is_dup``), ``metrics_from_progress`` from
Structured Streaming progress reports.

Rate rule (no PromQL engine is involved): a counter's increase between two
consecutive samples of a series is ``v - prev`` when ``v >= prev`` and
``v`` after a reset (``v < prev``); a series' first sample counts fully.
The rate of a window is the sum of increases of samples inside it divided
by the window length.  Windows are tumbling; label regexes are anchored.
Every query takes an optional ``since`` (epoch millis) bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scans import running_position

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("metric", T.StringType(), False),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType()), False),
        T.StructField("ts", T.TimestampType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)

# Series names and label values used by the queries.
WATERMARK_DELAY = "stream_loader_source_watermark_delay_ms"
RECORDS_LAG = "kafka_consumer_fetch_manager_metrics_records_lag_by_partition_topic"
RECORDS_BATCHED = "stream_loader_batch_records_batched_total"
RECORDS_WRITTEN = "stream_loader_batch_records_written_total"
DUPLICATES = "sink_duplicates_total"
COMMIT_COUNT = "stream_loader_batch_commit_duration_seconds_count"
COMMIT_BUCKET = "stream_loader_batch_commit_duration_seconds_bucket"
COMMIT_QUEUE = "stream_loader_batch_commit_queue_size"
BYTES_CONSUMED = "kafka_consumer_fetch_manager_metrics_bytes_consumed_total_by_topic"
JOB = "tidewater"
LOADER_THREAD = "loader-0"
SCRAPE_MS = 5_000
MAX_DELAY_MS = 6.048e8  # 7 days
# histogram bucket bounds (seconds) of the per-file span used as commit duration
DURATION_BUCKETS = ["0.5", "1", "5", "30", "60", "300", "900", "3600", "+Inf"]
FILE_RECORDS = 100


def _labels(**kv: Column) -> Column:
    keys = sorted(kv)
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[kv[k].cast("string") for k in keys]))


def _sample(metric: str, labels: Column, ts_ms: Column, value: Column) -> list[Column]:
    return [F.lit(metric).alias("metric"), labels.alias("labels"), F.timestamp_millis(ts_ms).alias("ts"), value.cast("double").alias("value")]


def metrics_from_log(marked: DataFrame, file_records: int = FILE_RECORDS, metrics: list[str] | None = None) -> DataFrame:
    """Loader series derived from a log with ``watermark`` and ``is_dup``: the named metrics, or all.

    Each of the three passes over the log (per topic-partition, bytes per topic,
    duration histogram) is made only where a named metric needs it.

    Samples are taken per topic-partition every 5 s of watermark time in
    which it had records (scrape time = end of the 5 s slot).  Counters:
    batched = kept records so far; written = records in closed files
    (files of ``file_records`` kept records); duplicates; committed files.
    Gauges: watermark delay = scrape time - watermark; lag = last offset of
    the partition - last offset read; queue = files closed in the slot.
    Histogram: per closed file, its watermark span in seconds.
    """
    x = marked.select(
        "topic", "partition", "offset", "watermark", F.col("is_dup").cast("int").alias("dup"),
        F.coalesce(F.octet_length("key"), F.lit(0)).alias("nbytes"),
        ((F.floor(F.col("watermark") / SCRAPE_MS) + 1) * SCRAPE_MS).cast("long").alias("scrape"),
    )
    tp = ["topic", "partition"]
    agg = x.groupBy(*tp, "scrape").agg(
        F.sum(1 - F.col("dup")).alias("n_kept"), F.sum("dup").alias("n_dup"), F.max("watermark").alias("wm_max"),
        F.max("offset").alias("off_max"),
    )
    run = Window.partitionBy(*tp).orderBy("scrape").rowsBetween(Window.unboundedPreceding, 0)
    cum = agg.select(
        *tp, "scrape", "n_kept", "wm_max", "off_max",
        F.sum("n_kept").over(run).alias("kept_cum"), F.sum("n_dup").over(run).alias("dup_cum"),
        F.max("off_max").over(Window.partitionBy(*tp)).alias("end_off"),
    )
    tp_lab = {"topic": F.col("topic"), "partition": F.col("partition")}
    files_now = F.floor(F.col("kept_cum") / file_records)
    files_before = F.floor((F.col("kept_cum") - F.col("n_kept")) / file_records)
    per_partition = [
        (WATERMARK_DELAY, tp_lab, F.col("scrape") - F.col("wm_max")),
        (RECORDS_LAG, tp_lab, F.col("end_off") - F.col("off_max")),
        (RECORDS_BATCHED, tp_lab, F.col("kept_cum")),
        (RECORDS_WRITTEN, tp_lab, files_now * file_records),
        (DUPLICATES, {**tp_lab, "loader_thread": F.lit(LOADER_THREAD)}, F.col("dup_cum")),
        (COMMIT_COUNT, {**tp_lab, "job": F.lit(JOB)}, files_now),
        (COMMIT_QUEUE, {**tp_lab, "job": F.lit(JOB)}, files_now - files_before),
    ]
    wanted = [p for p in per_partition if metrics is None or p[0] in metrics]
    series = []
    if wanted:
        # one pass over the per-scrape table: every sample row is unpivoted from it
        samples = F.explode(F.array(*[
            F.struct(F.lit(metric).alias("metric"), _labels(**labels).alias("labels"), value.cast("double").alias("value"))
            for metric, labels, value in wanted
        ])).alias("s")
        series.append(cum.select(samples, "scrape").select(
            "s.metric", "s.labels", F.timestamp_millis(F.col("scrape")).alias("ts"), "s.value"
        ))
    if metrics is None or BYTES_CONSUMED in metrics:
        by_topic = x.groupBy("topic", "scrape").agg(F.sum("nbytes").alias("b"))
        by_topic = by_topic.select("topic", "scrape", F.sum("b").over(Window.partitionBy("topic").orderBy("scrape").rowsBetween(Window.unboundedPreceding, 0)).alias("bytes_cum"))
        series.append(by_topic.select(*_sample(BYTES_CONSUMED, _labels(topic=F.col("topic")), F.col("scrape"), F.col("bytes_cum"))))
    if metrics is None or COMMIT_BUCKET in metrics:
        series.append(_duration_histogram(marked, file_records))
    if not series:
        raise ValueError(f"no series of a log among {metrics}")
    out = series[0]
    for s in series[1:]:
        out = out.unionByName(s)
    return out


def _duration_histogram(marked: DataFrame, file_records: int) -> DataFrame:
    tp = ["topic", "partition"]
    kept = marked.where(~F.col("is_dup")).select(*tp, "offset", "watermark")
    kept = running_position(kept, tp, "offset", "_pos")
    files = (
        kept.groupBy(*tp, F.floor(F.col("_pos") / file_records).alias("file"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("watermark").alias("wm_lo"), F.max("watermark").alias("wm_hi"))
        .where(F.col("n") == file_records)
        .select(*tp, ((F.floor(F.col("wm_hi") / SCRAPE_MS) + 1) * SCRAPE_MS).cast("long").alias("scrape"),
                ((F.col("wm_hi") - F.col("wm_lo")) / 1000.0).alias("dur"))
    )
    le = F.explode(F.array(*[F.lit(b) for b in DURATION_BUCKETS])).alias("le")
    per = files.select(*tp, "scrape", "dur", le).withColumn(
        "hit", F.when(F.col("le") == "+Inf", 1).when(F.col("dur") <= F.col("le").cast("double"), 1).otherwise(0)
    )
    per = per.groupBy(*tp, "scrape", "le").agg(F.sum("hit").alias("hits"))
    run = Window.partitionBy(*tp, "le").orderBy("scrape").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("cum", F.sum("hits").over(run))
    lab = _labels(
        le=F.col("le"), loader_thread=F.lit(LOADER_THREAD),
        partition_group=F.concat(F.col("topic"), F.lit("-"), F.col("partition").cast("string")),
    )
    return per.select(*_sample(COMMIT_BUCKET, lab, F.col("scrape"), F.col("cum")))


def _kafka_offsets(raw) -> dict[tuple[str, str], int]:
    """{topic: {partition: offset}} (dict or JSON text) -> {(topic, partition): offset}."""
    import json

    if raw is None:
        return {}
    data = json.loads(raw) if isinstance(raw, str) else raw
    out = {}
    if isinstance(data, dict):
        for topic, parts in data.items():
            if isinstance(parts, dict):
                for part, off in parts.items():
                    out[(topic, str(part))] = int(off)
    return out


def metrics_from_progress(spark, progresses: list[dict], job: str = JOB) -> DataFrame:
    """Series from streaming progress reports (``StreamingQuery.recentProgress``).

    Per Kafka topic-partition: records read so far (counter) and lag =
    latest offset - end offset (gauge); per batch: input rows, one commit with
    its ``addBatch`` time in the duration histogram.  Progress reports do not
    know the loader's duplicates; they are in the manifests
    (``metrics_from_manifests``).  The report list is small driver-side metadata.
    """
    rows = []
    read: dict[tuple[str, str], int] = {}
    batches = 0
    buckets = {b: 0 for b in DURATION_BUCKETS}
    total_rows = 0.0
    for p in sorted(progresses, key=lambda p: p.get("batchId", 0)):
        ts = p.get("timestamp")
        total_rows += float(p.get("numInputRows", 0) or 0)
        rows.append(("stream_loader_input_rows_total", {"job": job}, ts, total_rows))
        for src in p.get("sources", []) or []:
            start, end, latest = (_kafka_offsets(src.get(k)) for k in ("startOffset", "endOffset", "latestOffset"))
            for tp, off in end.items():
                read[tp] = read.get(tp, 0) + off - start.get(tp, off)
                labels = {"topic": tp[0], "partition": tp[1]}
                rows.append((RECORDS_BATCHED, labels, ts, float(read[tp])))
                if tp in latest:
                    rows.append((RECORDS_LAG, labels, ts, float(latest[tp] - off)))
        dur = (p.get("durationMs") or {}).get("addBatch")
        if dur is not None:
            batches += 1
            rows.append((COMMIT_COUNT, {"job": job}, ts, float(batches)))
            for b in DURATION_BUCKETS:
                if b == "+Inf" or dur / 1000.0 <= float(b):
                    buckets[b] += 1
                rows.append((COMMIT_BUCKET, {"le": b, "loader_thread": LOADER_THREAD, "partition_group": job}, ts, float(buckets[b])))
        rows.append((COMMIT_QUEUE, {"job": job}, ts, 0.0))
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts string, value double")
    return df.withColumn("ts", F.to_timestamp("ts"))


def metrics_from_manifests(spark, base: str, job: str = JOB) -> DataFrame:
    """Series from the batch audits of a loaded lake (one manifest per published batch).

    Per topic-partition: records read by each batch and records written, as
    counters, and the watermark's delay behind the commit; of reporting loads
    also duplicates and key bytes.  Per job: committed batches, the publish
    duration histogram, and a queue gauge (0: publishing is synchronous).
    Sample time = commit time of the batch.
    """
    import json

    from ..plans.sink import _FS

    base = base.rstrip("/")
    fs = _FS(spark, base)
    manifests = [json.loads(fs.read_text(m)) for m in fs.glob(f"{base}/_manifests/batch-*.json")]
    manifests.sort(key=lambda m: m["batch_id"])
    rows = []
    written: dict[tuple[str, str], int] = {}
    read: dict[tuple[str, str], int] = {}
    dups: dict[tuple[str, str], int] = {}
    size: dict[str, int] = {}
    buckets = {b: 0 for b in DURATION_BUCKETS}
    for i, m in enumerate(manifests, start=1):
        ts = m.get("committed_at_ms", 0)
        for p in m.get("positions", []):
            tp = (p["topic"], str(p["partition"]))
            read[tp] = read.get(tp, 0) + int(p.get("records", 0))
            rows.append((RECORDS_BATCHED, {"topic": tp[0], "partition": tp[1]}, ts, float(read[tp])))
            if p.get("watermark") is not None:
                rows.append((WATERMARK_DELAY, {"topic": tp[0], "partition": tp[1]}, ts, float(ts - p["watermark"])))
        for d in m.get("dropped", []):
            tp = (d["topic"], str(d["partition"]))
            dups[tp] = dups.get(tp, 0) + int(d["duplicate"])
            rows.append((DUPLICATES, {"job": job, "loader_thread": LOADER_THREAD, "topic": tp[0], "partition": tp[1]}, ts, float(dups[tp])))
            size[tp[0]] = size.get(tp[0], 0) + int(d.get("key_bytes") or 0)
        for topic, n in size.items():
            rows.append((BYTES_CONSUMED, {"topic": topic}, ts, float(n)))
        for w in m.get("written", []):
            tp = (w["topic"], str(w["partition"]))
            written[tp] = written.get(tp, 0) + int(w["count"])
            rows.append((RECORDS_WRITTEN, {"topic": tp[0], "partition": tp[1]}, ts, float(written[tp])))
        rows.append((COMMIT_COUNT, {"job": job}, ts, float(i)))
        dur = float(m.get("duration_s", 0.0))
        for b in DURATION_BUCKETS:
            if b == "+Inf" or dur <= float(b):
                buckets[b] += 1
            rows.append((COMMIT_BUCKET, {"le": b, "loader_thread": LOADER_THREAD, "partition_group": job}, ts, float(buckets[b])))
        rows.append((COMMIT_QUEUE, {"job": job}, ts, 0.0))
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ms long, value double")
    return df.select("metric", "labels", F.timestamp_millis("ms").alias("ts"), "value")


# ------------------------------------------------------------------ queries
def _since(m: DataFrame, since_ms: int | None) -> DataFrame:
    return m if since_ms is None else m.where(F.unix_millis("ts") >= F.lit(since_ms))


def _window_start(ms: int) -> Column:
    return (F.floor(F.unix_millis("ts") / ms) * ms).cast("long")


def _series_id() -> Column:
    return F.array_join(F.array_sort(F.transform(F.map_entries("labels"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")


def _increases(m: DataFrame, metric: str | list[str], since_ms: int | None, topic_regex: str | None = None) -> DataFrame:
    x = m.where(F.col("metric").isin(metric))
    if topic_regex is not None:
        x = x.where(F.col("labels")["topic"].rlike(f"^(?:{topic_regex})$"))
    x = x.withColumn("_sid", _series_id())
    prev = F.lag("value").over(Window.partitionBy("metric", "_sid").orderBy("ts"))
    x = x.withColumn("inc", F.when(prev.isNull(), F.col("value")).when(F.col("value") >= prev, F.col("value") - prev).otherwise(F.col("value")))
    return _since(x, since_ms)


def watermark_delay(m: DataFrame, window_ms: int = 60_000, since_ms: int | None = None) -> DataFrame:
    """M1: min delay < 7 days per (topic, partition) and window."""
    x = _since(m.where((F.col("metric") == WATERMARK_DELAY) & (F.col("value") < MAX_DELAY_MS)), since_ms)
    return x.groupBy(F.col("labels")["topic"].alias("topic"), F.col("labels")["partition"].alias("partition"), _window_start(window_ms).alias("window_ms")).agg(
        F.min("value").alias("delay_ms")
    )


def _last_per_series(m: DataFrame, metric: str, window_ms: int, since_ms: int | None) -> DataFrame:
    x = _since(m.where(F.col("metric") == metric), since_ms).withColumn("_sid", _series_id())
    return x.groupBy("_sid", _window_start(window_ms).alias("window_ms")).agg(
        F.max_by("value", "ts").alias("value"), F.first("labels").alias("labels")
    )


def offset_lag(m: DataFrame, window_ms: int = 60_000, since_ms: int | None = None) -> DataFrame:
    """M2: summed records lag per (topic, partition), last sample of each series per window."""
    x = _last_per_series(m, RECORDS_LAG, window_ms, since_ms)
    return x.groupBy(F.col("labels")["topic"].alias("topic"), F.col("labels")["partition"].alias("partition"), "window_ms").agg(
        F.sum("value").alias("lag")
    )


def _rate_by(m: DataFrame, metric: str, by: list[str], window_ms: int, since_ms: int | None, topic_regex: str | None = None) -> DataFrame:
    x = _increases(m, metric, since_ms, topic_regex)
    keys = [F.col("labels")[k].alias(k) for k in by]
    return x.groupBy(*keys, _window_start(window_ms).alias("window_ms")).agg((F.sum("inc") / (window_ms / 1000.0)).alias("rate"))


def records_batched_rate(m: DataFrame, topic_regex: str = ".*", window_ms: int = 60_000, since_ms: int | None = None) -> DataFrame:
    """M3: per-second rate of batched records per (topic, partition)."""
    return _rate_by(m, RECORDS_BATCHED, ["topic", "partition"], window_ms, since_ms, topic_regex)


def records_written_rate(m: DataFrame, topic_regex: str = ".*", window_ms: int = 60_000, since_ms: int | None = None) -> DataFrame:
    """M4: per-second rate of written records per (topic, partition)."""
    return _rate_by(m, RECORDS_WRITTEN, ["topic", "partition"], window_ms, since_ms, topic_regex)


def in_flight_rate(m: DataFrame, topic_regex: str = ".*", window_ms: int = 60_000, since_ms: int | None = None) -> DataFrame:
    """M5: batched rate minus written rate, matched on (topic, partition, window)."""
    x = _increases(m, [RECORDS_BATCHED, RECORDS_WRITTEN], since_ms, topic_regex)
    topic, partition = (F.col("labels")[k].alias(k) for k in ("topic", "partition"))
    batched, written = (F.sum(F.when(F.col("metric") == k, F.col("inc"))) / (window_ms / 1000.0) for k in (RECORDS_BATCHED, RECORDS_WRITTEN))
    # one pass over both counters; a window needs samples of both
    both = x.groupBy(topic, partition, _window_start(window_ms).alias("window_ms")).agg((batched - written).alias("rate"))
    return both.where(F.col("rate").isNotNull())


def duplicate_rate(m: DataFrame, window_ms: int = 60_000, since_ms: int | None = None) -> DataFrame:
    """M6: per-second duplicates per partition."""
    return _rate_by(m, DUPLICATES, ["partition"], window_ms, since_ms)


def files_per_hour(m: DataFrame, window_ms: int = 1_800_000, since_ms: int | None = None) -> DataFrame:
    """M7: committed files per hour, per job (3600 x rate over 30 minutes)."""
    r = _rate_by(m, COMMIT_COUNT, ["job"], window_ms, since_ms)
    return r.select("job", "window_ms", (F.col("rate") * 3600.0).alias("files_per_hour"))


def commit_duration_quantile(m: DataFrame, q: float = 0.999, window_ms: int = 20_000, since_ms: int | None = None) -> DataFrame:
    """M8: commit duration quantiles of all series, summed per (loader_thread, partition_group).

    Per series (all labels but ``le``) and window: bucket increases, then the first bucket whose cumulative
    count reaches q x total, interpolated linearly inside it (lower bound 0
    for the first bucket; the +Inf bucket answers with the largest finite
    bound).  Windows without observations are left out.
    """
    x = _increases(m, COMMIT_BUCKET, since_ms)
    others = F.map_filter("labels", lambda k, _: k != "le")
    series = F.array_join(F.array_sort(F.transform(F.map_entries(others), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    per = x.groupBy(
        F.col("labels")["loader_thread"].alias("loader_thread"), F.col("labels")["partition_group"].alias("partition_group"),
        series.alias("series"), F.col("labels")["le"].alias("le"), _window_start(window_ms).alias("window_ms"),
    ).agg(F.sum("inc").alias("cnt"))
    keys = ["loader_thread", "partition_group", "series", "window_ms"]
    bound = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double"))
    per = per.withColumn("bound", bound)
    w = Window.partitionBy(*keys).orderBy("bound")
    per = (
        per.withColumn("total", F.max(F.when(F.col("le") == "+Inf", F.col("cnt"))).over(Window.partitionBy(*keys)))
        .withColumn("prev_cnt", F.coalesce(F.lag("cnt").over(w), F.lit(0.0)))
        .withColumn("prev_bound", F.coalesce(F.lag("bound").over(w), F.lit(0.0)))
        .withColumn("rank", F.col("total") * q)
        .where((F.col("total") > 0) & (F.col("cnt") >= F.col("rank")))
    )
    first = per.groupBy(*keys).agg(F.min_by(F.struct("bound", "cnt", "prev_cnt", "prev_bound", "rank"), F.col("bound")).alias("b"))
    b = F.col("b")
    value = F.when(b["bound"] == float("inf"), b["prev_bound"]).otherwise(
        b["prev_bound"] + (b["bound"] - b["prev_bound"]) * (b["rank"] - b["prev_cnt"]) / (b["cnt"] - b["prev_cnt"])
    )
    return first.withColumn("q", value).groupBy("loader_thread", "partition_group", "window_ms").agg(F.sum("q").alias("duration_s"))


def commit_queue_depth(m: DataFrame, window_ms: int = 60_000, since_ms: int | None = None) -> DataFrame:
    """M9: summed queue gauge per job, last sample of each series per window."""
    x = _last_per_series(m, COMMIT_QUEUE, window_ms, since_ms)
    return x.groupBy(F.col("labels")["job"].alias("job"), "window_ms").agg(F.sum("value").alias("depth"))


def topic_values(m: DataFrame, since_ms: int | None = None) -> DataFrame:
    """Values of the ``topic`` label of the bytes-consumed series."""
    x = _since(m.where(F.col("metric") == BYTES_CONSUMED), since_ms)
    return x.select(F.col("labels")["topic"].alias("topic")).where(F.col("topic").isNotNull()).distinct()


__all__ = [
    "METRICS_SCHEMA", "metrics_from_log", "metrics_from_progress", "watermark_delay", "offset_lag",
    "records_batched_rate", "records_written_rate", "in_flight_rate", "duplicate_rate", "files_per_hour",
    "commit_duration_quantile", "commit_queue_depth", "topic_values",
]

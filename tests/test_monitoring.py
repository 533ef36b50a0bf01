"""Monitoring queries on hand-made series: counter resets, windows, regex, since, quantiles."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import monitoring as M

T0 = 1_704_067_200_000  # 2024-01-01T00:00:00Z


def _metrics(spark, rows):
    return spark.createDataFrame(rows, "metric string, labels map<string,string>, ms long, value double").select(
        "metric", "labels", F.timestamp_millis("ms").alias("ts"), "value"
    )


def test_rate_handles_counter_reset_and_regex(spark):
    lab = {"topic": "events", "partition": "0"}
    other = {"topic": "eventsX", "partition": "0"}
    rows = [(M.RECORDS_BATCHED, lab, T0 + i * 5000, v) for i, v in enumerate([5.0, 8.0, 2.0, 4.0])]  # reset after 8
    rows += [(M.RECORDS_BATCHED, other, T0, 100.0)]
    m = _metrics(spark, rows)
    got = M.records_batched_rate(m, topic_regex="events").collect()
    assert len(got) == 1  # the regex is anchored: eventsX is left out
    assert abs(got[0].rate - (5 + 3 + 2 + 2) / 60.0) < 1e-12


def test_since_and_delay_cut(spark):
    lab = {"topic": "t", "partition": "1"}
    rows = [(M.WATERMARK_DELAY, lab, T0, 7e8), (M.WATERMARK_DELAY, lab, T0 + 1000, 300.0), (M.WATERMARK_DELAY, lab, T0 + 61_000, 50.0)]
    m = _metrics(spark, rows)
    got = {r.window_ms: r.delay_ms for r in M.watermark_delay(m).collect()}
    assert got == {T0: 300.0, T0 + 60_000: 50.0}  # 7e8 ms (> 7 days) is dropped
    assert [r.window_ms for r in M.watermark_delay(m, since_ms=T0 + 60_000).collect()] == [T0 + 60_000]


def test_histogram_quantile_interpolates(spark):
    def b(le, v, ms=T0):
        return (M.COMMIT_BUCKET, {"le": le, "loader_thread": "l", "partition_group": "g"}, ms, float(v))

    # 1000 observations: 900 <= 1 s, 999 <= 5 s, all <= 30 s
    rows = [b("0.5", 0), b("1", 900), b("5", 999), b("30", 1000), b("60", 1000), b("300", 1000),
            b("900", 1000), b("3600", 1000), b("+Inf", 1000)]
    got = M.commit_duration_quantile(_metrics(spark, rows), 0.999).collect()[0]
    # rank 999 falls in (1, 5]: 1 + 4 * (999 - 900) / (999 - 900) = 5
    assert abs(got.duration_s - 5.0) < 1e-9
    got = M.commit_duration_quantile(_metrics(spark, rows), 0.95).collect()[0]
    assert abs(got.duration_s - (1 + 4 * (950 - 900) / 99)) < 1e-9
    # a quantile landing in +Inf answers with the largest finite bound
    rows = [b(le, 0) for le in ["0.5", "1", "5", "30", "60", "300", "900", "3600"]] + [b("+Inf", 10)]
    assert M.commit_duration_quantile(_metrics(spark, rows), 0.5).collect()[0].duration_s == 3600.0


def test_queue_depth_last_sample_and_topic_values(spark):
    rows = [(M.COMMIT_QUEUE, {"job": "j", "topic": "a", "partition": "0"}, T0, 3.0),
            (M.COMMIT_QUEUE, {"job": "j", "topic": "a", "partition": "0"}, T0 + 5000, 1.0),
            (M.COMMIT_QUEUE, {"job": "j", "topic": "a", "partition": "1"}, T0 + 2000, 2.0),
            (M.BYTES_CONSUMED, {"topic": "a"}, T0, 1.0), (M.BYTES_CONSUMED, {"topic": "b"}, T0, 1.0)]
    m = _metrics(spark, rows)
    assert [(r.job, r.depth) for r in M.commit_queue_depth(m).collect()] == [("j", 3.0)]
    assert sorted(r.topic for r in M.topic_values(m).collect()) == ["a", "b"]


def test_quantiles_of_several_series_are_summed(spark):
    def b(le, v, thread_no):
        return (M.COMMIT_BUCKET, {"le": le, "loader_thread": "l", "partition_group": "g", "instance": str(thread_no)}, T0, float(v))

    les = ["0.5", "1", "5", "30", "60", "300", "900", "3600", "+Inf"]
    rows = [b(le, 0 if le == "0.5" else 1000, 0) for le in les] + [b(le, 0 if le in ("0.5", "1") else 1000, 1) for le in les]
    got = M.commit_duration_quantile(_metrics(spark, rows), 0.999).collect()
    # one series lies in (0.5, 1], the other in (1, 5]
    assert len(got) == 1 and abs(got[0].duration_s - ((0.5 + 0.5 * 0.999) + (1 + 4 * 0.999))) < 1e-9


def test_named_metrics_of_a_log_equal_those_of_all(spark):
    rows = [("t", i % 2, i, f"k{i % 7}", 1_000 * i, i % 5 == 0) for i in range(60)]
    marked = spark.createDataFrame(rows, "topic string, partition int, offset long, key string, watermark long, is_dup boolean")
    flat = lambda m: sorted((r.metric, sorted(r.labels.items()), r.ts, r.value) for r in m.collect())
    whole = flat(M.metrics_from_log(marked, 5))
    for names in ([M.RECORDS_BATCHED, M.RECORDS_WRITTEN], [M.BYTES_CONSUMED], [M.COMMIT_BUCKET, M.RECORDS_LAG]):
        got = flat(M.metrics_from_log(marked, 5, names))
        assert got and got == [r for r in whole if r[0] in names]
    with pytest.raises(ValueError):
        M.metrics_from_log(marked, 5, ["no_such_metric"])

"""Chunked scans equal their single-window forms, whatever the chunk size."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidewater.operators.scans import lag_with_carry, running_max, running_position
from tidewater.operators.watermark import offsets_for_times, with_stream_watermark


def _frame(spark, n=500, groups=3, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"g": rng.integers(0, groups, n), "offset": np.arange(n) * 3, "v": rng.integers(0, 1000, n)})
    return spark.createDataFrame(pdf), pdf


def test_running_max_position_lag(spark):
    df, pdf = _frame(spark)
    pdf = pdf.sort_values("offset")
    pdf["rmax"] = pdf.groupby("g")["v"].cummax()
    pdf["pos"] = pdf.groupby("g").cumcount()
    pdf["lag"] = pdf.groupby("g")["v"].shift()
    for size in (1, 7, 100, 10_000):
        a = running_max(df, ["g"], "offset", "v", "rmax", chunk_size=size)
        a = running_position(a, ["g"], "offset", "pos", chunk_size=size)
        a = lag_with_carry(a, ["g"], "offset", ["v"], ["lag"], chunk_size=size).toPandas().sort_values("offset")
        assert (a.rmax.values == pdf.rmax.values).all()
        assert (a.pos.values == pdf.pos.values).all()
        assert a.lag.fillna(-1).tolist() == pdf.lag.fillna(-1).tolist()


def test_watermark_carries_late_records(spark):
    rows = [("t", 0, o, ts) for o, ts in enumerate([5, 3, 9, 1, 12, 11])]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, ms long").withColumn("timestamp", F.timestamp_millis("ms"))
    wm = [r.watermark for r in with_stream_watermark(df, chunk_size=2).orderBy("offset").collect()]
    assert wm == [5, 5, 9, 9, 12, 12]


def test_offsets_for_times(spark):
    rows = [("t", 0, o, ts) for o, ts in enumerate([5, 3, 9, 1, 12, 11])]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, ms long").withColumn("timestamp", F.timestamp_millis("ms"))
    times = spark.createDataFrame([("t", 0, 4), ("t", 0, 10), ("t", 0, 13), ("t", 1, 0)], "topic string, partition int, t_ms long")
    got = {(r.partition, r.t_ms): (r.offset, r.timestamp_ms) for r in offsets_for_times(df, times, bucket_ms=3).collect()}
    assert got == {(0, 4): (0, 5), (0, 10): (4, 12), (0, 13): (None, None), (1, 0): (None, None)}

"""Batches cut by limits of any open file, against a record-by-record rule."""

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tidewater.operators import partitioning, rolling
from tidewater.operators.rolling import Limits, exits_of, roll_limits
from tidewater.sources.logs import two_topic_log


def simulate(rows, limits):
    """(batch, closed) of rows (file, size, clock) of one group, in order."""
    out, batch, files, now = [], 0, {}, None
    for f, size, ms in rows:
        now = ms if now is None else max(now, now if ms is None else ms)
        state = files.setdefault(f, [0, 0, now])
        state[0] += 1
        state[1] += size or 0
        out.append(batch)
        full = limits.records and state[0] >= limits.records or limits.size and state[1] >= limits.size
        late = limits.open_ms and any(s[2] is not None and now is not None and now - s[2] >= limits.open_ms for s in files.values())
        if full or late:
            batch, files = batch + 1, {}
    return [(b, b < batch) for b in out]


def made_log(spark, n, groups, files, seed):
    rng = np.random.default_rng(seed)
    rows, expect = [], {}
    for g in range(groups):
        offset, clock = 0, 0
        for _ in range(int(n * rng.uniform(0.3, 1))):
            offset += int(rng.integers(1, 4))
            clock += int(rng.integers(0, 40))
            size = None if rng.random() < 0.05 else int(rng.choice([0, 1, 5, 30, 400], p=[0.1, 0.4, 0.3, 0.19, 0.01]))
            ms = None if rng.random() < 0.05 else clock - int(rng.integers(0, 60))
            rows.append(("t", g, offset, int(rng.integers(0, files)), size, ms))
            expect.setdefault(g, []).append(rows[-1])
    return spark.createDataFrame(rows, "topic string, partition int, offset long, file int, bytes long, ms long").repartition(5), expect


@pytest.mark.parametrize(
    ("limits", "chunk"),
    [(Limits(records=7), 11), (Limits(size=100), 11), (Limits(open_ms=500), 11), (Limits(9, 60, 400), 11), (Limits(1), 11), (Limits(9, 60, 400), 1 << 20), (Limits(10_000, 10**9, 10**9), 40)],
)
def test_limits_against_the_rule(spark, limits, chunk):
    df, expect = made_log(spark, 150, 3, 4, seed=chunk % 7)
    got = roll_limits(df, limits, file_cols=["file"], size=F.col("bytes"), clock=F.col("ms"), chunk_size=chunk)
    found = {(r.partition, r.offset): (r.batch_id, r.closed) for r in got.collect()}
    for g, rows in expect.items():
        want = simulate([r[3:] for r in rows], limits)
        assert [found[g, r[2]] for r in rows] == want
    assert len(found) == sum(map(len, expect.values()))


def test_one_root_group_over_interleaved_partitions(spark):
    log = two_topic_log(spark, SF_SMALL).withColumn("_tw_root", F.lit("root"))
    order = ["timestamp", "topic", "partition", "offset"]
    got = partitioning.roll_any_file(log, 20, group=["_tw_root"], file_cols=["topic", "partition"], order=order, chunk_size=97)
    rows = log.select("timestamp", "topic", "partition", "offset").orderBy(*order).collect()
    want = simulate([((r.topic, r.partition), 0, 0) for r in rows], Limits(records=20))
    found = {(r.topic, r.partition, r.offset): (r.batch_id, r.closed) for r in got.collect()}
    assert [found[r.topic, r.partition, r.offset] for r in rows] == want


def test_empty_log_and_wrong_limits(spark):
    df, _ = made_log(spark, 10, 1, 1, 0)
    assert roll_limits(df.limit(0), Limits(3)).count() == 0
    for wrong in ({}, {"records": 0}, {"size": -1}):
        with pytest.raises(ValueError):
            Limits(**wrong)
    with pytest.raises(ValueError):
        roll_limits(df, Limits(size=5))


def test_exits_follow_next_starts():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n, first = int(rng.integers(1, 60)), int(rng.integers(0, 100))
        place = np.arange(first, first + n)
        following = np.where(rng.random(n) < 0.2, -1, place + rng.integers(1, 15, n))
        want = []
        for i in range(n):
            at = int(following[i])
            while 0 <= at < first + n:
                at = int(following[at - first])
            want.append(at)
        assert exits_of(place, following).tolist() == want


def test_cut_chunks_are_wider_than_scan_chunks_and_bounded(spark, monkeypatch):
    assert [rolling.cut_width(n) for n in (1, 500, 1 << 14, 1 << 20)] == [64, 32_000, 1 << 16, 1 << 20]
    for scans in (1, 4):  # many cut chunks on few rows
        monkeypatch.setattr(rolling, "CUT_SCANS", scans)
        test_limits_against_the_rule(spark, Limits(9, 60, 400), 11)
        test_one_root_group_over_interleaved_partitions(spark)

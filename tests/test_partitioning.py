import pytest
"""Partition values, names and rolling rules."""

from pyspark.sql import functions as F

from tidewater.operators import partitioning, positions
from tidewater.sources.generators import generate_test_records


def test_time_partition_patterns(spark):
    df = spark.createDataFrame([(1704070800000 + 59 * 60_000,)], "watermark long")  # 2024-01-01 01:59 UTC
    h = partitioning.time_partition(df, "hourly").collect()[0]
    d = partitioning.time_partition(df, "daily").collect()[0]
    assert (h.dt, h.hr, d.dt) == ("20240101", "01", "2024_01_01")


def test_roll_any_file_reference_case(spark):
    # 1 topic x 3 partitions x 10 records written partition by partition, limit 6:
    # p0 0-5 | p0 6-9 + p1 0-5 | p1 6-9 + p2 0-5 | p2 6-9 (open)
    recs = generate_test_records(spark, ["test_topic_1"], 3, 10)
    rolled = partitioning.roll_any_file(recs, 6, group=("_tw_root",), file_cols=("topic", "partition"), order=["topic", "partition", "offset"])
    names = partitioning.offset_range_paths(rolled.where("closed"), batch="batch_id").toPandas()
    by_batch = names.groupby("batch_id")["path"].apply(sorted).to_dict()
    assert by_batch == {
        0: ["test_topic_1_0_0_5.parquet"],
        1: ["test_topic_1_0_6_9.parquet", "test_topic_1_1_0_5.parquet"],
        2: ["test_topic_1_1_6_9.parquet", "test_topic_1_2_0_5.parquet"],
    }
    open_rows = rolled.where("not closed").toPandas()
    assert sorted(open_rows.offset) == [6, 7, 8, 9] and set(open_rows.partition) == {2}


def test_roll_by_records_and_file_ranges(spark):
    recs = generate_test_records(spark, ["t"], 2, 25)
    rolled = partitioning.roll_by_records(recs, 10, chunk_size=4)
    ranges = partitioning.file_ranges(rolled, F.concat_ws("/", "topic", "partition", "file_seq")).toPandas()
    assert sorted(ranges.records) == [5, 5, 10, 10, 10, 10]
    assert set(zip(ranges.min_offset, ranges.max_offset)) == {(0, 9), (10, 19), (20, 24)}


def test_roll_fuzzy_is_deterministic_and_follows_limits(spark):
    recs = generate_test_records(spark, ["t"], 2, 300)
    a = partitioning.roll_fuzzy(recs, 20, 5, seed=7, chunk_size=37).orderBy("partition", "offset").toPandas()
    b = partitioning.roll_fuzzy(recs, 20, 5, seed=7).orderBy("partition", "offset").toPandas()
    assert len(a) == 600 and a.file_seq.tolist() == b.file_seq.tolist()
    sizes = {k: e - s for k, s, e in partitioning.fuzzy_limits(spark, 100, 20, 5, 7).select("k", "start", "end").collect()}
    for _, g in a.groupby("partition"):
        seen = g.groupby("file_seq").size()
        assert list(seen.index) == list(range(len(seen)))  # consecutive files in offset order
        assert all(seen[k] == sizes[k] for k in seen.index[:-1])
        assert g.file_seq.is_monotonic_increasing


def test_positions(spark):
    recs = generate_test_records(spark, ["a", "b"], 2, 5)
    cp = {(r.topic, r.partition): r.next_offset for r in positions.commit_positions(recs).collect()}
    assert cp == {("a", 0): 5, ("a", 1): 5, ("b", 0): 5, ("b", 1): 5}
    commits = spark.createDataFrame([("a", 0, 1, 3), ("a", 0, 2, 5)], "topic string, partition int, commit_seq long, next_offset long")
    req = spark.createDataFrame([("a", 0), ("a", 1)], "topic string, partition int")
    last = {(r.topic, r.partition): r.next_offset for r in positions.last_committed(commits, req).collect()}
    assert last == {("a", 0): 5, ("a", 1): None}
    grp = partitioning.partition_group(recs, F.when(F.col("partition") == 0, "even").otherwise("odd"))
    members = {r.group: r.members for r in positions.partition_group_members(grp).collect()}
    assert members == {"even": "a-0,b-0", "odd": "a-1,b-1"}


def test_roll_any_file_per_partition_against_simulation(spark):
    from conftest import SF_SMALL
    from tidewater.operators.watermark import with_stream_watermark
    from tidewater.sources.logs import events_log

    hourly = partitioning.time_partition(with_stream_watermark(events_log(spark, SF_SMALL)), "hourly")
    got = partitioning.roll_any_file(hourly, 5).toPandas()
    src = hourly.select("topic", "partition", "offset", "dt", "hr").toPandas()
    exp = {}
    for (t, p), g in src.sort_values("offset").groupby(["topic", "partition"]):
        batch, counts = 0, {}
        for o, f in zip(g.offset, zip(g.dt, g.hr)):
            counts[f] = counts.get(f, 0) + 1
            exp[(t, p, o)] = batch
            if counts[f] >= 5:
                batch, counts = batch + 1, {}
    assert {(r.topic, r.partition, r.offset): r.batch_id for r in got.itertuples()} == exp


def test_roll_any_file_contiguous_equals_sequential(spark):
    from conftest import SF_SMALL
    from tidewater.operators.watermark import with_stream_watermark
    from tidewater.sources.logs import events_log

    hourly = partitioning.time_partition(with_stream_watermark(events_log(spark, SF_SMALL)), "hourly")
    for n in (1, 3, 7):
        a = partitioning.roll_any_file(hourly, n, contiguous=True).toPandas().sort_values(["partition", "offset"]).reset_index(drop=True)
        b = partitioning.roll_any_file(hourly, n, contiguous=False).toPandas().sort_values(["partition", "offset"]).reset_index(drop=True)
        assert a[["partition", "offset", "batch_id", "closed"]].equals(b[["partition", "offset", "batch_id", "closed"]])

"""Writer options, staged publish, idempotent re-runs, read-back."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.operators import codec
from tidewater.operators.positions import last_committed
from tidewater.plans import loads, sink
from tidewater.sources.logs import events_log


def test_parse_compression():
    assert sink.parse_compression(None) == "none"
    assert [sink.parse_compression(c) for c in ("snappy", "ZSTD", "Gzip", "lz4", "NONE")] == ["snappy", "zstd", "gzip", "lz4", "none"]
    with pytest.raises(ValueError, match="Unknown compression type"):
        sink.parse_compression("brotli2")
    for known in ("bzip2", "LZO", "Brotli"):
        with pytest.raises(NotImplementedError, match="unsupported in Parquet"):
            sink.parse_compression(known)


def _encoded(spark):
    return codec.encode_events(events_log(spark, SF_SMALL, payload=True))


def test_hourly_publish_is_idempotent(spark, scratch):
    base = f"{scratch}/lake"
    spec = loads.LoadSpec(dedup="offsets", dedup_offsets=50, roll_records=None)
    m1 = loads.load(_encoded(spark), base, 7, spec)
    n1 = sink.read_loaded(spark, base, "hourly").count()
    m2 = loads.load(_encoded(spark), base, 7, spec)  # published already: no-op
    assert m1 == m2 and sink.read_loaded(spark, base, "hourly").count() == n1
    # a batch that died after moving files but before its manifest is redone cleanly
    os.remove(sink.manifest_path(base, 7))
    loads.load(_encoded(spark), base, 7, spec)
    assert sink.read_loaded(spark, base, "hourly").count() == n1
    lake = sink.read_loaded(spark, base, "hourly", committed_only=True)
    assert lake.count() == n1 and lake.schema["dt"].dataType.simpleString() == "string"
    assert lake.where("hr = '00'").count() > 0


def test_topic_partition_files_named_by_offset_range(spark, scratch):
    base = f"{scratch}/tp"
    spec = loads.LoadSpec(dedup=None, layout="topic_partition", roll_records=100)
    manifest = loads.load(_encoded(spark), base, 0, spec)
    names = sorted(os.path.basename(f) for f in manifest["files"])
    lake = sink.read_loaded(spark, base, "topic_partition")
    per_file = lake.groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("f")).agg(
        F.min("_kafka.offset").alias("lo"), F.max("_kafka.offset").alias("hi"), F.first("_kafka.topic").alias("t"), F.first("_kafka.partition").alias("p"), F.count(F.lit(1)).alias("n")
    ).collect()
    assert sorted(r.f for r in per_file) == names
    for r in per_file:
        assert r.f == f"{r.t}_{r.p}_{r.lo}_{r.hi}.parquet" and r.n <= 100
    assert lake.count() == 1000


def test_topic_partition_files_named_by_the_user(spark, scratch):
    base = f"{scratch}/named"
    name = F.format_string("%s-%d/from-%012d.parquet", F.col("t"), F.col("p"), F.col("lo"))
    spec = loads.LoadSpec(dedup=None, layout="topic_partition", roll_records=100, file_name=name)
    manifest = loads.load(_encoded(spark), base, 0, spec)
    lake = spark.read.option("recursiveFileLookup", "true").parquet(*manifest["files"])
    per_file = lake.groupBy(F.input_file_name().alias("f")).agg(F.min("_kafka.offset").alias("lo"), F.first("_kafka.topic").alias("t"), F.first("_kafka.partition").alias("p")).collect()
    assert {r.f.split("/named/")[1] for r in per_file} == {f"{r.t}-{r.p}/from-{r.lo:012d}.parquet" for r in per_file} == {f.split("/named/")[1] for f in manifest["files"]}
    assert lake.count() == 1000


def test_file_names_that_clash_stop_the_batch(spark, scratch):
    by_partition = F.format_string("%s_%d.parquet", F.col("t"), F.col("p"))
    rolled = loads.LoadSpec(dedup=None, layout="topic_partition", roll_records=100, file_name=by_partition)
    with pytest.raises(ValueError, match="two files named"):
        loads.load(_encoded(spark), f"{scratch}/clash", 0, rolled)
    whole = loads.LoadSpec(dedup=None, layout="topic_partition", file_name=by_partition)
    enc = _encoded(spark)
    first = loads.load(enc.where("offset < 500"), f"{scratch}/two", 0, whole)
    with pytest.raises(ValueError, match="two files named"):  # the first batch's files stay as they are
        loads.load(enc.where("offset >= 500"), f"{scratch}/two", 1, whole)
    assert spark.read.parquet(*first["files"]).agg(F.max("_kafka.offset")).first()[0] < 500
    with pytest.raises(ValueError, match="null"):
        loads.load(enc, f"{scratch}/null", 0, loads.LoadSpec(dedup=None, layout="topic_partition", file_name=F.lit(None).cast("string")))


def test_directories_by_another_time_column(spark, scratch):
    spec = loads.LoadSpec(dedup=None, layout="hourly", roll_records=None, time_column="header.creation_time")
    loads.load(_encoded(spark), f"{scratch}/created", 0, spec)
    lake = sink.read_loaded(spark, f"{scratch}/created", "hourly")
    created = F.timestamp_millis("header.creation_time")
    apart = lake.where((F.date_format(created, "yyyyMMdd") != F.col("dt")) | (F.date_format(created, "HH") != F.col("hr")))
    assert lake.count() == 1000 and apart.count() == 0 and lake.select("dt", "hr").distinct().count() > 1
    assert lake.where(F.date_format(F.timestamp_millis("_kafka.watermark"), "HH") != F.col("hr")).count() > 0


def test_loaders_by_name(spark, scratch):
    enc = _encoded(spark)
    manifest = loads.loader("by_topic_partition")(enc, f"{scratch}/by_name", 0, roll_records=100)
    assert manifest["layout"] == "topic_partition" and manifest["files"]
    assert sum(w["count"] for w in loads.loader("plain")(enc, f"{scratch}/plain", 0, layout="daily")["written"]) == 1000
    with pytest.raises(ValueError, match="unknown loader"):
        loads.loader("none such")


def test_writer_options_reach_parquet(spark, scratch):
    import pyarrow.parquet as pq

    df = spark.range(5000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("s"))
    sink.write_parquet(df.coalesce(1), f"{scratch}/z", sink.ParquetOptions(compression="ZSTD", block_size=1 << 20, page_size=1 << 12))
    f = [p for p in os.listdir(f"{scratch}/z") if p.endswith(".parquet")][0]
    meta = pq.ParquetFile(f"{scratch}/z/{f}").metadata
    assert meta.row_group(0).column(0).compression == "ZSTD"


def test_empty_batch_publishes_empty_manifest(spark, scratch):
    enc = _encoded(spark).where("offset < 0")
    for layout in ("hourly", "topic_partition"):
        m = loads.load(enc, f"{scratch}/{layout}", 3, loads.LoadSpec(dedup=None, layout=layout, roll_records=10))
        assert m["files"] == []


def test_runner_batch_load_from_parquet_topic(spark, scratch):
    from tidewater.plans import runner
    from tidewater.schema import KAFKA_SCHEMA

    _encoded(spark).select(*KAFKA_SCHEMA.fieldNames()).write.parquet(f"{scratch}/topic")
    runner.main(["--source", "parquet", "--path", f"{scratch}/topic", "--base", f"{scratch}/lake", "--loader", "plain",
                 "--layout", "daily", "--roll-records", "500", "--batch-id", "1"])
    assert sink.read_loaded(spark, f"{scratch}/lake", "daily", committed_only=True).count() == 1000
    args = runner.parse(["--source", "kafka", "--bootstrap", "b:1", "--topics", "a", "--base", "x", "--loader", "by_topic_partition"])
    assert runner.spec_from(args).layout == "topic_partition"


def test_positions_committed_with_each_batch(spark, scratch):
    from tidewater.operators import positions

    enc = _encoded(spark)
    spec = loads.LoadSpec(dedup=None, layout="daily", roll_records=None)
    loads.load(enc.where("offset < 600"), f"{scratch}/lake", 0, spec)
    loads.load(enc.where("offset >= 600"), f"{scratch}/lake", 1, spec)
    committed = sink.committed_positions(spark, f"{scratch}/lake")
    last = {(r.topic, r.partition): (r.next_offset, r.commit_seq) for r in positions.last_committed(committed).collect()}
    exp = {(r.topic, r.partition): r.next_offset for r in positions.commit_positions(enc).collect()}
    assert {k: v[0] for k, v in last.items()} == exp and {v[1] for v in last.values()} == {1}


def test_batch_audits_feed_monitoring(spark, scratch):
    from tidewater.operators import monitoring

    enc = _encoded(spark)
    spec = loads.LoadSpec(dedup="offsets", dedup_offsets=50, layout="hourly", roll_records=None)
    m0 = loads.load(enc.where("offset < 500"), f"{scratch}/lake", 0, spec)
    loads.load(enc.where("offset >= 500"), f"{scratch}/lake", 1, spec)
    assert sum(w["count"] for w in m0["written"]) == sink.read_loaded(spark, f"{scratch}/lake", "hourly").where("_kafka.offset < 500").count()
    m = monitoring.metrics_from_manifests(spark, f"{scratch}/lake")
    assert {r.metric for r in m.collect()} >= {monitoring.RECORDS_BATCHED, monitoring.RECORDS_WRITTEN, monitoring.COMMIT_COUNT}
    files = monitoring.files_per_hour(m).collect()
    assert sum(r.files_per_hour for r in files) == 2 * 2  # two batches, 2 x increase per 30 minutes
    written = monitoring.records_written_rate(m, window_ms=3_600_000).groupBy().sum("rate").first()[0] * 3600
    assert round(written) == sink.read_loaded(spark, f"{scratch}/lake", "hourly").count()


def test_runner_stream_load_from_parquet_topic(spark, scratch):
    from tidewater.plans import runner
    from tidewater.schema import KAFKA_SCHEMA

    _encoded(spark).select(*KAFKA_SCHEMA.fieldNames()).write.parquet(f"{scratch}/topic")
    runner.main(["--source", "parquet", "--path", f"{scratch}/topic", "--base", f"{scratch}/lake", "--loader", "deduplicated",
                 "--key-cache", "3", "--stream", "--available-now", "--checkpoint", f"{scratch}/ck"])
    from tidewater.operators.recent_keys import dedup_recent_keys
    from tidewater.sources.logs import read_stream_log

    exp = dedup_recent_keys(read_stream_log(spark, f"{scratch}/topic"), 3).where("not is_dup").count()
    assert sink.read_loaded(spark, f"{scratch}/lake", "hourly", committed_only=True).count() == exp


def test_small_files_appear_whole(spark, scratch):
    fs = sink._FS(spark, scratch)
    fs.write_text(f"{scratch}/m/x.json", "[1]")
    fs.write_text(f"{scratch}/m/x.json", "[1, 2]")
    assert fs.read_text(f"{scratch}/m/x.json") == "[1, 2]" and not [f for f in os.listdir(f"{scratch}/m") if f.endswith(".part")]


def test_an_attempt_that_died_while_moving_leaves_nothing(spark, scratch):
    base = f"{scratch}/tp"
    spec = loads.LoadSpec(dedup=None, layout="topic_partition", roll_records=100)
    loads.load(_encoded(spark), base, 0, spec)
    files = json.loads(open(sink.manifest_path(base, 0)).read())["files"]
    # as if the batch had died after its moves: no manifest, its list of moves still there
    os.remove(sink.manifest_path(base, 0))
    os.makedirs(f"{base}/_staging", exist_ok=True)
    with open(f"{base}/_staging/moves-0.json", "w") as f:
        json.dump(files, f)
    loads.load(_encoded(spark), base, 0, loads.LoadSpec(dedup=None, layout="topic_partition", roll_records=70))
    assert sink.read_loaded(spark, base, "topic_partition").count() == 1000


def test_committed_read_of_an_empty_lake_has_its_directories(spark, scratch):
    assert {"dt", "hr"} <= set(sink.read_loaded(spark, f"{scratch}/none", "hourly", committed_only=True).columns)


def test_resumed_increments_equal_one_batch(spark, scratch):
    enc = _encoded(spark)
    whole = loads.LoadSpec(dedup="recent", key_cache=4, layout="daily", chunk_size=300)
    loads.load(enc, f"{scratch}/one", 0, whole)
    parts = loads.LoadSpec(dedup="recent", key_cache=4, layout="daily", chunk_size=300, resume=True, rewind=1000)
    for i, end in enumerate((350, 351, 800, 2000)):
        loads.load(enc.where(F.col("offset") < end), f"{scratch}/parts", i, parts)
    a, b = (sink.read_loaded(spark, f"{scratch}/{p}", "daily", committed_only=True).select("_kafka.*", "dt") for p in ("one", "parts"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


def test_any_file_commits_go_on_in_the_next_load(spark, scratch):
    enc = _encoded(spark)
    spec = loads.LoadSpec(dedup=None, layout="daily", any_file=True, roll_records=9, resume=True)
    loads.load(enc, f"{scratch}/one", 0, spec)
    for i, end in enumerate((420, 5000)):
        loads.load(enc.where(F.col("offset") < end), f"{scratch}/parts", i, spec)
    one, parts = (
        sink.read_loaded(spark, f"{scratch}/{p}", "daily", committed_only=True).select("_kafka.topic", "_kafka.partition", "_kafka.offset", F.input_file_name().alias("f")) for p in ("one", "parts")
    )
    # the same files, whatever their names: the offsets that lie in one file together
    files = lambda df: sorted(tuple(sorted(r.o)) for r in df.groupBy("f").agg(F.collect_list("offset").alias("o")).collect())
    assert files(one) == files(parts) and files(one)
    at = lambda p: {(r.topic, r.partition): (r.next_offset, r.watermark) for r in last_committed(sink.committed_positions(spark, f"{scratch}/{p}")).collect()}
    assert at("one") == at("parts")
    uncommitted = enc.select("topic", "partition", "offset").join(one.select("topic", "partition", "offset"), ["topic", "partition", "offset"], "left_anti")
    assert all(r.offset >= at("one")[r.topic, r.partition][0] for r in uncommitted.collect())


def test_reports_feed_monitoring(spark, scratch):
    from tidewater.operators import monitoring

    enc = codec.encode_events(events_log(spark, SF_SMALL, payload=True), corrupt_every=50)
    m = loads.load(enc, f"{scratch}/lake", 0, loads.LoadSpec(dedup="offsets", dedup_offsets=50, layout="daily", report=True))
    series = monitoring.metrics_from_manifests(spark, f"{scratch}/lake")
    assert sum(d["duplicate"] for d in m["dropped"]) > 0
    rate = monitoring.duplicate_rate(series, window_ms=3_600_000).groupBy().sum("rate").first()[0]
    assert round(rate * 3600) == sum(d["duplicate"] for d in m["dropped"])
    batched = monitoring.records_batched_rate(series, window_ms=3_600_000).groupBy().sum("rate").first()[0]
    assert round(batched * 3600) == 1000
    assert loads.read_dead_letters(spark, f"{scratch}/lake").count() == sum(d["malformed"] for d in m["dropped"]) > 0


def test_staged_files_are_listed_once_by_spark(spark, scratch, monkeypatch):
    def refuse(self, root):
        raise AssertionError("the driver walked a staged batch file by file")

    monkeypatch.setattr(sink._FS, "data_files", refuse)
    enc = _encoded(spark).where(F.col("offset") < 300)
    loads.load(enc, f"{scratch}/commits", 0, loads.LoadSpec(dedup=None, any_file=True, layout="daily", roll_records=9))
    files = sink.read_loaded(spark, f"{scratch}/commits", "daily", committed_only=True).groupBy(F.input_file_name()).count().collect()
    assert files and max(r["count"] for r in files) <= 9
    # names that URLs and directories write in other ways
    odd = F.when(F.col("offset") % 3 == 0, "a b%20:c").when(F.col("offset") % 3 == 1, "50 %+x").otherwise("é=1")
    spec = loads.LoadSpec(dedup=None, layout="custom", partition_columns={"kind": odd})
    manifest = loads.load(enc, f"{scratch}/odd", 0, spec)
    assert all(os.path.exists(f.split(":", 1)[-1]) for f in manifest["files"])
    lake = sink.read_loaded(spark, f"{scratch}/odd", "custom", committed_only=True)
    assert {r.kind: r["count"] for r in lake.groupBy("kind").count().collect()} == {"a b%20:c": 100, "50 %+x": 100, "é=1": 100}


def test_resumed_increments_are_not_dealt_out_by_topic_partition(spark):
    positions = spark.createDataFrame([("events", p, 100, 0) for p in range(3)], "topic string, partition int, next_offset long, watermark long")
    log = events_log(spark, SF_SMALL).withColumn("value", F.lit(None).cast("binary"))
    marked = loads.mark(log, loads.LoadSpec(dedup="offsets", dedup_offsets=50, rewind=50, positions=positions, chunk_size=200))
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.findall(r"SortMergeJoin \[topic#\d+, partition#\d+\]", plan)
    assert marked.count() == log.where(F.col("offset") >= 100).count()


def test_topic_partition_files_are_listed_by_folder(spark, scratch):
    """Many files cost few tasks beside their writing: one scan for names and counts, one listing each."""
    base = f"{scratch}/many"
    rows = spark.range(400).select((F.col("id") % 2).cast("int").alias("p"), F.col("id").alias("o"))
    kafka = F.struct(F.when(F.col("p") == 0, "t").otherwise("u").alias("topic"), F.col("p").alias("partition"), F.col("o").alias("offset"))
    frame = rows.select(kafka.alias("_kafka"), F.floor(F.col("o") / 8).alias("file_seq"))
    tracker = spark.sparkContext.statusTracker()

    def tasks_of(group, run):
        spark.sparkContext.setJobGroup(group, group)
        try:
            out = run()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        infos = [tracker.getStageInfo(s) for s in stages]
        return out, max((i.numTasks for i in infos if i is not None), default=0)

    before = spark.conf.get(sink.LISTING_TASKS)
    manifest, most = tasks_of("publish-many", lambda: sink.publish(frame, base, 0, layout="topic_partition"))
    assert len(manifest["files"]) == 100 and most <= 4 * spark.sparkContext.defaultParallelism  # 100 when each folder is a task
    assert spark.conf.get(sink.LISTING_TASKS) == before
    assert sorted((w["topic"], w["partition"], w["count"]) for w in manifest["written"]) == [("t", 0, 200), ("u", 1, 200)]
    lake, most = tasks_of("read-many", lambda: sink.read_loaded(spark, base, "topic_partition"))
    assert most <= 1 and lake.count() == 400  # 100 when each file is a path of its own
    # folders of another layout beside the files are still left out
    spark.range(3).write.parquet(f"{base}/dt=2024_01_01")
    assert sink.read_loaded(spark, base, "topic_partition").select("_kafka.offset").distinct().count() == 400


def _commit_frame(spark):
    rows = spark.range(60).select((F.col("id") % 2).cast("int").alias("p"), F.col("id").alias("o"))
    kafka = F.struct(F.when(F.col("p") == 0, "t").alias("topic"), F.col("p").alias("partition"), F.col("o").alias("offset"))
    dt = F.when(F.col("o") < 20, "2024_01_01").when(F.col("o") < 30, "a b/c%{d}=1").when(F.col("o") < 40, "")  # else null
    things = F.when(F.col("o") % 3 > 0, F.array(F.col("p"), F.lit(None).cast("int")))
    commit = F.concat(F.lit("c-"), F.floor(F.col("o") / 7).cast("string"))
    return rows.select(things.alias("things"), F.struct(F.col("o").cast("string").alias("uuid")).alias("header"), kafka.alias("_kafka"), dt.alias("dt"), commit.alias("commit"))


def test_files_of_commits_are_written_without_a_process_each(spark, scratch, monkeypatch):
    """On the local file system Hadoop starts a process for every file that it creates: Python workers write the same files."""
    import pyarrow.parquet as pq

    frame = _commit_frame(spark)
    with monkeypatch.context() as m:
        m.setattr(sink, "_same_in_arrow", lambda *a: False, raising=False)
        theirs = sink.publish(frame, f"{scratch}/spark", 0, layout="daily", opts=sink.ParquetOptions("GZIP"), commit_col="commit")

    def refuse(*a, **kw):
        raise AssertionError("a commit's files were created through Hadoop")

    monkeypatch.setattr(sink, "write_parquet", refuse)
    ours = sink.publish(frame, f"file:{scratch}/arrow", 0, layout="daily", opts=sink.ParquetOptions("GZIP"), commit_col="commit")
    paths = [[os.path.relpath(f.removeprefix("file:"), f"{scratch}/{kind}") for f in m["files"]] for kind, m in (("spark", theirs), ("arrow", ours))]
    assert paths[0] == paths[1] and len(paths[0]) == 11
    key = lambda w: (w["topic"] or "", w["partition"], w["count"])
    assert sorted(map(key, theirs["written"])) == sorted(map(key, ours["written"])) == [("", 1, 30), ("t", 0, 30)]
    for f in paths[0]:
        a, b = (pq.ParquetFile(f"{scratch}/{kind}/{f}") for kind in ("spark", "arrow"))
        assert sorted(map(str, a.read().to_pylist())) == sorted(map(str, b.read().to_pylist())) and a.schema_arrow.equals(b.schema_arrow)
        assert a.metadata.metadata == b.metadata.metadata and a.metadata.row_group(0).column(0).compression == b.metadata.row_group(0).column(0).compression == "GZIP"
    assert os.listdir(f"{scratch}/arrow/_staging") == []
    # a commit of more rows than a batch or a row group is still one file
    monkeypatch.setattr(sink, "ROW_GROUP_BYTES", 1000)
    long = spark.range(25_000).select(F.struct(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset")).alias("_kafka"), F.lit("d").alias("dt"), F.lit("c").alias("commit"))
    one = sink.publish(long, f"{scratch}/long", 0, layout="daily", commit_col="commit")
    file = pq.ParquetFile(one["files"][0])
    assert len(one["files"]) == 1 and file.metadata.num_rows == 25_000 and file.num_row_groups > 2


def test_types_that_arrow_writes_otherwise_are_left_to_spark(spark, scratch):
    frame = _commit_frame(spark).withColumn("at", F.timestamp_millis(F.lit(1_700_000_000_000)))
    opts = sink.ParquetOptions()
    assert not sink._same_in_arrow(frame, ["dt"], "commit", opts) and sink._same_in_arrow(frame.drop("at"), ["dt"], "commit", opts)
    assert not sink._same_in_arrow(frame.drop("at"), ["dt"], "commit", sink.ParquetOptions(max_records_per_file=3))
    manifest = sink.publish(frame, f"{scratch}/lake", 0, layout="daily", commit_col="commit")
    assert len(manifest["files"]) == 11 and sum(w["count"] for w in manifest["written"]) == 60


def test_many_committed_files_are_read_by_folder(spark, scratch, monkeypatch):
    monkeypatch.setattr(sink, "FOLDERS_FROM", 1)
    base = f"{scratch}/lake"
    frame = _commit_frame(spark).where(F.col("_kafka.offset") < 20)
    for i in range(2):
        sink.publish(frame, base, i, layout="daily", commit_col="commit")
    other = spark.range(5).select(F.struct(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset")).alias("_kafka"), F.lit("2024_01_02").alias("dt"), F.lit("c").alias("commit"))
    sink.publish(other, base, 2, layout="daily", commit_col="commit")
    read = []
    monkeypatch.setattr(sink, "_committed_folders", lambda *a, real=sink._committed_folders: read.append(real(*a)) or read[-1])
    lake = sink.read_loaded(spark, base, "daily", committed_only=True)
    assert read == [lake] and sorted((r.dt, r["count"]) for r in lake.groupBy("dt").count().collect()) == [("2024_01_01", 40), ("2024_01_02", 5)]
    # a folder that holds a file of no committed batch is read file by file
    frame.drop("dt", "commit").coalesce(1).write.parquet(f"{scratch}/stray")
    stray = next(f for f in os.listdir(f"{scratch}/stray") if f.endswith(".parquet"))
    os.link(f"{scratch}/stray/{stray}", f"{base}/dt=2024_01_01/batch-{9:020d}-00000.parquet")
    assert sink.read_loaded(spark, base, "daily", committed_only=True).count() == 45
    # a committed file that is gone is still missed
    os.remove(next(iter(json.loads(open(sink.manifest_path(base, 2)).read())["files"])))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sink.read_loaded(spark, base, "daily", committed_only=True).count()


def test_moves_on_the_local_file_system_keep_what_is_there(spark, scratch):
    fs = sink._FS(spark, scratch)
    for name in ("a", "b"):
        with open(f"{scratch}/{name}", "w") as f:
            f.write(name)
        with open(f"{scratch}/.{name}.crc", "w") as f:
            f.write(f"sum of {name}")
    with pytest.raises(OSError, match="not this batch's"):
        fs.move_all([(f"{scratch}/a", f"file:{scratch}/b")])
    fs.move_all([(f"file:{scratch}/a", f"{scratch}/new/c")])
    assert sorted(os.listdir(f"{scratch}/new")) == [".c.crc", "c"] and open(f"{scratch}/b").read() == "b"

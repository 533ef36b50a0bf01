"""Load plans: Kafka-shaped records -> loaded Parquet rows.

Stage order is fixed, as in the loader: the running watermark is taken as
records are read (duplicates included), then recently seen keys are dropped,
then values are decoded (bad ones set aside), then the user filter runs on
decoded fields, then rows are annotated with ``_kafka`` and given their
partition value.  ``load_plan`` builds that DataFrame (no job runs for it, but
for a root scope, whose order is written first); ``load`` publishes it as one
batch.  The same plan runs inside ``foreachBatch`` for streams
(``streaming.load_stream``).

A resumed load (``LoadSpec(resume=True)``) begins where the lake's committed
positions end: committed offsets are skipped, the watermark goes on from the
committed one, and the dedup rule is warmed with the ``rewind`` offsets before.
A reporting load (``report=True``) stages every record with what became of it,
once: dead letters and counts come from that table.

With ``any_file`` the kept rows are cut into commits by the limits (F4); rows
after the last commit stay uncommitted, and the positions stop before them.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import codec, dedup, partitioning
from ..operators.positions import last_committed
from ..operators.recent_keys import dedup_recent_keys
from ..operators.rolling import Limits, roll_limits
from ..operators.scans import DEFAULT_CHUNK
from ..operators.watermark import with_stream_watermark
from ..schema import ts_millis
from .sink import _FS, ParquetOptions, committed_positions, manifest_path, materialize, publish

# The loader's two configurations.
APP_SETTINGS = {"key_cache": 2000, "rewind": 2000, "roll_records": 100, "compression": "SNAPPY", "layout": "hourly"}
SIMPLE_SETTINGS = {"key_cache": 10, "rewind": 1000, "roll_records": 6, "compression": None, "layout": "daily"}
BY_TOPIC_PARTITION_SETTINGS = {"key_cache": 30, "rewind": 30, "roll_records": 6, "compression": None, "layout": "topic_partition"}


# Records of a topic-partition file when no limit is set: a file has one writer.
TOPIC_PARTITION_ROLL = 1_000_000


@dataclass
class LoadSpec:
    """What a load does.  ``LoadSpec.preset`` has the loader's own settings, whose files hold very few records."""

    dedup: str | None = "recent"  # "recent" (X1) | "offsets" (X3) | "time" (X4) | None (K5)
    key_cache: int = 2000
    dedup_offsets: int = 2000
    dedup_ms: int = 0
    scope: object = None  # None = per topic-partition; "root"; columns; Column
    message: str = "messages.ComplexType"
    descriptor_set: bytes | None = None
    predicate: Column | None = None
    layout: str = "hourly"  # hourly | daily | topic_partition | custom
    roll_records: int | None = None  # records per file; None: as Spark's writers roll
    roll_bytes: int | None = None  # byte limit; exact with any_file, else a record limit from the mean value size
    roll_open_ms: int | None = None  # time since a file's first record, on the watermark's clock (any_file, streams)
    any_file: bool = False  # once any open file reaches a limit, all commit; later records wait for the next load
    history: DataFrame | None = None  # X5: earlier records to rewind over (batch increments)
    rewind: int = 2000
    resume: bool = False  # K8: go on from the lake's committed positions
    positions: DataFrame | None = None  # committed positions to go on from (set by a resumed load)
    report: bool = False  # R3/X6: dead letters and drop counts with every batch
    formatter: Callable[[DataFrame], DataFrame] | None = None  # U2: annotated rows -> 0..n rows each, partition columns kept
    partition_columns: dict[str, Column] | None = None  # U3: directories of the custom layout
    file_name: Column | None = None  # U5: topic-partition file name from t, p, lo, hi
    time_column: str = "watermark"  # U6: epoch millis that hourly and daily directories come from
    chunk_size: int = DEFAULT_CHUNK  # offsets that one window task scans
    decode_partitions: int | None = None  # tasks that values are decoded in; None: as they come
    parquet: ParquetOptions = field(default_factory=lambda: ParquetOptions(compression="SNAPPY"))

    @classmethod
    def preset(cls, name: str, **kw) -> "LoadSpec":
        """The loader's own settings: ``app``, ``simple`` or ``by_topic_partition``."""
        s = {"app": APP_SETTINGS, "simple": SIMPLE_SETTINGS, "by_topic_partition": BY_TOPIC_PARTITION_SETTINGS}[name]
        given = {"key_cache": s["key_cache"], "rewind": s["rewind"], "roll_records": s["roll_records"], "layout": s["layout"], "parquet": ParquetOptions(compression=s["compression"])}
        return cls(**{**given, **kw})


def mark_duplicates(log: DataFrame, spec: LoadSpec) -> DataFrame:
    if spec.dedup is None:
        return log
    if spec.dedup == "recent":
        return dedup_recent_keys(log, spec.key_cache, scope=spec.scope, chunk_size=spec.chunk_size)
    if spec.dedup == "offsets":
        return dedup.dedup_offset_range(log, spec.dedup_offsets, scope=spec.scope)
    if spec.dedup == "time":
        return dedup.dedup_watermark_range(log, spec.dedup_ms, scope=spec.scope, chunk_size=spec.chunk_size)
    raise ValueError(f"unknown dedup rule {spec.dedup!r}")


def mark(log: DataFrame, spec: LoadSpec = LoadSpec()) -> DataFrame:
    """Watermark and dedup: the new records with ``watermark`` and, if a rule is set, ``is_dup``."""
    history = spec.history
    if spec.positions is not None:  # one row per topic-partition: sent to the records, or these would be dealt out by topic-partition
        done = spec.positions.select("topic", "partition", F.col("next_offset").alias("_tw_next"), F.col("watermark").alias("_tw_wm"))
        history = log if history is None else history
        log = log.join(F.broadcast(done.drop("_tw_wm")), ["topic", "partition"], "left").where(F.coalesce(F.col("offset") >= F.col("_tw_next"), F.lit(True))).drop("_tw_next")
    if history is not None and spec.dedup is not None:
        log = dedup.with_rewind(log, history, spec.rewind)
    # the fused form needs a chunk that holds the window; both forms give the same rows
    if spec.dedup == "offsets" and spec.scope is None and spec.dedup_offsets <= spec.chunk_size:
        x = dedup.watermark_offset_dedup(log, spec.dedup_offsets, chunk_size=spec.chunk_size)  # one exchange for both
    else:
        x = mark_duplicates(with_stream_watermark(log, chunk_size=spec.chunk_size), spec)
    if "is_rewound" in x.columns:
        x = dedup.drop_rewound(x)
    if spec.positions is not None:
        x = x.join(F.broadcast(done.drop("_tw_next")), ["topic", "partition"], "left").withColumn("watermark", F.greatest("watermark", "_tw_wm")).drop("_tw_wm")
    return x


def prepare(log: DataFrame, spec: LoadSpec = LoadSpec()) -> DataFrame:
    """Watermark, dedup, decode, filter: decoded rows with ``watermark``, before file assignment."""
    x = mark(log, spec)
    if spec.dedup is not None:
        x = dedup.drop_duplicates_marked(x)
    x = codec.drop_malformed(codec.decode_proto(x, spec.message, spec.descriptor_set, partitions=spec.decode_partitions))
    if spec.predicate is not None:
        x = codec.filter_records(x, spec.predicate)
    return x


STATUS = "_tw_status"
BYTES = "_tw_bytes"  # a record's key and value, for byte limits
COMMIT = "_tw_commit"


def with_status(marked: DataFrame, spec: LoadSpec) -> DataFrame:
    """Every marked record, decoded unless it is a duplicate, with what becomes of it:
    kept, duplicate, malformed or filtered."""
    x = marked if "is_dup" in marked.columns else marked.withColumn("is_dup", F.lit(False))
    if spec.roll_bytes and spec.any_file:
        x = x.withColumn(BYTES, F.coalesce(F.octet_length("key"), F.lit(0)) + F.coalesce(F.octet_length("value"), F.lit(0)))
    x = codec.decode_proto(x.withColumn("value", F.when(~F.col("is_dup"), F.col("value"))), spec.message, spec.descriptor_set, partitions=spec.decode_partitions)
    status = F.when(F.col("is_dup"), "duplicate").when(F.col(codec.CORRUPT), "malformed")
    if spec.predicate is not None:
        status = status.when(~F.coalesce(spec.predicate, F.lit(False)), "filtered")
    return x.withColumn(STATUS, status.otherwise("kept")).drop("is_dup", codec.CORRUPT)


def publish_staged(spark: SparkSession, staged_path: str, base: str, batch_id: int, spec: LoadSpec, limit: int | None) -> dict:
    """Publish a staged table of ``with_status``: files of the kept rows, dead letters, and in the
    manifest the positions and drop counts, all from that one table."""
    staged = spark.read.parquet(staged_path)
    counts = staged.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset"), F.max("watermark").alias("watermark"), F.count(F.lit(1)).alias("records"),
        *(F.count(F.when(F.col(STATUS) == s, 1)).alias(s) for s in ("duplicate", "malformed", "filtered")),
        F.sum(F.coalesce(F.octet_length("key"), F.lit(0))).alias("key_bytes"),
    ).collect()  # one row per topic-partition
    rows = [r.asDict() for r in counts]
    positions = [{k: r[k] for k in ("topic", "partition", "next_offset", "watermark", "records")} for r in rows]
    dropped = [{k: r[k] for k in ("topic", "partition", "duplicate", "malformed", "filtered", "key_bytes")} for r in rows]
    if any(r["malformed"] for r in rows):
        letters = staged.where(F.col(STATUS) == "malformed").select("topic", "partition", "offset", "watermark")
        letters.write.mode("overwrite").parquet(f"{base.rstrip('/')}/_dead_letters/batch={batch_id}")
    kept = staged.where(F.col(STATUS) == "kept")
    if spec.any_file and "tw_commit" in staged.columns:  # a stream's records come with their commit
        kept = kept.withColumnRenamed("tw_commit", COMMIT)
    elif spec.any_file:
        committed = committed_any_file(kept, spec)
        positions = _positions_before(staged, committed.where(~F.col("closed")), positions)
        kept = kept.join(committed.where("closed").select("topic", "partition", "offset", COMMIT), ["topic", "partition", "offset"])
    return _publish(assign_files(kept, spec, limit), base, batch_id, spec, limit, positions, {"dropped": dropped})


def committed_any_file(kept: DataFrame, spec: LoadSpec) -> DataFrame:
    """(topic, partition, offset, _tw_commit, closed) of the kept rows: the commit of every row, and whether it happened.

    Batches are per topic-partition, or per ``spec.scope`` (``"root"``: all partitions, in the order of their times)."""
    if spec.layout not in ("hourly", "daily"):
        raise ValueError("any_file commits files of the hourly and daily layouts")
    x, group = dedup.scope_columns(kept, spec.scope)
    order = ["offset"] if sorted(group) == ["partition", "topic"] else ["timestamp", "topic", "partition", "offset"]
    x = partitioning.time_partition(x, spec.layout, spec.time_column)
    limits = Limits(spec.roll_records, spec.roll_bytes, spec.roll_open_ms)
    rolled = roll_limits(x, limits, group, partitioning.partition_columns(spec.layout), order, F.col(BYTES) if spec.roll_bytes else None, F.col("watermark"), spec.chunk_size)
    name = F.concat_ws("-", *(F.col(c).cast("string") for c in [*group, "batch_id"]))
    return materialize(rolled.select("topic", "partition", "offset", name.alias(COMMIT), "closed"), "commits")


def _positions_before(staged: DataFrame, still_open: DataFrame, positions: list[dict]) -> list[dict]:
    """Positions that stop before each topic-partition's first uncommitted record."""
    first = still_open.groupBy("topic", "partition").agg(F.min("offset").alias("_tw_first"))
    done = staged.join(F.broadcast(first), ["topic", "partition"]).where(F.col("offset") < F.col("_tw_first"))  # one row per topic-partition
    before = done.groupBy("topic", "partition").agg(F.max("watermark").alias("watermark"), F.count(F.lit(1)).alias("records"))
    stops = {(r["topic"], r["partition"]): r.asDict() for r in first.join(before, ["topic", "partition"], "left").collect()}
    out = []
    for p in positions:
        stop = stops.get((p["topic"], p["partition"]))
        out.append(p if stop is None else {**p, "next_offset": stop["_tw_first"], "watermark": stop["watermark"], "records": stop["records"] or 0})
    return out


def read_dead_letters(spark: SparkSession, base: str) -> DataFrame:
    """Topic, partition, offset and watermark of every malformed record of reporting loads, by batch."""
    path = f"{base.rstrip('/')}/_dead_letters"
    schema = "topic string, partition int, offset long, watermark long, batch long"
    if not _FS(spark, base).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/batch=*")


def assign_files(x: DataFrame, spec: LoadSpec, roll: int | None) -> DataFrame:
    """Partition value (and file number) for prepared rows; message fields, ``_kafka``, partition columns."""
    if spec.layout == "topic_partition":
        x = partitioning.roll_by_records(x, roll or TOPIC_PARTITION_ROLL, chunk_size=spec.chunk_size)
        keep = ["file_seq"]
    elif spec.layout in ("hourly", "daily"):
        x = partitioning.time_partition(x, spec.layout, spec.time_column)
        keep = [*partitioning.partition_columns(spec.layout), *([COMMIT] if spec.any_file else [])]
    elif spec.layout == "custom":
        if not spec.partition_columns:
            raise ValueError("the custom layout needs partition_columns")
        x = partitioning.custom_partitioner(x, **spec.partition_columns)
        keep = list(spec.partition_columns)
    else:
        raise ValueError(f"unknown layout {spec.layout!r}")
    msg_fields = [f.name for f in codec.proto.spark_schema(codec.proto.message_class(spec.message, spec.descriptor_set).DESCRIPTOR).fields]
    out = x.select(*msg_fields, codec.kafka_meta().alias("_kafka"), *keep)
    return codec.format_records(out, spec.formatter) if spec.formatter else out


def load_plan(log: DataFrame, spec: LoadSpec = LoadSpec()) -> DataFrame:
    """Annotated rows ready to write: message fields, ``_kafka``, partition columns (lazy)."""
    return assign_files(prepare(log, spec), spec, _record_limit(log, spec) if spec.layout == "topic_partition" else None)


def _record_limit(log: DataFrame, spec: LoadSpec) -> int | None:
    """Records per file: the record limit, or the byte limit over the mean value size (F2).

    Whichever is reached first wins, as with the loader's any-of limits; the
    byte form is approximate (Spark has no exact byte cap per file).
    """
    if spec.any_file:
        return None  # files are cut by the commits
    limits = [spec.roll_records] if spec.roll_records else []
    if spec.roll_bytes:
        mean = log.agg(F.avg(F.octet_length("value") + F.coalesce(F.octet_length("key"), F.lit(0)))).first()[0] or 1.0
        limits.append(partitioning.target_records_per_file(mean, spec.roll_bytes))
    return min(limits) if limits else None


def load(log: DataFrame, base: str, batch_id: int, spec: LoadSpec = LoadSpec()) -> dict:
    """Run one batch end to end and publish it; returns the batch manifest.

    For files per topic-partition and for reporting loads, the decoded rows are
    staged once as a table under the lake's staging folder: the numbering scan
    reads its input twice, and dedup and decode would otherwise run twice.
    Positions then come from that table.  Other loads read the log's offsets
    and times once more for them.
    """
    spark = log.sparkSession
    if _FS(spark, base).exists(manifest_path(base, batch_id)):
        return publish(log, base, batch_id)  # published already
    if spec.resume and spec.positions is None:
        spec = replace(spec, positions=last_committed(committed_positions(spark, base)))
    limit = _record_limit(log, spec)
    if spec.layout == "topic_partition" or spec.report or spec.any_file:
        staged_path = f"{base.rstrip('/')}/_staging/prepared={batch_id}"
        with_status(mark(log, spec), spec).write.mode("overwrite").parquet(staged_path)
        manifest = publish_staged(spark, staged_path, base, batch_id, spec, limit)
        _FS(spark, base).delete(staged_path)
        return manifest
    # K8: the position after this batch covers every record read (duplicates and bad ones too)
    new = log if spec.positions is None else log.join(F.broadcast(spec.positions.select("topic", "partition", F.col("next_offset").alias("_tw_next"))), ["topic", "partition"], "left").where(F.coalesce(F.col("offset") >= F.col("_tw_next"), F.lit(True)))
    read = new.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"), F.max(ts_millis("timestamp")).alias("watermark"), F.count(F.lit(1)).alias("records"))
    if spec.positions is not None:  # the running watermark goes on from the committed one
        read = read.join(spec.positions.select("topic", "partition", F.col("watermark").alias("_tw_wm")), ["topic", "partition"], "left").withColumn("watermark", F.greatest("watermark", "_tw_wm")).drop("_tw_wm")
    positions = [r.asDict() for r in read.collect()]  # one row per topic-partition
    return _publish(load_plan(log, spec), base, batch_id, spec, limit, positions)


def _publish(plan: DataFrame, base: str, batch_id: int, spec: LoadSpec, limit: int | None, positions: list[dict], audit: dict | None = None) -> dict:
    opts = spec.parquet
    if limit and spec.layout != "topic_partition":
        opts = ParquetOptions(opts.compression, opts.block_size, opts.page_size, opts.dictionary, limit)
    return publish(plan, base, batch_id, layout=spec.layout, opts=opts, positions=positions, partition_cols=list(spec.partition_columns or {}), file_name=spec.file_name, audit=audit, commit_col=COMMIT if spec.any_file else None)


def load_all(log: DataFrame, base: str, batch_id: int, **kw) -> dict:
    """K5: every record, duplicates included."""
    return load(log, base, batch_id, LoadSpec(dedup=None, **kw))


def load_deduplicated(log: DataFrame, base: str, batch_id: int, **kw) -> dict:
    """K6: recent-key dedup, then the time-partitioned load."""
    return load(log, base, batch_id, LoadSpec(dedup="recent", **kw))


def load_by_topic_partition(log: DataFrame, base: str, batch_id: int, **kw) -> dict:
    """K7: dedup, files per topic-partition named by offset range."""
    kw.setdefault("layout", "topic_partition")
    return load(log, base, batch_id, LoadSpec(dedup="recent", **kw))


# Loaders picked by name.
LOADERS = {
    "plain": load_all,
    "deduplicated": load_deduplicated,
    "by_topic_partition": load_by_topic_partition,
}


def loader(name: str):
    try:
        return LOADERS[name]
    except KeyError:
        raise ValueError(f"unknown loader {name!r}; known: {sorted(LOADERS)}") from None

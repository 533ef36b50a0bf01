"""Parquet sink with staged, idempotent publishing.

A batch is written by Spark into ``<staging>/batch=<id>`` (Spark's output
committer discards the files of failed tasks, K9).  The list of moves is
written next, the files are moved into the destination layout through the
Hadoop ``FileSystem``, then the positions and, last, the manifest
``_manifests/batch-<id>.json`` appear, each by a rename.  Re-running a batch id
whose manifest exists is a no-op; re-running one that failed half-way first
removes what its list of moves names, in every layout, so a restart neither
loses nor repeats a batch.  Readers that must see only complete batches read through the
manifests (``read_loaded(committed_only=True)``).

The moves are metadata operations issued by the driver, one per file; the
data itself is written by the executors.  Where a batch has very many files (one
for each commit), the cost is in the files.  Hadoop's local file system starts a
process for each file, each checksum file and each folder that it creates, to set
its mode; there a commit's files are written by the executors' Python workers
(``_write_commits``) and moved without a call into the JVM for each.
"""

from __future__ import annotations

import json
import os
import re
import shutil
import time
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.partitioning import offset_range_name
from ..schema import output_schema
from ..session import ship_package
from ..storage import materialize, scratch_path  # noqa: F401  (also used through this module)

# Accepted compression names (case-insensitive) -> Spark codec.
COMPRESSIONS = {"NONE": "none", "ZSTD": "zstd", "GZIP": "gzip", "SNAPPY": "snappy", "LZ4": "lz4"}

# Compressions known elsewhere that Parquet cannot be written with here.
UNUSABLE_COMPRESSIONS = ("BROTLI", "BZIP", "BZIP2", "DEFLATE", "LZO", "XZ")

DEFAULT_BLOCK_SIZE = 134_217_728
DEFAULT_PAGE_SIZE = 1_048_576
MOVES_AT_A_TIME = 16
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# Types whose Parquet form is the same from Arrow as from Spark's writer.
ARROW_TYPES = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType, T.BinaryType)
ARROW_LEVELS = {"gzip": 6, "zstd": 3}  # as Spark's writer has them
ROW_GROUP_BYTES = 1 << 25  # of rows that a worker holds before it writes them out, in smaller files than a block
REPORT = "folder string, commit string, name string, topic string, partition int, n long"  # a file, or rows of a topic-partition
DEFAULT_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"
TEXT_BYTES = 1 << 20  # of a text, handed to the JVM at a time
FOLDERS_FROM, FOLDERS_BATCHES = 1000, 64  # committed files from which, and batches up to which, folders are read whole


def parse_compression(name: str | None) -> str:
    """K2: compression setting -> Spark codec; absent -> none; known but unusable in Parquet
    -> NotImplementedError; unknown -> ValueError."""
    if name is None:
        return "none"
    key = name.strip().upper()
    if key in UNUSABLE_COMPRESSIONS:
        raise NotImplementedError(f"Compression '{name}' is unsupported in Parquet")
    if key not in COMPRESSIONS:
        raise ValueError(f"Unknown compression type '{name}'")
    return COMPRESSIONS[key]


@dataclass(frozen=True)
class ParquetOptions:
    """K1/K3: writer settings (defaults: 128 MiB row groups, 1 MiB pages, dictionary on)."""

    compression: str | None = None
    block_size: int = DEFAULT_BLOCK_SIZE
    page_size: int = DEFAULT_PAGE_SIZE
    dictionary: bool = True
    max_records_per_file: int | None = None


def write_parquet(
    df: DataFrame, path: str, opts: ParquetOptions = ParquetOptions(), partition_by: list[str] | None = None, mode: str = "append"
) -> None:
    """K1: Parquet write with codec, row-group, page and dictionary settings."""
    w = (
        df.write.mode(mode)
        .option("compression", parse_compression(opts.compression))
        .option("parquet.block.size", str(opts.block_size))
        .option("parquet.page.size", str(opts.page_size))
        .option("parquet.dictionary.page.size", str(opts.page_size))
        .option("parquet.enable.dictionary", str(opts.dictionary).lower())
    )
    if opts.max_records_per_file:
        w = w.option("maxRecordsPerFile", str(opts.max_records_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


class _FS:
    """Thin access to the Hadoop FileSystem of a path (driver-side metadata calls)."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.jvm = jvm
        self.Path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.is_local = self.fs.getUri().getScheme() == "file"

    def local(self, s: str) -> str:
        """The path of a local file (``is_local``) without scheme."""
        if s.startswith("file:"):
            return "/" + s[len("file:"):].lstrip("/")
        return s if s.startswith("/") else self.fs.makeQualified(self.p(s)).toUri().getPath()

    def p(self, s: str):
        return self.Path(s)

    def exists(self, s: str) -> bool:
        return self.fs.exists(self.p(s))

    def delete(self, s: str) -> None:
        if self.fs.exists(self.p(s)):
            self.fs.delete(self.p(s), True)

    def delete_tree(self, s: str) -> None:
        """Delete a folder that may hold very many others."""
        if self.is_local and os.path.isdir(self.local(s)):
            shutil.rmtree(self.local(s))
        else:
            self.delete(s)

    def data_files(self, root: str) -> list[str]:
        out = []
        it = self.fs.listFiles(self.p(root), True)
        while it.hasNext():
            st = it.next()
            name = st.getPath().getName()
            if name.endswith(".parquet") and not name.startswith(("_", ".")):
                out.append(st.getPath().toString())
        return sorted(out)

    def has_data(self, root: str) -> bool:
        """Whether a data file is there; looks no further than the first."""
        it = self.fs.listFiles(self.p(root), True)
        while it.hasNext():
            name = it.next().getPath().getName()
            if name.endswith(".parquet") and not name.startswith(("_", ".")):
                return True
        return False

    def any(self, pattern: str) -> bool:
        sts = self.fs.globStatus(self.p(pattern))
        return sts is not None and len(sts) > 0

    def glob(self, pattern: str) -> list[str]:
        sts = self.fs.globStatus(self.p(pattern))
        return [] if sts is None else [s.getPath().toString() for s in sts]

    def move(self, src: str, dst: str) -> None:
        d = self.p(dst)
        if self.fs.exists(d):
            raise OSError(f"{dst} exists and is not this batch's")
        if not self.fs.rename(self.p(src), d):
            raise OSError(f"rename failed: {src} -> {dst}")

    def move_local(self, src: str, dst: str) -> None:
        """``move`` on the local file system: the file and, as Hadoop does, its checksum file."""
        s, d = self.local(src), self.local(dst)
        if os.path.lexists(d):
            raise OSError(f"{dst} exists and is not this batch's")
        os.rename(s, d)
        s_sum, d_sum = (os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc") for f in (s, d))
        if os.path.exists(s_sum):
            os.replace(s_sum, d_sum)
        elif os.path.exists(d_sum):
            os.remove(d_sum)

    def move_all(self, moves: list[tuple[str, str]]) -> None:
        """Each folder is made once; moves wait for the file system, so several go at a time."""
        for folder in sorted({dst.rsplit("/", 1)[0] for _, dst in moves}):
            self.fs.mkdirs(self.p(folder))
        if self.is_local:
            for src, dst in moves:
                self.move_local(src, dst)
            return
        with ThreadPoolExecutor(MOVES_AT_A_TIME) as pool:
            list(pool.map(lambda m: self.move(*m), moves))

    def set_mtime(self, s: str, millis: int) -> None:
        self.fs.setTimes(self.p(s), int(millis), -1)

    def write_text(self, s: str, text: str) -> None:
        """Write a small file whole or not at all: under another name, then renamed."""
        target = self.p(s)
        part = self.Path(target.getParent(), f"_{target.getName()}.part")
        out = self.fs.create(part, True)
        try:
            data = text.encode("utf-8")
            for i in range(0, len(data), TEXT_BYTES):
                out.write(bytearray(data[i : i + TEXT_BYTES]))
        finally:
            out.close()
        if self.fs.exists(target):
            self.fs.delete(target, False)
        if not self.fs.rename(part, target):
            raise OSError(f"rename failed: {part} -> {s}")

    def read_text(self, s: str) -> str:
        if self.is_local:  # the list of very many files is a long line
            with open(self.local(s), encoding="utf-8") as f:
                return f.read()
        stream = self.fs.open(self.p(s))
        try:
            reader = self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()


def _rel(path: str, root: str) -> str:
    i = path.find(root.rstrip("/").split("://")[-1])
    tail = path[i + len(root.rstrip("/").split("://")[-1]):] if i >= 0 else path
    return tail.lstrip("/")


def positions_path(base: str, batch_id: int) -> str:
    return f"{base.rstrip('/')}/_positions/batch-{batch_id:020d}.json"


def manifest_path(base: str, batch_id: int) -> str:
    return f"{base.rstrip('/')}/_manifests/batch-{batch_id:020d}.json"


def publish(
    df: DataFrame,
    base: str,
    batch_id: int,
    layout: str = "hourly",
    opts: ParquetOptions = ParquetOptions(),
    staging: str | None = None,
    positions: list[dict] | None = None,
    partition_cols: list[str] | None = None,
    file_name: Column | None = None,
    audit: dict | None = None,
    commit_col: str | None = None,
) -> dict:
    """K4: stage one batch, move its files into ``base``, write the manifest last.

    ``positions`` (K8): the stream position after the batch per
    topic-partition (next offset, watermark); stored in the manifest, so
    files and positions become visible together.

    ``layout``: ``hourly`` (dt=yyyyMMdd/hr=HH), ``daily`` (dt=yyyy_MM_dd) —
    the frame carries those columns — or ``topic_partition``: one file per
    (topic, partition, file_seq) named ``{topic}_{partition}_{min}_{max}.parquet``
    (the frame carries ``_kafka`` and ``file_seq``) — or ``custom``: the frame
    carries ``partition_cols`` (U3).  ``file_name`` (U5) names a topic-partition
    file from its columns t, p, lo and hi; names that are null, repeat within the batch
    or are another batch's file stop the batch before anything moves.  ``audit`` is added to the manifest.
    ``commit_col``: a column of the frame (not written) that cuts the files of a
    directory, one file for each of its values.
    """
    spark = df.sparkSession
    base = base.rstrip("/")
    staging = (staging or f"{base}/_staging").rstrip("/")
    fs = _FS(spark, base)
    mpath = manifest_path(base, batch_id)
    if fs.exists(mpath):
        return json.loads(fs.read_text(mpath))

    started = time.time()
    stage = f"{staging}/batch={batch_id}"
    moves_path = f"{staging}/moves-{batch_id}.json"
    if fs.exists(moves_path):  # an attempt that died while moving
        for dst in json.loads(fs.read_text(moves_path)):
            fs.delete(dst)
        fs.delete(moves_path)
    fs.delete_tree(stage)
    tag = f"batch-{batch_id:020d}"
    moves: list[tuple[str, str]] = []

    written: list[dict] = []
    if layout in ("hourly", "daily", "custom"):
        cols = partition_cols if layout == "custom" else ["dt", "hr"] if layout == "hourly" else ["dt"]
        if commit_col and layout != "custom" and fs.is_local and _same_in_arrow(df, cols, commit_col, opts):
            files, written = _write_commits(df, fs, stage, opts, cols, commit_col)
        else:
            # REBALANCE lets AQE split a hot hour over several writers; a commit's file is bounded and has one
            dealt = df.repartition(*cols, commit_col) if commit_col else df.hint("rebalance", *cols)
            write_parquet(dealt, stage, opts, partition_by=[*cols, *([commit_col] if commit_col else [])], mode="overwrite")
            staged = _read_staged(spark, fs, stage)
            files, written = _files_of(staged), _written_counts(staged)
        for old in fs.glob(f"{base}/{'/'.join(c + '=*' for c in cols)}/{tag}-*"):  # files without a manifest are no one's
            fs.delete(old)
        for i, src in enumerate(files):
            rel_dir = "/".join(_rel(src, stage).split("/")[: len(cols)])
            moves.append((src, f"{base}/{rel_dir}/{tag}-{i:05d}.parquet"))
    elif layout == "topic_partition":
        file_key = F.concat_ws("__", F.col("_kafka.topic"), F.col("_kafka.partition").cast("string"), F.col("file_seq").cast("string"))
        keyed = df.withColumn("_tw_file", file_key).drop("file_seq")
        # one writer per file; a file is bounded by the roll limit, so no task is hot.  The cost
        # is in the files, not their bytes: the tasks are not to be merged by size
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        write_parquet(keyed.repartition(tasks, "_tw_file"), stage, opts, partition_by=["_tw_file"], mode="overwrite")
        # names and counts come from each staged file's offset range: one scan of _kafka only,
        # one small row per file (the batch plan is not evaluated twice)
        staged = _read_staged(spark, fs, stage)
        ranges = None if staged is None else (
            staged.groupBy("_tw_file", F.col("_kafka.topic").alias("t"), F.col("_kafka.partition").alias("p"))
            .agg(F.min("_kafka.offset").alias("lo"), F.max("_kafka.offset").alias("hi"), F.count(F.lit(1)).alias("n"))
            .groupBy("_tw_file")
            .agg(F.first("t").alias("t"), F.first("p").alias("p"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                 F.collect_list(F.struct("t", "p", "n")).alias("counts"))
            .select(F.col("_tw_file").cast("string").alias("_tw_file"), "counts",
                    (offset_range_name(F.col("t"), F.col("p"), F.col("lo"), F.col("hi")) if file_name is None else file_name).alias("name"))
        )
        found = [] if ranges is None else ranges.collect()
        names = {r["_tw_file"]: r["name"] for r in found}
        totals: Counter = Counter()
        for r in found:
            totals.update({(c["t"], c["p"]): c["n"] for c in r["counts"]})
        written = [{"topic": t, "partition": p, "count": n} for (t, p), n in totals.items()]
        for src in _files_of(staged):
            key = unquote(_rel(src, stage).split("/")[0].split("=", 1)[1])
            moves.append((src, f"{base}/{names[key]}"))
        _check_names(fs, list(names.values()), moves, taken=file_name is not None)
    else:
        raise ValueError(f"unknown layout {layout!r}")

    fs.write_text(moves_path, json.dumps([dst for _, dst in moves]))
    fs.move_all(moves)
    manifest = {
        "batch_id": batch_id, "layout": layout, "files": [dst for _, dst in moves], "positions": positions or [],
        "written": written, "committed_at_ms": int(time.time() * 1000),
        "duration_s": round(time.time() - started, 3), **(audit or {}),
    }
    fs.write_text(positions_path(base, batch_id), json.dumps(positions or []))
    fs.write_text(mpath, json.dumps(manifest))
    fs.delete(moves_path)
    fs.delete_tree(stage)
    return manifest


def _check_names(fs: _FS, names: list[str | None], moves: list[tuple[str, str]], taken: bool) -> None:
    """No two files may get one name, nor (``taken``) the name of a file that is there: the later would replace the earlier."""
    if None in names:
        raise ValueError("a file name is null")
    seen: set[str] = set()
    for _, dst in moves:
        if dst in seen or (taken and fs.exists(dst)):
            raise ValueError(f"two files named {dst}")
        seen.add(dst)


def _same_in_arrow(df: DataFrame, cols: list[str], commit_col: str, opts: ParquetOptions) -> bool:
    """Whether ``_write_commits`` writes the files that Spark would write."""

    def plain(t: T.DataType) -> bool:
        if isinstance(t, T.StructType):
            return len(t) > 0 and all(plain(f.dataType) for f in t)
        return plain(t.elementType) if isinstance(t, T.ArrayType) else isinstance(t, ARROW_TYPES) and not isinstance(t, (T.CharType, T.VarcharType))

    rows = T.StructType([f for f in df.schema if f.name not in (*cols, commit_col)])
    return plain(rows) and "_kafka" in rows.names and opts.max_records_per_file is None and parse_compression(opts.compression) != "lz4"


def _write_commits(df: DataFrame, fs: _FS, stage: str, opts: ParquetOptions, cols: list[str], commit_col: str) -> tuple[list[str], list[dict]]:
    """K1, K9: one file for each directory and commit, staged in a folder of the local file system by Python
    workers; paths in the order of directories and commits, and rows written per topic-partition.

    A worker holds the rows of one file, a row group at most.  Only what tasks report that ended well
    is published: files of other attempts, which have names of their own, go with the folder."""
    spark = df.sparkSession
    ship_package(spark)
    keys = [f"_tw_key{i}" for i in range(len(cols) + 1)]
    rows = [c for c in df.columns if c not in (*cols, commit_col)]
    # the cost is in the files, not their bytes: the tasks are not to be merged by size
    named = (F.nullif(F.col(c).cast("string"), F.lit("")).alias(k) for c, k in zip([*cols, commit_col], keys))  # an empty name is none
    dealt = df.select(*named, *(F.col(f"`{c}`") for c in rows))
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
    codec = parse_compression(opts.compression)
    settings = {
        "compression": codec, "compression_level": ARROW_LEVELS.get(codec), "use_dictionary": opts.dictionary, "data_page_size": opts.page_size,
        "dictionary_pagesize_limit": opts.page_size, "write_page_checksum": True, "store_schema": False,
    }
    metadata = {"org.apache.spark.version": spark.version, "org.apache.spark.sql.parquet.row.metadata": df.select(*(f"`{c}`" for c in rows))._jdf.schema().json()}
    group_bytes = min(opts.block_size, ROW_GROUP_BYTES)
    root = fs.local(stage)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, at = uuid.uuid4().hex, set(), None
        writer, held, held_bytes, number = None, [], 0, 0
        files, counts = [], Counter()

        def write_held():
            nonlocal held, held_bytes
            if held:
                table = pa.Table.from_batches(held)
                writer.write_table(table, row_group_size=len(table))
                held, held_bytes = [], 0

        def end_file():
            write_held()
            if writer is not None:
                writer.add_key_value_metadata(metadata)
                writer.close()
                sink.close()

        for batch in batches:
            if not batch.num_rows:
                continue
            data = batch.select(rows)
            # a struct's fields are null where it is null
            kafka = [pc.struct_field(batch.column("_kafka"), n) for n in ("topic", "partition")]
            for r in pa.table(kafka, names=["t", "p"]).group_by(["t", "p"]).aggregate([([], "count_all")]).to_pylist():
                counts[r["t"], r["p"]] += r["count_all"]
            ends = np.unique(np.concatenate([pc.run_end_encode(batch.column(k)).run_ends.to_numpy() for k in keys])).tolist()
            start = 0
            for end in ends:
                value = tuple(batch.column(k)[start].as_py() for k in keys)
                if value != at:
                    end_file()
                    *names, commit = value
                    folder = "/".join(f"{c}={_directory(v)}" for c, v in zip(cols, names))
                    if folder not in made:
                        os.makedirs(f"{root}/{folder}", exist_ok=True)
                        made.add(folder)
                    name = f"part-{task}-{number}.parquet"
                    sink = pa.OSFile(f"{root}/{folder}/{name}", "wb")
                    writer = pq.ParquetWriter(sink, data.schema, **settings)
                    files.append((folder, commit, name))
                    at, number = value, number + 1
                part = data.slice(start, end - start)
                held.append(part)
                held_bytes += part.nbytes
                if held_bytes >= group_bytes:
                    write_held()
                start = end
        end_file()
        yield _reported([(*f, None, None, None) for f in files] + [(None, None, None, t, p, n) for (t, p), n in counts.items()])

    found = dealt.mapInArrow(write, REPORT).collect()
    totals: Counter = Counter()
    for r in found:
        if r["n"] is not None:
            totals[r["topic"], r["partition"]] += r["n"]
    files = sorted((f"{r['folder']}/{_directory(r['commit'])}/", f"{stage}/{r['folder']}/{r['name']}") for r in found if r["n"] is None)
    return [path for _, path in files], [{"topic": t, "partition": p, "count": n} for (t, p), n in totals.items()]


def _reported(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string()] * 4 + [pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["folder", "commit", "name", "topic", "partition", "n"])


def _directory(value: str | None) -> str:
    """A partition value as Spark writes it into a directory's name."""
    return re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", value) if value else DEFAULT_DIRECTORY


def _read_staged(spark: SparkSession, fs: _FS, stage: str) -> DataFrame | None:
    """A staged batch, its folders listed once, by Spark tasks where there are many (several
    folders to a task, or each folder would be one); None: it has no file."""
    if not fs.has_data(stage):
        return None
    with _few_listing_tasks(spark):
        return spark.read.option("basePath", stage).parquet(stage)


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Many paths that are read meanwhile are listed by some tasks, not one for each."""
    before = spark.conf.get(LISTING_TASKS, None)
    spark.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(LISTING_TASKS) if before is None else spark.conf.set(LISTING_TASKS, before)


def _files_of(staged: DataFrame | None) -> list[str]:
    """Paths of a staged batch's files, in order, from the listing that it was read with."""
    # as Hadoop writes paths: decoded, and file:/x for file:///x
    return [] if staged is None else sorted(re.sub(r"^([^/]+):///", r"\1:/", unquote(f)) for f in staged.inputFiles())


def _written_counts(staged: DataFrame | None) -> list[dict]:
    """Rows written per topic-partition in a staged batch (a scan of ``_kafka`` only; one row each)."""
    if staged is None:
        return []
    counts = staged.groupBy(F.col("_kafka.topic").alias("topic"), F.col("_kafka.partition").alias("partition")).count()
    return [r.asDict() for r in counts.collect()]


def committed_positions(spark: SparkSession, base: str) -> DataFrame:
    """K8/A3 input: (topic, partition, commit_seq, next_offset, watermark) of every published batch.

    Reads the small position files only (one row per topic-partition), not the lists of files."""
    base = base.rstrip("/")
    fs = _FS(spark, base)
    published = {m.rsplit("/", 1)[-1] for m in fs.glob(f"{base}/_manifests/batch-*.json")}
    rows = []
    for path in fs.glob(f"{base}/_positions/batch-*.json"):
        name = path.rsplit("/", 1)[-1]
        for p in json.loads(fs.read_text(path)) if name in published else ():
            rows.append((p["topic"], int(p["partition"]), int(name[len("batch-") : -len(".json")]), int(p["next_offset"]), p.get("watermark")))
    return spark.createDataFrame(rows, "topic string, partition int, commit_seq long, next_offset long, watermark long")


def _committed_folders(fs: _FS, reader, base: str, paths: list[str]) -> DataFrame | None:
    """The committed files ``paths``, read by folder where they are very many: a folder is listed once
    instead of every file.  Only folders that hold these files and no others are read so; files that a
    later batch adds meanwhile are left out by name.  None: to be read file by file."""
    if not fs.is_local or len(paths) < FOLDERS_FROM:
        return None
    names: dict[str, set[str]] = defaultdict(set)
    tags = set()
    for path in paths:
        folder, name = path.rsplit("/", 1)
        tag = re.match(r"(batch-\d{20})-\d+\.parquet$", name)
        if tag is None:
            return None  # named by offsets
        tags.add(tag[1])
        names[folder].add(name)
    if len(tags) > FOLDERS_BATCHES:
        return None
    found = []
    for folder, committed in sorted(names.items()):
        try:
            there = {n for n in os.listdir(fs.local(folder)) if not n.startswith(("_", "."))}
        except FileNotFoundError:
            there = set()
        found += [folder] if there == committed else [f"{folder}/{n}" for n in sorted(committed)]
    return reader.option("pathGlobFilter", "{" + ",".join(sorted(tags)) + "}-*.parquet").parquet(*found)


def read_loaded(
    spark: SparkSession, base: str, layout: str = "hourly", committed_only: bool = False, schema=None
) -> DataFrame:
    """Read a loaded lake; directory values stay strings (dt=20240101, hr=00)."""
    base = base.rstrip("/")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    reader = spark.read.option("basePath", base)
    if schema is not None:
        reader = reader.schema(schema)
    if committed_only:
        fs = _FS(spark, base)
        paths = []
        for m in fs.glob(f"{base}/_manifests/batch-*.json"):
            paths.extend(json.loads(fs.read_text(m))["files"])
        if not paths:
            extra = {"hourly": "dt string, hr string", "daily": "dt string"}.get(layout)
            columns = [*output_schema().fields, *(T.StructType.fromDDL(extra).fields if extra else [])]
            return spark.createDataFrame([], T.StructType(columns))
        with _few_listing_tasks(spark):
            return _committed_folders(fs, reader, base, paths) or reader.parquet(*paths)
    if layout == "topic_partition":
        fs = _FS(spark, base)
        # files beside one another are one listing of their folder, not a path each; other layouts' folders are left out
        if fs.any(f"{base}/*.parquet") and not fs.any(f"{base}/[!_.]*/*"):
            return reader.option("pathGlobFilter", "*.parquet").parquet(base)
    pattern = {"topic_partition": "*.parquet", "hourly": "dt=*/hr=*/*.parquet", "daily": "dt=*/*.parquet"}[layout]
    return reader.parquet(f"{base}/{pattern}")

"""Partition values, file names and file rolling.

The loader writes one open file per partition value and rolls files on
limits.  In Spark the partition value is a column (``partitionBy``) and
file membership is a computed column (``file_seq`` / ``batch_id``), so the
same rules can be checked, reported and used to name files at publish time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rolling import Limits, roll_limits
from .scans import DEFAULT_CHUNK, offset_chunk, running_max, running_position
from .watermark import WATERMARK, hour_bucket

# Directory patterns of the two time layouts.
DAILY_PATTERN = "yyyy_MM_dd"  # dt=2024_01_31
HOURLY_DT_PATTERN = "yyyyMMdd"  # dt=20240131/hr=07
HOURLY_HR_PATTERN = "HH"


def time_partition(df: DataFrame, layout: str = "hourly", watermark: str | Column = WATERMARK) -> DataFrame:
    """Directory columns from the hour of the record's watermark.

    ``daily`` -> ``dt`` = yyyy_MM_dd; ``hourly`` -> ``dt`` = yyyyMMdd and
    ``hr`` = HH.  A late record goes to the watermark's hour (W4).
    """
    b = hour_bucket(watermark)
    if layout == "daily":
        return df.withColumn("dt", F.date_format(b, DAILY_PATTERN))
    if layout == "hourly":
        return df.withColumn("dt", F.date_format(b, HOURLY_DT_PATTERN)).withColumn("hr", F.date_format(b, HOURLY_HR_PATTERN))
    raise ValueError(f"unknown time layout {layout!r}")


def partition_columns(layout: str) -> list[str]:
    return {"daily": ["dt"], "hourly": ["dt", "hr"], "topic_partition": ["_tw_part_topic", "_tw_part_partition"]}[layout]


def topic_partition_partitioner(df: DataFrame) -> DataFrame:
    """Partition value = (topic, partition), kept as copies so ``_kafka`` stays whole."""
    return df.withColumn("_tw_part_topic", F.col("topic")).withColumn("_tw_part_partition", F.col("partition"))


def custom_partitioner(df: DataFrame, **exprs: Column) -> DataFrame:
    """Any Column expressions as partition values."""
    for name, e in exprs.items():
        df = df.withColumn(name, e)
    return df


def partition_group(df: DataFrame, fn: Column, name: str = "group") -> DataFrame:
    """P5/U4: route topic-partitions to named groups (shared dedup state and batches)."""
    return df.withColumn(name, fn)


def offset_range_name(topic: Column, partition: Column, lo: Column, hi: Column, ext: str | None = "parquet") -> Column:
    """``{topic}_{partition}_{min start}_{max end}[.ext]`` (end inclusive)."""
    base = F.format_string("%s_%d_%d_%d", topic, partition, lo, hi)
    return F.concat(base, F.lit(f".{ext}")) if ext else base


def offset_range_paths(df: DataFrame, batch: str = "batch_id", ext: str | None = "parquet") -> DataFrame:
    """File name per (topic, partition, batch) from its offset range."""
    return (
        df.groupBy("topic", "partition", batch)
        .agg(F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"), F.count(F.lit(1)).alias("records"))
        .withColumn("path", offset_range_name(F.col("topic"), F.col("partition"), F.col("min_offset"), F.col("max_offset"), ext))
    )


def roll_by_records(
    df: DataFrame,
    n: int,
    by: Sequence[str] = ("topic", "partition"),
    order: str = "offset",
    out: str = "file_seq",
    chunk_size: int = DEFAULT_CHUNK,
) -> DataFrame:
    """file number within each partition value = (row position) // n.

    Position comes from a chunked running count, so a hot partition value is
    not one task.  ``by`` must hold the order column's scope (positions are
    counted in ``order`` within ``by``).
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    x = running_position(df, list(by), order, "_tw_pos", chunk=offset_chunk(order, chunk_size))
    return x.withColumn(out, F.floor(F.col("_tw_pos") / F.lit(n)).cast("long")).drop("_tw_pos")


def target_records_per_file(avg_row_bytes: float, target_bytes: int) -> int:
    """byte limit turned into a record limit (Spark has no exact byte cap)."""
    return max(1, int(target_bytes // max(avg_row_bytes, 1.0)))


def roll_any_file(
    df: DataFrame,
    n: int,
    group: Sequence[str] = ("topic", "partition"),
    file_cols: Sequence[str] = ("dt", "hr"),
    order: Sequence[str] = ("offset",),
    contiguous: bool | None = None,
    chunk_size: int = DEFAULT_CHUNK,
) -> DataFrame:
    """once any open file of a batch holds ``n`` records, the whole batch commits.

    Returns (group..., topic, partition, offset, batch_id, closed): records
    in order get the current batch id; when the record makes its file reach
    ``n``, that batch closes and every counter restarts.  ``closed`` is false
    for the trailing batch still open at the end of the input.

    Default: one group per topic-partition (as one loader thread per
    partition set), files per hour of the watermark.  Those files are
    contiguous in offset order (the watermark never decreases), and then the
    rule has a closed form computed in parallel (``contiguous``, chosen
    automatically for that case): a batch closes every ``n`` records of a
    file, and a file's unfinished tail joins the next file's first batch, so
    ``batch_id = sum over earlier files of floor(count / n) + floor(pos / n)``.
    Interleaved files (e.g. ``group=("_tw_root",)``, files per
    topic-partition, order (timestamp, topic, partition, offset)) are cut by
    next starts and chunk tables (``rolling.roll_limits``).
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    if contiguous is None:
        contiguous = (
            sorted(group) == ["partition", "topic"] and set(file_cols) <= {"dt", "hr"} and list(order) == ["offset"]
        )
    if contiguous:
        return _roll_contiguous(df, n, list(group), list(file_cols))
    x = df.withColumn("_tw_root", F.lit("root")) if "_tw_root" in group and "_tw_root" not in df.columns else df
    out = roll_limits(x, Limits(records=n), group, file_cols, order, chunk_size=chunk_size)
    return out.drop("_tw_root") if "_tw_root" not in df.columns else out


def _roll_contiguous(df: DataFrame, n: int, group: list[str], file_cols: list[str]) -> DataFrame:
    ids = [c for c in ("topic", "partition", "offset") if c not in group]
    x = running_position(df.select(*group, *ids, *file_cols), [*group, *file_cols], "offset", "_tw_pos")
    files = x.groupBy(*group, *file_cols).agg(
        F.count(F.lit(1)).alias("_tw_n"), F.min("offset").alias("_tw_first")
    ).withColumn("_tw_closed", F.floor(F.col("_tw_n") / F.lit(n)))
    before = Window.partitionBy(*group).orderBy("_tw_first").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(
        *group, *file_cols,
        F.coalesce(F.sum("_tw_closed").over(before), F.lit(0)).alias("_tw_prev"),
        F.sum("_tw_closed").over(Window.partitionBy(*group)).alias("_tw_total"),
    )
    out = x.join(files, on=[*group, *file_cols], how="inner")
    batch = (F.col("_tw_prev") + F.floor(F.col("_tw_pos") / F.lit(n))).cast("long")
    return out.select(*group, *ids, batch.alias("batch_id"), (batch < F.col("_tw_total")).alias("closed"))


def _unit(seed: int, k: Column, tag: str) -> Column:
    """Uniform (0, 1) from the MD5 of "seed/k/tag" (first 13 hex digits): stable
    under any partitioning, and computable in SQL engines too."""
    text = F.concat_ws("/", F.lit(str(seed)), k.cast("string"), F.lit(tag))
    h = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return (h + F.lit(1)) / F.lit(float(16**13 + 1))


def fuzzy_limits(spark, count: int, mean: float, sd: float, seed: int) -> DataFrame:
    """(k, start, end): the k-th file holds positions [start, end); its size is
    max(1, round(mean + sd * z_k)) with z_k standard normal from (seed, k)."""
    k = F.col("id")
    z = F.sqrt(-2.0 * F.log(_unit(seed, k, "a"))) * F.cos(2.0 * 3.141592653589793 * _unit(seed, k, "b"))
    size = F.greatest(F.lit(1), F.round(F.lit(float(mean)) + F.lit(float(sd)) * z).cast("long"))
    lim = spark.range(count).select(F.lit(0).alias("_g"), k.alias("k"), size.alias("size"))
    lim = running_max(lim, ["_g"], "k", "size", "end", chunk=F.floor(F.col("k") / 65536).cast("long"), agg="sum")
    return lim.select("k", (F.col("end") - F.col("size")).alias("start"), "end")


def roll_fuzzy(
    df: DataFrame,
    mean: float,
    sd: float,
    seed: int,
    by: Sequence[str] = ("topic", "partition"),
    order: str = "offset",
    chunk_size: int = DEFAULT_CHUNK,
) -> DataFrame:
    """roll each partition value's files at Gaussian-jittered record limits.

    The k-th file of every partition value holds ``max(1, round(mean + sd *
    z_k))`` records, z_k drawn from a hash of (seed, k): the same on re-run.
    Row positions come from the chunked running count; the file of a
    position is found with a bucketed range join against the file
    boundaries (each file is listed under the ``mean``-wide position buckets
    it overlaps), so no partition value is handled by a single task.
    """
    spark = df.sparkSession
    x = running_position(df, list(by), order, "_tw_pos", chunk=offset_chunk(order, chunk_size))
    top = x.agg(F.max("_tw_pos")).first()[0]  # one number: how many positions to cover
    width = max(1, int(round(mean)))
    x = x.withColumn("_tw_bucket", F.floor(F.col("_tw_pos") / width).cast("long"))
    if top is None:
        return x.withColumn("file_seq", F.lit(None).cast("long")).drop("_tw_pos", "_tw_bucket")
    count = max(1, int((top + 1) / max(1.0, mean - 3 * sd)) + 1)
    limits = fuzzy_limits(spark, count, mean, sd, seed)
    while limits.agg(F.max("end")).first()[0] <= top:  # rare: draws ran small, extend
        count *= 2
        limits = fuzzy_limits(spark, count, mean, sd, seed)
    buckets = limits.where(F.col("start") <= top).select(
        F.col("k").alias("file_seq"), "start", "end",
        F.explode(F.sequence(F.floor(F.col("start") / width).cast("long"), F.floor((F.col("end") - 1) / width).cast("long"))).alias("_tw_bucket"),
    )
    out = x.join(buckets, on="_tw_bucket", how="inner").where(
        (F.col("_tw_pos") >= F.col("start")) & (F.col("_tw_pos") < F.col("end"))
    )
    return out.drop("_tw_pos", "_tw_bucket", "start", "end")


def file_ranges(df: DataFrame, file_col: str | Column | None = None) -> DataFrame:
    """offset range and size per written file (default: the file each row was read from)."""
    f = F.input_file_name() if file_col is None else (F.col(file_col) if isinstance(file_col, str) else file_col)
    off = F.col("_kafka.offset") if "_kafka" in df.columns else F.col("offset")
    tp = [F.col("_kafka.topic").alias("topic"), F.col("_kafka.partition").alias("partition")] if "_kafka" in df.columns else [F.col("topic"), F.col("partition")]
    return (
        df.select(f.alias("file"), *tp, off.alias("offset"))
        .groupBy("file", "topic", "partition")
        .agg(F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"), F.count(F.lit(1)).alias("records"))
    )

"""Cutting ordered records into batches by limits that any open file may reach.

A group of records (a topic-partition, or all partitions of one ``root`` group)
is written to several files at once, one for each value of ``file_cols``.  When
any open file reaches any limit - records, bytes, or time since its first
record - the whole batch commits and all files begin anew.  The record that
reaches the limit is its batch's last.

The rule is sequential, but not the work:

* For every record, the earliest place at which a file begun by it would reach a
  limit follows from joins and chunked scans: the n-th record after it in its
  file, the first whose byte sum is large enough, the first late enough.
* A batch that starts at place i ends at the least of these over all records
  from i on: a running minimum from the end.  That gives the next start after i.
* Chunks of places (some scan chunks each: fewer places are exits of a longer
  one) follow their next starts by doubling, until they leave the chunk: a cut
  table, from each possible entry of the chunk to its exit.
* Only exits can be entries of later chunks.  The places reached from the first
  one are found among these by doubling, in log-many joins of a small table.
* Each chunk then marks the starts behind its one entry.

No step holds more than a chunk of one group.  Rows must be unique on the
group's columns and ``order``.  Null sizes count as 0, null clocks as the last
clock before them.  The clock of a record is the greatest one of its group up to
it.  An empty log gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from ..storage import materialize
from .scans import DEFAULT_CHUNK, offset_chunk, running_max, running_position

POS, RANK, SUM, CLOCK, END, NEXT, CUT_CHUNK = "_tw_pos", "_tw_rank", "_tw_sum", "_tw_clock", "_tw_end", "_tw_next", "_tw_cut"

# Scan chunks in a chunk of the cut tables, as long as it holds no more than so many places.
CUT_SCANS, CUT_PLACES = 64, 1 << 16


def cut_width(chunk_size: int) -> int:
    return max(chunk_size, min(CUT_SCANS * chunk_size, CUT_PLACES))


@dataclass(frozen=True)
class Limits:
    """What closes a file: records, bytes, or milliseconds since its first record; at least one."""

    records: int | None = None
    size: int | None = None
    open_ms: int | None = None

    def __post_init__(self):
        given = [x for x in (self.records, self.size, self.open_ms) if x is not None]
        if not given or min(given) < 1:
            raise ValueError("at least one limit is needed, and all must be >= 1")


def placed(df: DataFrame, group: list[str], file_cols: list[str], order: list[str], size: Column | None, clock: Column | None, chunk_size: int) -> DataFrame:
    """Places of the records in their group, ranks and byte sums in their files, and the running clock (a written table)."""
    cols = list(dict.fromkeys([*group, "topic", "partition", "offset", *order, *file_cols]))
    base = df.select(*cols, *([F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("_tw_size")] if size is not None else []), *([clock.cast("long").alias("_tw_ms")] if clock is not None else []))
    if order == ["offset"]:
        chunk = offset_chunk("offset", chunk_size)
    else:  # all later steps must see the same ranges
        base = materialize(base.repartitionByRange(*group, *order).withColumn("_tw_range", F.spark_partition_id().cast("long")), "ranges")
        chunk = F.col("_tw_range")
    x = running_position(base, group, order, POS, chunk=chunk).drop("_tw_range")
    by_place = F.floor(F.col(POS) / chunk_size).cast("long")
    own = list(dict.fromkeys([*group, *file_cols]))
    x = materialize(x, "places")
    x = running_position(x, own, POS, RANK, chunk=by_place) if set(own) > set(group) else x.withColumn(RANK, F.col(POS))
    if size is not None:
        x = running_max(x, own, POS, "_tw_size", SUM, chunk=by_place, agg="sum")
    if clock is not None:
        x = running_max(x, group, POS, "_tw_ms", CLOCK, chunk=by_place)
    return materialize(x, "places")


def _first_at_least(x: DataFrame, by: list[str], value: str, target: Column, width: int) -> DataFrame:
    """(by, POS, END): for every row, the first place of its ``by`` whose ``value`` reaches the row's target.

    Rows and targets are read together from the greatest value down, ``width`` values to a chunk."""
    seen = x.select(*by, (-F.col(value)).alias("_tw_down"), F.lit(0).alias("_tw_asks"), F.col(POS).alias("_tw_at"), F.lit(None).cast("long").alias(POS))
    asks = x.select(*by, (-target).alias("_tw_down"), F.lit(1).alias("_tw_asks"), F.lit(None).cast("long").alias("_tw_at"), F.col(POS))
    both = running_max(seen.unionByName(asks), by, ["_tw_down", "_tw_asks"], "_tw_at", END, chunk=F.floor(F.col("_tw_down") / width).cast("long"), agg="min")
    return both.where((F.col("_tw_asks") == 1) & F.col(END).isNotNull())


def next_starts(x: DataFrame, group: list[str], file_cols: list[str], limits: Limits, chunk_size: int) -> DataFrame:
    """(group, POS, NEXT): where the batch after one that starts at a place starts; null if none closes."""
    own = list(dict.fromkeys([*group, *file_cols]))
    ends = x.select(*group, POS, F.lit(None).cast("long").alias(END))
    if limits.records:
        last = x.select(*own, (F.col(RANK) - (limits.records - 1)).alias(RANK), F.col(POS).alias(END))
        ends = ends.unionByName(x.select(*own, RANK, POS).join(last, [*own, RANK]).select(*group, POS, END))
    if limits.size:
        target = F.col(SUM) - F.col("_tw_size") + limits.size
        ends = ends.unionByName(_first_at_least(x, own, SUM, target, max(limits.size, 256 * chunk_size)).select(*group, POS, END))
    if limits.open_ms:
        target = F.col(CLOCK) + limits.open_ms
        ends = ends.unionByName(_first_at_least(x.where(F.col(CLOCK).isNotNull()), group, CLOCK, target, max(limits.open_ms, 3_600_000)).select(*group, POS, END))
    least = ends.groupBy(*group, POS).agg(F.min(END).alias(END)).withColumn("_tw_down", -F.col(POS))
    scanned = running_max(least, group, "_tw_down", END, NEXT, chunk=F.floor(F.col("_tw_down") / chunk_size).cast("long"), agg="min")
    return scanned.select(*group, POS, (F.col(NEXT) + 1).alias(NEXT), F.floor(F.col(POS) / cut_width(chunk_size)).cast("long").alias(CUT_CHUNK))


def exits_of(start: np.ndarray, following: np.ndarray) -> np.ndarray:
    """For each place of a chunk (consecutive places ``start``), the first place beyond it that its starts lead to; -1: none."""
    out, first, end = following.copy(), int(start[0]), int(start[-1]) + 1
    inside = np.flatnonzero((out >= 0) & (out < end))
    while len(inside):
        out[inside] = out[out[inside] - first]
        inside = inside[(out[inside] >= 0) & (out[inside] < end)]
    return out


def reached_entries(exits: DataFrame, group: list[str], chunk_size: int) -> DataFrame:
    """(group, _tw_node): the places among exits, and place 0, that starts lead to from place 0."""
    first = exits.select(*group).distinct().withColumn("_tw_node", F.lit(0).cast("long"))
    nodes = exits.where(F.col(END) >= 0).select(*group, F.col(END).alias("_tw_node")).unionByName(first).distinct()
    jump = exits.withColumnRenamed(POS, "_tw_node").join(nodes, [*group, "_tw_node"], "left_semi").where(F.col(END) >= 0).select(*group, "_tw_node", F.col(END).alias("_tw_to"))
    jump, reached = materialize(jump, "jumps"), first
    while not jump.isEmpty():
        onward = reached.join(jump, [*group, "_tw_node"]).select(*group, F.col("_tw_to").alias("_tw_node"))
        reached = materialize(reached.unionByName(onward).distinct(), "entries")
        then = jump.select(*group, F.col("_tw_node").alias("_tw_to"), F.col("_tw_to").alias("_tw_then"))
        jump = materialize(jump.join(then, [*group, "_tw_to"]).select(*group, "_tw_node", F.col("_tw_then").alias("_tw_to")), "jumps")
    return reached.withColumn(CUT_CHUNK, F.floor(F.col("_tw_node") / cut_width(chunk_size)).cast("long"))


def roll_limits(
    df: DataFrame,
    limits: Limits,
    group: Sequence[str] = ("topic", "partition"),
    file_cols: Sequence[str] = (),
    order: Sequence[str] = ("offset",),
    size: Column | None = None,
    clock: Column | None = None,
    chunk_size: int = DEFAULT_CHUNK,
) -> DataFrame:
    """(group, topic, partition, offset, batch_id, closed): the batch of every record, and whether a limit closed it.

    ``size``: bytes of a record, for a byte limit; ``clock``: its time in milliseconds, for a time limit."""
    group, file_cols, order = list(group), list(file_cols), list(order)
    if limits.size and size is None or limits.open_ms and clock is None:
        raise ValueError("a byte limit needs size, a time limit needs clock")
    ship_package(df.sparkSession)
    x = placed(df, group, file_cols, order, size if limits.size else None, clock if limits.open_ms else None, chunk_size)
    following = materialize(next_starts(x, group, file_cols, limits, chunk_size), "next-starts")
    keys = [following.schema[c] for c in [*group, CUT_CHUNK, POS]]

    def exits(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(POS)
        out = pdf[[*group, CUT_CHUNK, POS]].copy()
        out[END] = exits_of(pdf[POS].to_numpy(), pdf[NEXT].fillna(-1).to_numpy().astype(np.int64))
        return out

    table = materialize(following.groupBy(*group, CUT_CHUNK).applyInPandas(exits, T.StructType([*keys, T.StructField(END, T.LongType())])), "cut-tables")
    entries = reached_entries(table, group, chunk_size)

    def mark(pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(POS)
        starts = np.zeros(len(pdf), dtype=np.int64)
        closed = 0
        nodes, first = pdf[NEXT].fillna(-1).to_numpy().astype(np.int64), int(pdf[POS].iloc[0])
        # the place after a group's last record may lie in its last chunk too
        at = int(entry["_tw_node"].min()) if len(entry) else -1
        while 0 <= at < first + len(pdf):
            starts[at - first] = 1
            at = nodes[at - first]
            closed += at >= 0
        out = pdf[[*group, CUT_CHUNK, POS]].copy()
        out["_tw_local"], out["_tw_closed"] = np.cumsum(starts), closed
        return out

    schema = T.StructType([*keys, T.StructField("_tw_local", T.LongType()), T.StructField("_tw_closed", T.LongType())])
    marked = materialize(following.groupBy(*group, CUT_CHUNK).cogroup(entries.groupBy(*group, CUT_CHUNK)).applyInPandas(mark, schema), "marked")
    per_chunk = marked.groupBy(*group, CUT_CHUNK).agg(F.max("_tw_local").alias("n"), F.max("_tw_closed").alias("c"))
    before = Window.partitionBy(*group).orderBy(CUT_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(*group, CUT_CHUNK, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_tw_before"), F.sum("c").over(Window.partitionBy(*group)).alias("_tw_total"))
    batch = (F.col("_tw_before") + F.col("_tw_local") - 1).cast("long")
    numbered = marked.join(carry, [*group, CUT_CHUNK]).select(*group, POS, batch.alias("batch_id"), (batch < F.col("_tw_total")).alias("closed"))
    ids = [c for c in ("topic", "partition", "offset") if c not in group]
    return x.select(*group, *ids, POS).join(numbered, [*group, POS]).drop(POS)

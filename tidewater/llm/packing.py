"""Best-fit packing by linear grouping (operator 3).

Documents become pieces of at most ``capacity`` tokens.  Piece lengths are
integers up to the capacity, so their counts are a table of bounded size.
The plan is made on that table alone: large lengths are put into groups of
equal cardinality and rounded up within their group, the few rounded sizes are
combined into configurations, the actual lengths take the places of the
rounded ones, and small pieces then go best-fit into the room that is left.  A
plan row says which ranks of a length go where, so that pieces find their
place by a join on length and rank; no piece passes through the driver.

A null text is an empty one (one piece holding the end token).  Repeated
documents are packed like others, ties in length are broken by rank, and an
empty table gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sink import materialize
from ..session import small_batches
from . import bpe
from . import textvec as tv

CAPACITY = 1024
CHUNK_CHARS = 1 << 18  # characters that are encoded at once, unless one text is longer
GROUPS = 800
SMALL_SHARE = 4  # pieces up to capacity / SMALL_SHARE are small

PLAN_SCHEMA = "length int, first long, last long, each long, seq_base long, seq_offset long"


def cut_pieces(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 2, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (if asked for), and the task (__part) and the
    number within task and length (__nth) of every piece.  Write the result once before using these."""
    schema = f"doc_id {df.schema[doc_id].dataType.simpleString()}, piece int, start long, length int, ids_crc32 long, __part int, __nth long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seen = bpe.coder(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for rows, texts in tv.text_slices(batch, 1, CHUNK_CHARS):
                ids, bounds = coder.encode(texts)
                ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
                total = np.diff(bounds) + 1
                n_pieces = -(-total // capacity)
                doc = np.repeat(np.arange(len(texts)), n_pieces)
                piece = tv.spans(np.zeros(len(texts), dtype=np.int64), n_pieces)
                head = total - (n_pieces - 1) * capacity
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                begin = (bounds[:-1] + np.arange(len(texts)))[doc] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * x : 4 * (x + n)]) for x, n in zip(begin.tolist(), length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                sizes, at, counts = np.unique(length[order], return_index=True, return_counts=True)
                nth = np.empty(len(length), dtype=np.int64)
                nth[order] = np.arange(len(length)) - np.repeat(at, counts) + np.repeat(seen[sizes], counts)
                seen[sizes] += counts
                columns = [rows.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length.astype(np.int32)), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), part, dtype=np.int32)), pa.array(nth)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "__part", "__nth"]
                if with_ids:
                    columns.append(tv.binary_slices(ids, np.concatenate([begin, [len(ids)]])))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(tv.giving_back(run), schema)


def group_lengths(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Runs (length, count), longest first, cut into groups of equal cardinality."""
    total = sum(counts.values())
    if not total:
        return []
    each = -(-total // groups)
    out: list[list[tuple[int, int]]] = [[]]
    room = each
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append([])
                room = each
            k = min(left, room)
            out[-1].append((length, k))
            left, room = left - k, room - k
    return out


def best_fill(sizes: list[int], left: list[int], room: int) -> list[tuple[int, int]]:
    """(group, uses) that fill ``room`` as far as the groups' counts allow; few, large pieces first."""
    reach = np.full(room + 1, -1, dtype=np.int64)  # last group used to reach a sum
    uses = np.zeros(room + 1, dtype=np.int64)
    reach[0] = len(sizes)
    trail: list[tuple[int, np.ndarray, np.ndarray]] = []
    for g, size in enumerate(sizes):
        if left[g] and size <= room:
            base = reach >= 0
            added = np.zeros(room + 1, dtype=np.int64)
            for k in range(1, min(left[g], room // size) + 1):
                new = np.zeros(room + 1, dtype=bool)
                new[k * size :] = base[: room + 1 - k * size]
                new &= (reach < 0) & (added == 0)
                added[new] = k
            fresh = added > 0
            reach[fresh], uses[fresh] = g, added[fresh]
            if reach[room] >= 0:
                break
    at = int(np.flatnonzero(reach >= 0)[-1])
    found = []
    while at:
        g, k = int(reach[at]), int(uses[at])
        found.append((g, k))
        at -= k * sizes[g]
    return found


def configurations(sizes: list[int], counts: list[int], capacity: int) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """Configurations [(group, uses)] and how often each is used: the largest size that is left, filled best."""
    left = list(counts)
    for g, size in enumerate(sizes):
        while left[g]:
            left[g] -= 1
            fill = dict(best_fill(sizes, left, capacity - size))
            left[g] += 1
            fill[g] = fill.get(g, 0) + 1
            times = min(left[k] // n for k, n in fill.items())
            for k, n in fill.items():
                left[k] -= n * times
            yield sorted(fill.items()), times


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[list[tuple], int]:
    """Plan rows (length, first, last, each, seq_base, seq_offset) and the number of sequences.

    Ranks first <= r < last of a length go to sequence seq_base + (r - first) // each, at
    offset seq_offset + length * ((r - first) % each).
    """
    small = capacity // SMALL_SHARE
    rank = dict.fromkeys(counts, 0)
    # a class: [number of alike sequences, room left, [(length, each, first rank, offset)]]
    classes: list[list] = []

    def take(length: int, n: int) -> int:
        rank[length] += n
        return rank[length] - n

    if counts.get(capacity):
        classes.append([counts[capacity], 0, [(capacity, 1, take(capacity, counts[capacity]), 0)]])
    grouped = group_lengths({k: n for k, n in counts.items() if small < k < capacity and n}, groups)
    queues = [[list(run) for run in g] for g in grouped]
    for config, times in configurations([g[0][0] for g in grouped], [sum(n for _, n in g) for g in grouped], capacity):
        # actual lengths take the places of the rounded ones, a run at a time
        slots = []
        for g, n in config:
            for _ in range(n):
                need, runs = times, []
                while need:
                    run = queues[g][0]
                    k = min(need, run[1])
                    runs.append([run[0], k])
                    need, run[1] = need - k, run[1] - k
                    if not run[1]:
                        queues[g].pop(0)
                slots.append(runs)
        while slots[0]:
            k = min(runs[0][1] for runs in slots)
            offset, items = 0, []
            for runs in slots:
                length = runs[0][0]
                items.append((length, 1, take(length, k), offset))
                offset += length
                runs[0][1] -= k
                if not runs[0][1]:
                    runs.pop(0)
            classes.append([k, capacity - offset, items])
    by_room: list[list] = [[] for _ in range(capacity + 1)]
    for c in classes:
        by_room[c[1]].append(c)

    def split(c: list, k: int) -> list:
        """The first k sequences of a class as a class of their own."""
        head = [k, c[1], list(c[2])]
        c[2] = [(n, each, first + k * each, offset) for n, each, first, offset in c[2]]
        c[0] -= k
        classes.append(head)
        return head

    for length in sorted((k for k, n in counts.items() if 0 < k <= min(small, capacity - 1) and n), reverse=True):
        left, room = counts[length], length
        while left:
            while room <= capacity and not by_room[room]:
                room += 1
            if room > capacity:
                c = [-(-left // (capacity // length)), capacity, []]
                classes.append(c)
                by_room[capacity].append(c)
                room = capacity
            c = by_room[room][-1]
            each = room // length
            if left >= c[0] * each:
                by_room[room].pop()
            elif left >= each:
                c = split(c, left // each)
            else:
                each = left
                if c[0] > 1:
                    c = split(c, 1)
                else:
                    by_room[room].pop()
            c[2].append((length, each, take(length, c[0] * each), capacity - room))
            c[1] = room - each * length
            by_room[c[1]].append(c)
            left -= c[0] * each
    rows, base = [], 0
    for n, _, items in classes:
        rows += [(length, first, first + n * each, each, base, offset) for length, each, first, offset in items]
        base += n
    return rows, base


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Written pieces with their sequence_id and offset."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    # at most ``capacity`` rows
    table = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    rows, _ = plan_packing(table, capacity)
    # its size depends on the capacity, not on the number of pieces
    plan = F.broadcast(spark.createDataFrame(rows, PLAN_SCHEMA))
    ranked = pieces.join(starts, ["length", "__part"]).withColumn("__rank", F.col("__start") + F.col("__nth"))
    placed = ranked.join(plan, (ranked["length"] == plan["length"]) & (F.col("__rank") >= F.col("first")) & (F.col("__rank") < F.col("last")))
    at = F.col("__rank") - F.col("first")
    return placed.select(
        *(ranked[c] for c in pieces.columns if not c.startswith("__")),
        (F.col("seq_base") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("seq_offset") + ranked["length"] * (at % F.col("each"))).cast("long").alias("offset"),
    )


def pack(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 2, with_ids: bool = True) -> DataFrame:
    """Pack documents into sequences of at most ``capacity`` tokens; one row per piece."""
    with small_batches(df.sparkSession):
        pieces = materialize(cut_pieces(df, path, doc_id, text, capacity, end_id, with_ids), "pieces")
    return assign(pieces, capacity)

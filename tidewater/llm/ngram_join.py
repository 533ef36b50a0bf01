"""N-gram Jaccard join by parity sketches (operator 4).

A document's set holds the hashes of its distinct word n-grams.  Its sketch
deals them into blocks by hash, each block keeping the XOR of its hashes: every
element of the symmetric difference of two sets changes at most one block, so
the number of differing blocks bounds that difference from below.  Two sets
within the threshold differ in at most D blocks, D following from their sizes;
so of any D + 1 blocks taken in one common order from each, at least one pair
agrees.  Blocks are made per size band; a set near the upper end of its band
joins the next band too.  Each set gives its D + 1 blocks in the order of how
rare their rarest element is (by a counting sketch over all documents, which
grows with them up to a bound), so that passages that several documents share
seldom become join keys.  The counting sketch only orders blocks: whatever it
holds, no pair is lost.

Sets that share a block key are sorted by size.  Each meets the key's first set
and its next ``window`` ones.  Keys with more sets than that are looked at again
once links are known: where they hold several components, the sets outside the
largest one are compared with that component's sets by bit sketches, in bounded
chunks, and tried with the nearest.  What still lies in different components
after that is tried pair by pair, as far as the sketches allow a link.
Candidate pairs pass the bit sketches' Hamming bound and are then verified
exactly.

Equal sets are one node from the start.  Components come from star contraction
on written tables.  Rows without words (null, empty) have no shingles and link
with nothing, nor do rows with a null id, whose component is null.  Repeated
rows share their set's component.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.sink import materialize
from . import textvec as tv

WORDS = 5
COUNTER_BITS = 20  # 2 ** COUNTER_BITS counters at least
MAX_COUNTER_BITS = 26  # two bits each reach the tasks: at most 16 MB
PART_BITS = 16  # counters of a part are added up together
BAND_BITS = 3  # sizes of a band lie within a factor of 2 ** BAND_BITS
WINDOW = 4
CHUNK_SETS = 1 << 14  # sets of a component that are compared in one task
CHUNK_CHARS = 1 << 18  # characters whose words are hashed at once, unless one text is longer
BROADCAST_ROWS = 1 << 20  # ids that a text scan may be filtered by without a shuffle


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least num / den."""

    num: int = 75
    den: int = 100

    def largest(self, n):
        """Largest size of a set that may link with one of n elements."""
        return n * self.den // self.num

    def difference(self, a, b):
        """Largest symmetric difference of linked sets of a and b elements."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased, split at ASCII white space) and the n + 1 text boundaries in them."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]).lower(), dtype=np.uint8)
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in raw], out=bounds[1:])
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    lengths = np.diff(starts, append=len(data))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    values = np.where(blank, 0, data.astype(np.uint64) + np.uint64(1))[starts[0] :]
    h = np.add.reduceat(values * tv.position_weights(int(lengths.max()))[place], starts - starts[0])
    return tv.mix64(h), np.searchsorted(starts, bounds)


def shingle_hashes(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams, with repeats, and the n + 1 text boundaries; a shorter text is one n-gram."""
    h, bounds = word_hashes(texts)
    counts = np.diff(bounds)
    w = tv.position_weights(4096)[2048 : 2048 + words]
    padded = np.concatenate([h, np.zeros(words, dtype=np.uint64)])
    n = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    at = tv.spans(bounds[:-1], n)
    left = np.repeat(counts, n) - (at - np.repeat(bounds[:-1], n))
    total = np.zeros(len(at), dtype=np.uint64)
    for j in range(words):
        total += np.where(left > j, padded[at + j], 0).astype(np.uint64) * w[j]
    return tv.mix64(total), np.concatenate([[0], np.cumsum(n)])


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.uint64).view(np.int64)


class Rarity:
    """Rarity classes (0 to 3) of a power of two of counters, four in a byte."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed

    def __len__(self) -> int:
        return 4 * len(self.packed)

    def __getitem__(self, slots: np.ndarray) -> np.ndarray:
        return self.packed[slots >> 2] >> (2 * (slots & 3)).astype(np.uint8) & np.uint8(3)


def packed_gaps(slots: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Sorted counter numbers, cut into parts of 2 ** PART_BITS: the parts, and each one's gaps in
    bytes (a gap of 255 k + r is k bytes of 255 and r)."""
    part, low = slots >> PART_BITS, (slots & ((1 << PART_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    gaps = np.diff(low, prepend=0)
    gaps[first] = low[first]
    ends = np.cumsum(gaps // 255 + 1)
    out = np.full(int(ends[-1]), 255, dtype=np.uint8)
    out[ends - 1] = gaps % 255
    cuts = [0, *ends[np.append(first[1:], len(slots)) - 1].tolist()]
    return part[first], [out[x:y].tobytes() for x, y in zip(cuts, cuts[1:], strict=False)]


def unpacked_gaps(raw: bytes) -> np.ndarray:
    """The counter numbers within their part that ``packed_gaps`` packed."""
    gaps = np.frombuffer(raw, dtype=np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps < 255]


def rarity(df: DataFrame, text: str, words: int) -> Rarity:
    """Rarity class of every counter: 0 for the load that chance makes common, up to 3 for much more.

    There are about as many counters as n-grams, so that what few documents share stands out
    however large the table is, but at most 2 ** MAX_COUNTER_BITS."""
    chars = df.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    bits = min(max((chars // 8).bit_length(), COUNTER_BITS), MAX_COUNTER_BITS)
    size = 1 << PART_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tv.release()
        kept, count = [], 0

        def out() -> pa.RecordBatch:
            part, gaps = packed_gaps(np.sort(np.concatenate(kept)))
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(gaps, pa.binary())], names=["part", "gaps"])

        for batch in batches:
            for _, texts in tv.text_slices(batch, 0, CHUNK_CHARS):
                h, _ = shingle_hashes(texts, words)
                kept.append((h >> np.uint64(64 - bits)).astype(np.int32))
                count += len(h)
                if count >= 1 << 22:
                    yield out()
                    count = 0
        if count:
            yield out()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, np.zeros(size, dtype=np.int64)

        def out() -> pa.RecordBatch:
            mean = total.mean()
            usual = max(2.0, mean + 3 * mean**0.5)
            kinds = np.searchsorted([max(1.0, mean + mean**0.5), usual, 4 * usual], total).astype(np.uint8).reshape(-1, 4)
            packed = (kinds << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([packed.tobytes()], pa.binary())], names=["part", "classes"])

        for batch in batches:
            for part, gaps in zip(batch.column("part").to_pylist(), batch.column("gaps").to_pylist(), strict=True):
                if part != current:
                    if current is not None:
                        yield out()
                    current = part
                    total[:] = 0
                total += np.bincount(unpacked_gaps(gaps), minlength=size)
        if current is not None:
            yield out()

    rows = df.select(F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(run, "part int, gaps binary")
    added = rows.repartition(F.col("part")).sortWithinPartitions("part").mapInArrow(add, "part int, classes binary")
    packed = np.zeros((1 << (bits - PART_BITS), size // 4), dtype=np.uint8)
    for r in added.collect():  # two bits a counter: at most 16 MB
        packed[r["part"]] = np.frombuffer(r["classes"], dtype=np.uint8)
    return Rarity(packed.reshape(-1))


def block_keys(held: np.ndarray, classes: np.ndarray | Rarity, limit: Threshold) -> np.ndarray:
    """Join keys of a set: its first D + 1 blocks in each size band that it takes part in."""
    n = len(held)
    band = (n.bit_length() - 1) // BAND_BITS
    rank = classes[(held >> np.uint64(65 - len(classes).bit_length())).astype(np.int64)]
    out = []
    for level in (band, band + 1):
        top = (1 << BAND_BITS * (band + 1)) - 1
        largest = limit.largest(n)
        if level == band:
            largest = min(largest, top)
        elif largest <= top:
            break
        need = limit.difference(n, largest) + 1
        blocks = max(64, 1 << BAND_BITS * (level + 1))
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        block = (tv.mix64(held ^ salt) >> np.uint64(32)) & np.uint64(blocks - 1)
        order = np.argsort(block, kind="stable")
        sorted_block = block[order]
        starts = np.flatnonzero(np.append(True, sorted_block[1:] != sorted_block[:-1]))
        value = np.bitwise_xor.reduceat(held[order], starts)
        names = sorted_block[starts]
        keys = tv.mix64(value ^ tv.mix64(names + salt))
        rarest = np.minimum.reduceat(rank[order], starts)
        if len(keys) < need:  # blocks without an element agree too, and come last
            empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), names)
            keys = np.concatenate([keys, tv.mix64(~tv.mix64(empty + salt))])
            rarest = np.concatenate([rarest, np.full(len(empty), 63, dtype=np.uint8)])
        first = np.lexsort((keys, rarest))[:need]
        out.append(keys[first])
    return np.concatenate(out)


def bit_sketch(held: np.ndarray) -> bytes:
    """Parity bits of a set: four to eight bits an element, at least 64."""
    m = max(64, 1 << (4 * len(held) - 1).bit_length())
    return np.packbits(np.bincount((held & np.uint64(m - 1)).astype(np.int64), minlength=m).astype(np.uint8) & 1).tobytes()


def sketch_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Hamming distance of two bit sketches, the longer one folded to the shorter one's length."""
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def sketch_sets(df: DataFrame, doc_id: str, text: str, words: int, limit: Threshold) -> DataFrame:
    """id, text_hash, n (set size), node (the set's hash), keys and sketch; keys and sketch are null for
    repeats of a set in a task, and for rows that link with nothing."""
    classes = rarity(df, text, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tv.release()
        seen: set[int] = set()
        for batch in batches:
            for part, texts in tv.text_slices(batch, 2, CHUNK_CHARS):
                valid = part.column(0).is_valid().to_pylist()
                h, bounds = shingle_hashes(texts, words)
                sizes, nodes, keys, sketches = [], [], [], []
                for i in range(len(texts)):
                    held = np.unique(h[bounds[i] : bounds[i + 1]])
                    node = node_of(held)
                    new = bool(len(held)) and valid[i] and node not in seen
                    if new:
                        seen.add(node)
                    sizes.append(len(held))
                    nodes.append(node)
                    keys.append(signed(block_keys(held, classes, limit)) if new else None)
                    sketches.append(bit_sketch(held) if new else None)
                columns = [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "text_hash", "n", "node", "keys", "sketch"])

    rows = df.select(F.col(doc_id).alias("__id"), F.xxhash64(text).alias("__hash"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return rows.mapInArrow(run, f"id {df.schema[doc_id].dataType.simpleString()}, text_hash long, n long, node long, keys array<long>, sketch binary")


def key_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, n, node) columns of sorted rows, each key whole within one yield, repeats gone."""
    rest = None
    for batch in batches:
        key, n, node = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "n", "node"))
        if rest is not None:
            key, n, node = (np.concatenate(x) for x in zip(rest, (key, n, node), strict=True))
        again = np.append(False, (key[1:] == key[:-1]) & (node[1:] == node[:-1]))
        key, n, node = key[~again], n[~again], node[~again]
        cut = np.searchsorted(key, key[-1]) if len(key) else 0
        if cut:
            yield key[:cut], n[:cut], node[:cut]
        rest = key[cut:], n[cut:], node[cut:]
    if rest is not None and len(rest[0]):
        yield rest


def candidates(keyed: DataFrame, limit: Threshold, window: int) -> DataFrame:
    """Rows (a, b, key, n): pairs a < b with a null key; sets (a) of keys that have more than
    ``window`` + 1 of them with a null b."""

    def both(found: list[np.ndarray]) -> pa.RecordBatch:
        a, b = np.concatenate(found, axis=1)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
        a, b = a[new], b[new]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int64())], names=["a", "b", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0  # pairs share many keys: a bounded number is kept back to drop repeats
        for key, n, node in key_runs(batches):
            start = np.append(True, key[1:] != key[:-1])
            first = np.flatnonzero(start)
            size = np.diff(first, append=len(key))
            if size.max() == 1:
                continue
            head = np.repeat(first, size)
            end = head + np.repeat(size, size)
            at = np.arange(len(key))
            for d in range(0, min(window, int(size.max()) - 1) + 1):
                other = at + d if d else head  # d = 0: the key's first set
                ok = ((other < end) if d else (at - head > window)) & (np.repeat(size, size) > 1)
                x, y = at[ok], other[ok]
                ok = np.maximum(n[x], n[y]) <= limit.largest(np.minimum(n[x], n[y]))
                held.append(np.stack([np.minimum(node[x[ok]], node[y[ok]]), np.maximum(node[x[ok]], node[y[ok]])]))
                count += int(ok.sum())
            if count >= 1 << 20:
                yield both(held)
                held, count = [], 0
            many = np.repeat(size > window + 1, size)
            if many.any():
                k = int(many.sum())
                yield pa.RecordBatch.from_arrays([pa.array(node[many]), pa.nulls(k, pa.int64()), pa.array(key[many]), pa.array(n[many])], names=["a", "b", "key", "n"])
        if count:
            yield both(held)

    ordered = keyed.repartition(F.col("key")).sortWithinPartitions("key", "n", "node")
    return ordered.mapInArrow(run, "a long, b long, key long, n long")


def near_by_sketch(pairs: DataFrame, sketches: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs (a, b) whose sizes and bit sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, sa, sb = (c.to_pylist() for c in batch.columns)
            ok = [sketch_distance(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) <= limit.difference(m, n) for m, n, x, y in zip(na, nb, sa, sb, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "sa", "sb")
    return both.mapInArrow(run, "a long, b long")


def filtered_by_ids(df: DataFrame, column: str, ids: DataFrame, how: str, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Semi or anti join of a wide table with a written table of ids (one column of the same
    name): broadcast if they are counted to be at most ``bound``, shuffled otherwise."""
    return df.join(F.broadcast(ids) if ids.count() <= bound else ids, column, how)


def exact_sets(nodes: DataFrame, sets: DataFrame, df: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(node, held): the sorted hashes of the sets of ``nodes``, made again from the texts, once a node."""
    owners = sets.where("keys is not null").groupBy("node").agg(F.min("id").alias("id")).join(nodes, "node", "left_semi")
    owner_ids = materialize(owners.select(F.col("id").alias("__id")).distinct(), "owner-ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tv.release()
        for batch in batches:
            for _, texts in tv.text_slices(batch, 1, CHUNK_CHARS):
                h, bounds = shingle_hashes(texts, words)
                held = [np.unique(h[bounds[i] : bounds[i + 1]]) for i in range(len(texts))]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(x) for x in held], pa.int64()), pa.array([x.tobytes() for x in held], pa.binary())], names=["node", "held"])

    rows = df.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    # rows that repeat an id give a node twice or nodes of no pair: the first repeats links, the joins drop the others
    return filtered_by_ids(rows, "__id", owner_ids, "left_semi").mapInArrow(run, "node long, held binary")


def verified(pairs: DataFrame, exact: DataFrame, limit: Threshold) -> DataFrame:
    """The pairs (a, b) that are links, by their exact sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(limit.den * shared >= limit.num * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(exact.select(F.col("node").alias("a"), F.col("held").alias("ha")), "a").join(exact.select(F.col("node").alias("b"), F.col("held").alias("hb")), "b")
    return both.select("a", "b", "ha", "hb").mapInArrow(compare, "a long, b long")


def node_of(held: np.ndarray) -> int:
    """A set's own hash."""
    return int(signed(tv.mix64(tv.mix64(held ^ np.uint64(0xD6E8FEB86659FD93)).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(held))))[0])


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for nodes with edges (a, b).

    Star contraction: every node is tied to the smallest of its neighbours, in turn
    among larger and smaller ones, until only stars are left; each round is written.
    """

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        return r[0], r[1]

    # edges from the larger node u to the smaller v
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = mark(e)
    while state[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        tied = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v")))
        e = materialize(tied.distinct(), "edges")
        now = mark(e)
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def grouped_pairs(rows: DataFrame, keys: list[str], limit: Threshold, nearest: bool) -> DataFrame:
    """Pairs (a, b) within groups of rows (keys, own, n, node, root, sketch) that may link by their
    sketches: every row that is not ``own`` against those of other roots (the ``own`` ones, if the
    group has any), or only the nearest."""

    def compare(group: list[tuple]) -> Iterator[tuple[int, int]]:
        own, n, node, root = (np.array([g[k] for g in group], dtype=np.int64) for k in (0, 1, 2, 3))
        size = np.array([len(g[4]) for g in group])
        asked = own == own.max()
        rows_of = {int(w): np.flatnonzero((size == w) & asked) for w in np.unique(size[asked])}
        matrix = {w: np.stack([np.frombuffer(group[i][4], np.uint8) for i in at]) for w, at in rows_of.items()}
        for i in np.flatnonzero(own == 0).tolist():
            mine, best = np.frombuffer(group[i][4], np.uint8), (1 << 40, -1)
            for width in (len(mine) // 2, len(mine), 2 * len(mine)):
                for c in range(0, len(rows_of.get(width, ())), 4096):
                    block, others = rows_of[width][c : c + 4096], matrix[width][c : c + 4096]
                    ok = (root[block] != root[i]) & (n[block] <= limit.largest(n[i])) & (n[i] <= limit.largest(n[block]))
                    block, others = block[ok], others[ok]
                    if width > len(mine):
                        others = others[:, : len(mine)] ^ others[:, len(mine) :]
                    folded = mine if width >= len(mine) else mine[:width] ^ mine[width:]
                    far = np.bitwise_count(others ^ folded).sum(axis=1)
                    ok = far <= limit.difference(n[i], n[block])
                    if not ok.any():
                        continue
                    block, far = block[ok], far[ok]
                    if nearest:
                        best = min(best, (int(far.min()), int(node[block[far.argmin()]])))
                    else:
                        yield from ((int(node[i]), int(x)) for x in node[block].tolist())
            if nearest and best[0] < 1 << 40:
                yield int(node[i]), best[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[tuple] = []
        current = None
        told: set[tuple[int, int]] = set()  # a bounded number of pairs, to drop repeats

        def out() -> pa.RecordBatch:
            a, b = np.array(sorted(told), dtype=np.int64).reshape(-1, 2).T
            told.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        def take() -> Iterator[pa.RecordBatch]:
            for x, y in compare(rest) if rest else ():
                told.add((min(x, y), max(x, y)))
                if len(told) >= 1 << 17:
                    yield out()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[: len(keys)] != current:
                    yield from take()
                    current, rest = row[: len(keys)], []
                rest.append(row[len(keys) :])
        yield from take()
        if told:
            yield out()

    ordered = rows.select(*keys, "own", "n", "node", "root", "sketch").repartition(*keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(run, "a long, b long")


def unresolved(crowded: DataFrame, roots: DataFrame, sketches: DataFrame, limit: Threshold, nearest: bool) -> DataFrame:
    """Pairs (a, b) of different components that share a crowded key and may link by their sketches.

    In each key, the sets outside its largest component are strangers.  Each stranger meets the
    sets of that component once, however many keys say so, the component dealt in chunks of
    bounded size and the strangers too; with ``nearest`` only the nearest of them.  Strangers of
    one key and of different components meet within the key (not with ``nearest``), dealt in
    chunks of which every two meet in a group of their own."""
    share = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    chunks_of = F.ceil(F.count(F.lit(1)) / CHUNK_SETS).cast("int")
    rows = crowded.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("key").agg(F.max(F.struct("c", "root")).alias("m"), F.count(F.lit(1)).alias("roots")).where("roots > 1").select("key", F.col("m.root").alias("main"), "roots")
    strangers = materialize(rows.join(main, "key").where("root <> main"), "strangers")
    asked = strangers.select("main", "node", "root").distinct()
    mains = asked.select("main").distinct()
    members = roots.withColumnRenamed("root", "main").join(mains, "main", "left_semi").select("main", "node").union(mains.select("main", F.col("main").alias("node"))).distinct()
    chunks = members.groupBy("main").agg(chunks_of.alias("chunks"))
    parts = asked.groupBy("main").agg(chunks_of.alias("parts"))
    own = members.join(chunks, "main").join(parts, "main").select("main", share(F.col("chunks")).alias("chunk"), every(F.col("parts")).alias("part"), F.lit(1).alias("own"), "node", F.col("main").alias("root"))
    guests = asked.join(chunks, "main").join(parts, "main").select("main", every(F.col("chunks")).alias("chunk"), share(F.col("parts")).alias("part"), F.lit(0).alias("own"), "node", "root")
    # strangers need not meet one another here: they are marked by one root
    guests = guests.withColumn("root", F.lit(0).cast("long")).union(own.withColumn("root", F.lit(1).cast("long")))
    pairs = grouped_pairs(guests.join(sketches, "node"), ["main", "chunk", "part"], limit, nearest)
    if not nearest:
        keys = strangers.groupBy("key").agg(F.countDistinct("root").alias("k"), chunks_of.alias("chunks")).where("k > 1").select("key", "chunks")
        dealt = strangers.join(keys, "key").withColumn("chunk", share(F.col("chunks"))).withColumn("other", every(F.col("chunks")))
        dealt = dealt.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other"), "own": (F.col("chunk") > F.col("other")).cast("int")})
        pairs = pairs.union(grouped_pairs(dealt.select("key", "i", "j", "own", "node", "root").join(sketches, "node"), ["key", "i", "j"], limit, False))
    return pairs.distinct()


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, limit: Threshold | None = None, window: int = WINDOW) -> DataFrame:
    """id, text_hash (xxhash64 of the text), n_shingles and component_id (the smallest id that links reach) of every row."""
    limit = limit or Threshold()
    sets = materialize(sketch_sets(df, doc_id, text, words, limit), "sketches")
    keyed = sets.where("keys is not null").select(F.explode("keys").alias("key"), "n", "node")
    met = materialize(candidates(keyed, limit, window), "candidates")
    sketches = sets.where("sketch is not null").select("node", "n", "sketch").dropDuplicates(["node"])
    near = materialize(near_by_sketch(met.where("b is not null").select("a", "b").distinct(), sketches, limit), "near")
    crowded = met.where("key is not null").select("key", F.col("a").alias("node"), "n")

    def links_of(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        return verified(pairs, materialize(exact_sets(nodes, sets, df, doc_id, text, words), "sets"), limit)

    roots = materialize(components(links_of(near)), "roots")
    tried = near
    for nearest in (True, False):
        more = materialize(unresolved(crowded, roots, sketches, limit, nearest).join(tried, ["a", "b"], "left_anti"), "unresolved")
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links_of(more))
        roots = materialize(components(links), "roots")
        tried = tried.union(more)
    ids = sets.where("id is not null and n > 0").groupBy("node").agg(F.min("id").alias("low"))
    lowest = ids.join(roots, "node").groupBy("root").agg(F.min("low").alias("lowest"))
    named = ids.join(roots.join(lowest, "root"), "node", "left").select("node", F.coalesce("lowest", "low").alias("lowest"))
    rows = sets.select("id", "text_hash", F.col("n").alias("n_shingles"), "node").join(named, "node", "left")
    return rows.select("id", "text_hash", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("lowest")).otherwise(F.col("id")).alias("component_id"))

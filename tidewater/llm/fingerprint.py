"""Document fingerprints by a randomised edit embedding (operator 5).

A walk reads a text: at step t it stays on a character or moves to the next
one, as a random function of t and the character says.  All texts share these
functions, so two walks meet again after an edit, and a few edits change few
steps: edit distance becomes Hamming distance between what the walks read.  A
fingerprint samples that: each of ``BINS`` bins owns a random share of the
steps and keeps eight bits of what was read at the step of best priority that
the walk reached.  Likeness is the share of bins that agree.  For joins, bits
of some bins form band keys; rows that share one are verified by the likeness of
whole fingerprints, first with their neighbours in a key, then, in keys that still
hold several components of links, with every row of another component.

Null texts are empty; an empty text has an empty fingerprint, two of which are
alike (1.0) and unlike any other (0.0).  Equal texts have equal fingerprints.
Rows with equal ids are ordered by their texts; null ids come first.  A table
of one row is its own neighbour.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sink import materialize
from . import textvec as tv
from .ngram_join import components

BINS = 128
PERIOD = 4096  # the walk's random functions repeat after so many steps
GRAM = 3  # characters read at a step
SCALAR = 48  # with fewer walks left, each goes on alone
CHUNK_CHARS = 1 << 22
BLOCK_ROWS = 512

_MOVES = np.random.default_rng(71).integers(0, 2, size=(PERIOD, 256), dtype=np.int8)
_records: list[tuple[int, int]] = []
_reached = 0
_best = [1 << 64] * BINS


def records(upto: int) -> list[tuple[int, int]]:
    """(step, bin) of every step below ``upto`` at which a bin takes a new value, in order."""
    global _reached
    while _reached < upto:
        n = max(1 << 16, _reached)
        h = tv.mix64(np.arange(_reached, _reached + n, dtype=np.uint64) + np.uint64(0x51ED270B))
        bins = (h % np.uint64(BINS)).astype(np.int64)
        order = tv.mix64(h)
        worst = max(_best)
        for k in np.flatnonzero(order < np.uint64(min(worst, (1 << 64) - 1))).tolist() if worst < 1 << 64 else range(n):
            if int(order[k]) < _best[bins[k]]:
                _best[bins[k]] = int(order[k])
                _records.append((_reached + k, int(bins[k])))
        _reached += n
    return _records


def fingerprints(texts: list[str]) -> np.ndarray:
    """Texts x BINS: the value of each bin, 256 where no step of the walk falls into it."""
    out = np.full((len(texts), BINS), 256, dtype=np.int16)
    cp, bounds = tv.code_points(texts)
    if not len(cp):
        return out
    char = (tv.mix64(cp.astype(np.uint64)) >> np.uint64(56)).astype(np.int64)  # 256 classes of characters
    padded = np.concatenate([cp, np.zeros(GRAM, dtype=np.uint32)]).astype(np.uint64)
    text_end = np.repeat(bounds[1:], np.diff(bounds))
    at = np.arange(len(cp))
    h = np.zeros(len(cp), dtype=np.uint64)
    for j in range(GRAM):
        h = h * np.uint64(0x9E3779B97F4A7C15) + np.where(at + j < text_end, padded[at + j] + np.uint64(1), 0)
    read = (tv.mix64(h) >> np.uint64(56)).astype(np.int16)
    moves = _MOVES.reshape(-1)
    who = np.flatnonzero(np.diff(bounds) > 0)
    place, end = bounds[who].copy(), bounds[who + 1]
    known = iter(records(4 * int(np.diff(bounds).max()) + 64))
    step, bin_ = next(known)
    t = 0
    char = np.append(char, 0)
    while len(who) >= SCALAR:
        # walks that end in these steps only stay at their text's end
        for _ in range(16):
            live = place < end
            if t == step:
                out[who[live], bin_] = read[place[live]]
                step, bin_ = next(known, (1 << 62, 0))
            place += moves[char[place] + 256 * (t % PERIOD)] * live
            t += 1
        live = place < end
        who, place, end = who[live], place[live], end[live]
    for d, p, stop in zip(who.tolist(), place.tolist(), end.tolist(), strict=True):
        _walk_on(out[d], t, char[p:stop].tolist(), read, p)
    return out


def _walk_on(row: np.ndarray, t: int, chars: list[int], read: np.ndarray, first: int) -> None:
    """One text's walk from step t to its end."""
    i, n = 0, len(chars)
    flat = _FLAT
    known = records(t + 4 * n + 64)
    k = _first_record(known, t)
    while i < n:
        if k == len(known):
            known = records(2 * t + 64)
        step, bin_ = known[k] if k < len(known) else (1 << 62, 0)
        while t < step and i < n:
            i += flat[(t % PERIOD) * 256 + chars[i]]
            t += 1
        if i < n:
            row[bin_] = read[first + i]
            k += 1


_FLAT = _MOVES.reshape(-1).tolist()


def _first_record(known: list[tuple[int, int]], t: int) -> int:
    import bisect

    return bisect.bisect_left(known, (t, -1))


def spell(row: np.ndarray) -> str:
    """A fingerprint as text: two hexadecimal digits a bin, `--` for one without a value."""
    return "".join("--" if v == 256 else f"{v:02x}" for v in row.tolist()) if (row != 256).any() else ""


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, the share of equal bins among those with a value in either; 1 if there are none."""
    used = (a != 256) | (b != 256)
    n = used.sum(axis=1)
    return np.where(n > 0, ((a == b) & used).sum(axis=1) / np.maximum(n, 1), 1.0)


def edited(text: str, following: str) -> str:
    """The text whose last half is replaced by as many first characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and fingerprint of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for a, b in tv.chunks(texts, CHUNK_CHARS):
                found = [spell(r) for r in fingerprints(texts[a:b])]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:-1]), pa.array(found, pa.string())], names=[*keep, "fingerprint"])

    schema = df.select(*keep).schema.add("fingerprint", "string")
    return df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(run, schema)


_FIELDS = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compared(ids: list, texts: list[str], following: str) -> list[list]:
    """Result columns of consecutive rows; the row after the last one is ``following``."""
    shown = [*texts, following]
    changed = [edited(t, n) for t, n in zip(texts, shown[1:], strict=True)]
    own, other = fingerprints(shown), fingerprints(changed)
    return [
        ids, [len(t) for t in texts], [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
        [spell(r) for r in own[:-1]], [spell(r) for r in other], likeness(own[:-1], other).tolist(), likeness(own[:-1], own[1:]).tolist(),
    ]


def with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next, where
    the next document is the one of the next larger id (after the last, the first).

    Rows are dealt in ranges of ids, their texts compressed on the way, and read in order; a range's
    last row waits for the first text of the next range, of which there is one a partition."""
    id_type = df.schema[doc_id].dataType.simpleString()
    schema = f"id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, started = TaskContext.get().partitionId(), None, False
        kind, unpack = None, zstandard.ZstdDecompressor().decompress

        def out(columns: list[list], role: str, whole: list) -> pa.RecordBatch:
            n = len(columns[0])
            types = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([role] * n), pa.array([part] * n, pa.int32()), pa.array(whole, pa.string())], names=[*_FIELDS, "role", "part", "text"])

        def text_only(id_, role: str, text: str) -> pa.RecordBatch:
            return out([[id_], *([None] for _ in _FIELDS[1:])], role, [text])

        for batch in batches:
            kind = batch.schema.field(0).type
            ids, texts = batch.column(0).to_pylist(), [unpack(x.as_py()).decode() for x in batch.column(1)]
            for a, b in tv.chunks(texts, CHUNK_CHARS):
                rows, row_ids = texts[a:b], ids[a:b]
                if not started:
                    yield text_only(row_ids[0], "first", rows[0])
                    started = True
                if waiting:
                    rows, row_ids = [waiting[1], *rows], [waiting[0], *row_ids]
                if len(rows) > 1:
                    columns = _compared(row_ids[:-1], rows[:-1], rows[-1])
                    yield out(columns, "done", [None] * (len(rows) - 1))
                waiting = row_ids[-1], rows[-1]
        if waiting:
            yield text_only(waiting[0], "last", waiting[1])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                id_, own, following = (c[i].as_py() for c in batch.columns)
                columns = _compared([id_], [own], following)
                types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_FIELDS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([press(x.as_py()) for x in batch.column(1)], pa.binary()), batch.column(2)], names=["id", "__text", "__hash"])

    rows = df.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__text"))
    rows = rows.withColumn("__hash", F.xxhash64("__text")).mapInArrow(pack, f"id {id_type}, __text binary, __hash long")
    order = [F.col("id").asc_nulls_first(), F.col("__hash")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "__text")
    read = materialize(dealt.mapInArrow(run, f"{schema}, role string, part int, text string"), "fingerprints")
    # one row a partition each; the first text of all follows the last row
    firsts = read.where("role = 'first'").select("part", F.col("text").alias("following"))
    parts = firsts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy(F.lit(1)))).alias("next"))
    ends = read.where("role = 'last'").select("id", "text", "part").join(parts, "part").join(firsts.withColumnRenamed("part", "next"), "next")
    finished = ends.select("id", "text", "following").mapInArrow(finish, schema)
    return read.where("role = 'done'").select(_FIELDS).union(finished)


def unspell(prints: list[str]) -> np.ndarray:
    """Fingerprints, not empty, of their texts."""
    return np.array([[256 if p[i : i + 2] == "--" else int(p[i : i + 2], 16) for i in range(0, 2 * BINS, 2)] for p in prints], dtype=np.int16).reshape(len(prints), BINS)


def _verified(pairs: DataFrame, one: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose fingerprints are alike."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = likeness(unspell(batch.column(2).to_pylist()), unspell(batch.column(3).to_pylist())) >= threshold
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda k, name: one.select(F.col("node").alias(k), F.col("fingerprint").alias(name))
    return pairs.join(side("a", "fa"), "a").join(side("b", "fb"), "b").select("a", "b", "fa", "fb").mapInArrow(compare, "a long, b long")


def _neighbours(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that follow one another in a key; ranges may cut a key, which is only a later meeting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            both = [(x[1], y[1]) for x, y in zip([last, *rows], rows, strict=False) if x and x[0] == y[0]]
            last = rows[-1] if rows else last
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in both], pa.int64()), pa.array([y for _, y in both], pa.int64())], names=["a", "b"])

    return shared.select("key", "node").repartitionByRange("key", "node").sortWithinPartitions("key", "node").mapInArrow(run, "a long, b long").distinct()


def _unresolved(shared: DataFrame, roots: DataFrame, one: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between components that share a key: its rows are dealt into blocks of about
    BLOCK_ROWS, and every two blocks meet in a group of their own."""

    def meet(group: pa.Table) -> pa.Table:
        node, root, chunk = (group.column(c).to_numpy() for c in ("node", "root", "chunk"))
        prints, i, j = unspell(group.column("fingerprint").to_pylist()), group.column("i")[0].as_py(), group.column("j")[0].as_py()
        first, second, found = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j), []
        for x in first.tolist():
            others = second[root[second] != root[x]]
            others = others[node[others] > node[x]] if i == j else others
            ok = others[likeness(prints[[x]].repeat(len(others), axis=0), prints[others]) >= threshold]
            found += [(int(node[x]), int(n)) for n in node[ok]]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    rows = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("chunks")).where("low < high")
    dealt = rows.join(several.select("key", "chunks"), "key").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")})
    return dealt.join(one, "node").select("key", "i", "j", "chunk", "node", "root", "fingerprint").groupBy("key", "i", "j").applyInArrow(meet, "a long, b long").distinct()


def classes(prints: DataFrame, doc_id: str, threshold: float = 0.6, bands: int = 32, bins: int = 4) -> DataFrame:
    """(fingerprint, class_id): the smallest id of its component of links, for every distinct fingerprint.

    Links join fingerprints that share a band key and are alike by ``threshold``.  A key of bins
    that no walk reached says nothing and joins nothing."""
    one = prints.groupBy("fingerprint").agg(F.min(doc_id).alias("id")).withColumn("node", F.xxhash64("fingerprint"))
    one = materialize(one, "prints")
    shown = one.where("fingerprint <> ''").select("node", "fingerprint")
    picks = np.random.default_rng(5).permutation(BINS)
    keys = [F.concat_ws("", *(F.substring("fingerprint", 2 * int(picks[(k * bins + j) % BINS]) + 1, 2) for j in range(bins))) for k in range(bands)]
    banded = shown.select("node", F.posexplode(F.array(*keys)).alias("band", "bits")).where(F.col("bits") != "--" * bins).select(F.xxhash64("band", "bits").alias("key"), "node")
    held = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    shared = materialize(banded.join(held, "key", "left_semi"), "shared-keys")
    roots = materialize(components(_verified(_neighbours(shared), shown, threshold)), "print-roots")
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(_unresolved(shared, roots, shown, threshold))
    roots = materialize(components(links), "print-roots")
    rooted = one.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = rooted.groupBy("root").agg(F.min("id").alias("class_id"))
    return rooted.join(lowest, "root").select("fingerprint", "class_id")


def near_pairs(prints: DataFrame, doc_id: str, threshold: float = 0.6, bands: int = 32, bins: int = 4) -> DataFrame:
    """Membership in classes of alike fingerprints: (id, class_id, likeness) of every row that is not
    its class's smallest id, with its likeness to that row, which a chain of links may lie between."""
    found = classes(prints, doc_id, threshold, bands, bins).where("fingerprint <> ''")
    rows = prints.join(found, "fingerprint").where(F.col(doc_id) != F.col("class_id")).select(F.col(doc_id).alias("id"), "class_id", "fingerprint")
    first = prints.join(found, "fingerprint").where(F.col(doc_id) == F.col("class_id")).groupBy("class_id").agg(F.min("fingerprint").alias("other"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share = likeness(unspell(batch.column(2).to_pylist()), unspell(batch.column(3).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(share, pa.float64())], names=["id", "class_id", "likeness"])

    kind = prints.schema[doc_id].dataType.simpleString()
    return rows.join(first, "class_id").select("id", "class_id", "fingerprint", "other").mapInArrow(compare, f"id {kind}, class_id {kind}, likeness double")


def with_classes(found: DataFrame) -> DataFrame:
    """Rows of ``with_next`` and class_id, the smallest id of the class of their fingerprint."""
    named = classes(found, "id")
    return found.join(named, "fingerprint", "left").select(*found.columns, "class_id")

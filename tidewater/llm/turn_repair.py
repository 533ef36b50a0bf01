"""Conversation structure repair by weighted CYK interval parsing (operator 13).

Faulty turns are repaired by the cheapest edits that make a conversation's role
initials match ``(s?(ua)+)?``.  The repair grammar is in Chomsky normal form: a
nonterminal is a pair (p, q) of places in that pattern and derives the spans
that lead from p to q.  Its rules are (p, q) -> (p, r) (r, q), the terminals that
keep, rerole or delete a row, and insertions, which derive the empty span and are
closed beforehand.  A span's cell holds, for every nonterminal, the least
(cost, audit); cells are combined bottom-up by span length.  As nonterminals are
pairs of places, every split of a span gives the same cell, so one split serves
and spans double in length.  Equal costs of one nonterminal never have audits of
which one begins the other (that takes two insertions more), so the least audit
of a span is made of least audits of its parts.

A conversation of at most ``LONG_ROWS`` rows is parsed in one go, rows grouped by a
shuffle on its id.  Longer ones are dealt over ordered pieces: equal rows are
counted once, a range shuffle by (id, turn, role, text) cuts the conversation
wherever its rows need it, every piece is parsed by itself, only the pieces' cells
meet to choose the path, and the pieces are then replayed apart.  The hash of a
repaired conversation takes its rows one after another, as they stream by.

Nulls of role and text are read as one blank, in the CRC's key too.  Rows lie by
turn (nulls first), then role and text, so repeated rows lie side by side; a null
id is a conversation of its own; ids are whole numbers.  Empty texts are blank
rows; very long ones are passed on whole.  Rows that repeat a role and a text of
their conversation are duplicates whatever their turns.  An empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.sink import materialize
from . import textvec as tv

LONG_ROWS = 512

# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# Places in the pattern (0 at its start) and where each role's initial leads.
START, ACCEPTING = 0, (0, 3)
STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAMED = {"u": "user", "a": "assistant"}

Cell = dict[tuple[int, int], tuple[int, str]]
BLANK, DUPLICATE, CUT, FINE = "blank", "duplicate", "truncated", "fine"


def joined(a: Cell, b: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = {}
    for (p, r), (cost, audit) in a.items():
        for (r2, q), (more, rest) in b.items():
            if r == r2:
                new = (cost + more, audit + rest)
                if (p, q) not in out or new < out[p, q]:
                    out[p, q] = new
    return out


@lru_cache(maxsize=1)
def insertions() -> Cell:
    """The cell of an empty span: insertion closed under repetition."""
    cell: Cell = {(p, p): (0, "") for p in STEPS}
    one = cell | {(p, q): (INSERT, "I") for p, steps in STEPS.items() for c, q in steps.items() if c in NAMED}
    while (more := joined(cell, one)) != cell:
        cell = more
    return cell


@lru_cache(maxsize=64)
def row_cell(initial: str, fault: str) -> Cell:
    """The cell of one row, with insertions on both sides."""
    edits: Cell = {(p, p): (DELETE, "D") for p in STEPS}
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if fault == CUT else 0
        for p, steps in STEPS.items():
            for c, q in steps.items():
                if c == initial:
                    edits[p, q] = min(edits.get((p, q), (99, "")), (extra, "K"))
                elif c in NAMED:
                    edits[p, q] = min(edits.get((p, q), (99, "")), (extra + REROLE, "R"))
    return joined(joined(insertions(), edits), insertions())


def parse(kinds: Sequence[tuple[str, str]]) -> Cell:
    """The cell of a whole span of rows, given by initial and fault: spans of one row, of two, of four, ..."""
    spans = [row_cell(*k) for k in kinds] or [insertions()]
    while len(spans) > 1:
        pairs = [joined(a, b) for a, b in zip(spans[::2], spans[1::2], strict=False)]
        spans = pairs + spans[len(pairs) * 2 :]
    return spans[0]


@lru_cache(maxsize=1 << 14)
def _parse_short(kinds: tuple[tuple[str, str], ...]) -> Cell:
    return parse(kinds)


def cheapest(cell: Cell, start: int = START, ends: Sequence[int] = ACCEPTING) -> tuple[int, str]:
    """Cost and audit of the cheapest way from ``start`` to one of ``ends``."""
    return min(cell[start, q] for q in ends if (start, q) in cell)


def replay(place: int, audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every step of an audit from a place of the pattern; deleted rows keep role and text."""
    for edit in audit:
        if edit == "I":
            role, text = ("user" if "u" in STEPS[place] else "assistant"), ""
        else:
            role, text = next(rows)
            if edit == "R":
                role = "user" if "u" in STEPS[place] else "assistant"
        if edit != "D":
            place = STEPS[place][role[0]]
        yield edit, role, text


# Fixed value: the characters that do not show.
_SHOWN_END = " \t\n\v\f\r"


def fault_of(role: str, text: str, seen: set) -> str:
    """A row's first fault, given the (role, text) digests seen before, to which it is added."""
    digest = hashlib.blake2b(b"%d:" % len(role) + role.encode() + text.encode(), digest_size=16).digest()
    again = digest in seen
    seen.add(digest)
    return own_fault(text, again)


def own_fault(text: str, again: bool) -> str:
    shown = text.rstrip(_SHOWN_END)
    return BLANK if not shown else DUPLICATE if again else FINE if shown[-1] in ".!?" else CUT


def legal(a: str, b: str) -> bool:
    return a[:1] + b[:1] in ("su", "ua", "au")


def damage(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by the CRC of their id and turn, 0 copies for a dropped row."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.concat(blank(conv_id), F.lit(":"), blank(turn))
    rows = df.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("h"))
    h = F.col("h")
    harmed = F.when(h == 1, F.lit("")).when(h == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(h == 0, 0).when(h == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(h == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), harmed.alias("text"), copies.alias("copies"))


def repair(rows: DataFrame, long_rows: int = LONG_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every
    conversation in rows of (conv_id, turn, role, text, copies), no text being null."""
    rows = rows.select("conv_id", "turn", "role", "text", F.col("copies").cast("int").alias("copies"))
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"))
    long_ids = materialize(sizes.where(F.col("n") > long_rows).select(F.col("conv_id").alias("__long")), "long-conversations")
    if long_ids.isEmpty():
        return _repair_short(rows)
    is_long = rows["conv_id"].eqNullSafe(long_ids["__long"])
    return _repair_short(rows.join(long_ids, is_long, "left_anti")).unionByName(_repair_long(rows.join(long_ids, is_long, "left_semi")))


def _schema(rows: DataFrame) -> T.StructType:
    return T.StructType([rows.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def _repair_short(rows: DataFrame) -> DataFrame:
    """Conversations one after another, each held while it is parsed."""
    schema = _schema(rows)
    id_type = pa.int64()

    def answer(conv, turns: list) -> tuple:
        seen: set = set()
        turns = [(t, r, x) for t, r, x, n in turns for _ in range(n)]
        kinds = tuple((r[:1], fault_of(r, x, seen)) for _, r, x in turns)
        faults = [f for _, f in kinds]
        known = {t for t, _, _ in turns if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        illegal = sum(not legal(a[1], b[1]) for a, b in zip(turns, turns[1:], strict=False))
        cost, audit = cheapest(_parse_short(kinds)) if len(kinds) <= 16 else cheapest(parse(kinds))
        lines = (f"{r}:{x}" for e, r, x in replay(START, audit, ((r, x) for _, r, x in turns)) if e != "D")
        return conv, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tv.release()
        now, turns, out = None, [], []

        def ready() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

        for batch in batches:
            for conv, turn, role, text, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if turns and conv != now:
                    out.append(answer(now, turns))
                    turns = []
                    if len(out) >= 4096:
                        yield ready()
                now = conv
                turns.append((turn, role, text, n))
        if turns:
            out.append(answer(now, turns))
        if out:
            yield ready()

    rows = rows.withColumn("conv_id", F.col("conv_id").cast("long"))
    dealt = rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    return dealt.mapInArrow(run, T.StructType([T.StructField("conv_id", T.LongType()), *schema.fields[1:]])).withColumn("conv_id", F.col("conv_id").cast(schema["conv_id"].dataType))


def _repair_long(rows: DataFrame) -> DataFrame:
    """Conversations in ordered pieces, each held while it is parsed or replayed."""
    schema = _schema(rows)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("long").alias("copies"))
    # the first row of a role and text is its least turn; later ones, and further copies, are duplicates
    once = once.withColumn("digest", F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256))
    present = once.where("copies > 0")
    turn_order = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    firsts = present.groupBy("conv_id", "digest").agg(F.min(turn_order).alias("first"))
    f = firsts.select(F.col("conv_id").alias("__c"), F.col("digest").alias("__d"), "first")
    marked = present.join(f, present["conv_id"].eqNullSafe(f["__c"]) & (present["digest"] == f["__d"])).withColumn("again", turn_order != F.col("first"))
    ranged = marked.select("conv_id", "turn", "role", "text", "copies", "again").repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = materialize(ranged.withColumn("piece", F.spark_partition_id()), "turn-pieces")
    by_piece = pieces.repartition("conv_id", "piece").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("piece"), *order[1:])
    cells = materialize(by_piece.mapInArrow(_piece_cells, _CELLS), "turn-cells")
    by_conv = cells.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "piece")
    plan = materialize(by_conv.mapInArrow(_piece_paths, _PATHS), "turn-paths")
    p = plan.select(F.col("conv_id").alias("__c"), F.col("piece").alias("__p"), "place", F.col("audit").alias("part"))
    replayed = pieces.join(p, pieces["conv_id"].eqNullSafe(p["__c"]) & (pieces["piece"] == p["__p"])).drop("__c", "__p")
    replayed = replayed.repartition("conv_id", "piece").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "piece", *order[1:])
    lines = replayed.mapInArrow(_piece_lines, "conv_id long, piece int, nth long, line string")
    hashed = lines.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "piece", "nth").mapInArrow(_hashes, "__h long, repaired_sha256 string")
    per_conv = cells.groupBy("conv_id").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"))
    turns = pieces.where("turn is not null").select("conv_id", "turn").distinct().groupBy(F.col("conv_id").alias("__t")).agg(F.count(F.lit(1)).alias("turns"))
    totals = plan.groupBy(F.col("conv_id").alias("__p")).agg(F.max("cost").alias("cost"), F.max("illegal").alias("illegal"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    out = per_conv.join(totals, per_conv["conv_id"].eqNullSafe(totals["__p"]))
    out = out.join(turns, per_conv["conv_id"].eqNullSafe(turns["__t"]), "left").join(hashed, per_conv["conv_id"].eqNullSafe(hashed["__h"]), "left")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    sha = F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")
    return out.select(per_conv["conv_id"].cast(schema["conv_id"].dataType).alias("conv_id"), gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit", sha)


_CELLS = "conv_id long, piece int, low long, high long, blank long, duplicate long, truncated long, illegal long, first string, last string, ways array<struct<p:int,q:int,cost:long,audit:string>>"
_PATHS = "conv_id long, piece int, place int, audit string, cost long, illegal long"


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches by their first columns, one group after another."""
    from itertools import groupby

    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    return groupby(rows, key=lambda r: r[:keys])


def _piece_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tv.release()
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 6, pa.string(), pa.string(), pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))]
    names = [x.split()[0] for x in _CELLS.split(", ")]
    for (conv, piece), rows in _groups((b.select(["conv_id", "piece", "turn", "role", "text", "copies", "again"]) for b in batches), 2):
        low = high = first = last = None
        count = {BLANK: 0, DUPLICATE: 0, CUT: 0, FINE: 0}
        illegal, spans, kinds = 0, [], []
        for _, _, turn, role, text, copies, again in rows:
            low = turn if low is None else low
            high = turn if turn is not None else high
            initial = role[:1]
            illegal += (last is not None and not legal(last, initial)) + (copies - 1) * (not legal(initial, initial))
            first, last = initial if first is None else first, initial
            for n in range(copies):
                fault = own_fault(text, again or n > 0)
                count[fault] += 1
                kinds.append((initial, fault))
            if len(kinds) >= LONG_ROWS:
                spans.append(parse(kinds))
                kinds = []
        spans += [parse(kinds)] if kinds else []
        while len(spans) > 1:
            pairs = [joined(a, b) for a, b in zip(spans[::2], spans[1::2], strict=False)]
            spans = pairs + spans[len(pairs) * 2 :]
        ways = [{"p": p, "q": q, "cost": c, "audit": x} for (p, q), (c, x) in sorted(spans[0].items())]
        values = [conv, piece, low, high, count[BLANK], count[DUPLICATE], count[CUT], illegal, first, last, ways]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)


def _piece_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces' parts of the cheapest path: from which place, by which edits."""
    tv.release()
    types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in _PATHS.split(", ")]
    for (conv,), rows in _groups((b.select(["conv_id", "piece", "illegal", "first", "last", "ways"]) for b in batches), 1):
        pieces, cells, illegal, before = [], [], 0, None
        for _, piece, inside, first, last, ways in rows:
            illegal += inside + (before is not None and not legal(before, first))
            before = last
            pieces.append(piece)
            cells.append({(w["p"], w["q"]): (w["cost"], w["audit"]) for w in ways})
        # best[i][p]: cost and audit from place p before piece i to the end, and the place after it
        best: list[dict[int, tuple[tuple[int, str], int]]] = [{q: ((0, ""), q) for q in ACCEPTING}]
        for cell in reversed(cells):
            found: dict[int, tuple[tuple[int, str], int]] = {}
            for (p, q), (cost, audit) in cell.items():
                if q in best[-1]:
                    (more, rest), _ = best[-1][q]
                    if p not in found or (cost + more, audit + rest) < found[p][0]:
                        found[p] = ((cost + more, audit + rest), q)
            best.append(found)
        cost, place, out = best[-1][START][0][0], START, []
        for piece, cell, found in zip(pieces, cells, reversed(best), strict=False):
            after = found[place][1]
            out.append((conv, piece, place, cell[place, after][1], cost, illegal))
            place = after
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _piece_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tv.release()
    for (conv, piece), rows in _groups((b.select(["conv_id", "piece", "place", "part", "role", "text", "copies"]) for b in batches), 2):
        first = next(rows)
        place, audit = first[2], first[3]
        turns = ((r[4], r[5]) for one in (iter([first]), rows) for r in one for _ in range(r[6]))
        held: list[tuple[int, str]] = []
        for nth, (edit, role, text) in enumerate(replay(place, audit, turns)):
            if edit != "D":
                held.append((nth, f"{role}:{text}"))
            if len(held) >= 1024:
                yield _line_batch(conv, piece, held)
                held = []
        if held:
            yield _line_batch(conv, piece, held)


def _line_batch(conv: int | None, piece: int, held: list[tuple[int, str]]) -> pa.RecordBatch:
    n = len(held)
    columns = [pa.array([conv] * n, pa.int64()), pa.array([piece] * n, pa.int32()), pa.array([i for i, _ in held], pa.int64()), pa.array([x for _, x in held], pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", "piece", "nth", "line"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tv.release()
    for (conv,), rows in _groups((b.select(["conv_id", "line"]) for b in batches), 1):
        h = hashlib.sha256()
        for n, (_, line) in enumerate(rows):
            h.update((b"\n" if n else b"") + line.encode())
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([h.hexdigest()], pa.string())], names=["__h", "repaired_sha256"])


def repaired_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, nth, edit, role, text): every step of the cheapest repair of conversations of at most LONG_ROWS rows,
    deleted rows included; of longer ones ``repair`` gives the audit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv,), turns in _groups(batches, 1):
            seen: set = set()
            turns = [(r[2], r[3]) for r in turns for _ in range(r[4])]
            cost_audit = cheapest(parse([(r[:1], fault_of(r, x, seen)) for r, x in turns]))
            steps = list(replay(START, cost_audit[1], iter(turns)))
            if steps:
                edits, roles, texts = zip(*steps, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([conv] * len(steps), pa.int64()), pa.array(range(len(steps)), pa.int64()), pa.array(edits, pa.string()), pa.array(roles, pa.string()), pa.array(texts, pa.string())], names=["conv_id", "nth", "edit", "role", "text"])

    dealt = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text", "copies").repartition("conv_id")
    dealt = dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    return dealt.mapInArrow(run, "conv_id long, nth long, edit string, role string, text string")

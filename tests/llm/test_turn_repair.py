import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidewater.llm import queries, turn_repair

SF = "/root/testdata/sf0.01"
STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def cheapest(rows):
    """Least (cost, audit) and its rows, by a shortest path over (rows taken, place in the pattern)."""
    queue, done = [(0, "", 0, 0, ())], set()
    while queue:
        cost, audit, i, p, out = heapq.heappop(queue)
        if (i, p) in done:
            continue
        done.add((i, p))
        if i == len(rows) and p in (0, 3):
            return cost, audit, out
        push = lambda c, e, j, q, o: heapq.heappush(queue, (cost + c, audit + e, j, q, o))  # noqa: B023, E731
        for c, q in STEPS[p].items():
            if c != "s":
                push(5, "I", i, q, (*out, ("user" if c == "u" else "assistant") + ":"))
        if i < len(rows):
            role, text, fault = rows[i]
            push(2, "D", i + 1, p, out)
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                for c, q in STEPS[p].items():
                    if role[:1] == c:
                        push(extra, "K", i + 1, q, (*out, f"{role}:{text}"))
                    if c != "s":
                        push(extra + 1, "R", i + 1, q, (*out, ("user:" if c == "u" else "assistant:") + text))
    raise AssertionError


def brute(rows):
    """Answers for (conv_id, turn, role, text) rows."""
    text_of = lambda v: " " if v is None else v
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = convs[conv]
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = text_of(role), text_of(text)
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    out = []
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked = set(), []
        for _, role, text in kept:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            marked.append((role, text, "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"))
            seen.add((role, text))
        known = {t for t, _, _ in kept if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:], strict=False)]
        cost, audit, lines = cheapest(marked)
        n = lambda f: sum(m[2] == f for m in marked)  # noqa: B023, E731
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, n("blank"), n("duplicate"), n("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def answers(df, **options):
    got = turn_repair.repair(turn_repair.damage(df), **options)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("long_rows", [512, 3, 0])
def test_conversations_equal_brute_force(spark, long_rows):
    df = queries.read(spark, SF, "conversations").select("conv_id", "turn", "role", "text")
    want = brute([tuple(r) for r in df.collect()])
    assert answers(df, long_rows=long_rows) == want
    if long_rows == 512:
        assert sorted((tuple(r) for r in queries.op13_turn_repair(spark, SF).collect()), key=str) == want


def odd_rows():
    rng = np.random.default_rng(3)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "u"], ["Hi.", "no end", "", " \t", None, "Why?!", "x. y", " ", "ok!\n"]
    rows = [(int(c), None if rng.random() < 0.1 else int(rng.integers(0, 6)), roles[rng.integers(0, 7)], texts[rng.integers(0, 9)]) for c in np.repeat(np.arange(60), 9)]
    rows += [(None, t, "user", "Yes.") for t in (None, None, 1, 2, 3)] + [(99, 0, "user", "x" * 100_000)]
    return rows + [(7, int(t), roles[t % 3], "A long one.") for t in rng.integers(0, 50, 200)]


@pytest.mark.parametrize("long_rows", [512, 4])
def test_odd_rows(spark, long_rows):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, copies int")
    assert answers(df, long_rows=long_rows) == brute(rows)
    assert answers(df.limit(0)) == []


def test_a_long_conversation_is_cut(spark):
    rng = np.random.default_rng(4)
    rows = [(5, i // 2, ["user", "assistant", "system"][int(rng.integers(0, 3))], f"Turn {int(rng.integers(0, 900))}" + "."[: int(rng.integers(0, 2))]) for i in range(1500)] + [(6, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    assert answers(df) == brute(rows)


def all_splits(kinds):
    """The chart of every span and every split."""
    n = len(kinds)
    chart = {(i, i + 1): turn_repair.row_cell(*k) for i, k in enumerate(kinds)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell = {}
            for m in range(i + 1, i + length):
                for key, way in turn_repair.joined(chart[i, m], chart[m, i + length]).items():
                    cell[key] = min(cell.get(key, way), way)
            chart[i, i + length] = cell
    return chart[0, n]


def test_one_split_of_a_span_serves_for_all():
    rng = np.random.default_rng(0)
    for _ in range(60):
        kinds = [("suat"[rng.integers(0, 4)], ["fine", "fine", "blank", "truncated", "duplicate"][rng.integers(0, 5)]) for _ in range(rng.integers(1, 9))]
        assert turn_repair.parse(kinds) == all_splits(kinds)


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "x."), (2, 0, "user", "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, copies int")
    got = sorted((r.conv_id, r.nth, r.edit, r.role, r.text) for r in turn_repair.repaired_rows(df).collect())
    assert got == [(1, 0, "K", "system", "Be kind."), (1, 1, "R", "user", "Hello."), (1, 2, "R", "assistant", "x."), (2, 0, "D", "user", "")]

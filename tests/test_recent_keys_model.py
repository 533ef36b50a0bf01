"""The chunked recent-key rule equals a record-by-record cache simulation."""

from hypothesis import given, settings
from hypothesis import strategies as st

from cache_model import run_fold, simulate_cache
from tidewater.operators.recent_keys import WarmFold, _summary_rows, decide_chunk


def chunked(keys, capacity, chunk_len):
    chunks = [keys[i : i + chunk_len] for i in range(0, len(keys), chunk_len)]
    fold = WarmFold(capacity)
    out = []
    for ch in chunks:
        rows = _summary_rows(ch, capacity + 1)
        summary = [k for r, k in rows if r >= 0]
        last = [k for r, k in rows if r < 0][0]
        warm, replay = fold.step(summary, last)
        out.extend(decide_chunk(ch, warm, replay, capacity))
    return out


@settings(max_examples=1500, deadline=None)
@given(
    keys=st.lists(st.integers(0, 12).map(str), min_size=1, max_size=200),
    capacity=st.integers(1, 10),
    chunk_len=st.integers(1, 40),
)
def test_chunked_equals_simulation(keys, capacity, chunk_len):
    assert chunked(keys, capacity, chunk_len) == simulate_cache(keys, capacity)


def test_single_chunk_examples():
    # back-to-back copies: every second record is a duplicate
    keys = [f"k{i}" for i in range(10) for _ in range(2)]
    assert sum(simulate_cache(keys, 10)) == 10
    assert chunked(keys, 10, 7) == simulate_cache(keys, 10)
    # three topics repeating the same 30 keys into one cache of 30: only 30 kept
    keys = [f"key{p}-{n}" for _t in range(3) for p in range(3) for n in range(10)]
    flags = simulate_cache(keys, 30)
    assert flags.count(False) == 30
    assert chunked(keys, 30, 8) == flags


def test_capacity_one():
    keys = list("aabba")
    assert simulate_cache(keys, 1) == [False, True, False, True, False]
    assert chunked(keys, 1, 2) == simulate_cache(keys, 1)


@settings(max_examples=500, deadline=None)
@given(
    keys=st.lists(st.integers(0, 60).map(str), min_size=1, max_size=400),
    capacity=st.integers(1, 40),
    chunk_len=st.integers(1, 90),
)
def test_chunked_equals_simulation_wide(keys, capacity, chunk_len):
    assert chunked(keys, capacity, chunk_len) == simulate_cache(keys, capacity)


def chunked_runs(keys, capacity, chunk_len):
    chunks = [keys[i : i + chunk_len] for i in range(0, len(keys), chunk_len)]
    summ = []
    for ch in chunks:
        rows = _summary_rows(ch, capacity + 1)
        summ.append(([k for r, k in rows if r >= 0], [k for r, k in rows if r < 0][0]))
    warm = run_fold(summ, capacity)
    out = []
    for ch, (w, rp) in zip(chunks, warm):
        out.extend(decide_chunk(ch, w, rp, capacity))
    return out


@settings(max_examples=800, deadline=None)
@given(
    keys=st.lists(st.integers(0, 30).map(str), min_size=1, max_size=300),
    capacity=st.integers(1, 12),
    chunk_len=st.integers(1, 60),
)
def test_run_fold_equals_simulation(keys, capacity, chunk_len):
    assert chunked_runs(keys, capacity, chunk_len) == simulate_cache(keys, capacity)

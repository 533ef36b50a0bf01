"""Models that the recent-key tests compare with: the cache record by record, and a fold run by run."""

from collections import OrderedDict
from collections.abc import Sequence

from tidewater.operators.recent_keys import WarmFold


def simulate_cache(keys: Sequence[str | None], capacity: int) -> list[bool]:
    """Reference model: the bounded recent-key set applied record by record."""
    cache: OrderedDict[str, None] = OrderedDict()  # last = most recent
    out = []
    for k in keys:
        if k is None:
            out.append(False)
            continue
        out.append(k in cache)
        if len(cache) >= capacity:
            cache.popitem(last=False)
        cache[k] = None
        cache.move_to_end(k)
    return out


def run_fold(chunks: list[tuple[list[str], str]], capacity: int) -> list[tuple[list[str], str | None]]:
    """Warm state of every chunk, computed run by run.

    ``chunks``: per chunk in order, (summary keys newest first, last key).
    A chunk whose summary holds ``capacity + 1`` keys fixes the state after
    it on its own, so the fold restarts there: runs between such chunks are
    independent (in Spark, one task per run instead of one per scope).
    Returns (warm keys, replayed key) per chunk, as ``WarmFold`` would.
    """
    cap = capacity + 1
    out: list[tuple[list[str], str | None]] = [([], None)] * len(chunks)
    run_start = [i for i, (summary, _) in enumerate(chunks) if len(summary) >= cap]
    starts = sorted(set([0] + run_start))
    for a, b in zip(starts, starts[1:] + [len(chunks)]):
        fold = WarmFold(capacity)
        if a > 0:  # the run's first chunk is full: what came before does not matter
            fold.prev_last = chunks[a - 1][1]
        for j in range(a, b):
            summary, last = chunks[j]
            fold.step(summary, last)
            if j + 1 < len(chunks):
                out[j + 1] = (fold.state, fold.prev_last)
    return out

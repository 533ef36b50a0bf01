"""Array helpers for text inside a task: code points, pre-token boundaries, piece hashes.

A chunk of documents becomes one code-point array; every later step is a few
array passes over it.  ``CHUNK_CHARS`` bounds the memory of a pass (a longer
single document forms a chunk of its own).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np

CHUNK_CHARS = 1 << 20
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3

# The code points with the White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

_classes: np.ndarray | None = None
_weights = np.zeros(0, dtype=np.uint64)


_held: dict = {}


def held(name: tuple, make):
    """The worker's one long-lived helper: made anew, and the last one dropped with what earlier work
    left in memory, when another is asked for."""
    if name not in _held:
        release()
        _held[name] = make()
    return _held[name]


def release() -> None:
    """Drop the worker's long-lived helper, and give its memory back."""
    import ctypes
    import gc

    import pyarrow as pa

    _held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it
        pass


def giving_back(work):
    """A task's function that ends by giving back the worker's helper and memory.  Spark hands a task to
    the worker that has been idle longest, and there may be more workers than cores: each would keep
    a helper of its own, while no more of them work than there are cores."""

    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        release()

    return run


def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    global _classes
    if _classes is None:
        kinds = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), dtype=np.uint8, count=0x110000)
        table[WHITE_SPACE] = SPACE
        _classes = table
    return _classes


def position_weights(n: int) -> np.ndarray:
    """Odd 64-bit multipliers by position, the same in every process."""
    global _weights
    if len(_weights) < n:
        _weights = np.random.default_rng(20240229).integers(0, 2**63, size=max(1024, 1 << n.bit_length()), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return _weights


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of texts holding at most ``limit`` characters, or one text."""
    a = size = 0
    for b, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield a, b
            a, size = b, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def text_slices(batch, column: int, limit: int = CHUNK_CHARS, rows: int = 1024) -> Iterator[tuple]:
    """Slices of an Arrow batch with their texts (null: empty): at most ``rows`` rows and, unless
    one text is longer, ``limit`` characters."""
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        texts = [t or "" for t in part.column(column).to_pylist()]
        for a, b in chunks(texts, limit):
            yield part.slice(a, b - a), texts[a:b]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one code-point array, and the n + 1 text boundaries in it."""
    cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return cp, bounds


def run_hashes(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of ``values`` beginning at ``starts`` (to the next start)."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = np.diff(starts, append=len(values))
    pos = np.arange(len(values)) - np.repeat(starts, lengths)
    w = position_weights(int(lengths.max()))
    h = np.add.reduceat((values.astype(np.uint64) + np.uint64(1)) * w[pos], starts)
    return mix64(h + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def piece_starts(cp: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Start of every match of the byte-level pre-token pattern.

    A piece is a contraction ('s 't 're 've 'm 'll 'd), or a run of letters,
    numbers or other characters with one blank before it, or white space; of
    white space before a visible character the last one stands apart.
    """
    n = len(cp)
    if not n:
        return np.zeros(0, dtype=np.int64)
    cls = char_classes()[cp]
    first = np.zeros(n + 1, dtype=bool)
    first[bounds] = True
    last = first[1:]
    first = first[:-1]
    space = cls == SPACE
    prev_cls = np.empty_like(cls)
    prev_cls[0], prev_cls[1:] = OTHER, cls[:-1]
    prev_blank = np.zeros(n, dtype=bool)
    prev_blank[1:] = cp[:-1] == 32
    next_visible = np.zeros(n, dtype=bool)
    next_visible[:-1] = ~space[1:]
    next_visible &= ~last
    start = np.where(space, (prev_cls != SPACE) | next_visible, (cls != prev_cls) & ~prev_blank)
    start |= first
    quote = np.flatnonzero((cp == 39) & start)
    if len(quote):
        text_end = bounds[np.searchsorted(bounds, quote, side="right")]
        at = lambda k: np.where(quote + k < text_end, cp[np.minimum(quote + k, n - 1)], 0)
        one, two = at(1), at(2)
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        k = np.where(single, 1, np.where(double, 2, 0))
        hit = k > 0
        start[quote[hit] + 1] = False
        after = quote[hit] + 1 + k[hit]
        start[after[after < n]] = True
    return np.flatnonzero(start)


def binary_slices(flat: np.ndarray, bounds: np.ndarray):
    """Arrow large-binary array of the byte ranges of a flat array of fixed-width values."""
    import pyarrow as pa

    data = np.ascontiguousarray(flat)
    offsets = np.asarray(bounds, dtype=np.int64) * data.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


class RowTable:
    """Row numbers by 64-bit hash: an array with one slot per hash prefix, a dict for the rest."""

    def __init__(self, bits: int = 22):
        self.shift = np.uint64(64 - bits)
        self.key = np.zeros(1 << bits, dtype=np.uint64)
        self.at = np.zeros(1 << bits, dtype=np.int32)
        self.rest: dict[int, int] = {}
        self.count = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is unknown."""
        slot = (keys >> self.shift).astype(np.int64)
        rows = np.where((self.key[slot] == keys) & (keys != 0), self.at[slot], -1).astype(np.int64)
        if self.rest:
            lost = np.flatnonzero(rows < 0)
            rows[lost] = [self.rest.get(k, -1) for k in keys[lost].tolist()]
        return rows

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Number new, distinct keys in order; their rows."""
        rows = np.arange(self.count, self.count + len(keys))
        self.count += len(keys)
        slot = (keys >> self.shift).astype(np.int64)
        free = np.flatnonzero((self.key[slot] == 0) & (keys != 0))
        self.key[slot[free]], self.at[slot[free]] = keys[free], rows[free]
        beaten = (self.key[slot] != keys) | (keys == 0)
        self.rest.update(zip(keys[beaten].tolist(), rows[beaten].tolist(), strict=True))
        return rows


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, a place of each, and the number of each input hash among them."""
    import pandas as pd

    inverse, keys = pd.factorize(hashes)
    where = np.empty(len(keys), dtype=np.int64)
    where[inverse] = np.arange(len(inverse))
    return keys, where, inverse


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every span, one after another."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts - starts, counts)

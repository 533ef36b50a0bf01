"""Periodic runs of words, found by multi-scale minimizers (operator 12).

A run is a stretch of consecutive words with smallest period q, at least
``MIN_LENGTH`` words and three periods long, that no neighbouring word extends.

* Periods up to ``SHORT`` are found by comparing the words with those one lag
  earlier, for each lag.
* Longer periods belong to scales.  A scale's grams of K words cover periods
  from lo + 1 to K.  Within a run of such a period a gram recurs at distance q
  and nowhere in between, because it holds a whole period.  A gram is kept if it
  is the least of some window of ``2 lo + 3 - K`` grams; a run of three periods
  holds two such windows one period apart, so two neighbouring equal minimizers
  lie q apart.  Each such pair, if its distance is in the scale's range, is a seed.
* A seed is extended to both sides, and counts if the stretch is long enough.
  Stretches with the same ends are one run, of the smallest period found.

Grams are named exactly: a gram's number is that of the pair of numbers of its
two halves, so equal numbers are equal words and no hash decides anything; a
gram that does not recur in its text needs no number.  Extension goes down the
same numbers, from long to short.

Every text is worked on whole, in chunks of texts; memory follows a chunk, or
one text if it is longer (some 100 bytes a word).  Null and empty texts have no
words and no runs.  Rows are answered one by one, so repeated rows repeat their
answers; an empty table gives an empty result.  The kept columns may have any
name but those of the answer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv

MIN_LENGTH = 24
MIN_PERIODS = 3
SHORT = 16
CHUNK_WORDS = 1 << 17

# Fixed value: a word is a stretch without blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
_find_words = re.compile(WORD).findall


def stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edge = np.diff(np.concatenate([[0], equal.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def scales(longest: int) -> Iterator[tuple[int, int]]:
    """(lo, K): the gram lengths, each half as long again as the last, and the periods they go beyond."""
    lo = SHORT
    while MIN_PERIODS * (lo + 1) <= longest:
        k = lo + lo // 2
        yield lo, k
        lo = k


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every window of ``w`` values (one pass up and one down in blocks of ``w``)."""
    n = len(x)
    padded = np.concatenate([x, np.full(-n % w, x.max(initial=0), dtype=x.dtype)]).reshape(-1, w)
    up = np.minimum.accumulate(padded, axis=1).reshape(-1)
    down = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(down[: n - w + 1], up[w - 1 : n])


def is_minimizer(order: np.ndarray, w: int) -> np.ndarray:
    """Whether a place is the least of some window of ``w`` places."""
    if len(order) < w:
        return np.zeros(len(order), dtype=bool)
    least = sliding_min(order, w)
    # the greatest of the windows' least values over the windows that hold a place
    edge = np.zeros(w - 1, dtype=order.dtype)
    around = ~sliding_min(~np.concatenate([edge, least, edge]), w)
    return around == order


class Names:
    """Numbers of the grams of 1, 2, 4, ... words that lie within one text and recur in it; -1 elsewhere.

    ``codes``: word numbers of their own in every text, ``ends``: for every word, the end of its text.
    A gram that holds one that does not recur does not recur, so ever fewer grams are numbered."""

    def __init__(self, codes: np.ndarray, ends: np.ndarray):
        self.left = ends - np.arange(len(codes))  # words from here to the text's end
        self.levels = [self._recurring(codes)]

    @staticmethod
    def _recurring(keys: np.ndarray) -> np.ndarray:
        named = pd.factorize(keys)[0].astype(np.int32)
        return np.where(np.bincount(named)[named] > 1, named, np.int32(-1)) if len(named) else named

    def paired(self, a: np.ndarray, b_offset: int, length: int) -> np.ndarray:
        """Numbers of grams of ``length`` words by their beginnings (``a``) and those ``b_offset`` words later."""
        at = np.flatnonzero((a >= 0) & (self.left >= length))
        at = at[a[at + b_offset] >= 0]
        named = np.full(len(a), -1, dtype=np.int32)
        named[at] = self._recurring(a[at].astype(np.int64) << 32 | a[at + b_offset])
        return named

    def only(self, kept: np.ndarray, ends: np.ndarray) -> None:
        """Go on with the words of some texts only."""
        self.left = ends - np.arange(len(ends))
        self.levels = [level[kept] for level in self.levels]

    def level(self, j: int) -> np.ndarray:
        while len(self.levels) <= j:
            half = 1 << (len(self.levels) - 1)
            self.levels.append(self.paired(self.levels[-1], half, 2 * half))
        return self.levels[j]

    def grams(self, k: int) -> np.ndarray:
        j = k.bit_length() - 1
        return self.level(j) if 1 << j == k else self.paired(self.level(j), k - (1 << j), k)

    def extend(self, at: np.ndarray, lag: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The stretch around word ``at`` of period ``lag``, within its text: its start and end."""
        right, left = at.copy(), at.copy()
        top = len(self.levels) - 1
        for j in range(top, -1, -1):
            names, step = self.levels[j], 1 << j
            for moving, forward in ((right, True), (left, False)):
                active = np.arange(len(at))
                while len(active):  # the longest gram may fit more than once, the others once
                    a = moving[active] if forward else moving[active] - step
                    ok = (a >= starts[active]) & (a + lag[active] + step <= ends[active])
                    active, a = active[ok], a[ok]
                    active = active[(names[a] >= 0) & (names[a] == names[a + lag[active]])]
                    moving[active] += step if forward else -step
                    if j < top:
                        break
        return left, right + lag


def find_runs(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of every run, by start, of texts given as word numbers (from 0) between ``bounds``."""
    lengths = np.diff(bounds)
    found = []
    # a number of its own after each text ends every stretch of equal words there
    ends = bounds[1:] + np.arange(1, len(bounds))
    flat = np.empty(len(codes) + len(lengths), dtype=np.int64)
    flat[ends - 1] = -1 - np.arange(len(lengths))
    inside = np.ones(len(flat), dtype=bool)
    inside[ends - 1] = False
    flat[inside] = codes
    for q in range(1, min(SHORT, int(lengths.max(initial=0)) // MIN_PERIODS) + 1):
        a, b = stretches(flat[:-q] == flat[q:])
        long = b - a + q >= max(MIN_LENGTH, MIN_PERIODS * q)
        found.append((a[long], b[long] + q, np.full(int(long.sum()), q)))
    # from here on only words of texts that are long enough, and hold a recurring gram of the scale
    whole, texts = np.flatnonzero(inside), np.repeat(np.arange(len(lengths)), lengths)
    names = None
    for lo, k in scales(int(lengths.max(initial=0))):
        able = lengths >= MIN_PERIODS * (lo + 1)
        if names is not None:
            recurs = np.zeros(len(lengths), dtype=bool)
            recurs[texts[names.level(k.bit_length() - 1) >= 0]] = True
            able &= recurs
        kept = able[texts]
        if not kept.any():
            break
        if names is None or kept.sum() < 0.8 * len(kept):
            whole, texts = whole[kept], texts[kept]
            new = np.flatnonzero(np.diff(texts, prepend=-1))
            own_ends = np.repeat(np.append(new[1:], len(texts)), np.diff(new, append=len(texts)))
            own_starts = np.repeat(new, np.diff(new, append=len(texts)))
            if names is None:
                names = Names(texts << 32 | flat[whole], own_ends)
            else:
                names.only(kept, own_ends)
        grams = names.grams(k)
        # a fixed order of the grams; grams that leave their text come last
        order = np.where(grams >= 0, tv.mix64(grams.astype(np.uint64) + np.uint64(1)) >> np.uint64(1), np.uint64(2**63))
        at = np.flatnonzero(is_minimizer(order, MIN_PERIODS * (lo + 1) - k + 1 - (lo + 1)) & (grams >= 0))
        at = at[np.argsort(grams[at], kind="stable")]
        first, second = at[:-1], at[1:]
        lag = second - first
        seed = (grams[first] == grams[second]) & (own_ends[first] == own_ends[second]) & (lag > lo) & (lag <= k)
        first, lag = first[seed], lag[seed]
        a, b = names.extend(first, lag, own_starts[first], own_ends[first])
        long = b - a >= MIN_PERIODS * lag
        found.append((whole[a[long]], whole[b[long] - 1] + 1, lag[long]))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    start, end, period = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    once = np.ones(len(start), dtype=bool)
    once[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[once], end[once], period[once]
    order = np.lexsort((period, start))
    text = np.searchsorted(ends, start[order], side="right")  # take the separators away again
    return start[order] - text, end[order] - text, period[order]


def _answers(texts: list[str]) -> Iterator[tuple[int, list[dict], str]]:
    """Words, runs and collapsed text of each text."""
    words = [_find_words(t) for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    flat = np.array([w for ws in words for w in ws], dtype=object)
    codes = pd.factorize(flat)[0] if len(flat) else np.zeros(0, dtype=np.int64)
    start, end, period = find_runs(codes, bounds)
    drops = np.zeros(len(flat) + 1, dtype=np.int64)
    np.add.at(drops, start + period, 1)
    np.add.at(drops, end, -1)
    dropped = np.cumsum(drops) > 0
    cuts = np.searchsorted(start, bounds)
    for i, ws in enumerate(words):
        a, b, at = cuts[i], cuts[i + 1], bounds[i]
        runs = [{"start": int(s - at), "length": int(e - s), "period": int(q)} for s, e, q in zip(start[a:b], end[a:b], period[a:b], strict=True)]
        kept = ws if a == b else [w for w, gone in zip(ws, dropped[at : at + len(ws)].tolist(), strict=True) if not gone]
        yield len(ws), runs, " ".join(kept)


RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])


def periodic_runs(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, n_words, runs (start word, length and period, by start and period) and
    collapsed (the words that no run holds after its first period, joined by one blank) of every row."""
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tv.release()
        for batch in batches:
            for part, texts in tv.text_slices(batch, len(keep), limit=6 * CHUNK_WORDS):
                n, runs, collapsed = zip(*_answers(texts), strict=True)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n, pa.int64()), pa.array(runs, run_type), pa.array(collapsed, pa.string())], names=schema.names)

    return df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(run, schema)


def repeat_tails(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with every tenth text's tail made periodic, by the CRC of its id: from word a on, word i becomes
    word a + (i - a) % p, and words are joined by one blank.  Null ids leave their text as it is."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), F.lit(1))
    n = F.size("__words").cast("long")
    tailed = df.withColumn("__words", F.when(h % 10 == 0, words))
    tailed = tailed.withColumn("__a", F.when(n > 0, g % n))
    tailed = tailed.withColumn("__p", F.when(n > 0, 1 + F.floor((n - F.col("__a")) / (3 + g % 8)).cast("long")))

    def at(i: Column) -> Column:
        a, p = F.col("__a"), F.col("__p")
        return F.get("__words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))

    made = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), at), " ")
    return tailed.withColumn(text, F.when(F.coalesce(n, F.lit(0)) > 0, made).otherwise(F.col(text))).drop("__words", "__a", "__p")


def strongest(runs: Column) -> Column:
    """The run with the most periods, exactly compared; ties to the smaller start, then period."""

    def before(x: Column, y: Column) -> Column:
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        by_place = F.when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1)).otherwise(F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))
        return F.when(a > b, -1).when(a < b, 1).otherwise(by_place)

    return F.get(F.array_sort(runs, before), F.lit(0))

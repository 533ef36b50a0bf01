"""Greedy word-piece token counts by a linear longest-match automaton (operator 9).

The vocabulary is a trie.  A node's failure link says where matching goes on
when no longer piece is possible, and its popped count how many pieces are
settled by following it, so a word's greedy longest-match length comes from
one pass over its symbols; no piece is built and nothing is read twice.  Each
distinct word goes through the automaton once per worker.

Words are those of the vocabulary file: NFC, lower case, contractions, runs of
letters, single numbers, runs of other signs; their bytes stand as printable
characters, and the last one carries the end mark.  A word with a symbol that
no piece covers counts as one unknown token.  Null, empty and blank texts
count 0; repeated rows are counted alike; an empty table gives an empty one.
Only the text and the kept columns are read.
"""

from __future__ import annotations

import json
import unicodedata
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .bpe import byte_chars

END = "</w>"
CACHE_WORDS = 1 << 20


class Automaton:
    """Trie with failure links over symbols; ``first`` are pieces that begin a word, ``later`` those that continue one."""

    def __init__(self, first: list[tuple[str, ...]], later: list[tuple[str, ...]] | None = None):
        self.next: list[dict[str, int]] = [{}]
        piece = [False]

        def insert(root: int, symbols: tuple[str, ...]) -> None:
            at = root
            for s in symbols:
                if s not in self.next[at]:
                    self.next[at][s] = len(self.next)
                    self.next.append({})
                    piece.append(False)
                at = self.next[at][s]
            piece[at] = True

        for p in first:
            insert(0, p)
        self.rest = 0  # where a piece after the first one begins
        if later is not None:
            self.rest = len(self.next)
            self.next.append({})
            piece.append(False)
            for p in later:
                insert(self.rest, p)
        self.fail = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        queue = deque(sorted({0, self.rest}))
        while queue:  # by depth, so that links point to finished nodes
            u = queue.popleft()
            for s, v in self.next[u].items():
                if piece[v]:
                    self.fail[v], self.popped[v] = self.rest, 1
                else:
                    z, k = self.fail[u], self.popped[u]
                    while z >= 0 and s not in self.next[z]:
                        k += self.popped[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[v], self.popped[v] = self.next[z][s], k
                queue.append(v)

    def count(self, symbols: list[str] | tuple[str, ...] | str) -> int:
        """Number of greedy longest-match pieces, 1 if some symbol cannot be matched."""
        step, fail, popped = self.next, self.fail, self.popped
        at = n = 0
        for s in symbols:
            while s not in step[at]:
                n += popped[at]
                at = fail[at]
                if at < 0:
                    return 1
            at = step[at][s]
        while at != self.rest:
            if fail[at] < 0:
                return 1 if symbols else 0
            n += popped[at]
            at = fail[at]
        return n


def word_starts(cp: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every word or white-space run, and whether it is a word."""
    n = len(cp)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    cls = tv.char_classes()[cp]
    first = np.zeros(n + 1, dtype=bool)
    first[bounds] = True
    start = np.append(True, cls[1:] != cls[:-1]) | (cls == tv.NUMBER) | first[:-1]
    quote = np.flatnonzero((cp == 39) & start)
    if len(quote):
        end = bounds[np.searchsorted(bounds, quote, side="right")]
        one, two = (np.where(quote + k < end, cp[np.minimum(quote + k, n - 1)], 0) for k in (1, 2))
        pair = one.astype(np.int64) << 32 | two
        k = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]), 2, 0))
        hit = k > 0
        start[quote[hit] + 1] = False
        after = quote[hit] + 1 + k[hit]
        start[after[after < n]] = True
    at = np.flatnonzero(start)
    return at, cls[at] != tv.SPACE


class WordCounter:
    """Token counts of texts under a vocabulary file with end marks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            parsed = json.load(f)
        special = {t["content"] for t in parsed["added_tokens"]}
        pieces = [(*t[: -len(END) - 1], t[-len(END) - 1] + END) if t.endswith(END) and t != END else tuple(t) for t in parsed["model"]["vocab"] if t not in special]
        self.automaton, self.char = Automaton(pieces), byte_chars()
        self.forget()

    def forget(self) -> None:
        self.rows, self.known = tv.RowTable(), np.zeros(1 << 14, dtype=np.int32)

    def count_word(self, word: str) -> int:
        symbols = [self.char[b] for b in word.encode("utf-8", "surrogatepass")]
        symbols[-1] += END
        return self.automaton.count(symbols)

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words and tokens of every text."""
        texts = [t.lower() if t.isascii() else unicodedata.normalize("NFC", t).lower() for t in texts]
        cp, bounds = tv.code_points(texts)
        starts, shown = word_starts(cp, bounds)
        keys, where, inverse = tv.distinct(tv.run_hashes(cp, starts))
        if self.rows.count > CACHE_WORDS:
            self.forget()
        rows = self.rows.find(keys)
        new = np.flatnonzero(rows < 0)
        if len(new):
            rows[new] = self.rows.add(keys[new])
            while self.rows.count > len(self.known):
                self.known = np.concatenate([self.known, np.zeros_like(self.known)])
            ends = np.append(starts[1:], len(cp))
            cut = lambda j: cp[starts[j] : ends[j]].tobytes().decode("utf-32-le", "surrogatepass")
            self.known[rows[new]] = [self.count_word(cut(j)) if shown[j] else 0 for j in where[new].tolist()]
        tokens = np.concatenate([[0], np.cumsum(self.known[rows[inverse]])])
        words = np.concatenate([[0], np.cumsum(shown)])
        at = np.searchsorted(starts, bounds)
        return np.diff(words[at]), np.diff(tokens[at])


def token_counts(df: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, n_words and n_tokens of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = tv.held(("words", path), lambda: WordCounter(path))
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for a, b in tv.chunks(texts):
                words, tokens = counter.count(texts[a:b])
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:-1]), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[*keep, "n_words", "n_tokens"])

    schema = df.select(*keep).schema.add("n_words", "long").add("n_tokens", "long")
    return df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(run, schema)

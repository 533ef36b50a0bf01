"""Toxicity of whole texts behind spelling tricks (operator 7).

A noisy channel explains odd tokens: a letter may be written as a look-alike
digit or sign, repeated (doubled letters too), or set apart by blanks and marks,
where a blank may also be a word's edge.  The Viterbi path
through the lattice of readings, under a letter-trigram model of all texts,
restores the token.  Written and restored words then give evidence: words and
word beginnings that mark toxic texts beyond chance, each explaining toxic
rows that stronger ones leave open or found in many kinds of texts, joined by
a noisy-or.

The letter model counts every document.  Labels are learned from a bounded
sample of labelled rows (``SAMPLE_ROWS``, those with the smallest id hashes);
equal texts in it count once.  A text is scored by decoding only tokens of which
some reading can begin like a word of the evidence (``Stems``); no other token
can hit.  Decoding is exact and linear in a token's length, as is all else.
Null and empty texts hold no word and get the score of texts without evidence;
other columns are not looked at, equal texts have equal scores.  Documents labelled twice are sampled once,
toxic if any label says so; null labels are not used.  Without a toxic row every
score is 0.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.sink import materialize
from . import textvec as tv

SAMPLE_ROWS = 30_000
PREFIXES = (4, 5, 6)

# Letters that a sign may stand for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SEPARATORS = "-._*'~:/,"

OTHER_LETTER, SYMBOLS = 60, 61


def letter_codes(cp: np.ndarray) -> np.ndarray:
    """Letter number of code points of lower-cased text: a-z, then 0xDF to 0xFF, one for all other letters; 0 is a word's edge."""
    out = np.where(tv.char_classes()[cp] == tv.LETTER, OTHER_LETTER, 0)
    out = np.where((cp >= 97) & (cp <= 122), cp.astype(np.int64) - 96, out)
    return np.where((cp >= 0xDF) & (cp <= 0xFF) & (cp != 0xF7), cp.astype(np.int64) - 0xDF + 27, out).astype(np.int64)


def trigram_counts(df: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of letter trigrams over all texts; the table's size is the alphabet's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tv.release()
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in tv.chunks(texts):
                codes = letter_codes(np.frombuffer(("  ".join(["", *texts[a:b], ""])).lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
                # a run of edges is one edge
                codes = codes[(codes > 0) | (np.append(codes[1:], 1) > 0) | (np.append(1, codes[:-1]) > 0)]
                total += np.bincount((codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:], minlength=SYMBOLS**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    rows = df.select(F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(run, "gram long, n long")
    table = np.zeros(SYMBOLS**3, dtype=np.int64)
    for r in rows.groupBy("gram").agg(F.sum("n").alias("n")).toLocalIterator():  # SYMBOLS ** 3 rows at most
        table[r["gram"]] = r["n"]
    return table


def trigram_logs(counts: np.ndarray) -> np.ndarray:
    """Log probability of a letter after two others: trigrams, backed by bigrams and letters."""
    c = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
    one = (c.sum(axis=(0, 1)) + 0.5) / (c.sum() + 0.5 * SYMBOLS)
    two = (c.sum(axis=0) + 8 * one) / (c.sum(axis=(0, 2)) + 8)[:, None]
    three = (c + 8 * two[None]) / (c.sum(axis=2) + 8)[:, :, None]
    return np.log(three).astype(np.float32)


class Restorer:
    """Viterbi decoding of odd tokens under the letter model."""

    MEMO_CHARS = 1 << 23

    def __init__(self, logs: np.ndarray):
        self.logs = logs
        self.memo: dict[str, str] = {}
        self.held = 0  # characters of the remembered tokens

    @staticmethod
    def odd(token: str) -> bool:
        """Whether a token (lower case, no signs at its ends) has a reading besides itself."""
        if token.isalpha():
            return re.search(r"(.)\1", token) is not None
        return sum(c.isalpha() for c in token) >= 2 or (len(token) >= 3 and any(c.isalpha() for c in token))

    def restore(self, token: str) -> str:
        if token not in self.memo:
            if self.held > self.MEMO_CHARS:
                self.memo.clear()
                self.held = 0
            self.memo[token] = self._viterbi(token)
            self.held += len(token) + 64
        return self.memo[token]

    def restore_run(self, run: str) -> list[str]:
        """The words of letters that were set apart: a blank between them joins them or is a word's edge."""
        return self._viterbi(run, edges=True).split()

    def _viterbi(self, token: str, edges: bool = False) -> str:
        """The best path, exactly: a state is the last two letters; the words behind it are linked backwards."""
        code = {c: int(k) for c, k in zip(token, letter_codes(np.array([ord(c) for c in token], dtype=np.uint32)), strict=True)}
        code |= {r: ord(r) - 96 for c in code for r in LOOKALIKES.get(c, "")}
        logs = self.logs
        states: dict[tuple[int, int, str], tuple[float, tuple | None]] = {(0, 0, ""): (0.0, None)}
        for c in token:
            readings = [(c, 0.0)] if c.isalpha() else [(r, -0.5) for r in LOOKALIKES.get(c, "")]
            new: dict[tuple[int, int, str], tuple[float, tuple | None]] = {}
            if edges:
                for (a, b, _), (score, word) in list(states.items()):
                    ended = score + float(logs[a, b, 0])
                    if b and ended > states.get((b, 0, ""), (-math.inf, None))[0]:
                        states[b, 0, ""] = ended, (word, " ")
            for (a, b, last), (score, word) in states.items():
                ways = []
                for letter, cost in readings:
                    k = code[letter]
                    ways.append(((b, k, letter), score + cost + float(logs[a, b, k]), letter))
                    if letter == last:  # one letter written again
                        ways.append(((a, b, last), score + cost - 2.0, ""))
                if not c.isalpha():  # a mark between letters
                    ways.append(((a, b, last), score - (0.5 if c in SEPARATORS else 8.0), ""))
                for key, total, letter in ways:
                    if key not in new or total > new[key][0]:
                        new[key] = total, (word, letter) if letter else word
            states = new
        _, link = max(((s + float(logs[a, b, 0]), w) for (a, b, _), (s, w) in states.items()), key=lambda x: x[0], default=(0.0, None))
        letters = []
        while link is not None:
            link, letter = link
            letters.append(letter)
        return "".join(reversed(letters))


# Signs beside letters and digits that a word may begin or end with.
WORD_SIGNS = frozenset("@$!|+(€£_")


def without_edges(token: str) -> str:
    """A token without the signs at its ends that stand for no letter, or without its last sign if that is written often."""
    a, b = 0, len(token)
    kept = lambda c: c.isalnum() or c in WORD_SIGNS
    while a < b and not kept(token[a]):
        a += 1
    while b > a and not kept(token[b - 1]):
        b -= 1
    if b == len(token) and b > a and not token[-1].isalnum() and token[-1] != "_":
        c = b
        while c > a and token[c - 1] == token[-1]:
            c -= 1
        b = c if b - c >= 3 else b
    return token[a:b]


def letters_and_digits(token: str) -> str:
    """A token without the signs at its ends."""
    a, b = 0, len(token)
    while a < b and not token[a].isalnum():
        a += 1
    while b > a and not token[b - 1].isalnum():
        b -= 1
    return token[a:b]


# Letters that one sign may stand for are one class; a word's skeleton is its classes, equal neighbours once.
_CLASS = {"l": "i"}
_CLASSES_OF = {c: frozenset(_CLASS.get(r, r) for r in readings) for c, readings in LOOKALIKES.items()}


def skeleton(word: str) -> str:
    """What all spellings that can be read as a word have in common."""
    classes = [_CLASS.get(c, c) for c in word if c.isalpha()]
    return "".join(c for i, c in enumerate(classes) if not i or classes[i - 1] != c)


class Stems:
    """Skeletons of the evidence, to tell tokens that no reading can make a hit."""

    def __init__(self, evidence):
        self.nodes: list[dict[str, int]] = [{}]
        self.ends: set[int] = set()
        self.last: list[str] = [""]
        for word in evidence:
            at = 0
            for c in skeleton(word.rstrip("*")):
                if c not in self.nodes[at]:
                    self.nodes[at][c] = len(self.nodes)
                    self.nodes.append({})
                    self.last.append(c)
                at = self.nodes[at][c]
            self.ends.add(at)

    def may_begin(self, token: str, anywhere: bool = False) -> bool:
        """Whether some reading of the token (of a part of it, if ``anywhere``) begins like the evidence."""
        if 0 in self.ends:
            return True
        at = {0}
        for c in token:
            classes = (_CLASS.get(c, c),) if c.isalpha() else _CLASSES_OF.get(c, ())
            then = {0} if anywhere else set()
            for node in at:
                if not c.isalpha():
                    then.add(node)  # left out
                for k in classes:
                    if self.last[node] == k:
                        then.add(node)
                    if k in self.nodes[node]:
                        then.add(self.nodes[node][k])
            if not self.ends.isdisjoint(then):
                return True
            if not then:
                return False
            at = then
        return False


def token_words(token: str, restorer: Restorer | None, stems: Stems | None = None) -> list[str]:
    """The words that a token shows: as written, in parts, and restored (with ``stems``: if that can begin like one)."""
    low = token.lower()
    if low.isalpha() and not Restorer.odd(low):
        return [low]
    words = [w for w in re.split(r"[\W\d_]+", low) if w]
    core = without_edges(low)
    if restorer and core and not core.isdigit():
        for form in {core, letters_and_digits(low)}:
            if form and Restorer.odd(form) and (stems is None or stems.may_begin(form)):
                words.append(restorer.restore(form))
    return words


def run_words(run: str, restorer: Restorer | None, stems: Stems | None = None) -> list[str]:
    """The words that letters set apart show: as one token, and parted where words end."""
    # the first letter may be a word of its own ("a", "I") whatever the letter model makes of it
    parts = lambda r: restorer.restore_run(r) if restorer and (stems is None or stems.may_begin(r, anywhere=True)) else ()
    return [w for r in (run.lower(), run[1:].lower()) if r for w in [*token_words(r, restorer, stems), *parts(r)]]


def word_features(word: str) -> list[str]:
    """The word and its beginnings (marked by a star)."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


def spaced_runs(tokens: list[str]) -> list[str]:
    """Three or more one-character tokens in a row, joined."""
    out, run = [], []
    for t in [*tokens, ""]:
        if len(t) == 1 and (t.isalpha() or t in LOOKALIKES):
            run.append(t)
            continue
        if len(run) >= 3:
            out.append("".join(run))
        run = []
    return out


def text_features(text: str, restorer: Restorer | None, around: bool = True) -> dict[str, int]:
    """A text's features, each with a hash of the words around it where it comes first (without ``around``: 0)."""
    tokens = text.split()
    first: dict[str, int] = {}
    for i, t in enumerate(tokens):
        first.setdefault(t, i)
    out: dict[str, int] = {}
    for t, i in first.items():
        beside = None if around else 0
        for w in token_words(t, restorer):
            for f in word_features(w):
                if f not in out:
                    beside = hash_text(" ".join(tokens[max(0, i - 1) : i] + tokens[i + 1 : i + 2]).lower()) if beside is None else beside
                    out[f] = beside
    for r in {*spaced_runs(tokens)}:
        for w in run_words(r, restorer):
            for f in word_features(w):
                out.setdefault(f, hash_text(r) if around else 0)
    return out


@dataclass
class ToxicModel:
    logs: np.ndarray
    evidence: dict[str, float] = field(default_factory=dict)  # word or word beginning to its share of toxic rows
    base: float = 0.0  # share of toxic rows without evidence
    name: str = ""

    def score(self, hits: set[str]) -> float:
        return 1.0 - (1.0 - self.base) * math.prod(1.0 - self.evidence[h] for h in hits)


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, rows: int) -> DataFrame:
    """(toxic, text) of at most ``rows`` labelled documents, those with the smallest id hashes."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("int").alias("__toxic"))
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(rows)
    texts = docs.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    # ``rows`` narrow rows at most
    return texts.join(F.broadcast(chosen), "__id").select("__toxic", "__text")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = SAMPLE_ROWS) -> ToxicModel:
    """Letter model of all ``docs``; evidence from a bounded sample of the rows that ``labels`` marks."""
    model = ToxicModel(trigram_logs(trigram_counts(docs, text)))
    logs = model.logs

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = tv.held(("restorer", name), lambda: Restorer(logs))  # a worker's tasks share what it has decoded
        for batch in batches:
            toxic, texts = (c.to_pylist() for c in batch.columns)
            held = [sorted(text_features(t, restorer, around=bool(bad)).items()) for t, bad in zip(texts, toxic, strict=True)]
            names = [[f for f, _ in h] for h in held]
            around = [[c for _, c in h] if bad else None for h, bad in zip(held, toxic, strict=True)]
            columns = [pa.array(toxic, pa.int32()), pa.array(names, pa.list_(pa.string())), pa.array(around, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "features", "around"])

    name = uuid.uuid4().hex
    sample = labelled_sample(docs, labels, doc_id, text, label, rows).distinct().repartition(64)
    found = materialize(sample.mapInArrow(features, "toxic int, features array<string>, around array<long>"), "toxic-sample")
    size = {r["toxic"]: r["n"] for r in found.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = size.get(1, 0), size.get(0, 0)
    if not bad:
        return model
    prior = bad / (bad + good)
    pairs = found.select("toxic", F.explode("features").alias("f"))
    counts = pairs.groupBy("f").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n"))
    # rarer ones are neither evidence nor common; written once for the three readings below
    counts = materialize(counts.where((F.col("n") >= 3) | (2 * F.col("n") >= bad + good)), "toxic-counts")
    # log likelihood ratio against the prior, beyond what the best of so many features reaches by chance
    share = F.col("bad") / F.col("n")
    gain = 2 * (F.col("bad") * F.log(share / prior) + (F.col("n") - F.col("bad")) * F.log(F.greatest(1 - share, F.lit(1e-12)) / max(1 - prior, 1e-12)))
    able = counts.where((F.col("bad") >= 3) & (share >= 0.75) & (share > prior))
    tested = max(2, counts.where("n >= 3").count())
    able = able.where(gain >= 2 * math.log(tested)).select("f", "bad", "n")
    table = {r["f"]: (r["bad"], r["n"]) for r in able.collect()}  # bounded by the sample
    # what at least half of the sample's rows hold tells no text from another
    common = {r["f"] for r in counts.where(2 * F.col("n") >= bad + good).select("f").collect()}
    rows_with: dict[str, set[int]] = defaultdict(set)
    kinds_with: dict[str, Counter] = defaultdict(Counter)
    around_with: dict[str, Counter] = defaultdict(Counter)
    n_rows = 0
    for n_rows, r in enumerate(found.where("toxic = 1").select("features", "around").toLocalIterator(), 1):
        kind = min((hash_text(f) for f in r["features"] if f not in common), default=0)
        for f, around in zip(r["features"], r["around"], strict=True):
            if f in table:
                rows_with[f].add(n_rows)
                kinds_with[f][kind] += 1
                around_with[f][around] += 1
    enough = math.log(tested) / math.log(1 / prior)  # so many rows are no accident
    open_rows, chosen = set(range(1, n_rows + 1)), []
    weight = lambda f: len(rows_with[f]) * math.log(table[f][0] / table[f][1] / prior)
    for f in sorted(rows_with, key=lambda f: (-round(weight(f), 6), not f.endswith("*"), -len(f), f)):
        stem = f.rstrip("*")
        if any(stem.startswith(g.rstrip("*")) or g.rstrip("*").startswith(stem) for g in chosen):
            continue  # another length of the same beginning says it already
        clean = table[f][1] - table[f][0]
        newly = len(rows_with[f] & open_rows)
        # copies of one text, near ones too, mostly share a kind and the words around: they are no further evidence
        apart, wanted = max(effective_number(kinds_with[f]), effective_number(around_with[f])), max(3, enough, 4 * clean)
        held = min(table[f][0], apart)
        sure = held >= 0.75 * (held + clean) and gain_of(held, held + clean, prior) >= 2 * math.log(tested)
        if sure and apart >= wanted and (newly >= wanted or apart >= 1.5 * wanted):
            chosen.append(f)
            open_rows -= rows_with[f]
    model.evidence = {f: (table[f][0] + 0.5) / (table[f][1] + 1.0) for f in chosen}
    model.base = min(0.4, (len(open_rows) + 0.5) / (len(open_rows) + good + 1.0))
    return model


def gain_of(bad: float, n: float, prior: float) -> float:
    """Log likelihood ratio, times two, of ``bad`` toxic rows among ``n`` against the prior."""
    clean = n - bad
    return 2 * (bad * math.log(bad / n / prior) + (clean * math.log(clean / n / max(1 - prior, 1e-12)) if clean else 0.0))


def effective_number(counts: Counter) -> float:
    """How many groups of equal size are as diverse as these (inverse Simpson index)."""
    return sum(counts.values()) ** 2 / sum(n * n for n in counts.values())


def hash_text(s: str) -> int:
    """A 62-bit hash that is the same in every process."""
    import zlib

    raw = s.encode("utf-8", "surrogatepass")
    return (zlib.crc32(raw) * 0x9E3779B1 + zlib.adler32(raw) * 0x85EBCA77) * 0xC2B2AE3D27D4EB4F % (1 << 62)


class Scorer:
    """Scores chunks of texts; the evidence of every distinct token is found once per worker."""

    def __init__(self, model: ToxicModel):
        self.model, self.restorer = model, Restorer(model.logs)
        self.stems = Stems(model.evidence)
        self.rows = tv.RowTable(21)
        self.hits: dict[int, tuple[str, ...]] = {}

    def _evidence(self, token: str, words=token_words) -> tuple[str, ...]:
        known = self.model.evidence
        return tuple(f for w in words(token, self.restorer, self.stems) for f in word_features(w) if f in known)

    def score(self, texts: list[str]) -> list[float]:
        cp, bounds = tv.code_points(texts)
        found: dict[int, set[str]] = defaultdict(set)
        space = tv.char_classes()[cp] == tv.SPACE
        first = np.zeros(len(cp) + 1, dtype=bool)
        first[bounds] = True
        # tokens and the white space between them are runs; only tokens count
        starts = np.flatnonzero((space != np.append(True, space[:-1])) | first[:-1])
        shown = ~space[starts] if len(starts) else np.zeros(0, dtype=bool)
        ends = np.append(starts[1:], len(cp))
        keys, where, inverse = tv.distinct(tv.run_hashes(cp, starts))
        if self.rows.count > 1 << 20:
            self.rows, self.hits = tv.RowTable(21), {}
        rows = self.rows.find(keys)
        new = np.flatnonzero(rows < 0)
        if len(new):
            rows[new] = self.rows.add(keys[new])
            cut = lambda j: cp[starts[j] : ends[j]].tobytes().decode("utf-32-le", "surrogatepass")
            for r, j in zip(rows[new].tolist(), where[new].tolist(), strict=True):
                if shown[j] and (hit := self._evidence(cut(j))):
                    self.hits[r] = hit
        if self.hits:
            bad = np.isin(rows, np.fromiter(self.hits, dtype=np.int64, count=len(self.hits)))
            for at in np.flatnonzero(bad[inverse]).tolist():
                found[int(np.searchsorted(bounds, starts[at], side="right")) - 1].update(self.hits[int(rows[inverse[at]])])
        # letters set apart: runs of one-character tokens
        single = shown & (ends - starts == 1)
        places = np.flatnonzero(single[:-4] & single[2:-2] & single[4:]) if len(single) > 4 else []
        for d in {int(np.searchsorted(bounds, starts[at], side="right")) - 1 for at in places}:
            for run in spaced_runs(texts[d].split()):
                found[d].update(self._evidence(run, run_words))
        return [self.model.score(found[i]) if i in found else self.model.base for i in range(len(texts))]


def score(df: DataFrame, model: ToxicModel, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and score (0 to 1) for every row."""
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("score", T.DoubleType())])
    model.name = model.name or uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = tv.held(("scorer", model.name), lambda: Scorer(model))
        for batch in batches:
            for part, texts in tv.text_slices(batch, len(keep)):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(scorer.score(texts), pa.float64())], names=schema.names)

    return df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(run, schema)


"""Language identification with string kernels (operator 1).

The kernel counts the n-grams (two to four characters of the lower-cased text)
that two texts share, n-gram presence only, over the square root of the
product of their n-gram numbers.  Landmark texts span a Nyström approximation;
one-versus-rest ridge regression on it gives a score per language.  A task
scores a chunk of whole texts with two matrix products: presence times
landmarks, then kernel rows times weights.

The model is fitted in the driver on a bounded sample: ``per_label`` distinct
labelled texts a language, those with the smallest hashes.  Only text and label
are read.  Null texts, and texts without a letter, get `und` and score 0;
so does every text if no labelled text exists.  Ties go to the first language
in alphabetical order.  Repeated texts count once in the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv

PER_LABEL = 300
LANDMARKS = 32  # a language
ORDERS = (2, 3, 4)
SLOT_BITS = 20
RIDGE = 1e-2
UNKNOWN = "und"


def gram_hashes(cp: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the n-gram at each place."""
    w = tv.position_weights(64)[8 * n : 8 * n + n]
    values = cp.astype(np.uint64)
    size = max(0, len(cp) - n + 1)
    h = np.zeros(size, dtype=np.uint64)
    for j in range(n):
        h += values[j : j + size] * w[j]
    return h


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts with NULs between them, and the text that owns each place."""
    lowered = [t.lower().replace("\0", " ") for t in texts]
    cp = np.frombuffer(("\0" * 3).join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return cp, np.repeat(np.arange(len(texts)), [len(t) + 3 for t in lowered])


@dataclass
class KernelModel:
    labels: list[str]
    grams: dict[int, np.ndarray]  # n-gram hashes by order; columns are numbered in this order
    landmarks: np.ndarray  # n-grams x landmarks, 0 or 1
    weights: np.ndarray  # landmarks x labels
    sharpness: float
    _tables: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_tables": {}, "landmarks": self.landmarks.astype(np.uint8)}

    def _table(self) -> None:
        first = 0
        for n, hashes in self.grams.items():
            key, col = np.zeros(1 << SLOT_BITS, dtype=np.uint64), np.zeros(1 << SLOT_BITS, dtype=np.int32)
            slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            key[slot], col[slot] = hashes, np.arange(first, first + len(hashes))
            self._tables[n] = key, col
            first += len(hashes)
        self.landmarks = self.landmarks.astype(np.float32)
        self._tables["norm"] = np.sqrt(np.maximum(self.landmarks.sum(axis=0), 1))

    def presence(self, texts: list[str]) -> np.ndarray:
        """Texts x n-grams: whether a text holds an n-gram."""
        if not self._tables:
            self._table()
        width = len(self.landmarks)
        out = np.zeros((len(texts), width), dtype=bool)
        cp, owner = joined(texts)
        flat = out.reshape(-1)
        for n in self.grams:
            key, col = self._tables[n]
            h = gram_hashes(cp, n)
            slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            at = np.flatnonzero((key[slot] == h) & (h != 0))  # 0 is an empty slot
            flat[owner[at] * width + col[slot[at]]] = True
        return out

    def kernel(self, texts: list[str]) -> np.ndarray:
        """Texts x landmarks."""
        p = self.presence(texts).astype(np.float32)
        norm = np.sqrt(np.maximum(p.sum(axis=1), 1))
        return (p @ self.landmarks) / norm[:, None] / self._tables["norm"]

    def scores(self, texts: list[str]) -> np.ndarray:
        """Texts x labels, each row adding up to 1."""
        return _softmax(self.kernel(texts) @ self.weights * self.sharpness)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def labelled_sample(train: DataFrame, text: str = "text", label: str = "lang", per_label: int = PER_LABEL) -> DataFrame:
    """(label, text): the ``per_label`` distinct texts of each label with the smallest hashes."""
    rows = train.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(label).cast("string").alias("__label"), F.col(text).alias("__text"))
    rows = rows.withColumn("__h", F.xxhash64("__text"))
    keys = rows.select("__label", "__h").distinct()
    nth = F.row_number().over(Window.partitionBy("__label").orderBy("__h"))
    chosen = keys.withColumn("__nth", nth).where(F.col("__nth") <= per_label).drop("__nth")  # the limit runs before the shuffle too
    # ``per_label`` rows a label at most
    return rows.join(F.broadcast(chosen), ["__label", "__h"]).groupBy("__label", "__h").agg(F.first("__text").alias("__text"))


def fit(train: DataFrame, text: str = "text", label: str = "lang", per_label: int = PER_LABEL, landmarks: int = LANDMARKS) -> KernelModel | None:
    """Fit on a bounded sample of labelled rows; None if there are none."""
    sample = sorted((r["__label"], r["__h"], r["__text"]) for r in labelled_sample(train, text, label, per_label).collect())
    if not sample:
        return None
    labels = sorted({x[0] for x in sample})
    texts = [x[2] for x in sample]
    y = np.array([labels.index(x[0]) for x in sample])
    marks = np.concatenate([np.flatnonzero(y == k)[:landmarks] for k in range(len(labels))])
    cp, owner = joined([texts[i] for i in marks])
    nul = np.concatenate([[0], np.cumsum(cp == 0)])
    grams, columns = {}, []
    for n in ORDERS:
        h = gram_hashes(cp, n)
        inside = np.flatnonzero(nul[n:][: len(h)] == nul[: len(h)])
        pairs = np.unique(np.stack([h[inside], owner[inside].astype(np.uint64)], axis=1), axis=0)
        held, at, count = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        often = count >= (2 if len(marks) > 3 else 1)  # an n-gram of one landmark says little
        held, at, count = held[often], at[often], count[often]
        _, one = np.unique(held >> np.uint64(64 - SLOT_BITS), return_index=True)  # one n-gram a slot
        grams[n] = held[one]
        for a, c in zip(at[one], count[one], strict=True):
            row = np.zeros(len(marks), dtype=np.float32)
            row[pairs[a : a + c, 1].astype(np.int64)] = 1
            columns.append(row)
    if not columns:
        return None
    model = KernelModel(labels, grams, np.array(columns), np.zeros((len(marks), len(labels)), dtype=np.float32), 1.0)
    k = np.concatenate([model.kernel(texts[i : i + 64]) for i in range(0, len(texts), 64)])
    values, vectors = np.linalg.eigh(k[marks].astype(np.float64))
    good = values > 1e-6 * values.max()
    half = vectors[:, good] / np.sqrt(values[good])
    phi = k @ half
    targets = np.where(y[:, None] == np.arange(len(labels)), 1.0, -1.0)
    balance = (1 / np.bincount(y, minlength=len(labels)))[y][:, None] * len(y) / len(labels)
    ridge = np.linalg.solve(phi.T @ (phi * balance) + RIDGE * len(y) * np.eye(phi.shape[1]), phi.T @ (targets * balance))
    model.weights = (half @ ridge).astype(np.float32)
    raw = k @ model.weights
    loss = lambda s: -np.log(np.maximum(_softmax(raw * s)[np.arange(len(y)), y], 1e-9)).mean()
    model.sharpness = float(min((0.5, 1, 2, 4, 8, 16), key=loss))
    return model


def predict(df: DataFrame, model: KernelModel | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred and score for every row."""
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tv.release()
        for batch in batches:
            # few rows of a matrix at a time, however short the texts
            for part, texts in tv.text_slices(batch, len(keep), 1 << 19, 128):
                cp, bounds = tv.code_points(texts)
                letters = np.concatenate([[0], np.cumsum(tv.char_classes()[cp] == tv.LETTER)])[bounds]
                known = (np.diff(letters) > 0) & (model is not None)
                s = model.scores(texts) if known.any() else np.zeros((len(texts), 1))
                best = s.argmax(axis=1)
                names = [model.labels[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
                scores = [float(min(1.0, s[i, k])) if ok else 0.0 for i, (k, ok) in enumerate(zip(best, known, strict=True))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text")).mapInArrow(run, schema)

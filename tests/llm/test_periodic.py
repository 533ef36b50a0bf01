import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def brute_runs(words):
    """Runs by scanning every lag: start, length, period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{x},{q}\n" for s, x, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def check(spark, df):
    want = sorted((brute_row(r.doc_id, r.text) for r in df.collect()), key=str)
    df.write.mode("overwrite").parquet(path := queries.scratch_path(spark, "test") + "/documents.parquet")
    got = queries.op12_periodic_runs(spark, path.rsplit("/", 1)[0])
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    return want


def test_documents_equal_brute_force(spark):
    short = queries.read(spark, SF, "documents").where(F.length("text") < 9000)
    assert sum(r[1] for r in check(spark, short)) > 5


def test_odd_texts(spark):
    texts = [None, "", " ", "\t\n", "a", "a " * 23, "a " * 24, "a\x0bb\x1c " * 40, "a b c " * 8 + "x", " x " * 30, ("one two three four five six seven eight " * 2 + "nine ") * 40, "x" * 50_000 + " y" * 100]
    rows = [(i, t, "e") for i, t in enumerate(texts)] + [(None, "q r " * 20, None), (3, "z " * 30, "e"), (3, "z " * 30, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    check(spark, df)
    assert queries.periodic.periodic_runs(df.limit(0), ["doc_id"]).count() == 0


def test_tails_are_repeated(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, " ".join(map(str, rng.integers(0, 40, int(rng.integers(1, 900)))))) for i in ids], "doc_id long, text string")
    assert sum(r[1] for r in check(spark, df)) >= len(ids) // 3


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_made_up_texts(seed):
    rng = np.random.default_rng(seed)
    for _ in range(25):
        docs = []
        for _ in range(rng.integers(1, 5)):
            k, parts = int(rng.choice([1, 2, 3, 50])), [np.zeros(0, dtype=int)]
            for _ in range(rng.integers(1, 4)):
                p = int(rng.integers(1, 90))
                unit = rng.integers(0, k, p)
                if rng.random() < 0.4 and p > 4:  # nearly a shorter period
                    unit = np.resize(unit[: p // int(rng.integers(2, 5))], p)
                    unit[rng.integers(0, p)] = 99
                parts += [rng.integers(0, k, int(rng.integers(0, 60))), np.resize(unit, int(p * rng.uniform(2.5, 5)))]
            docs.append(np.concatenate(parts))
        bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        start, end, period = periodic.find_runs(np.concatenate(docs), bounds)
        want = [(int(at) + s, n, q) for d, at in zip(docs, bounds, strict=False) for s, n, q in brute_runs(d.tolist())]
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist(), strict=True)) == want


def test_sliding_minima():
    rng = np.random.default_rng(1)
    for n, w in [(1, 1), (5, 5), (40, 7), (41, 1), (64, 13)]:
        x = rng.integers(0, 9, n).astype(np.uint64)
        least = [int(x[i : i + w].min()) for i in range(n - w + 1)]
        assert periodic.sliding_min(x, w).tolist() == least
        assert periodic.is_minimizer(x, w).tolist() == [any(least[i] == x[p] for i in range(max(0, p - w + 1), min(p, n - w) + 1)) for p in range(n)]


def test_strongest_run_compares_exactly(spark):
    rows = [([(0, 1000001, 333333), (5, 1000004, 333334), (9, 30, 10)],), ([(4, 30, 10), (2, 60, 20), (2, 30, 10)],), ([],), (None,)]
    df = spark.createDataFrame(rows, "runs array<struct<start: long, length: long, period: long>>")
    got = [r.b and tuple(r.b) for r in df.select(periodic.strongest(F.col("runs")).alias("b")).collect()]
    assert got == [(0, 1000001, 333333), (2, 30, 10), None, None]

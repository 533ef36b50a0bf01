import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import bitslice, queries

SF = "/root/testdata/sf0.01"


def brute(rows, asks, k=5, scale=256):
    """Best of every (id, vector) row against all rows of other ids, by Python integers."""
    q = [(i, tuple(math.floor(scale * float(x)) for x in v)) for i, v in rows]
    out = []
    for (i, v), (_, x) in zip(q, rows, strict=True):
        if asks(i):
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in q if j != i and len(w) == len(v))[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(found, 1)]
    return sorted(out)


def test_all_queries_equal_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in queries.read(spark, SF, "embeddings").collect()]
    got = sorted(tuple(r) for r in queries.op11_sliced_top_k(spark, SF).collect())
    assert got == brute(rows, lambda i: i % 50 == 0)


def test_small_blocks_and_parts_give_the_same(spark):
    df = queries.read(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = bitslice.top_k(df, F.col("vec_id") % 50 == 0, block_rows=70, query_rows=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 50 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25]), (2, [0.5, -0.25]), (3, [0.5, -0.25]), (2, [0.5, -0.25]), (4, [0.0, 0.0]), (5, [-0.3, 0.1]), (6, [1.0]), (7, [2.5]), (8, []), (9, []),
            (10, None), (11, [None, 1.0]), (12, [nan, 1.0]), (13, [inf, 1.0]), (None, [0.1, 0.2]), (14, [0.001, 0.003]), (5, [0.7, 0.7])]
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<double>, id string, block int")
    plain = [*dict.fromkeys((i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v))]
    got = bitslice.top_k(df, F.lit(True), k=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(plain, lambda i: True, k=3)
    assert bitslice.top_k(df.limit(0), F.lit(True)).count() == 0
    assert bitslice.top_k(df, F.lit(None).cast("boolean")).count() == 0


def test_huge_components_are_summed_exactly(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [1e300, 2.0]), (4, [3.0, 1e17])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    low, high = bitslice.LONG
    want = [(i, n, j, min(max(s, low), high)) for i, n, j, s in brute(rows, lambda i: True)]
    assert sorted(tuple(r) for r in bitslice.top_k(df, F.lit(True)).collect()) == want


@pytest.mark.parametrize("seed", range(6))
def test_slices_against_plain_products(seed):
    rng = np.random.default_rng(seed)
    n, d = int(rng.integers(1, 300)), int(rng.integers(1, 9))
    values = rng.integers(-9, 10, (n, d)) * rng.integers(1, 4)
    block = bitslice.SlicedBlock.build(np.arange(n) * 2, values)
    for _ in range(10):
        w = rng.integers(-300, 301, d).tolist()
        own = int(rng.integers(0, 2 * n))
        score = values @ np.array(w)
        order = [i for i in np.lexsort((np.arange(n), -score)) if 2 * i != own][:7]
        rows, scores = block.top(w, 7, own)
        assert rows.tolist() == order and scores == score[order].tolist()


def test_signed_digits():
    for w in range(-300, 301):
        digits = list(bitslice.signed_digits(w))
        assert sum(s << p for p, s in digits) == w and all(b - a > 1 for (a, _), (b, _) in zip(digits, digits[1:], strict=False))

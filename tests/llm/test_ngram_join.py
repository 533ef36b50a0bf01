import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import ngram_join, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(id, text) rows to their (n_shingles, component_id), by all pairs that share a shingle."""
    held = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for k, s in enumerate(held):
        shared = Counter(j for x in s for j in by[x])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(held[j]) - n) and rows[k][0] is not None and rows[j][0] is not None:
                parent[root(k)] = root(j)
        for x in s:
            by[x].append(k)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root(k)] = min(low.get(root(k), i), i)
    return sorted((str(i), len(held[k]), str(low[root(k)] if i is not None else None)) for k, (i, _) in enumerate(rows))


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((str(r.id), r.n_shingles, str(r.component_id)) for r in ngram_join.near_duplicates(df, **how).collect())


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in queries.read(spark, sf, "documents").select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in queries.op4_ngram_jaccard(spark, sf).collect())
    assert got == brute(rows)


def edited(words, share, rnd, vocabulary):
    return [rnd.choice(vocabulary) if rnd.random() < share else w for w in words]


@pytest.mark.parametrize("window", [1, 8])
def test_clusters_boilerplate_and_crowded_keys(spark, window):
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    rows, base = [], [rnd.choice(vocabulary) for _ in range(150)]
    for i in range(150):
        kind = i % 5
        if kind == 0:  # near copies of one text, near the threshold
            words = edited(base, rnd.choice([0.01, 0.03, 0.05, 0.08]), rnd, vocabulary)
        elif kind == 1:  # mostly one passage
            words = [*passage, *(rnd.choice(vocabulary) for _ in range(rnd.randint(10, 30)))]
        elif kind == 2:  # short texts of few words
            words = [rnd.choice("abc") for _ in range(rnd.randint(0, 9))]
        elif kind == 3:
            words = rows[rnd.randrange(len(rows))][1].upper().split() if rows else []
        else:
            words = [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 400))]
        rows.append((i, " ".join(words)))
    assert found(spark, rows, window=window) == brute(rows)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "One two"), (3, "one\ttwo"), (9, "a b c d e"), (9, "a b c d e"), (None, "a b c d e"), (10, long), (11, long + " x"), (12, "ÀB c d e f"), (13, "àb c d e f")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    df = spark.createDataFrame([(1, "a b c d e f", 5, "x"), (2, "a b c d e f", 6, "y")], "doc_id long, text string, n long, node string")
    assert {r.component_id for r in ngram_join.near_duplicates(df).collect()} == {1}


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 120), st.integers(0, 60), st.integers(0, 60), st.integers(0, 2**32))
def test_linked_sets_share_a_key(shared, left, right, seed):
    rnd = np.random.default_rng(seed)
    x = rnd.integers(0, 2**64, shared + left + right, dtype=np.uint64)
    a, b = np.unique(x[: shared + left]), np.unique(np.concatenate([x[:shared], x[shared + left :]]))
    classes = rnd.integers(0, 5, 1 << ngram_join.COUNTER_BITS).astype(np.uint8)
    limit = ngram_join.Threshold()
    same = len(np.intersect1d(a, b))
    linked = 100 * same >= 75 * (len(a) + len(b) - same)
    if linked:
        assert set(ngram_join.block_keys(a, classes, limit).tolist()) & set(ngram_join.block_keys(b, classes, limit).tolist())
    sketches = [np.frombuffer(ngram_join.bit_sketch(s), np.uint8) for s in (a, b)]
    assert ngram_join.sketch_distance(*sketches) <= len(a) + len(b) - 2 * same


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(130, 131), (131, 130), (7, 7)]
    got = {r.node: r.root for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 120), 100), 130: 130, 131: 130}
    assert ngram_join.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_strangers_of_one_key_are_dealt_in_chunks(spark, monkeypatch):
    import numpy as np
    from pyspark.sql import functions as F

    rnd, limit = np.random.default_rng(3), ngram_join.Threshold()
    base = rnd.integers(0, 256, 64, dtype=np.uint8)
    nodes = [(i, 100, bytearray(base.tobytes() if i % 3 else rnd.integers(0, 256, 64, dtype=np.uint8).tobytes())) for i in range(1, 61)]
    sketches = spark.createDataFrame(nodes, "node long, n long, sketch binary")
    crowded = sketches.select(F.lit(7).cast("long").alias("key"), "node", "n").drop("n")
    roots = spark.createDataFrame([], "node long, root long")
    grouped, largest = ngram_join.grouped_pairs, []

    def measured(rows, keys, *rest):
        largest.append(rows.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return grouped(rows, keys, *rest)

    found = lambda: {(r.a, r.b) for r in ngram_join.unresolved(crowded, roots, sketches, limit, False).collect()}
    whole = found()
    monkeypatch.setattr(ngram_join, "CHUNK_SETS", 10)
    monkeypatch.setattr(ngram_join, "grouped_pairs", measured)
    assert found() == whole and len(whole) > 500
    assert max(largest) <= 40  # two chunks, which hashes fill unevenly


def test_what_a_few_documents_share_is_no_join_key(spark):
    from pyspark.sql import functions as F

    limit = ngram_join.Threshold()
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(120)) + (f" {passage}" if i < 7 else "")) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes = ngram_join.rarity(df, "text", 5)
    bits = len(classes).bit_length() - 1
    of = lambda text: classes[(ngram_join.shingle_hashes([text])[0] >> np.uint64(64 - bits)).astype(np.int64)]
    assert bits == ngram_join.COUNTER_BITS and of(passage).min() > 0 and np.median(of(rows[-1][1])) == 0
    keyed = ngram_join.sketch_sets(df, "doc_id", "text", 5, limit).select(F.explode("keys").alias("key"), "n", "node")
    assert ngram_join.candidates(keyed, limit, 4).count() == 0


def test_counters_follow_the_table(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "COUNTER_BITS", 17)
    df = spark.range(300).selectExpr("concat_ws(' ', transform(sequence(0, 1000), x -> concat('w', id, 'x', x))) text")
    assert len(ngram_join.rarity(df, "text", 5)) > 1 << 17
    monkeypatch.setattr(ngram_join, "MAX_COUNTER_BITS", 17)
    assert len(ngram_join.rarity(df, "text", 5)) == 1 << 17
    assert not ngram_join.rarity(df.limit(0), "text", 5).packed.any()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 26) - 1), min_size=1, max_size=200), st.integers(0, 20))
def test_packed_gaps(slots, spread):
    held = np.sort(np.array(slots, dtype=np.int32) >> spread)
    parts, gaps = ngram_join.packed_gaps(held)
    back = [(p << ngram_join.PART_BITS) + ngram_join.unpacked_gaps(g) for p, g in zip(parts.tolist(), gaps, strict=True)]
    assert np.concatenate(back).tolist() == held.tolist() and len(set(parts.tolist())) == len(parts)

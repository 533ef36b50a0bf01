import hashlib
import random

import numpy as np

from tidewater.llm import fingerprint, queries
from tidewater.llm import textvec as tv


def plain_walk(text):
    """One text's fingerprint, step by step."""
    out = [256] * fingerprint.BINS
    if not text:
        return out
    takes = dict(fingerprint.records(8 * len(text) + 100))
    cp = [ord(c) for c in text]
    i = t = 0
    while i < len(text):
        if t in takes:
            h = 0
            for j in range(fingerprint.GRAM):
                h = (h * 0x9E3779B97F4A7C15 + (cp[i + j] + 1 if i + j < len(cp) else 0)) % (1 << 64)
            out[takes[t]] = int(tv.mix64(np.array([h], dtype=np.uint64))[0] >> np.uint64(56))
        i += int(fingerprint._MOVES[t % fingerprint.PERIOD][int(tv.mix64(np.array([cp[i]], dtype=np.uint64))[0] >> np.uint64(56))])
        t += 1
    return out


def texts(n, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("abcdefgh é日\n") for _ in range(rnd.choice([0, 1, 2, 5, 50, 400]))) for _ in range(n)]


def test_walks_match_a_plain_walk():
    sample = texts(120)
    assert fingerprint.fingerprints(sample).tolist() == [plain_walk(t) for t in sample]
    assert fingerprint.fingerprints(sample[:5]).tolist() == [plain_walk(t) for t in sample[:5]]


def test_few_edits_change_little():
    rnd = random.Random(1)
    base = "".join(rnd.choice("abcdefghij klm") for _ in range(2000))
    near = base[:700] + base[703:1500] + "zz" + base[1500:]
    other = "".join(rnd.choice("abcdefghij klm") for _ in range(2000))
    a, b, c = fingerprint.fingerprints([base, near, other])
    assert fingerprint.likeness(a[None], b[None])[0] > 0.6 > 0.15 > fingerprint.likeness(a[None], c[None])[0]


def test_query_against_plain_neighbours(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text or "") for r in queries.read(spark, sf, "documents").collect())
    rows = {r.doc_id: r for r in queries.op5_fingerprints(spark, sf).collect()}
    assert len(rows) == len(docs)
    own = fingerprint.fingerprints([t for _, t in docs])
    for k, (i, t) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        changed = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert r.fingerprint == fingerprint.spell(own[k])
        other = fingerprint.fingerprints([changed])
        assert r.edited_fingerprint == fingerprint.spell(other[0])
        assert abs(r.near_edited - fingerprint.likeness(own[k][None], other)[0]) < 1e-12
        assert abs(r.near_next - fingerprint.likeness(own[k][None], own[(k + 1) % len(docs)][None])[0]) < 1e-12
    assert np.median([r.near_edited for r in rows.values()]) > 0.4 > 0.1 > np.median([r.near_next for r in rows.values()])


def test_edges(spark):
    rows = [(3, None, "x"), (1, "abc", "y"), (2, "", "z"), (None, "nul", None), (1, "abc", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string")
    got = fingerprint.with_next(df).collect()
    assert len(got) == 5 and sorted(str(r.id) for r in got) == sorted(str(r[0]) for r in rows)
    assert {r.fingerprint for r in got if r.id in (2, 3)} == {""}
    two = next(r for r in got if r.id == 2)
    assert (two.near_edited, two.near_next) == (1.0, 1.0)
    assert len(fingerprint.with_next(df.limit(1)).collect()) == 1
    assert fingerprint.with_next(df.limit(0)).count() == 0


def test_banded_join_finds_near_copies(spark):
    rnd = random.Random(9)
    base = ["".join(rnd.choice("abcdefghij klmno") for _ in range(1500)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t[:800] + "#" + t[801:]) for i, t in enumerate(base)] + [(200, base[0]), (201, "")]
    prints = fingerprint.fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"])
    pairs = {(r.id, r.class_id): r.likeness for r in fingerprint.near_pairs(prints, "doc_id").collect()}
    assert sum((100 + i, i) in pairs for i in range(30)) >= 28
    assert pairs[(200, 0)] == 1.0 and all(a % 100 == b % 100 for a, b in pairs)


def test_classes_pass_by_unlike_first_rows_and_join_two_classes(spark):
    def hexed(row):
        return "".join(f"{v:02x}" for v in row)

    rnd = np.random.default_rng(8)
    base, unlike = rnd.integers(0, 256, 128), rnd.integers(0, 256, 128)
    picks = np.random.default_rng(5).permutation(128)
    unlike[picks[:64]] = base[picks[:64]]  # half of the bands: all meet the smallest id, 0.5 alike
    near = base.copy()
    near[picks[64::4]] = (near[picks[64::4]] + 1) % 256  # the other half of the bands differ from base's
    left = rnd.integers(0, 256, 128)
    middle, right = left.copy(), left.copy()
    middle[:40] = (middle[:40] + 1) % 256
    right[:40], right[40:80] = middle[:40], (right[40:80] + 1) % 256  # middle is alike to both, they are not
    rows = [(1, hexed(unlike)), (2, hexed(base)), (3, hexed(near)), (10, hexed(left)), (11, hexed(right)), (12, hexed(middle)), (13, "")]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    got = {(r.id, r.class_id) for r in fingerprint.near_pairs(df, "doc_id").collect()}
    assert got == {(3, 2), (11, 10), (12, 10)}


def test_query_has_classes(spark):
    rows = queries.op5_fingerprints(spark, "/root/testdata/sf0.001").collect()
    prints = {}
    for r in rows:
        assert r.class_id is not None and r.class_id <= r.doc_id
        assert prints.setdefault(r.fingerprint, r.class_id) == r.class_id

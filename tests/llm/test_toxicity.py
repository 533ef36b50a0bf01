from collections import Counter

import numpy as np
import pytest

from tidewater.llm import queries, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(queries.read(spark, SF, "documents"), queries.read(spark, SF, "labels").where(queries.remainder("doc_id", 5) != 0))


def test_held_out_rows(spark):
    toxic = {r.doc_id: r.toxic for r in queries.read(spark, SF, "labels").collect()}
    rows = queries.op7_toxicity(spark, SF).collect()
    assert len(rows) == queries.read(spark, SF, "documents").count() and all(0 <= r.score <= 1 for r in rows)
    known = [(r.predicted, toxic[r.doc_id], r.held_out) for r in rows if r.doc_id in toxic]
    assert all(not p for p, t, _ in known if not t)  # clean documents are left alone
    assert np.mean([p for p, t, _ in known if t]) > 0.6


@pytest.mark.parametrize("text", ["you 1d10t", "what an i d i o t", "iiidiooot", "a l.o.s.e.r here", "p@thet1c", "cl0wn", "w0rthle$$", "$tup1d", "L0SER!!!", "scum%%%"])
def test_tricks_are_seen_through(model, text):
    assert toxicity.Scorer(model).score([text])[0] >= 0.5


@pytest.mark.parametrize("text", ["", " ", "the normal text of 3 things and 10 more", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "a b c d", "x" * 30_000, "1,000.50 $ 7"])
def test_clean_texts_stay_clean(model, text):
    assert toxicity.Scorer(model).score([text])[0] < 0.5


def test_trigrams_match_a_plain_count(spark):
    texts = ["Ab cab!", None, "", "ça 12 ab"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    code = lambda c: ord(c) - 96 if "a" <= c <= "z" else ord(c) - 0xDF + 27 if "\xdf" <= c <= "\xff" and c != "÷" else toxicity.OTHER_LETTER if c.isalpha() else 0
    counts = Counter()
    for t in texts:
        for word in "".join(c if c.isalpha() else " " for c in (t or "").lower()).split():
            k = [0, 0, *map(code, word), 0, 0]
            counts.update(zip(k, k[1:], k[2:], strict=False))
    table = toxicity.trigram_counts(df).reshape((toxicity.SYMBOLS,) * 3)
    for (a, b, c), n in counts.items():
        if 0 < b:
            assert table[a, b, c] == n, (a, b, c)


def test_viterbi_finds_the_best_reading(model):
    restorer = toxicity.Restorer(model.logs)
    logs = model.logs

    def best(token):
        readings = [""]
        for c in token:
            readings = [r + x for r in readings for x in (c if c.isalpha() else toxicity.LOOKALIKES[c])]
        value = lambda w: sum(logs[a, b, c] for a, b, c in zip([0, 0, *k(w)], [0, *k(w), 0], [*k(w), 0], strict=False))
        k = lambda w: [int(x) for x in toxicity.letter_codes(np.array([ord(c) for c in w], dtype=np.uint32))]
        return max(readings, key=value)

    for token in ("1d1ot", "c1own", "t1e", "p1e"):
        assert len(restorer.restore(token)) <= len(token)
        if len(restorer.restore(token)) == len(token):
            assert restorer.restore(token) == best(token)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, None), (None, 1)], "doc_id long, toxic int")
    m = toxicity.fit(docs, labels)
    assert [r.score for r in toxicity.score(docs, m, ["doc_id"]).collect()] == [0.0, 0.0]
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels.limit(0)), ["doc_id"]).count() == 0


@pytest.mark.parametrize("text", ["you are a l o s e r", "I i d i o t", "you iddiot", "what a loosser", "you a 1 0 s e r"])
def test_word_edges_and_doubled_letters_are_seen_through(model, text):
    assert toxicity.Scorer(model).score([text])[0] >= 0.5


@pytest.mark.parametrize("text", ["a good letter will follow soon", "plan a b c or x y z", "I a m h e r e"])
def test_doubles_and_runs_of_clean_texts_stay_clean(model, text):
    assert toxicity.Scorer(model).score([text])[0] < 0.5


@pytest.mark.parametrize("footer", [0, 60, 200])
def test_a_shared_footer_hides_no_label(spark, footer):
    rng = np.random.default_rng(2)
    end = " ".join(f"foot{i}" for i in range(footer))
    rows, labels = [], []
    for i in range(1200):
        own = [f"w{rng.integers(0, 4000)}" for _ in range(20)]
        if i % 10 == 0:
            for k, word in enumerate(rng.choice(["vornik", "plazzer", "gromtek", "skuldar", "yibbet", "drazzle"], 4)):
                own.insert(int(rng.integers(0, 20)), str(word))
        rows.append((i, " ".join(own) + " " + end))
        labels.append((i, int(i % 10 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([x for x in labels if x[0] % 20 < 10], "doc_id long, toxic int")
    m = toxicity.fit(docs, known)
    found = {r.doc_id: r.score >= 0.5 for r in toxicity.score(docs, m, ["doc_id"]).collect()}
    held = [i for i, _ in rows if i % 20 >= 10]
    assert all(found[i] == (i % 10 == 0) for i in held)


def test_filtered_tokens_hit_as_if_all_were_decoded(model, spark):
    r = toxicity.Scorer(model)
    texts = [x.text or "" for x in queries.read(spark, SF, "documents").select("text").limit(150).collect()]
    hits = lambda words: {f for w in words for f in toxicity.word_features(w) if f in model.evidence}
    tokens = {t for text in texts for t in text.split()} | {"1d10t", "l0-ser", "$-c-u-m", "st!ll", "1|l1", "m0r0n!!!", "clown...", "iiidiot"}
    for t in tokens:
        assert hits(toxicity.token_words(t, r.restorer, r.stems)) == hits(toxicity.token_words(t, r.restorer)), t
    for run in ("aloser", "iidiot", "abcd", "y0u5cum"):
        assert hits(toxicity.run_words(run, r.restorer, r.stems)) == hits(toxicity.run_words(run, r.restorer)), run


@pytest.mark.parametrize("token", ["a" + "." * 300_000 + "a", "x" * 300_000, "." * 300_000, "i" * 100_000 + "!", "a-" * 100_000])
def test_long_tokens_take_linear_time(model, token):
    import time

    began = time.time()
    toxicity.Scorer(model).score([token])
    assert time.time() - began < 10

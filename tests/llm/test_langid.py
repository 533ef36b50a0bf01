import numpy as np

from tidewater.llm import langid, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in queries.op1_language(spark, sf).collect()]
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97


def grams(text, known=None):
    t = text.lower()
    found = {t[i : i + n] for n in langid.ORDERS for i in range(len(t) - n + 1)}
    return found if known is None else found & known


def test_kernel_is_the_normalised_intersection(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log", "le chat est sur la table", "la table est sous le chat", "the the the"]
    df = spark.createDataFrame(list(zip(texts, ["en", "en", "fr", "fr", "en"], strict=True)), "text string, lang string")
    model = langid.fit(df)
    marks = [x[2] for x in sorted((r["__label"], r["__h"], r["__text"]) for r in langid.labelled_sample(df).collect())]
    held = [grams(t) for t in marks]
    known = {g for g in set().union(*held) if sum(g in h for h in held) >= 2}
    assert model.landmarks.shape == (len(known), len(marks))
    for t in [*texts, "the table is a log"]:
        own = grams(t, known)
        expected = [len(own & h) / np.sqrt(max(1, len(own)) * max(1, len(h & known))) for h in held]
        assert np.allclose(model.kernel([t])[0], expected, atol=1e-5)


def test_edges(spark):
    rows = [("the cat sat on the mat", "en", 1.0), ("le chat est sur la table", "fr", 2.0), (None, "en", 3.0), ("", None, 4.0), ("123 456 !!", "fr", 5.0), ("the cat", None, 6.0)]
    df = spark.createDataFrame(rows, "text string, lang string, score double")
    got = {r.text: r for r in langid.predict(df, langid.fit(df), ["text"]).collect()}
    assert got["the cat"].lang_pred == "en" and got["le chat est sur la table"].lang_pred == "fr"
    assert all(got[t].lang_pred == "und" and got[t].score == 0.0 for t in (None, "", "123 456 !!"))
    unlabelled = df.where("lang is null")
    assert langid.fit(unlabelled) is None
    assert {r.lang_pred for r in langid.predict(df, None, ["text"]).collect()} == {"und"}
    assert langid.predict(df.limit(0), langid.fit(df), ["text"]).count() == 0


def test_sample_is_bounded_and_without_copies(spark):
    df = spark.createDataFrame([("same text", "en")] * 50 + [(f"text number {i}", "en") for i in range(30)], "text string, lang string")
    found = [r["__text"] for r in langid.labelled_sample(df, per_label=20).collect()]
    assert len(found) == len(set(found)) == 20

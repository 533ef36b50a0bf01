from test_ngram_join import brute

import corpus_pipeline

SF = "/root/testdata/sf0.01"


def test_stages_hand_on_what_they_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = corpus_pipeline.materialize(corpus_pipeline.drop_toxic(spark, docs, SF), "t1")
    assert clean.columns == docs.columns and clean.dtypes == docs.dtypes
    kept = {r.doc_id for r in clean.select("doc_id").collect()}
    gone = {r.doc_id for r in docs.select("doc_id").collect()} - kept
    assert gone and all(toxic.get(i, 1) for i in gone)
    known = corpus_pipeline.materialize(corpus_pipeline.keep_known_languages(spark, clean, SF), "t2")
    assert known.columns == docs.columns and known.count() >= 0.99 * len(kept)
    rows = [(r.doc_id, r.text) for r in known.select("doc_id", "text").collect()]
    single = corpus_pipeline.keep_one_of_near_duplicates(spark, known, SF)
    assert single.columns == docs.columns
    assert {str(r.doc_id) for r in single.collect()} == {i for i, _, c in brute(rows) if i == c}
    packed = corpus_pipeline.pack_documents(spark, single, SF).collect()
    assert {str(r.doc_id) for r in packed} == {i for i, _, c in brute(rows) if i == c}


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(1, None, None, "n"), (2, "", "en", "n"), (3, "the cat sat on the mat today", "en", "n"), (3, "the cat sat on the mat today", "en", "n"), (None, "the dog sat on the log today", "en", "n"), (4, "123", "en", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert out.columns == docs.columns and out.count() == 6
    out = corpus_pipeline.keep_known_languages(spark, docs, SF)
    assert sorted(str(r.doc_id) for r in out.collect()) == ["3", "3", "None"]
    out = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, SF)
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "3", "4", "None"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_repeated_ids_lose_no_text(spark):
    a = " ".join(f"word{i}" for i in range(60))
    b = " ".join(f"other{i}" for i in range(40))
    rows = [(1, a), (3, a + " more"), (3, b), (5, b), (5, b), (7, "quite another text that stands alone"), (7, "quite another text that stands alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, SF)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, a), (3, b), (7, rows[-1][1])]


def test_texts_reach_python_in_small_batches_and_before_a_stage_returns(spark, monkeypatch):
    name, used, write = "spark.sql.execution.arrow.maxBytesPerBatch", [], corpus_pipeline.materialize
    monkeypatch.setattr(corpus_pipeline, "materialize", lambda df, at: used.append(spark.conf.get(name)) or write(df, at))
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(1, "the cat sat on the mat today", "en"), (2, None, None)], "doc_id long, text string, lang string")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert "MapInArrow" not in out._jdf.queryExecution().toString() and spark.conf.get(name) == before
    assert len(used) >= 3 and set(used) == {"4m"}

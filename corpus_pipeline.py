"""From raw documents to packed sequences: toxicity, language, near duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; all but the last return the columns of ``docs``.
``run`` writes every stage's rows and reads them again for the next one.

Nulls: a null text counts as empty; it is not toxic, has no language (and goes
there), no near duplicates, and one piece of one token.  A null doc_id is kept
as it is.  Rows that repeat a doc_id with the same text are one document.  Columns that
documents do not need are carried along whatever their names.  Empty tables
give empty results.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import langid, ngram_join, packing, queries, toxicity
from tidewater.plans.sink import materialize
from tidewater.session import ship_package, small_batches

MAX_TOXICITY = 0.5  # a document with this score or more goes
MIN_LANGUAGE_SCORE = 0.4  # a document whose best language scores less goes


def _in_small_batches(stage: Callable) -> Callable:
    """All Python work of a stage is done when it returns; until then whole texts reach it in small batches."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark):
            return stage(spark, docs, sf_dir)

    return run


def _to_judge(docs: DataFrame) -> DataFrame:
    """What an operator needs to judge a document by: __id, __hash (of the text) and __body."""
    return docs.select(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__hash"), F.col("text").alias("__body"))


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The documents whose id and text are not among the rejected ones; texts pass no Python on this way."""
    gone = materialize(rejected.select("__id", "__hash").distinct(), "rejected")
    if gone.count() <= ngram_join.BROADCAST_ROWS:
        gone = F.broadcast(gone)
    same = (F.xxhash64(docs["text"]) == gone["__hash"]) & docs["doc_id"].eqNullSafe(gone["__id"])
    return docs.join(gone, same, "left_anti")


@_in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below MAX_TOXICITY; learned from the labels that are not held out."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.coalesce(queries.remainder("doc_id", 5) == 0, F.lit(False))
    model = toxicity.fit(docs, labels.where(~held_out))
    scored = toxicity.score(_to_judge(docs), model, ["__id", "__hash"], "__body")
    return _without(docs, scored.where(F.col("score") >= MAX_TOXICITY))


@_in_small_batches
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose best language scores at least MIN_LANGUAGE_SCORE.

    The languages are learned from the documents' own labels; with no label at all, all
    documents with letters stay."""
    ship_package(spark)
    model = langid.fit(docs.select("text", "lang"))
    if model is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    judged = langid.predict(_to_judge(docs), model, ["__id", "__hash"], "__body")
    return _without(docs, judged.where((F.col("lang_pred") == langid.UNKNOWN) | (F.col("score") < MIN_LANGUAGE_SCORE)))


@_in_small_batches
def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every near-duplicate component the document with the smallest doc_id (of those, the smallest text hash)."""
    ship_package(spark)
    found = materialize(ngram_join.near_duplicates(docs), "components")
    linked = found.where("id is not null and n_shingles > 0").select("component_id", F.struct(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).alias("row"))
    first = linked.groupBy("component_id").agg(F.min("row").alias("first"))
    # copies are pre-aggregated, so a component of very many rows is a few counts
    rows = linked.groupBy("component_id", "row").agg(F.count(F.lit(1)).alias("n"))
    kept = _without(docs, rows.join(first, "component_id").where("row <> first").select("row.*"))
    again = materialize(rows.where("n > 1").select("row.*"), "repeated")
    if not again.isEmpty():  # rows that repeat a doc_id with its text are one document
        again = F.broadcast(again) if again.count() <= ngram_join.BROADCAST_ROWS else again
        same = (F.xxhash64(kept["text"]) == again["__hash"]) & kept["doc_id"].eqNullSafe(again["__id"])
        repeated = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.join(again, same, "left_anti").unionByName(repeated)
    return kept.select(docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of at most 1024 tokens."""
    ship_package(spark)
    return packing.pack(docs, queries.BYTE_TOKENIZER, with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_languages),
    ("ngram_jaccard", keep_one_of_near_duplicates),
    ("best_fit_packing", pack_documents),
]

# Kernel scores, learned evidence and packing plans are beyond SQL; the tests
# compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if i + 1 < len(STAGES):
            rows = materialize(rows, f"stage-{name}")
    return rows

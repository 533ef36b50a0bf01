"""The registered queries of the operators; the SQL of those that SQL can express is in ``oracles``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sink import scratch_path
from . import ann, bitslice, bpe, fingerprint, html_extract, langid, ngram_join, packing, periodic, tokencount, toxicity, turn_repair, warc
from .oracles import ORACLE_SQL  # noqa: F401

MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def remainder(column: str, n: int):
    """crc32 of an id as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from the documents that are not held out."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))  # a null id is not held out
    model = langid.fit(docs.where(~held_out).select("text", "lang"))
    return langid.predict(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the bytes they decode to, as digests."""
    coded = bpe.encode(read(spark, sf_dir, "documents"), MULTI_RANKS, ["doc_id"], round_trip=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of at most 1024 tokens."""
    packed = packing.pack(read(spark, sf_dir, "documents"), BYTE_TOKENIZER, with_ids=False)
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document: 5-word shingles, Jaccard similarity of 0.75 or more."""
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text, its edited text, and their likeness to each other and the next document's;
    class_id is the smallest id of the documents whose fingerprints are alike, in chains."""
    return fingerprint.with_classes(fingerprint.with_next(read(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by its host's winning container path."""
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every whole text, learned from the labels that are not held out."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))  # a null id is not held out
    model = toxicity.fit(docs, labels.where(~held_out))
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100, against all vectors."""
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy longest-match tokens of every whole text."""
    return tokencount.token_counts(read(spark, sf_dir, "documents"), WORD_TOKENIZER, ["doc_id"])


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC records of all pages, written and read back."""
    path = scratch_path(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), path)
    back = warc.read_records(spark, path)
    return back.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


def op11_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five greatest integer inner products of every vector whose id is divisible by 50, against all vectors."""
    return bitslice.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every whole text, every tenth with a repeated tail; digests of all runs and of the collapsed text."""
    found = periodic.periodic_runs(periodic.repeat_tails(read(spark, sf_dir, "documents")), ["doc_id"])
    found = found.withColumn("best", periodic.strongest(F.col("runs")))
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every conversation's turns after damage."""
    return turn_repair.repair(turn_repair.damage(read(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_language, op2_byte_bpe, op3_best_fit_packing, op4_ngram_jaccard, op5_fingerprints, op6_html_text, op7_toxicity, op8_nearest, op9_token_counts, op10_warc, op11_sliced_top_k, op12_periodic_runs, op13_turn_repair)}

"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwise.llm import (embedding_dedup, license_scan, mixing, ngram_jaccard, periodic_runs, piece_encoding,
                          quality_classifier, quality_rules, spelling_variants, substring_dedup, token_records, toxicity, warc)
from martwise.llm.common import cut, held_out, read, ship


def word_model() -> str:
    """Path of the public word tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model() -> str:
    """Path of the public piece tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return planned.select("doc_id", "size", "source_size", "target",
                          (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    scored = cut(quality_rules.score_documents(docs).drop("text"))
    judged = quality_rules.with_verdicts(scored, cut(quality_rules.host_verdicts(scored)))
    return judged.select("doc_id", *quality_rules.STATS.names, "base_failed", "kept")


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_records.write_records(read(spark, sf_dir, "documents"), word_model())
    return token_records.read_records(manifest, with_ids=False)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_jaccard.near_duplicates(read(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return (toxicity.severity(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
            .select("doc_id", "held_out", "severity", "score", "grade", "toxic"))


def op6_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_encoding.encode(docs, piece_model(), ("n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256")).drop("text")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.train(docs, read(spark, sf_dir, "labels"))
    return (quality_classifier.score(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
            .select("doc_id", "held_out", "score", "predicted"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(read(spark, sf_dir, "pages"))
    return warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"), keep=["doc_id"])


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(read(spark, sf_dir, "documents"))


def run_digests(docs: DataFrame) -> DataFrame:
    """The strongest run of every document, and digests of all its runs and of its collapsed text."""
    found = periodic_runs.find_runs(docs, periodic_runs.looped).withColumn("best", periodic_runs.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))),
                                                   F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    return run


QUERIES = {fn.__name__: _shipped(fn) for fn in (
    op1_mixing, op2_quality_rules, op3_token_records, op4_ngram_jaccard, op5_toxicity, op6_piece_encoding,
    op7_quality_classifier, op8_embedding_dedup, op9_warc, op10_license_scan,
    op11_substring_dedup, op12_spelling_variants, op13_periodic_runs, pipeline)}

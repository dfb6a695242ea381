"""A training corpus from ``documents``: classify, apply rules, drop near
duplicates, mix the sources, encode.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
its result is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``.

Defined cases: without labels of both kinds the classifier keeps every document;
documents without words are rejected by the quality rules;
null ids, repeated rows and empty tables are handled as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwise.llm import mixing, ngram_jaccard, piece_encoding, quality_classifier, quality_rules
from martwise.llm.common import cut, read, ship
from martwise.llm.queries import piece_model


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as good stay; all, where the labels fit no model."""
    ship(spark)
    model = quality_classifier.train(docs, read(spark, sf_dir, "labels"))
    if not len(model[1]):  # no weights: labels of both kinds are missing
        return docs
    return quality_classifier.score(docs, model).filter(F.col("predicted") == 1).select(*docs.columns)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host is not rejected stay."""
    ship(spark)
    scored = cut(quality_rules.score_documents(docs))
    judged = quality_rules.with_verdicts(scored, cut(quality_rules.host_verdicts(scored)))
    return judged.filter("kept").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    ship(spark)
    return ngram_jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    ship(spark)
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of their decoding."""
    ship(spark)
    return piece_encoding.encode(docs, piece_model(), ("n_tokens", "ids", "decoded_sha256")).select(
        "doc_id", "source", "n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("ngram_jaccard", drop_near_duplicates),
    ("mixing", mix_sources),
    ("piece_encoding", encode_pieces),
]

# The classifier and the encoder have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

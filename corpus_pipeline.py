"""Corpus pipeline: each stage is a step of a training-data pipeline and keeps what the next one works on."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import bpe, decontaminate, lang_id, simhash_dedup, toxicity
from tillcast.llm.common import held_out, table
from tillcast.session import materialise


#: Bytes of pieces that a worker remembers while encoding: executors still hold what earlier stages made them grow to.
ENCODER_BYTES = 40_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labels of those not held out, does not call toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    own = [f"_{i}" for i in range(len(docs.columns))]
    scored = toxicity.score_toxicity(docs.toDF(*own), model, own[docs.columns.index("text")])
    return scored.where("predicted = 0").select(*own).toDF(*docs.columns)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fit the model of some language."""
    models = lang_id.train(docs.where(~held_out("doc_id")))
    own = [f"_{i}" for i in range(len(docs.columns))]
    found = lang_id.identify(docs.toDF(*own), models, own[docs.columns.index("text")])
    return found.where(~F.col("lang_rejected")).select(*own).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one of smallest id."""
    return simhash_dedup.keep_one(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the benchmark's passages; documents that are mostly benchmark go."""
    clean = decontaminate.remove_hits(docs, table(spark, sf_dir, "benchmark"))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    kept = docs.select("doc_id", "lang", "source", "text")
    found = bpe.encode_texts(kept, public_tokenizers.path("word_bpe_49k.json"), keep_text=False, remembered=ENCODER_BYTES)
    return found.drop("text")


STAGES = [
    ("toxicity", drop_toxic), ("language", drop_unknown_language), ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark), ("bpe", encode),
]

#: The trained models and the fingerprints' hash cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Corpus preparation as a sequence of stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareline.llm import dedup, packing, quality, secrets, simhash
from fareline.llm.common import Saved
from fareline.llm.queries import quality_model, tokenizer_file
from fareline.sources.scratch import delete_folder, released


def keep_good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from those of the input that have a label."""
    return quality.keep_good(docs, quality_model(spark, docs, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id."""
    return dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHashes of three-word shingles are linked by at most three differing bits, the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, words_each=3, radius=3)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets they show or hold encoded masked."""
    return secrets.mask_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences, with their token ids."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", keep_good_texts),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]

# Classifier, fingerprints and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each stage's result written to the shared folder and read again.

    What a stage wrote on its way is deleted when its result is stored, and the result when the next one's is.
    """
    saved = Saved(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        with released(spark):
            docs = saved(stage(spark, docs, sf_dir), name)
        if before is not None:
            delete_folder(spark, f"{saved.root}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)

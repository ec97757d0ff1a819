"""A training corpus from ``documents``: five stages, each on what the one before kept.

Quality rules reject documents, of near copies one stays, documents that hold
benchmark items go, secrets are masked, and the rest is encoded. A stage's rows are
written to the shared folder and read again, so a lost executor repeats part of one
stage. The first four return the columns of their input.

The near-copy stage links on five-word shingles and a Jaccard similarity of 0.8, so copies
with a few edits go too. (``op2_ngram_join`` has its own contract, three words and 0.9.)
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workcal.llm import op02_ngram_join, op03_decontaminate, op04_secret_scan, op06_bpe, op10_quality_rules
from workcal.llm.texts import table
from workcal.scratch import stage


SHINGLE = 5
PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_quality_rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op02_ngram_join.keep_first(docs, size=SHINGLE, percent=PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op03_decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Also counts the characters of the masked texts anew."""
    masked = op04_secret_scan.mask_secrets(docs, op04_secret_scan.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return op06_bpe.digests(op06_bpe.encode(docs, path))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_join", near_copies),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("bpe", encoding),
]

# The n-gram join, the templates, the trained models and the tokenizer are beyond SQL;
# the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""A corpus in five stages: quality rules, near copies, repeated passages, personal data, packing.

Each stage takes what the one before kept. Quality rules drop documents, of near copies the one
with the smallest id stays, repeated strings of 100 bytes and personal data go from the texts,
and what is left is packed into sequences of 1024 tokens.

Null texts have no words, so the quality rules drop them; later stages take null texts as empty.
Rows with a null key are kept like others; of rows equal in key and text one stays behind the
near copies. Columns beside the text stay until the last stage, whatever their names, very long
texts are taken whole, and an empty table stays empty through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachmark.llm import packing, pii, quality, simhash, suffix_dedup
from reachmark.llm.common import KEY
from reachmark.runtime import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the fitted trees keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit_quality(docs, labels))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of texts with SimHash fingerprints at most three bits apart, or that share 0.8 of
    their five-word shingles, which such fingerprints alone would miss."""
    return simhash.keep_one(docs, shingle=5, least=0.8, distance=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that occur earlier."""
    return suffix_dedup.remove_repeats(docs, size="n_chars")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked."""
    return pii.mask_pii(docs, pii.fit_pii(docs), length="n_chars")


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, path, 1024, 2).withColumn(KEY, F.col(KEY).cast("bigint")).withColumnRenamed(KEY, "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("pii", personal_data),
    ("best-fit packing", best_fit),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)


#: The trees, the random field and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}

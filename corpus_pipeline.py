"""The corpus pipeline: quality rules, language identification, near-duplicate removal, packing.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame, which ``run`` writes
as Parquet into the folder named by ``spark.checkpoint.dir`` and reads again for the next one. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from airmill.llm import language_id, packing, quality_rules, simhash
from airmill.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are mostly boilerplate go."""
    return quality_rules.keep(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language go; ``lang`` stays as declared."""
    return language_id.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of three words, at most three differing bits, as in ``op4_simhash``."""
    return simhash.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("language_id", language), ("simhash", near_duplicates), ("packing", pack)]

#: Hashes, learned likelihoods, fingerprints and tokenizer ids are not in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""One registered query per operator, each over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airmill.llm import (
    embedding_dedup,
    html_text,
    language_id,
    maxent_lm,
    packing,
    prefix_trie,
    quality_model,
    quality_rules,
    ranked_search,
    sentencepiece_viterbi,
    simhash,
    token_counts,
    url_filter,
)
from airmill.session import ensure_checkpoint_dir, stored

#: Place of the tokenizer files; a parameter of every operator that uses one.
WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge(table(spark, folder, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 9).alias("purity"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))


def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.groups(table(spark, folder, "embeddings"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return judged.select("doc_id", *quality_rules.FIGURES, "base_failed", "kept", "depleted")


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_viterbi.digest(table(spark, folder, "documents"), public_tokenizers.path(PIECE_BPE))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Load all documents, retire the toxic ones, and revise those of good quality to a version that counts an end id."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    labels = table(spark, folder, "labels")
    counted = stored(token_counts.with_counts(docs, public_tokenizers.path(WORD_BPE))).withColumn("tokenizer", F.lit("word_bpe_49k/1"))
    toxic = labels.where("toxic = 1").select("doc_id")
    good = labels.where("quality = 1").select("doc_id").join(toxic, "doc_id", "left_anti")
    retired = counted.join(toxic, "doc_id", "left_semi").withColumn("sign", F.lit(-1))
    old = counted.join(good, "doc_id", "left_semi").withColumn("sign", F.lit(-1))
    new = old.withColumns({"sign": F.lit(1), "tokenizer": F.lit("word_bpe_49k/2"), "n_tokens": F.col("n_tokens") + 1})
    rollup = token_counts.Rollup(spark, f"{ensure_checkpoint_dir(spark)}/token-counts-{uuid.uuid4().hex}")
    rollup.commit("load", counted.withColumn("sign", F.lit(1)))
    rollup.commit("retire", retired)
    rollup.compact()
    rollup.commit("revise", old.unionByName(new))
    rollup.commit("retire", retired)  # again: changes nothing
    return rollup.totals()


def op8_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.col("doc_id").isNotNull() & (F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1)) % 5 == 0)
    labels = table(spark, folder, "labels").where(~held_out)
    scored = quality_model.score(docs, quality_model.fit(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = language_id.identify(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    return found.select("doc_id", F.col("lang").alias("declared"), "language", F.round("posterior", 9).alias("posterior"), F.col("known").alias("kept"))


def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(*prefix_trie.rebuilt(table(spark, folder, "conversations")))


def op12_maxent_lm(spark: SparkSession, folder: str) -> DataFrame:
    return maxent_lm.score(table(spark, folder, "documents"), maxent_lm.held_out(F.col("doc_id")))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}

"""The text operators bound to the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapframe.llm import (
    bpe,
    conversations,
    fingerprints,
    licenses,
    lm,
    mixing,
    neardup,
    orc_output,
    pii,
    quality,
    ranked_search,
    rule_ensemble,
    statements,
    toxicity,
)
from lapframe.llm.common import read_table
from lapframe.session import scratch_dir

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), RANKS)


def as_files(docs: DataFrame) -> DataFrame:
    """``doc_id, path, text``: documents as files below a folder per source, a hundred to a folder.

    A slash in a source is no folder; documents without an id lie in ``none`` of their source.
    """
    part = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    number = F.col("doc_id")
    place = F.concat_ws("/", F.translate(part(F.col("source")), "/", "_"), part(F.floor(number / 1000)), part(F.floor(number / 100) % 10), part(number))
    return docs.select("doc_id", place.alias("path"), "text")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(as_files(read_table(spark, sf_dir, "documents")))
    return found.withColumn("doc_id", F.element_at(F.split("path", "/"), -1).try_cast("bigint"))


# As even as a fourfold repetition of the rarest source allows.
MIX_TARGET = mixing.Target(entropy_share=0.95, max_repeats=4.0)
BLOCK_TOKENS = 100_000


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.fit(read_table(spark, sf_dir, "documents"), MIX_TARGET)
    return mixing.block_permutations(mix, BLOCK_TOKENS)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pii.report(docs, pii.learn(docs))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.learn(docs, read_table(spark, sf_dir, "labels")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read_table(spark, sf_dir, "documents"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read_table(spark, sf_dir, "documents"), RANKS)


def op10_orc_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-ids")
    orc_output.write_token_ids(read_table(spark, sf_dir, "documents"), WORD_TOKENIZER, path)
    return orc_output.document_index(spark, path)


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return rule_ensemble.score_documents(docs, rule_ensemble.learn(docs, read_table(spark, sf_dir, "labels")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damaged(read_table(spark, sf_dir, "conversations")))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_license_scan": op2_license_scan,
    "op3_mixing": op3_mixing,
    "op4_pii": op4_pii,
    "op5_toxicity": op5_toxicity,
    "op6_quality_rules": op6_quality_rules,
    "op7_fingerprints": op7_fingerprints,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_orc_output": op10_orc_output,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_ranked_search": op13_ranked_search,
}

# Statements for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op8_minhash_dedup": statements.NEAR_DUPLICATES,
    "op12_conversation_repair": statements.CONVERSATION_REPAIR,
    "op13_ranked_search": statements.RANKED_SEARCH,
}

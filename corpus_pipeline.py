"""A corpus pipeline of the text operators; every stage is written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapframe.llm import bpe, mixing, neardup, pii, toxicity
from lapframe.llm.common import read_table, stored
from lapframe.llm.workload import MIX_TARGET, RANKS


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the machine calls toxic; it learns from the labels of ``docs``."""
    machine = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score_column(machine) < F.lit(0.5))


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Redact personal data; ``n_chars`` follows the text where it is changed."""
    clean = pii.redact(docs.withColumn("__before", F.col("text")), pii.learn(docs))
    changed = ~F.col("text").eqNullSafe(F.col("__before"))
    n_chars = F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", n_chars).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat the documents of small sources; every document stays at least once."""
    return mixing.repeated(docs, mixing.fit(docs, MIX_TARGET))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    return bpe.digests(docs, RANKS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("neardup", neardup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("encode", encode_stage),
]

# Two stages learn models, which SQL cannot express; tests/llm compares with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

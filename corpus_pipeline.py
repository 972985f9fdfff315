"""The corpus pipeline: documents in, training-ready documents out.

Five stages, each one operator of ``emporia.llm``; each result is written as
Parquet to the shared scratch folder and read again as the next one's input:
toxicity (rejected documents go), near duplicates (one of each group stays),
secrets (their spans are replaced), mixing sources to target weights (documents
repeat or go as their source's target asks), BPE encoding and decoding.

Defined cases: those of the operators; an empty table passes through as an empty
table; columns beyond those of ``documents`` pass all stages but are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import bpe_automaton, minhash, mixing, secret_scan, toxicity
from emporia.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC_AT = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below TOXIC_AT."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    # The row stays whole beside its score, so no column of it can clash.
    scored = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.where(F.col("score") < TOXIC_AT).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact or near copies."""
    return minhash.deduplicated(docs)


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secret spans replaced by a mark."""
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    return mixing.mixed_documents(docs, weights=(3, 1, 2), share=1.0, max_epochs=2.0)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, and the text decoded from these."""
    return bpe_automaton.coded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("secrets", replace_secrets),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

# Weighted sampling, a fitted model and BPE have no SQL form: tests/llm/test_pipeline.py
# chains plain versions of the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

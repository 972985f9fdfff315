"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import (
    bit_sliced,
    bpe_automaton,
    collocations,
    decontamination,
    minhash,
    mixing,
    multiprobe,
    periodic_runs,
    secret_scan,
    sharding,
    token_counts,
    toxicity,
    url_filter,
)
from emporia.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

# Small enough that the given tables need many shards.
SHARD_BYTES = 64 << 10


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_epochs=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def n(kind: str):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        n("assign"),
        n("access"),
        n("hex"),
        F.sha2(secret_scan.span_text(F.col("base_spans")), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("findings")).alias("spans"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), limit=512)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op6_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.round_trip(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiprobe.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op10_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_k(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.report(periodic_runs.periodic_runs(docs))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.report(found)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), top=2000)


QUERIES: dict[str, Query] = {
    "op1_source_mix": op1_source_mix,
    "op2_secret_scan": op2_secret_scan,
    "op3_toxicity": op3_toxicity,
    "op4_token_counts": op4_token_counts,
    "op5_sharding": op5_sharding,
    "op6_bpe_automaton": op6_bpe_automaton,
    "op7_url_filter": op7_url_filter,
    "op8_minhash": op8_minhash,
    "op9_multiprobe": op9_multiprobe,
    "op10_bit_sliced": op10_bit_sliced,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_decontamination": op12_decontamination,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op5_sharding": sharding.ORACLE.format(limit=SHARD_BYTES),
    "op7_url_filter": url_filter.oracle(),
    "op10_bit_sliced": bit_sliced.ORACLE,
    "op11_periodic_runs": periodic_runs.ORACLE,
    "op12_decontamination": decontamination.ORACLE,
    "op13_collocations": collocations.oracle(top=2000),
}

"""The registered queries of the training-data operators: thin, whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import contamination, host_rules, interpolation, language, line_dedup, neighbours, packing, secrets, simhash, token_store
from weir.llm.common import fold
from weir.llm.sql import ORACLE


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.interpolated_scores(_table(spark, sf_dir, "documents"))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_and_digest(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.fit(docs, ~fold(3, 1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold(3, 1).alias("held_out"), "text")
    return language.predict(rows, model, "doc_id", "held_out")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = neighbours.fit(docs, _table(spark, sf_dir, "labels"), ~fold(4, 2))
    return neighbours.score(docs, model).select("doc_id", fold(4, 2).alias("held_out"), "score", "predicted")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.apply_host_rules(_table(spark, sf_dir, "documents")).drop("host", "verdict")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_ALL = (
    op1_secrets, op2_packing, op3_lm_scoring, op4_token_ids, op5_language_id, op6_line_dedup, op7_quality,
    op8_quality_rules, op9_simhash, op10_decontamination,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
ORACLE_SQL: dict[str, str] = ORACLE

"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.llm import best_fit, byte_bpe, chat_format, collocations, cover_tree, decontaminate, hmm_lm, language_id, license_scan, seed_extend, simhash, suffix_dedup, turn_repair
from tickwell.llm.spark import ship_package
from tickwell.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@_query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.code(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@_query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


@_query
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = r"\### Assistant: </turn> ok"
    turns = F.array(*[F.struct(F.lit(i).alias("turn"), F.lit(role).alias("role")) for i, role in enumerate(("user", "assistant"))])
    extra = spark.range(1).select(F.explode(turns).alias("t")).select(F.lit(-7).alias("conv_id"), "t.turn", "t.role", F.lit(control).alias("text"))
    return chat_format.read_back(chat_format.examples(given.union(extra)))


@_query
def op7_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(_table(spark, sf_dir, "embeddings"))


@_query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


SQL["op6_license_scan"] = license_scan.scan_sql()


@_query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op9_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = seed_extend.dedup(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256", F.size("spans").cast("long").alias("n_spans"))


@_query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.dedup(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@_query
def op4_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score(_table(spark, sf_dir, "documents"))


@_query
def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations")
    return turn_repair.audit(given, turn_repair.repair(turn_repair.damaged(given)))


@_query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


SQL["op11_collocations"] = collocations.collocations_sql()

"""The training-data pipeline over documents: one operator a stage, each stage a written table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.llm import byte_bpe, decontaminate, language_id, simhash, suffix_dedup
from tickwell.llm.spark import ship_package, written
from tickwell.session import configure, scratch_dir

# A text whose best language has less than this pooled probability is rejected.
LEAST_SCORE = 0.4
# Passages of over 50 words that repeat are longer than this many bytes.
REPEATED_BYTES = 200


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts in a language the labelled documents teach; null texts and those without letters go."""
    return language_id.accepted(docs, language_id.train(docs), LEAST_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group linked by SimHash, one row of each of its fingerprints.

    Of rows without doc_id one of each fingerprint stays. Of equal rows any one is kept, as they are equal, and of
    rows of one id and one fingerprint that differ, the first one read.
    """
    row = "_row"
    while row in docs.columns:
        row = f"_{row}"
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = simhash.near_duplicates(numbered, carry=[row])
    first = found.filter("component_id is null or doc_id = component_id").groupBy("doc_id", "fingerprint")
    first = first.agg(F.min(F.col("rest").getField(row)).alias(row)).select(row)
    return numbered.join(first, row, "left_semi").select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts all byte strings that occur twice; a text of which nothing but space is left goes."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    kept = suffix_dedup.dedup(docs, REPEATED_BYTES, with_kept=True, carry=rest)
    kept = kept.filter((F.col("n_removed") == 0) | F.col("kept").rlike(r"\S"))
    made = kept.select("doc_id", F.col("kept").alias("text"), "rest.*", F.length("kept").cast("long").alias("n_chars"))
    return made.select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark questions, in their own or other parameters; rows without doc_id stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contaminated(docs, benchmark).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of what is left."""
    return byte_bpe.code(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("simhash", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", encode),
]
# Trained networks, suffix arrays and XXH64 fingerprints are not SQL: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each writes Parquet to the shared folder and the next one reads it."""
    ship_package(configure(spark))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

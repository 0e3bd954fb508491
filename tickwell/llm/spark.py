"""What the operators share on the Spark side."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.session import materialize, scratch_dir


def planned_bytes(df: DataFrame) -> int:
    """Bytes the optimizer expects of a table: of files, their size. No job runs for file or local tables."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size < 1 << 50:
        return size
    return df.select([F.col(f"`{c}`").cast("string") for c in df.columns]).select(
        F.coalesce(F.sum(sum([F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in df.columns])), F.lit(0))
    ).first()[0]


def shuffle_parts(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def block_count(docs: DataFrame, block_bytes: int) -> int:
    """Blocks of about block_bytes of text; texts take about twice the bytes of their files."""
    return max(1, -(-2 * planned_bytes(docs) // block_bytes))


def by_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int, carry: list[str] | None = None) -> DataFrame:
    """(block, doc_id, text, rest), spread over blocks of about block_bytes by a hash of the id.

    rest holds the columns to carry, null if there are none.
    The number of blocks grows with the input, so a block fits a task at any size.
    Rows without an id are spread by their text.
    """
    blocks = block_count(docs, block_bytes)
    doc_id = F.col(f"`{id_col}`").cast("long")
    text = F.col(f"`{text_col}`").cast("string")
    block = F.when(doc_id.isNull(), F.xxhash64(text)).otherwise(F.xxhash64(doc_id))
    rest = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("int")
    chosen = docs.select(F.pmod(block, F.lit(blocks)).alias("block"), doc_id.alias("doc_id"), text.alias("text"), rest.alias("rest"))
    return chosen.repartition(shuffle_parts(docs), "block")


def written(df: DataFrame, label: str) -> DataFrame:
    """A table written once to the shared folder, well compressed; shuffles that nothing refers to any more go."""
    path = scratch_dir(df.sparkSession, label)
    spark, schema = df.sparkSession, df.schema
    df.write.option("compression", "zstd").parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # Spark removes the files of shuffles once their plans are collected
    return spark.read.schema(schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of the undirected edges (a, b) reaches.

    Alternates large-star and small-star rounds until the edges stay the same. Every round is a
    written table, so a lost executor costs tasks, never the rounds before. Only counts reach
    the driver.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, seen = materialize(now, "edges"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 31))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = mark
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.union(least).distinct(), "edges")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where their path does not already hold it."""
    root = Path(__file__).resolve().parents[2]
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    app = spark.sparkContext.applicationId
    if str(root) in known or app in _shipped:
        return
    archive = Path(tempfile.mkdtemp()) / "tickwell.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted((root / "tickwell").rglob("*.py")):
            z.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))  # the driver serves it to all executors
    _shipped.add(app)

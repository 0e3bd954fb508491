"""Materialization: views for staging, Parquet tables per layer for marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.operators import staging
from tickwell.sources import scans


def layer_path(root: str, layer: str, name: str) -> str:
    """<root>/<layer>/<name>; layers are core and marts."""
    return f"{root.rstrip('/')}/{layer}/{name}"


def write_table(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> str:
    """Write a table, replacing it; partitions get files in proportion to their bytes."""
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    df.write.mode("overwrite").partitionBy(*partition_cols).parquet(path)
    return path


def save_table(df: DataFrame, root: str, layer: str, name: str, keys: Sequence[str], buckets: int) -> str:
    """Write a table of the catalog, in a database per layer, its files bucketed and sorted by keys; returns its name.

    Groupings and joins by the keys then need no shuffle.  One shuffle by the same keys before
    the write gives a file per bucket instead of one per bucket and task.
    """
    spark = df.sparkSession
    spark.sql(f"create database if not exists {layer}")
    full = f"{layer}.{name}"
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", layer_path(root, layer, name))
        .saveAsTable(full)
    )
    return full


def literal_rows(spark: SparkSession) -> DataFrame:
    """The two rows of the first example model: 1 and NULL."""
    one = spark.range(1).select(F.lit(1).alias("id"))
    null = spark.range(1).select(F.lit(None).cast("int").alias("id"))
    return one.unionByName(null)


def first_rows(df: DataFrame) -> DataFrame:
    """The second example model: rows of the first with id 1."""
    return df.filter(F.col("id") == 1)


def register_views(spark: SparkSession, root: str, layout: str = "objects", dates: Sequence | None = None) -> list[str]:
    """Register the staged views over a lake, and the example models.

    ``dates`` restricts the views to some days; the per-coin folders of the object layout are
    then read no further.  In the others a filter on snapshot_date prunes folders by itself.
    """
    example = literal_rows(spark)
    views = {
        "stg_coins_markets": staging.stg_snapshots(scans.scan_snapshots(spark, root, layout, dates)),
        "stg_coin_metadata": staging.stg_metadata(scans.scan_metadata(spark, root, layout, dates)),
        "stg_global": staging.stg_global(scans.scan_global(spark, root, layout, dates)),
        "stg_market_chart": staging.stg_chart_points(scans.scan_charts(spark, root, layout, dates)),
        "my_first_dbt_model": example,
        "my_second_dbt_model": first_rows(example),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)

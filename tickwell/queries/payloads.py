"""Market payloads made of the given tables.

events stand in for chart points (user = coin), orders for snapshot items, documents
for coin metadata, hourly sums of events for the global figures.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tickwell.functions.scalars import epoch_ms, hour_start
from tickwell.operators.landing import as_landing
from tickwell.queries.registry import table
from tickwell.session import create_root, scratch_dir
from tickwell.sources.objects import PLAIN_DISK
from tickwell.sources.requests import (
    CHART_PART,
    json_of,
    part_of,
    request_charts,
    request_documents,
    request_list,
)
from tickwell.sources.scans import with_key

BACKFILL_AT = datetime(2024, 2, 1)  # logical time of the backfill run
REFETCH_AT = datetime(2024, 2, 2)  # and of a later incremental run


def new_root(spark: SparkSession, label: str) -> str:
    return create_root(spark, scratch_dir(spark, label))


def objects_writer(documents: DataFrame) -> DataFrameWriter:
    """A writer of one small file per document.

    On a local disk Hadoop would put a checksum file beside each, and start a process per file it
    makes; its plain local file system makes the documents only.  Other file systems take no notice.
    """
    return documents.write.options(**PLAIN_DISK)


def unlanded(payloads: DataFrame) -> DataFrame:
    """Payloads as a scan of the landing table would give them, without storing them."""
    return with_key(as_landing(payloads))


def chart_values(factor: float = 1.0) -> dict[str, Column]:
    return {
        "prices": F.col("value") * factor,
        "market_caps": F.col("value") * 1000,
        "total_volumes": F.col("event_id"),
    }


def charts(
    spark: SparkSession,
    sf_dir: str,
    as_of: datetime = BACKFILL_AT,
    days: int | None = None,
    factor: float = 1.0,
    where: str = "true",
) -> DataFrame:
    events = table(spark, sf_dir, "events").filter(where)
    return request_charts(
        events, "user_id", "ts", "event_id", chart_values(factor), as_of, days
    )


def chart_parts(spark: SparkSession, sf_dir: str, series: dict[str, Column]) -> DataFrame:
    """Chart payloads whose rows are given as JSON-ready columns; NULL leaves a row out."""
    grouped = (
        table(spark, sf_dir, "events")
        .withColumn("t", epoch_ms(F.col("ts")).cast("double"))
        .groupBy(
            F.col("user_id").cast("string").alias("coin_id"),
            part_of(F.col("event_id"), CHART_PART).alias("part"),
        )
        .agg(*[F.collect_list(rows).alias(name) for name, rows in series.items()])
    )
    return grouped.select(
        F.lit("market_chart").alias("kind"),
        "coin_id",
        F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("fetched_at"),
        "part",
        json_of(F.struct(*series)).alias("payload"),
    )


def order_month() -> Column:
    return F.date_trunc("month", F.col("o_orderdate")).cast("timestamp_ntz")


def snapshots(spark: SparkSession, sf_dir: str, loose: bool = False, filled: bool = False) -> DataFrame:
    """Snapshot lists: the orders of a month, fetched at its start; o_custkey is no known key.

    ``loose`` writes integers as decimals and numbers as text, which a contract allows; ``filled`` makes as few parts as the items need.
    """
    rank, volume = F.col("o_custkey"), F.col("o_totalprice")
    if loose:
        rank, volume = rank.cast("double"), volume.cast("string")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    coin = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("symbol"),
        F.col("o_orderpriority").alias("name"),
        iso.alias("last_updated"),
        F.col("o_totalprice").alias("current_price"),
        (F.col("o_totalprice") * 4).alias("market_cap"),
        rank.alias("market_cap_rank"),
        volume.alias("total_volume"),
        F.lit(None).cast("double").alias("max_supply"),
        F.col("o_custkey"),
    )
    orders = table(spark, sf_dir, "orders")
    return request_list(orders, "coins_markets", order_month(), F.col("o_orderkey"), coin, filled)


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata documents: one per document, its text under its language."""
    text = F.col("text")
    home = F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), F.col("doc_id").cast("string"))
    body = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("symbol"),
        F.col("lang").alias("name"),
        F.array("lang", "source").alias("categories"),
        F.create_map(F.col("lang"), text).alias("description"),
        F.struct(
            F.array(F.when(F.col("lang") == "fr", "").otherwise(home), F.lit("")).alias("homepage"),
            F.when(F.col("lang") == "en", F.array(home)).otherwise(F.array().cast("array<string>")).alias("blockchain_site"),
        ).alias("links"),
        F.create_map(
            F.col("source"), F.when(F.col("lang") == "de", None).otherwise(F.col("lang")),
            F.lit(""), F.lit(""),
        ).alias("platforms"),
        F.lit("2009-01-03").alias("genesis_date"),
        F.col("n_chars").alias("market_cap_rank"),
        F.lit("2024-01-31T10:00:00.000Z").alias("last_updated"),
    )
    fetched = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    docs = table(spark, sf_dir, "documents")
    return request_documents(docs, "coins_metadata", F.col("doc_id"), fetched, body)


def exact_sum(c: Column) -> Column:
    """Sum in hundredths, exact whatever the order of summation."""
    return F.sum(c.cast("decimal(18,2)"))


def hourly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per hour, maps keyed by event type: sum and count; at most one entry per type."""
    by_type = (
        table(spark, sf_dir, "events")
        .groupBy(hour_start(F.col("ts")).alias("fetched_at"), "event_type")
        .agg(exact_sum(F.col("value")).cast("double").alias("cap"), F.count(F.lit(1)).alias("n"))
    )

    def as_map(value: str) -> Column:
        return F.map_from_entries(F.collect_list(F.struct("event_type", value)))

    return by_type.groupBy("fetched_at").agg(
        as_map("cap").alias("caps"), as_map("n").alias("counts"), F.sum("n").alias("n")
    )


def global_document() -> Column:
    return F.struct(
        F.col("n").alias("active_cryptocurrencies"),
        F.size("caps").alias("markets"),
        F.col("caps").alias("total_market_cap"),
        F.col("counts").alias("total_volume"),
        F.transform_values("counts", lambda _, v: v / F.col("n") * 100).alias("market_cap_percentage"),
        F.unix_seconds(F.col("fetched_at").cast("timestamp")).alias("updated_at"),
    )


def global_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = hourly_totals(spark, sf_dir)
    body = F.struct(global_document().alias("data"))
    return request_documents(
        totals, "global", F.lit(None), F.col("fetched_at"), body
    )

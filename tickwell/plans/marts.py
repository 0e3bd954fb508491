"""Derived facts, dimension and marts.

The source system only declares these outputs by name; their definitions are ours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.functions.scalars import drop_empty, hour_start, item, to_bigint
from tickwell.operators.consolidate import lag_by_day, latest_by, restrict_to, top_by
from tickwell.operators.staging import all_series
from tickwell.schemas import CHART_SERIES


def hourly_fact(snapshots: DataFrame) -> DataFrame:
    """Per coin and hour, the row of the latest fetch; the other columns, in order, settle ties."""
    hourly = snapshots.withColumn("hour", hour_start(F.col("fetched_at")))
    settled = ["landed_at"] if "landed_at" in snapshots.columns else []
    settled += [c for c in snapshots.columns if c not in ("coin_id", "fetched_at", *settled)]
    return latest_by(hourly, ["coin_id", "hour"], ["fetched_at", *settled])


def current_points(points: DataFrame) -> DataFrame:
    """Of streamed points, those of the version of each fetch that was landed last."""
    key = ["coin_id", "fetched_at"]
    latest = points.groupBy(*key).agg(F.max("landed_at").alias("landed_at"))
    return points.join(latest, [*key, "landed_at"], "left_semi").drop("landed_at")


def latest_points(points: DataFrame, value: str = "price_usd") -> DataFrame:
    """One row per coin and time: the point of the latest fetch, of equal times the highest value.

    All columns are fixed-width, which makes both steps hash aggregations with partial
    results in every task: a point fetched very often ships one row per task and fetch, and no
    rows are sorted.  Use ``latest_by`` for whole rows or further tie-breaks.
    """
    settled = points.groupBy("coin_id", "ts_ms", "fetched_at").agg(F.max(value).alias(value))
    return settled.groupBy("coin_id", "ts_ms").agg(
        F.max_by(value, "fetched_at").alias(value), F.max("fetched_at").alias("fetched_at")
    )


def daily_ohlc(points: DataFrame, value: str = "price_usd") -> DataFrame:
    """Per coin and UTC day: first, highest, lowest and last value, and number of points.

    ``points`` holds each (coin_id, ts_ms) once.
    """
    day = F.to_date(F.timestamp_millis("ts_ms")).alias("day")
    return points.groupBy("coin_id", day).agg(
        F.min_by(value, "ts_ms").alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, "ts_ms").alias("close"),
        F.count(F.lit(1)).alias("n_points"),
    )


def coin_dim(metadata: DataFrame, watch: DataFrame) -> DataFrame:
    """The watch list with each coin's latest metadata and cleaned links.

    ``metadata`` is the scan: nested values as JSON text, and ``fetched_at``.
    """
    links = F.from_json("links", "homepage array<string>, blockchain_site array<string>")
    # Cut to the watched coins first; the join then has one row per coin on both sides
    # and picks its own strategy from the measured bytes.
    watched = restrict_to(metadata, watch, "id")
    latest = latest_by(watched, ["id"], ["fetched_at", "filename"]).select(
        F.col("id"),
        F.get_json_object("description", "$.en").alias("description_en"),
        drop_empty(links["homepage"]).alias("homepages"),
        drop_empty(links["blockchain_site"]).alias("block_explorers"),
        F.col("genesis_date").try_cast("date").alias("genesis_date"),
        F.col("fetched_at").alias("metadata_fetched_at"),
    )
    return watch.join(latest, "id", "left").withColumnRenamed("id", "coin_id")


def market_health(totals: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Global rows in time order: level, change against the previous fetch, share of one coin.

    ``totals``: (*series, fetched_at, total_market_cap, coin_share_pct).
    """
    lagged = lag_by_day(totals, series, "fetched_at", ["total_market_cap"])
    change = F.col("total_market_cap") - F.col("prev_total_market_cap")
    return lagged.withColumn("cap_change", change).withColumn(
        "cap_change_pct",
        F.when(F.col("prev_total_market_cap") != 0, change / F.col("prev_total_market_cap") * 100),
    )


def top_movers(
    snapshots: DataFrame, k: int, change: str = "price_change_percentage_24h"
) -> DataFrame:
    """Per fetch, the k strongest gainers and the k strongest losers.

    Two rankings, each cut to k rows per fetch before its shuffle.
    """
    moved = snapshots.filter(F.col(change).isNotNull())
    up = top_by(moved, change, k, "coin_id", ["fetched_at"]).withColumn("direction", F.lit("gainer"))
    down = (
        top_by(moved.withColumn("_fall", -F.col(change)), "_fall", k, "coin_id", ["fetched_at"])
        .withColumn("direction", F.lit("loser"))
        .drop("_fall")
    )
    return up.unionByName(down)


def performance(
    daily: DataFrame, horizons: Sequence[int] = (1, 7, 30), average_days: int = 7, volatility_days: int = 30
) -> DataFrame:
    """Per coin and day: returns over the horizons, trailing mean of the close, volatility of
    daily log returns.

    A coin has one row per calendar day, which bounds the window; all frames share one
    partitioning and one sort.  A return from zero, and a log return from or to a value
    that is not positive, is NULL.
    """
    number = F.unix_date("day")
    coin = Window.partitionBy("coin_id").orderBy("_n")

    def days_ago(n: int) -> Column:
        return F.max("close").over(coin.rangeBetween(-n, -n))

    close = F.col("close")
    returns = [(F.try_divide(close, days_ago(n)) - 1).alias(f"return_{n}d") for n in horizons]
    positive = (close > 0) & (days_ago(1) > 0)
    log_return = F.when(positive, F.log(F.try_divide(close, days_ago(1))))
    # Two steps: the volatility frame runs over the log returns.
    stepped = daily.withColumn("_n", number).select(
        "coin_id",
        "day",
        "close",
        "_n",
        *returns,
        F.avg("close").over(coin.rangeBetween(1 - average_days, 0)).alias("moving_average"),
        log_return.alias("_log"),
    )
    spread = F.stddev_samp("_log").over(coin.rangeBetween(1 - volatility_days, 0))
    return stepped.withColumn("volatility", spread).drop("_n", "_log")


def currency_long(data: DataFrame, *carry: str, column: str = "total_market_cap") -> DataFrame:
    """One row per fetch and currency of a currency map."""
    return data.select(*carry, F.explode(column).alias("currency", "value"))


def chain_bridge(metadata: DataFrame, *carry: str) -> DataFrame:
    """One row per coin and chain with a contract address; empty names and addresses drop."""
    known = F.map_filter(
        "platforms", lambda chain, address: (chain != "") & address.isNotNull() & (address != "")
    )
    return metadata.select(*carry, F.explode(known).alias("chain", "address"))


def aligned_series(charts: DataFrame) -> DataFrame:
    """Price, market cap and volume side by side per coin, fetch and time.

    The three series need not share positions.  Each payload is decoded once, its
    points are tagged with their series and put back together by time; as all points
    of a payload start out in one task, the partial aggregation already joins them.
    """
    names = list(CHART_SERIES)
    def rows_of(doc: Column, tag: int, name: str) -> Column:
        series = F.coalesce(doc[name], F.array().cast("array<array<double>>"))
        return F.transform(
            series,
            lambda p: F.struct(F.lit(tag).alias("s"), item(p, 1).alias("t"), item(p, 2).alias("v")),
        )

    def tagged(doc: Column) -> Column:
        return F.concat(*[rows_of(doc, i, n) for i, n in enumerate(names)])

    bound = F.get(F.transform(F.array(all_series()), tagged), 0)
    points = charts.select("coin_id", "fetched_at", F.inline(bound))
    values = [
        F.max(F.when(F.col("s") == i, F.col("v"))).alias(CHART_SERIES[n]) for i, n in enumerate(names)
    ]
    return points.groupBy("coin_id", "fetched_at", to_bigint(F.col("t")).alias("ts_ms")).agg(*values)

"""The four staged views, and the generators below them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.functions.scalars import item, json_first, json_text, map_value, text_to, to_bigint
from tickwell.schemas import CHART_SERIES, SNAPSHOT_COLUMNS

_SNAPSHOT_TYPES = dict(SNAPSHOT_COLUMNS)


def _fetch() -> list[Column]:
    return [F.col("date").alias("snapshot_date"), F.col("fetched_at")]


def stg_snapshots(df: DataFrame, lenient: bool = False) -> DataFrame:
    """stg_coins_markets: one row per coin and fetch."""

    def typed(name: str) -> Column:
        return text_to(F.col(name), _SNAPSHOT_TYPES[name], lenient)

    return df.select(
        F.col("id").alias("coin_id"),
        "symbol",
        "name",
        *[
            typed(c).alias(c)
            for c in (
                "current_price",
                "market_cap",
                "market_cap_rank",
                "total_volume",
                "high_24h",
                "low_24h",
                "price_change_24h",
                "price_change_percentage_24h",
                "circulating_supply",
                "total_supply",
                "max_supply",
            )
        ],
        typed("last_updated").alias("api_last_updated"),
        *_fetch(),
    )


def stg_metadata(df: DataFrame, lenient: bool = False) -> DataFrame:
    """stg_coin_metadata: one row per document; coin_id is the document's own id."""
    return df.select(
        F.col("id").alias("coin_id"),
        "symbol",
        "name",
        "categories",
        "platforms",
        json_text(F.col("description"), "en").alias("description_en"),
        json_first(F.col("links"), "homepage").alias("homepage_url"),
        json_first(F.col("links"), "blockchain_site").alias("block_explorer_url"),
        "genesis_date",
        text_to(F.col("market_cap_rank"), "bigint", lenient).alias("market_cap_rank"),
        F.col("last_updated").alias("api_last_updated"),
        *_fetch(),
    )


def stg_global(df: DataFrame, currency: str = "usd", coin: str = "btc", lenient: bool = False) -> DataFrame:
    """stg_global: one row per fetch, totals in one currency and the share of one coin."""

    def total(name: str, key: str) -> Column:
        return text_to(map_value(F.col(f"data.{name}"), key), "double", lenient)

    def count(name: str) -> Column:
        return text_to(F.col(f"data.{name}"), "bigint", lenient)

    return df.select(
        count("active_cryptocurrencies").alias("active_cryptocurrencies"),
        total("total_market_cap", currency).alias(f"total_market_cap_{currency}"),
        count("markets").alias("markets"),
        total("total_volume", currency).alias(f"total_volume_{currency}"),
        total("market_cap_percentage", coin).alias(f"{coin}_dominance_pct"),
        *_fetch(),
    )


def _numbers(fast: Column, text: Column, lenient: bool) -> Column:
    """Rows of doubles: those decoded as numbers if they are whole, else their text, cast."""
    whole = F.forall(fast, lambda p: F.coalesce(F.forall(p, lambda x: x.isNotNull()), F.lit(False)))
    slow = F.transform(text, lambda p: F.transform(p, lambda x: text_to(x, "double", lenient)))
    return F.when(whole, fast).otherwise(slow)


def _decoded(shape: str, bind, lenient: bool) -> Column:
    """bind(payload decoded with doubles, payload decoded with text).

    Numbers decode directly.  Where that leaves a hole (a number written as text)
    the payload is decoded again as text and cast, so nothing turns NULL unnoticed;
    a payload that is no JSON at all is an error unless lenient.
    """
    mode = {"mode": "PERMISSIVE" if lenient else "FAILFAST"}
    text = F.from_json("payload", shape.replace("double", "string"), mode)
    # One-item transform: binds the decoded payload, which is then decoded only once.
    return F.get(F.transform(F.array(F.from_json("payload", shape)), lambda fast: bind(fast, text)), 0)


def series_of(name: str, lenient: bool = False) -> Column:
    """A chart series as rows of doubles."""
    return _decoded(f"struct<{name}:array<array<double>>>", lambda fast, text: _numbers(fast[name], text[name], lenient), lenient)


def all_series(lenient: bool = False) -> Column:
    """The three series of a chart payload as rows of doubles, from one decoding."""
    shape = ",".join(f"{n}:array<array<double>>" for n in CHART_SERIES)

    def bind(fast: Column, text: Column) -> Column:
        return F.struct(*[_numbers(fast[n], text[n], lenient).alias(n) for n in CHART_SERIES])

    return _decoded(f"struct<{shape}>", bind, lenient)


def candle_rows(lenient: bool = False) -> Column:
    """The rows of a candle payload as doubles."""
    return _decoded("array<array<double>>", lambda fast, text: _numbers(fast, text, lenient), lenient)


def chart_points(df: DataFrame, series: str = "prices", lenient: bool = False, *carry: str) -> DataFrame:
    """One row per pair of a chart series; a null or empty series gives none."""
    # The generator holds the decoding itself: written over a column, the optimizer
    # would add a size filter below and decode every payload twice.
    return df.select(
        "coin_id",
        "fetched_at",
        F.col("date").alias("snapshot_date"),
        *carry,
        F.explode(series_of(series, lenient)).alias("point"),
    )


def stg_chart_points(df: DataFrame, series: str = "prices", lenient: bool = False, *carry: str) -> DataFrame:
    """stg_market_chart: one row per point of a coin's series and fetch; ``carry`` names columns to keep."""
    point = F.col("point")
    return chart_points(df, series, lenient, *carry).select(
        "coin_id",
        "fetched_at",
        "snapshot_date",
        to_bigint(item(point, 1)).alias("ts_ms"),
        item(point, 2).alias(CHART_SERIES[series]),
        *carry,
    )


def ohlc_rows(df: DataFrame, *carry: str) -> DataFrame:
    """One row per candle of decoded ``rows``; ``carry`` names columns to keep."""
    candle = F.col("candle")
    return df.select(*carry, F.explode("rows").alias("candle")).select(
        *carry,
        to_bigint(item(candle, 1)).alias("ts_ms"),
        item(candle, 2).alias("open"),
        item(candle, 3).alias("high"),
        item(candle, 4).alias("low"),
        item(candle, 5).alias("close"),
    )

"""Building payloads from tables, in the shape the market data API answers with.

The engine does no network calls: a table of points, coins or totals takes the
place of the API, and each function here the place of one request kind.  A response
that would be long is split into parts of a bounded id range, so one coin, day or
list never becomes one unbounded document.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.functions.scalars import epoch_ms
from tickwell.operators.consolidate import last_n_days
from tickwell.schemas import CHART_SERIES

CHART_PART = 1 << 18  # at most this many points in one part of a chart
LIST_PART = 1 << 14  # at most this many items in one part of a list

_KEEP_NULLS = {"ignoreNullFields": "false"}


def part_of(unique_id: Column, size: int) -> Column:
    """Part number of a row; ids are unique, so a part has at most ``size`` (2^n) rows."""
    return F.shiftright(unique_id.cast("bigint"), size.bit_length() - 1)


def json_of(value: Column) -> Column:
    return F.to_json(value, _KEEP_NULLS)


def request_charts(
    points: DataFrame,
    coin: str,
    ts: str,
    unique_id: str,
    values: dict[str, Column],
    as_of: datetime,
    days: int | None = None,
) -> DataFrame:
    """Chart payloads of all coins at one logical time: ``days=7`` trailing, None for all.

    ``values`` gives the value of each of the three series.  One grouping for all
    coins; nothing loops over coins.
    """
    # One list per coin carries time and all three values, so time is shuffled once.
    point = F.struct(
        epoch_ms(F.col(ts)).cast("double").alias("t"),
        *[values[name].cast("double").alias(name) for name in CHART_SERIES],
    )
    grouped = (
        last_n_days(points, ts, as_of, days)
        .groupBy(
            F.col(coin).cast("string").alias("coin_id"),
            part_of(F.col(unique_id), CHART_PART).alias("part"),
        )
        # In time order, as responses are; a rerun then writes the same text.
        .agg(F.array_sort(F.collect_list(point)).alias("points"))
    )

    def series(name: str) -> Column:
        return F.transform("points", lambda p: F.array(p["t"], p[name])).alias(name)

    return grouped.select(
        F.lit("market_chart").alias("kind"),
        "coin_id",
        F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz").alias("fetched_at"),
        "part",
        json_of(F.struct(*[series(name) for name in CHART_SERIES])).alias("payload"),
    )


def with_parts(items: DataFrame, fetched_at: Column, unique_id: Column, size: int) -> DataFrame:
    """Add ``fetched_at`` and ``part``: the items of a fetch in id order, cut into parts of at most ``size`` (2^n).

    Ranges of half as many ids are counted, one short row each, and put together until they hold
    half a part; so the number of parts follows the items and not the range of their ids.
    """
    ranged = items.withColumns({"fetched_at": fetched_at, "_range": part_of(unique_id, size // 2)})
    counted = ranged.groupBy("fetched_at", "_range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("fetched_at").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    part = part_of(F.coalesce(F.sum("n").over(before), F.lit(0)), size // 2)
    parts = counted.select(F.col("fetched_at").alias("_at"), F.col("_range").alias("_of"), part.alias("part"))
    same = F.col("fetched_at").eqNullSafe(F.col("_at")) & F.col("_range").eqNullSafe(F.col("_of"))
    return ranged.join(parts, same).drop("_range", "_at", "_of")


def request_list(
    items: DataFrame, kind: str, fetched_at: Column, unique_id: Column, item: Column, filled: bool = False
) -> DataFrame:
    """Payloads that are a JSON list of items per fetch (snapshots, candles).

    ``filled`` counts the items first, so that few parts hold many: for payloads stored as a file each.
    """
    if filled:
        parted = with_parts(items.withColumn("_item", item), fetched_at, unique_id, LIST_PART)
        grouped = parted.groupBy("fetched_at", "part").agg(F.collect_list("_item").alias("items"))
    else:
        grouped = items.groupBy(
            fetched_at.alias("fetched_at"), part_of(unique_id, LIST_PART).alias("part")
        ).agg(F.collect_list(item).alias("items"))
    return grouped.select(
        F.lit(kind).alias("kind"), "fetched_at", "part", json_of(F.col("items")).alias("payload")
    )


def request_documents(
    items: DataFrame, kind: str, coin: Column, fetched_at: Column, document: Column
) -> DataFrame:
    """One JSON document per row (metadata, global); no grouping."""
    return items.select(
        F.lit(kind).alias("kind"),
        coin.cast("string").alias("coin_id"),
        fetched_at.alias("fetched_at"),
        json_of(document).alias("payload"),
    )

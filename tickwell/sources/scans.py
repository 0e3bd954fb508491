"""Scans of the four staged sources, over objects or over the landing table.

Both layouts give the same rows.  ``root`` is any Hadoop path.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwell.operators.landing import logical_key, read_raw
from tickwell.operators.staging import candle_rows
from tickwell.schemas import GLOBAL_TEXT, METADATA_TEXT, SNAPSHOT_TEXT
from tickwell.sources import objects


def _rows(schema: T.StructType, lenient: bool) -> Column:
    """One row per document of a payload: the items of a top-level list, else the object."""
    mode = "PERMISSIVE" if lenient else "FAILFAST"
    return F.inline(F.from_json("payload", T.ArrayType(schema), {"mode": mode}))


def landed(spark: SparkSession, root: str, kind: str, dates=None) -> DataFrame:
    """Landed payloads of one kind; kind and dates prune directories."""
    days = sorted(date.fromisoformat(str(d)) for d in dates) if dates is not None else []
    df = read_raw(spark, root, (days[0], days[-1]) if days else None).filter(F.col("kind") == kind)
    if dates is not None:
        df = df.filter(F.col("date").isin([F.lit(d) for d in days]))
    return with_key(df)


def with_key(payloads: DataFrame) -> DataFrame:
    """Give payload rows the filename they would have as objects."""
    return logical_key(payloads).withColumnRenamed("key", "filename")


def decode_snapshots(payloads: DataFrame, lenient: bool = False) -> DataFrame:
    """One row per item of each snapshot payload."""
    return payloads.select("filename", "date", "fetched_at", _rows(SNAPSHOT_TEXT, lenient))


def decode_metadata(payloads: DataFrame, lenient: bool = False) -> DataFrame:
    """One row per metadata document, nested values as JSON text."""
    return payloads.select("filename", "date", "fetched_at", _rows(METADATA_TEXT, lenient))


def decode_global(payloads: DataFrame, lenient: bool = False) -> DataFrame:
    """One row per global document, its envelope in ``data``."""
    return payloads.select("filename", "date", "fetched_at", _rows(GLOBAL_TEXT, lenient))


def scan_snapshots(spark, root, layout="objects", dates=None, lenient=False) -> DataFrame:
    if layout == "objects":
        return objects.object_snapshots(spark, root, dates, lenient)
    return decode_snapshots(landed(spark, root, "coins_markets", dates), lenient)


def scan_metadata(spark, root, layout="objects", dates=None, lenient=False) -> DataFrame:
    if layout == "objects":
        return objects.object_metadata(spark, root, dates, lenient)
    return decode_metadata(landed(spark, root, "coins_metadata", dates), lenient)


def scan_global(spark, root, layout="objects", dates=None, lenient=False) -> DataFrame:
    if layout == "objects":
        return objects.object_global(spark, root, dates, lenient)
    return decode_global(landed(spark, root, "global", dates), lenient)


def scan_charts(spark, root, layout="objects", dates=None, lenient=False) -> DataFrame:
    """Chart payloads; the series are decoded where they are unnested."""
    if layout == "objects":
        return objects.object_charts(spark, root, dates, lenient)
    return landed(spark, root, "market_chart", dates)


def scan_ohlc(payloads: DataFrame) -> DataFrame:
    """Candle payloads with their rows decoded."""
    return payloads.withColumn("rows", candle_rows())

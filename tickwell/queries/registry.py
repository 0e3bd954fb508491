"""Registered queries: each a DataFrame builder over the given tables, most with the SQL
that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.session import bytes_below, configure, size_shuffles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, so results compare across engines."""
    return df.select(
        *[
            F.col(c).cast("string").alias(c) if t.startswith(("date", "timestamp")) else F.col(c)
            for c, t in df.dtypes
        ]
    )


def query(sql: str | None = None):
    """Register a function under its name, with its SQL twin."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            own = spark.newSession()  # its settings are not the caller's
            size_shuffles(configure(own), bytes_below(own, sf_dir))
            return portable(build(own, sf_dir))

        name = build.__name__
        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return build

    return register

"""Latest fetch wins, time windows, ranking and key restriction."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest ``order`` columns of every key.

    ``= 1`` on the row number lets Spark keep one row per key in every task before
    the shuffle, so a key with very many copies sends one row per task.
    """
    rank = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(rank)).filter("_rank = 1").drop("_rank")


def last_n_days(df: DataFrame, ts: str, as_of: datetime, days: int | None) -> DataFrame:
    """Rows of the last N days before ``as_of``; None keeps all.

    The bound is a literal, so it reaches the Parquet scan.
    """
    if days is None:
        return df
    upper = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    lower = upper - F.make_dt_interval(F.lit(days))
    return df.filter((F.col(ts) >= lower) & (F.col(ts) <= upper))


def top_by(
    df: DataFrame, by: str, k: int = 100, tie: str = "id", per: Sequence[str] | None = None
) -> DataFrame:
    """The k rows with the highest value, over the table or per group; nulls last."""
    order = [F.col(by).desc_nulls_last(), F.col(tie)]
    if not per:
        return df.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.partitionBy(*per).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def restrict_to(df: DataFrame, watch: DataFrame, key: str) -> DataFrame:
    """Rows whose key is on the watch list."""
    # No hint and no count: adaptive execution broadcasts the ids once their bytes are known.
    return df.join(watch.select(F.col("id").alias(key)).distinct(), key, "left_semi")


def ids_string(
    watch: DataFrame, position: str = "position", page_size: int = 100, id_col: str = "id"
) -> DataFrame:
    """Comma-joined ids in list order, one row per request page of ``page_size`` positions.

    Positions are unique, so a page never holds more than ``page_size`` ids.
    """
    page = F.floor(F.col(position) / page_size).cast("bigint")
    entries = F.array_sort(F.collect_list(F.struct(F.col(position), F.col(id_col).cast("string").alias("id"))))
    return (
        watch.groupBy(page.alias("page"))
        .agg(entries.alias("entries"))
        .select("page", F.array_join(F.col("entries.id"), ",").alias("ids"))
    )


def lag_by_day(df: DataFrame, series: Sequence[str], ts: str, columns: Sequence[str]) -> DataFrame:
    """Add ``prev_<column>``: the value of the previous row in time, per series.

    A plain window per series would put a whole series into one task.  Here the
    window is per series and day; only the last row of each day, one per calendar
    day, is compared across days.  ``ts`` is unique within a series.
    """
    day = F.to_date(ts)
    values = F.struct(*[F.col(c) for c in columns])
    within = Window.partitionBy(*series, "_day").orderBy(ts)
    across = Window.partitionBy(*series).orderBy("_day")
    rows = df.withColumn("_day", day)
    lagged = rows.withColumn("_prev", F.lag(values).over(within)).withColumn(
        "_first", F.row_number().over(within) == 1
    )
    closing = rows.groupBy(*series, "_day").agg(
        *[F.max_by(c, ts).alias(f"_c{i}") for i, c in enumerate(columns)]
    )
    before = closing.select(
        *[F.col(c).alias(f"_s{i}") for i, c in enumerate(series)],
        F.col("_day").alias("_d"),
        *[F.lag(f"_c{i}").over(across).alias(f"_b{i}") for i in range(len(columns))],
    )
    # Joined for the first row of a day only.
    on = F.col("_first") & (F.col("_day") == F.col("_d"))
    for i, c in enumerate(series):
        on = on & F.col(c).eqNullSafe(F.col(f"_s{i}"))
    joined = lagged.join(before, on, "left")
    previous = [
        F.coalesce(F.col("_prev")[c], F.col(f"_b{i}")).alias(f"prev_{c}") for i, c in enumerate(columns)
    ]
    return joined.select(*df.columns, *previous)



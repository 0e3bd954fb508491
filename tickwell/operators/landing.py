"""Landing: raw payloads stored unchanged under deterministic keys, append only.

One Parquet table holds the payload text of all kinds below ``<root>/raw``.  Its
directories are kind and date of the fetch and the run that landed it, so their number
follows the calendar whatever the number of coins, and inside them files are sorted by
(fetched_at, coin_id), so keyed reads skip row groups.

A run only ever adds files, and nobody sees them before the run's row stands in the small
table ``<root>/runs``: readers take the runs first and then list the files, so they see a
run whole or not at all.  A fetch that is landed again is stored again with a later
``landed_at``, and its key is noted below ``<root>/replaced`` before the run is marked;
readers keep the latest version of the noted keys.  So runs never wait for, rewrite or
delete each other's data, whatever dates they share.  ``compact`` is such a run too.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.functions import keys
from tickwell.functions.scalars import utc
from tickwell.schemas import ALL_COINS, LANDING, LANDING_DIRS, LANDING_KEY, REPLACED, RUNS, SUPERSEDED
from tickwell.session import path_exists


def landing_path(root: str) -> str:
    if not root:
        raise ValueError("a lake root is required")
    return f"{root.rstrip('/')}/raw"


def as_landing(payloads: DataFrame) -> DataFrame:
    """(kind, [coin_id], fetched_at, [part], payload) in the columns of the landing table."""
    at = F.date_trunc("second", utc(F.col("fetched_at"))).cast("timestamp_ntz")
    coin = F.col("coin_id").cast("string") if "coin_id" in payloads.columns else F.lit(None)
    part = F.col("part").cast("bigint") if "part" in payloads.columns else F.lit(0).cast("bigint")
    return payloads.select(
        F.coalesce(coin, F.lit(ALL_COINS)).alias("coin_id"),
        at.alias("fetched_at"),
        part.alias("part"),
        F.lit(None).cast("bigint").alias("landed_at"),
        F.col("payload"),
        F.col("kind"),
        F.to_date(at).alias("date"),
        F.lit(None).cast("string").alias("batch"),
    )


def logical_key(df: DataFrame) -> DataFrame:
    """Add the object key each landed row has in the store's own naming."""
    prefix = keys.key_prefix(F.col("kind"), F.col("coin_id"))
    return df.withColumn("key", keys.raw_key(prefix, F.col("fetched_at")))


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """All stored rows with the explicit schema (numeric coin ids stay text): old versions and unfinished runs too."""
    return spark.read.schema(LANDING).parquet(landing_path(root))


def _beside(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame | None:
    """A small table beside the landing table; None while it does not exist."""
    path = f"{root.rstrip('/')}/{name}"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """The runs that are complete."""
    runs = _beside(spark, root, "runs", RUNS)
    return spark.createDataFrame([], RUNS) if runs is None else runs


def _read_complete(spark: SparkSession, root: str, between) -> tuple[DataFrame, DataFrame | None]:
    """Stored rows of complete runs, but for those another complete run has rewritten, and the keys noted by these runs."""
    runs = _beside(spark, root, "runs", RUNS)  # before the files are listed: a marked run has all its files
    if runs is None:
        return spark.createDataFrame([], LANDING), None
    noted = _beside(spark, root, "replaced", REPLACED)
    gone = _beside(spark, root, "superseded", SUPERSEDED)
    stored = read_versions(spark, root).filter(between).join(runs.select("batch"), "batch", "left_semi")
    stored = stored.select(*LANDING.fieldNames())
    if gone is not None:
        gone = gone.join(runs.select(F.col("batch").alias("by")), "by", "left_semi")
        stays = (stored["batch"] == gone["batch"]) & stored["date"].between(gone["first_date"], gone["last_date"])
        stored = stored.join(gone, stays, "left_anti")
    if noted is not None:
        noted = noted.filter(between).join(runs.select("batch"), "batch", "left_semi")
    return stored, noted


def read_raw(spark: SparkSession, root: str, dates: tuple[date, date] | None = None) -> DataFrame:
    """The landing table: of every fetch the latest version, of the given range of dates.

    The table of runs, one short row each, meets the directories' run in a semi-join.  Only
    while the log of replaced keys holds any of these dates is there a join on key
    columns, against one short row per replaced fetch.
    """
    between = F.col("date").between(*map(F.lit, dates)) if dates else F.lit(True)
    stored, noted = _read_complete(spark, root, between)
    if noted is None or noted.isEmpty():
        return stored
    key = [*LANDING_KEY, "date"]
    noted = noted.select(*key).distinct()
    latest = stored.select(*key, "landed_at").join(noted, key, "left_semi")
    latest = latest.groupBy(*key).agg(F.max("landed_at").alias("_latest"))
    kept = stored.join(latest, key, "left").filter("_latest is null or landed_at = _latest")
    return kept.select(*stored.columns)


@dataclass(frozen=True)
class Landed:
    """What a landing run stored: enough to read exactly its rows back."""

    root: str
    batch: str
    rows: int
    first_date: date | None
    last_date: date | None


def land_raw(payloads: DataFrame, root: str, order_by: str | None = None) -> Landed:
    """Store payloads; readers see the version landed last of a fetch, and all others.

    The unit of replacement is (kind, coin_id, fetched_at) with all its parts.  The run
    writes its rows, checks what it has stored, notes those of its keys that are stored in
    another version too, and last is marked complete: a run that is lost on the way changes
    nothing that is read.  The input is computed once.  Two runs that land one fetch at once
    both may note it; the later landed_at wins.  A lost executor costs a task retry and nothing else.

    ``order_by`` names a column of the input that decides between several versions of
    one fetch inside the batch (highest wins); without it a batch that holds one
    (kind, coin_id, fetched_at, part) twice is refused.
    """
    spark = payloads.sparkSession
    path = landing_path(root)
    if not path_exists(spark, root):
        raise FileNotFoundError(f"lake root does not exist: {root}")
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        raise ValueError("landing needs a UTC session: call session.configure")

    if order_by:
        # The top version is found on key columns only; payloads then meet it in a semi-join.
        coin = F.col("coin_id").cast("string") if "coin_id" in payloads.columns else F.lit(None)
        keyed = payloads.withColumns(
            {
                "_at": F.date_trunc("second", utc(F.col("fetched_at"))),
                "_coin": F.coalesce(coin, F.lit(ALL_COINS)),
                "_version": F.col(order_by),
            }
        )
        top = keyed.groupBy("kind", "_coin", "_at").agg(F.max("_version").alias("_version"))
        payloads = keyed.join(top, ["kind", "_coin", "_at", "_version"], "left_semi").select(*payloads.columns)

    run = uuid.uuid4().hex
    landed_at = time.time_ns() // 1000
    arriving = as_landing(payloads).withColumns({"batch": F.lit(run), "landed_at": F.lit(landed_at)})
    write_rows(arriving, path)
    return _complete(spark, root, run, landed_at)


def write_rows(rows: DataFrame, path: str) -> None:
    """Add rows to the landing table.

    Rebalance: one shuffle by directory and a share of the coins, hot directories split and
    small ones merged at run time, so the number of files follows the bytes.
    """
    (
        rows.withColumn("_share", F.pmod(F.xxhash64("coin_id"), F.lit(16)))
        .hint("rebalance", *LANDING_DIRS, "_share")
        .sortWithinPartitions(*LANDING_DIRS, "fetched_at", "coin_id", "part")
        .drop("_share")
        .write.mode("append")
        .partitionBy(*LANDING_DIRS)
        .parquet(path)
    )


def _folders(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Directories of the landing table that fit a pattern below it; no file is listed."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{landing_path(root)}/{pattern}")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    return [status.getPath().toString() for status in found or []]


def _read_folders(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], LANDING)
    return spark.read.schema(LANDING).option("basePath", landing_path(root)).parquet(*folders)


def _complete(spark: SparkSession, root: str, run: str, landed_at: int) -> Landed:
    """Check the stored rows of a run, note the keys it has landed again, and mark it complete."""
    folders = _folders(spark, root, f"kind=*/date=*/batch={run}")
    own = _read_folders(spark, root, folders)
    # Key columns only.  The result has a row per day.
    parts = own.groupBy(*LANDING_KEY, "part", "date").agg(F.count(F.lit(1)).alias("n"))
    days = parts.groupBy("date").agg(F.sum("n").alias("rows"), F.max("n").alias("most")).collect()
    if any(day["most"] > 1 for day in days):
        _remove(spark, folders)
        raise ValueError("the batch holds one part of a fetch twice: say which counts with order_by")
    dates = sorted(day["date"] for day in days if day["date"] is not None)
    landed = Landed(root, run, sum(day["rows"] for day in days), dates[0] if dates else None, dates[-1] if dates else None)
    if landed.rows:
        _note_replaced(spark, landed)
        _mark(spark, landed, landed_at)
    return landed


def _remove(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _note_replaced(spark: SparkSession, landed: Landed) -> None:
    """Write down the keys of a run that other runs have stored too; reads key columns of the run's own days only."""
    own = _folders(spark, landed.root, f"kind=*/date=*/batch={landed.batch}")
    days = sorted({folder.rsplit("/", 1)[0] for folder in own})
    columns = [*LANDING_KEY, "date"]
    stored = _read_folders(spark, landed.root, days).select(*columns, "batch")
    own = stored.filter(F.col("batch") == landed.batch).select(*columns).distinct()
    others = stored.filter(F.col("batch") != landed.batch).select(*columns)
    again = own.join(others, columns, "left_semi").withColumn("batch", F.lit(landed.batch))
    again = again.persist()
    if not again.isEmpty():
        again.write.mode("append").parquet(f"{landed.root.rstrip('/')}/replaced")
    again.unpersist()


def _mark(spark: SparkSession, landed: Landed, landed_at: int) -> None:
    """One row in one file: it appears at once."""
    values = (landed.batch, landed_at, landed.rows, landed.first_date, landed.last_date)
    fields = [f.split() for f in RUNS.split(", ")]
    row = spark.range(1, numPartitions=1).select(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(values, fields)])
    row.write.mode("append").parquet(f"{landed.root.rstrip('/')}/runs")


def compact(spark: SparkSession, root: str, dates: tuple[date, date]) -> Landed:
    """Rewrite a range of dates as one run without old versions, while others read and land.

    The rewritten runs give way, for these dates, with the mark of the new one; those that are
    complete only after this call has begun stay.  Their files remain until ``vacuum``.
    """
    rewritten = [row["batch"] for row in read_runs(spark, root).filter((F.col("first_date") <= F.lit(dates[1])) & (F.col("last_date") >= F.lit(dates[0]))).collect()]
    run = uuid.uuid4().hex
    write_rows(read_raw(spark, root, dates).filter(F.col("batch").isin(rewritten)).withColumn("batch", F.lit(run)), landing_path(root))
    folders = _folders(spark, root, f"kind=*/date=*/batch={run}")
    rows = _read_folders(spark, root, folders).count()
    landed = Landed(root, run, rows, *dates)
    if rows:
        gone = [F.struct(F.lit(b).alias("batch"), F.lit(dates[0]).alias("first_date"), F.lit(dates[1]).alias("last_date"), F.lit(run).alias("by")) for b in rewritten]
        spark.range(1, numPartitions=1).select(F.inline(F.array(*gone))).write.mode("append").parquet(f"{root.rstrip('/')}/superseded")
        _mark(spark, landed, time.time_ns() // 1000)
    return landed


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete what ``compact`` has made useless; run it when no reader older than the last ``compact`` is left."""
    gone = _beside(spark, root, "superseded", SUPERSEDED)
    if gone is None:
        return 0
    runs = read_runs(spark, root).select(F.col("batch").alias("by"))
    removed = 0
    for row in gone.join(runs, "by", "left_semi").collect():
        folders = [f for f in _folders(spark, root, f"kind=*/date=*/batch={row['batch']}") if str(row["first_date"]) <= f.split("/date=")[1][:10] <= str(row["last_date"])]
        _remove(spark, folders)
        removed += len(folders)
    return removed


def read_batch(spark: SparkSession, landed: Landed) -> DataFrame:
    """Exactly the stored rows of one landing run; no join, only its directories are read."""
    return _read_folders(spark, landed.root, _folders(spark, landed.root, f"kind=*/date=*/batch={landed.batch}"))


def read_landed(spark: SparkSession, root: str, fetches: DataFrame) -> DataFrame:
    """Stored payloads of many fetches at once, given as (kind, coin_id, fetched_at)."""
    wanted = as_landing(fetches.withColumn("payload", F.lit(None).cast("string"))).select(
        *LANDING_KEY, "date"
    )
    wanted = wanted.distinct()
    span = wanted.agg(F.min("date"), F.max("date")).first()
    if span[0] is None:
        return spark.createDataFrame([], LANDING)
    # No hint: adaptive execution broadcasts the wanted keys if their bytes allow.
    return read_raw(spark, root, tuple(span)).join(wanted, [*LANDING_KEY, "date"], "left_semi")

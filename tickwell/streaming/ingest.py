"""Incremental ingestion with Structured Streaming.

Both jobs read a growing folder with a fixed schema and run with ``availableNow``, so
the same call serves a scheduled batch and a catch-up.  Each micro-batch is written
so that repeating it changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickwell.functions import keys
from tickwell.operators.landing import Landed, land_raw, logical_key, read_versions
from tickwell.operators.staging import stg_chart_points
from tickwell.schemas import KEY_PREFIX, RUNS
from tickwell.session import materialize, path_exists
from tickwell.sources.objects import OBJECT, payloads_from_objects


# By default a file stream leaves out files a week older than the newest it has seen.
NEVER_OLD = "36500d"
# A fetch is an object, or a folder of such a name with one or more files, its parts.
FETCH = r"^(.*/fetched_at=[^/]*\.json)"
# Beyond so many changed folders whole days are read instead of single folders; the rows are the same.
FOLDERS = 10_000
_SEEN = "fetch string, state string, at long"


def listed_objects(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, fetch, modified) of the objects below some folders: a listing, no content is read."""
    path = F.col("_metadata.file_path")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(paths)
        .filter(path.rlike(OBJECT))
        .select(path.alias("path"), F.regexp_extract(path, FETCH, 1).alias("fetch"), F.col("modificationTime").alias("modified"))
    )


def _folders_of(changed: DataFrame, source: str) -> list[str]:
    """The date folders that changed fetches lie in; of very many, the folders of their kinds and days."""
    folder = F.regexp_extract("fetch", "^(.*)/[^/]*$", 1)
    folders = [r[0] for r in changed.select(folder).distinct().limit(FOLDERS + 1).collect()]
    if len(folders) <= FOLDERS:
        return folders
    fetch = F.col("fetch")
    days = changed.select(keys.kind_of(fetch).alias("kind"), keys.date_of(fetch).cast("string").alias("date")).distinct().collect()
    return [f"{source.rstrip('/')}/raw/{KEY_PREFIX[d['kind']].replace('{id}', '*')}/date={d['date']}" for d in days if d["kind"]]


def _land_fetches(spark: SparkSession, source: str, root: str, changed: DataFrame) -> Landed:
    """Land changed fetches (fetch, path, part) whole; only the folders they lie in are read."""
    folders = _folders_of(changed, source)
    objects = payloads_from_objects(spark, source, "path", folders)
    return land_raw(objects.join(changed.select("path", "part"), "path").drop("path"), root)


def _parts(objects: DataFrame) -> DataFrame:
    """Files of a fetch numbered in the order of their names."""
    in_order = Window.partitionBy("fetch").orderBy("path")
    return objects.withColumn("part", (F.row_number().over(in_order) - 1).cast("long"))


def ingest_objects(spark: SparkSession, source: str, root: str) -> Landed | None:
    """Land the fetches below ``source``/raw that are new or were changed since the last call.

    A batch job.  A fetch is what has one key: an object, or a folder of files where a long
    list came in parts.  When any file of it is added, replaced or removed, all its
    files are landed again as its parts.  The listing (path and modification time, no content)
    is compared with a log of what was landed, whatever its age, and only the date folders of
    changed fetches are read.  The log is written last, so a run that fails is simply
    repeated; landing a fetch twice leaves what readers see as it was.
    """
    log = f"{root.rstrip('/')}/objects"
    listed = listed_objects(spark, [f"{source.rstrip('/')}/raw"])
    # All files of a fetch and their times in one value; the sum does not depend on their order.
    file = F.xxhash64("path", "modified").cast("decimal(38,0)")
    state = F.concat_ws("/", F.count(F.lit(1)), F.sum(file).cast("string"))
    now = listed.groupBy("fetch").agg(state.alias("state"))
    at = 0
    if path_exists(spark, log):
        seen = spark.read.schema(_SEEN).parquet(log)
        at = (seen.agg(F.max("at")).first()[0] or 0) + 1
        last = seen.groupBy("fetch").agg(F.max_by("state", "at").alias("state"))
        now = now.join(last, ["fetch", "state"], "left_anti")
    new = materialize(now, "arrived")
    if new.isEmpty():
        return None
    changed = materialize(_parts(listed.join(new.select("fetch"), "fetch", "left_semi")), "changed")
    landed = _land_fetches(spark, source, root, changed)
    new.withColumn("at", F.lit(at).cast("long")).write.mode("append").parquet(log)
    return landed


def _available(rows: DataFrame, checkpoint: str, write) -> None:
    """Run a stream over what has arrived, then stop."""
    (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _committed(spark: SparkSession, root: str, runs_per_trigger: int) -> DataFrame:
    """The stream of complete runs of a lake."""
    return (
        spark.readStream.schema(RUNS)
        .option("maxFilesPerTrigger", runs_per_trigger)
        .option("maxFileAge", NEVER_OLD)
        .parquet(f"{root.rstrip('/')}/runs")
    )


def _landed_points(spark: SparkSession, root: str, runs: DataFrame, series: str) -> DataFrame:
    """Points of the chart payloads that some runs have landed, with their ``landed_at``; only the runs' days are read."""
    span = runs.agg(F.min("first_date"), F.max("last_date")).first()
    stored = read_versions(spark, root).filter((F.col("kind") == "market_chart") & F.col("date").between(*map(F.lit, span)))
    stored = stored.join(runs.select("batch"), "batch", "left_semi")
    return stg_chart_points(logical_key(stored).withColumnRenamed("key", "filename"), series, False, "landed_at")


def stream_points(
    spark: SparkSession,
    root: str,
    out: str,
    checkpoint: str,
    series: str = "prices",
    runs_per_trigger: int = 1000,
) -> None:
    """Stage the points of newly landed chart payloads into ``out``, with their ``landed_at``.

    The stream is that of complete runs, so a payload is staged once, and never from a run that
    was lost on the way.  A micro-batch owns the folder ``batch=<id>`` and overwrites it when it
    is replayed after a failure.  Of a fetch that is landed again both versions are staged;
    ``marts.current_points`` keeps the last.
    """

    def write(runs: DataFrame, batch_id: int) -> None:
        points = _landed_points(runs.sparkSession, root, runs, series)
        points.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _available(_committed(spark, root, runs_per_trigger), checkpoint, write)


def stream_latest(spark: SparkSession, points: str, out: str, checkpoint: str, value: str = "price_usd") -> None:
    """Maintain the latest value per coin and time of the points that ``stream_points`` stages.

    The state store holds one value per (coin_id, ts_ms), that of the latest fetch, of its last landed
    version, and of equal times the highest; an increment reads the new points only, and writes the
    keys it has changed.  ``read_latest`` gives the values.  A point that a later version of its
    fetch leaves out stays, unlike with ``marts.current_points``.
    """
    # Where the highest of several fields wins, they are compared in this order.
    best = F.struct("fetched_at", "landed_at", value)
    staged = spark.read.parquet(points)
    arriving = (
        spark.readStream.schema(staged.drop("batch").schema)
        .option("maxFileAge", NEVER_OLD)
        .option("recursiveFileLookup", True)
        .parquet(points)
    )
    latest = arriving.groupBy("coin_id", "ts_ms").agg(F.max(best).alias("best"))

    def write(changed: DataFrame, batch_id: int) -> None:
        rows = changed.select("coin_id", "ts_ms", "best.*")
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    (
        latest.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_latest(spark: SparkSession, out: str, value: str = "price_usd") -> DataFrame:
    """(coin_id, ts_ms, value, fetched_at) as ``stream_latest`` left it: of every key what changed it last."""
    changes = spark.read.parquet(out)
    last = changes.groupBy("coin_id", "ts_ms").agg(F.max_by(F.struct(value, "fetched_at"), "batch").alias("last"))
    return last.select("coin_id", "ts_ms", f"last.{value}", "last.fetched_at")


def stream_objects(
    spark: SparkSession, source: str, root: str, checkpoint: str, bytes_per_trigger: int = 64 << 30
) -> None:
    """Land newly arrived JSON objects (below ``source``/raw), each fetch whole.

    A file that arrives lands its fetch with all files it has by then.  Readers see the last
    version of a fetch, so a replayed micro-batch leaves what they read as it was.  A file
    stream knows an object by its path: where objects are replaced under their key, use
    ``ingest_objects``.
    """
    path = F.col("_metadata.file_path")
    objects = (
        spark.readStream.schema("value string")
        .option("recursiveFileLookup", True)
        .option("maxBytesPerTrigger", bytes_per_trigger)
        .option("maxFileAge", NEVER_OLD)
        .text(f"{source.rstrip('/')}/raw", wholetext=True)
        .filter(path.rlike(OBJECT))
        .select(F.regexp_extract(path, FETCH, 1).alias("fetch"))
    )

    def write(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        arrived = materialize(batch.distinct(), "arrived")
        if arrived.isEmpty():
            return
        listed = listed_objects(session, _folders_of(arrived, source))
        changed = materialize(_parts(listed.join(arrived, "fetch", "left_semi")), "changed")
        _land_fetches(session, source, root, changed)

    _available(objects, checkpoint, write)

"""Session settings the engine relies on, and where it may write scratch tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Semantics the library needs, all settable at run time on any session.
# UTC: every epoch, hive date and key is a UTC one.  ANSI: a bad cast is an
# error, not a silent NULL.  Duplicate JSON keys: the last one wins, as in the
# usual JSON decoders, instead of making the document unreadable.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Payload text is small for the work of decoding it; do not merge shuffled
    # payloads into few tasks as eagerly as plain rows.  Only small inputs notice.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    # Many folders are listed in so many tasks at most; by default each of 10,000 coins' folders has its own.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "1000",
    # Few folders may hold many files: they are listed in tasks too.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "4",
    # Of files of a few hundred bytes a task reads thousands; at 4 MB each, the default, 32, which cost less than the task.
    "spark.sql.files.openCostInBytes": "64KB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's run-time settings to an existing session."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "tickwell", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


# Input bytes a shuffle partition should stand for.
SHUFFLE_BYTES = 256 * 1024 * 1024


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the number of shuffle partitions to suit the input; never lower it.

    Adaptive execution can merge and split partitions, but starts from this number: the
    default of 200 would give tasks of half a terabyte each on 100 TB.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = -(-input_bytes // SHUFFLE_BYTES)
    if needed > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    return max(needed, current)


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes stored below a Hadoop path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(hadoop_path).getLength()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for tables written part-way through a plan.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``,
    so it outlives any executor.  Only a local session, where driver and
    executors are one process, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = os.environ.get("TICKWELL_LOCAL_SCRATCH") or tempfile.gettempdir()
    return f"{base.rstrip('/')}/tickwell-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a table once to the shared scratch folder and read it from there on.

    For a result that several jobs use: the plan behind it then runs once, and a lost
    executor cannot make it run again.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a Hadoop path (local, HDFS, object store) exists."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def create_root(spark: SparkSession, root: str) -> str:
    """Make sure the lake root exists; landing refuses to write to a missing one."""
    if not root:
        raise ValueError("a lake root is required")
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop_path)
    return root

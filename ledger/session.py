"""Session set-up and tables written between stages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on.  A skewed shuffle partition of a join is split by
# AQE even when the split costs one more exchange above it.  A stage whose code comes out as one method too long for
# the just-in-time compiler (8000 bytes) is generated in smaller methods instead.  Staged columns of keys, flags and reasons take
# some twenty times their file size as rows: a join is not planned as a broadcast by the file size, AQE still chooses one by the
# measured rows.  For the same reason splits are small, so that a task sorts its rows in memory.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.fileCompressionFactor": "20",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "ledger", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach; a temporary one only where the cluster names none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledger-"))
    return spark.conf.get("spark.checkpoint.dir")


def session_scratch(spark: SparkSession) -> str:
    """The folder below which all scratch tables of this application lie."""
    return f"{shared_root(spark)}/ledger/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str = "run") -> str:
    return f"{session_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this application; results that still read them must have been written before."""
    remove_scratch(spark, session_scratch(spark))


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet and read it back.

    Used where a result feeds several jobs: the lineage ends at files that outlive executors,
    later readers prune columns, and the planner knows the real size.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, work: Callable, items: Iterable[str], at_once: int = 4) -> dict:
    """``work(item)`` for a few items at once, so that the jobs of one fill the idle slots of another."""
    items = list(items)
    with ThreadPoolExecutor(at_once) as pool:
        runs = {i: pool.submit(inheritable_thread_target(spark)(work), i) for i in items}
        return {i: run.result() for i, run in runs.items()}


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete one run's own scratch folder."""
    if "/ledger/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)

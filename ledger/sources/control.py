"""The watermark control dataset.

One row per successful run is kept below ``<root>/_control/history/run_id=<id>``; the current boundary is
the row completed last.  Nothing is replaced in place, so a reader never meets a half-written
control file and moving the boundary is a single create-only write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger.schemas import TABLES
from ledger.session import path_exists

MARKS = [f"{table}_watermark" for table in TABLES]
FIELDS = [*MARKS, "last_successful_run_id", "completed_at"]
SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in FIELDS])


def control_text(df: DataFrame) -> DataFrame:
    """All control fields as text, in order."""
    return df.select(*[F.col(name).cast("string").alias(name) for name in FIELDS])


def write_watermarks(df: DataFrame, root: str, run_id: str) -> None:
    (
        control_text(df).coalesce(1).write.mode("errorifexists")
        .option("header", True).option("quoteAll", True)
        .csv(f"{root}/_control/history/run_id={run_id}")
    )


def read_watermark_history(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/_control/history"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no watermarks below {path}; run a full load first")
    return spark.read.schema(SCHEMA).option("header", True).csv(f"{path}/run_id=*")


def completed_runs(spark: SparkSession, root: str) -> DataFrame:
    """``_run`` and ``_done`` (microseconds): the runs that wrote a control row, one row per run."""
    return read_watermark_history(spark, root).groupBy(F.col("last_successful_run_id").alias("_run")).agg(
        F.unix_micros(F.max(F.col("completed_at").cast("timestamp"))).alias("_done")
    )


def read_watermarks(spark: SparkSession, root: str) -> DataFrame:
    """The current control row, exactly one."""
    history = read_watermark_history(spark, root)
    newest = F.max_by(F.struct(*FIELDS), F.struct(F.col("completed_at").cast("timestamp"), "last_successful_run_id"))
    return history.agg(newest.alias("row")).select("row.*")

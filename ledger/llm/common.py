"""Helpers shared by the corpus operators.

Tables are read by column name only, so extra columns never get in the way.  Columns that an operator adds to
a caller's rows for itself start with ``_llm_``.
"""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger.session import scratch, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a run of anything but blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60


_shipped: set[str] = set()


#: Rows handed to Python at a time: texts are long, and both sides hold a batch in memory.
BATCH_ROWS = "1000"


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, once; they may run where it is not installed."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        base = Path(tempfile.mkdtemp(prefix="ledger-code-")) / "ledger"
        spark.sparkContext.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(name: str) -> Column:
    """Column by its literal name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Array of words; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def hash60(text: Column) -> Column:
    """The first 60 bits of md5 as a long; any SQL engine can compute it."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def document_key(doc_id: Column, text: Column) -> Column:
    """One non-null long for a document; rows equal in id and text share it."""
    return F.xxhash64(doc_id, text)


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: ends the lineage and survives lost executors."""
    return stage(df, scratch(df.sparkSession, label))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added while ``df`` has such a column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name

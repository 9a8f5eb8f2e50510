"""Writers of the lake: raw extracts, curated and rejected layers, table reloads.

Targets are create-only unless a caller asks for replacement, so a retried job never mixes its
rows with those of another run.  Files are plain text, or compressed where ``compression`` names a codec of Spark's
csv writer, gzip at its fastest; readers tell by the file name.  Nothing is lost by it for files with quoted line breaks, which are read whole anyway.
"""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger.functions.rules import utc_iso
from ledger.schemas import (
    KEYS,
    NULLABLE,
    TABLES,
    columns,
    text_schema,
    timestamps,
    typed_schema,
)
from ledger.session import together
from ledger.sources.manifest import next_number, read_manifest, write_manifest
from ledger.sources.raw import csv_reader, locate_raw

ROWS_PER_FILE = 2_000_000


def as_text(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns(table)])


def _write_csv(df: DataFrame, path: str, mode: str = "errorifexists", escape: str = '"', compression: str | None = None) -> None:
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", escape)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("compression", compression or "none")
        .option("zlib.compress.level", "BEST_SPEED")
        .csv(path)
    )


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows as they pass."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_raw_full(
    df: DataFrame, root: str, table: str, mode: str = "errorifexists", escape: str = '"', compression: str | None = None
) -> int:
    """Write ``<root>/<table>/<table>.csv`` with every field as text; returns the rows written.

    The count is taken while writing, not by a second scan.
    """
    rows, seen = _counted(df)
    _write_csv(as_text(rows, table), f"{root}/{table}/{table}.csv", mode, escape, compression)
    return seen.get["rows"]


def watermark_folder(watermark: datetime | str) -> str:
    """``yyyyMMddTHHmmssfffffffZ``: fixed width, so folder names sort by time."""
    if isinstance(watermark, str):
        watermark = datetime.fromisoformat(watermark)
    if watermark.tzinfo is not None:
        watermark = watermark.astimezone(timezone.utc)
    return watermark.strftime("%Y%m%dT%H%M%S") + f"{watermark.microsecond:06d}0Z"


def batch_path(root: str, table: str, watermark: datetime | str, run_id: str) -> str:
    return f"{root}/{table}/incremental/watermark={watermark_folder(watermark)}/run_id={run_id}"


def write_raw_batch(
    df: DataFrame, root: str, table: str, watermark: datetime | str, run_id: str, escape: str = '"', compression: str | None = None
) -> int:
    """Write one bounded batch into its own folder, each file in the order of ``updated_at`` and key.

    Sorted inside the tasks that read the source, so the window is asked for once.  A batch without rows still
    leaves a file with the header.  Returns the rows written.
    """
    rows, seen = _counted(df.sortWithinPartitions("updated_at", KEYS[table]))
    _write_csv(as_text(rows, table), batch_path(root, table, watermark, run_id), escape=escape, compression=compression)
    return seen.get["rows"]


def curated_rows(df: DataFrame, table: str) -> DataFrame:
    """Rows without reasons: the original text, timestamps rewritten to UTC with microseconds."""
    times = set(timestamps(table))
    return df.filter(F.size("reasons") == 0).select(
        *[utc_iso(F.col(f"t_{c}")).alias(c) if c in times else F.col(c) for c in columns(table)]
    )


def rejected_rows(df: DataFrame, table: str) -> DataFrame:
    """Rows with reasons: the untouched text and the reasons joined by ``;``."""
    return df.filter(F.size("reasons") > 0).select(
        *columns(table), F.array_join("reasons", ";").alias("rejection_reason")
    )


def write_curated(df: DataFrame, path: str, table: str, overwrite: bool = False, compression: str | None = None) -> int:
    """Returns the rows written, counted while writing."""
    rows, seen = _counted(curated_rows(df, table))
    _write_csv(rows, path, "overwrite" if overwrite else "errorifexists", compression=compression)
    return seen.get["rows"]


def write_rejected(df: DataFrame, path: str, table: str, overwrite: bool = False, compression: str | None = None) -> int:
    """Returns the rows written, counted while writing."""
    rows, seen = _counted(rejected_rows(df, table))
    _write_csv(rows, path, "overwrite" if overwrite else "errorifexists", compression=compression)
    return seen.get["rows"]


def layer_path(root: str, table: str, run_id: str | None = None) -> str:
    """``<root>/<table>.csv``, or the published ``<root>/<table>/full/run_id=<id>/<table>.csv``."""
    return f"{root}/{table}/full/run_id={run_id}/{table}.csv" if run_id else f"{root}/{table}.csv"


def _typed(table: str, field: T.StructField):
    """The typed field; a blank that the table does not allow fails the job."""
    value = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(value, F.lit("")).alias(field.name)
    typed = F.nullif(value, F.lit("")).cast(field.dataType)
    if field.name not in NULLABLE.get(table, set()):
        typed = F.coalesce(typed, F.raise_error(F.lit(f"{table}.{field.name} is blank")))
    return typed.alias(field.name)


def reload_tables(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Replace the four tables below ``dst`` by the files below ``src``; returns their counts.

    Headers are checked and rows typed while each table is written, once, to a folder of its own.  A manifest that names all four
    folders comes last: readers (``reloaded_tables``) meet the old set or the new one, also if the job stops between two tables.
    """
    number, run = next_number(spark, dst), uuid4().hex[:8]

    def load(table: str) -> tuple[str, str, int]:
        strings = csv_reader(spark, text_schema(table)).csv(locate_raw(spark, src, table))
        rows, seen = _counted(strings.select(*[_typed(table, f) for f in typed_schema(table).fields]))
        folder = f"{table}/load={number}-{run}"
        rows.write.mode("errorifexists").parquet(f"{dst}/{folder}")
        return table, folder, seen.get["rows"]

    loaded = together(spark, load, TABLES)
    write_manifest(spark.createDataFrame(list(loaded.values()), "table_name string, folder string, rows bigint"), dst, number)
    return read_manifest(spark, dst).select("table_name", F.col("rows").alias("row_count"))


def reloaded_tables(spark: SparkSession, dst: str) -> dict[str, DataFrame]:
    """The tables of the last finished reload."""
    current = read_manifest(spark, dst)
    if current is None:
        raise FileNotFoundError(f"no loaded tables below {dst}")
    folders = {r["table_name"]: r["folder"] for r in current.collect()}
    return {t: spark.read.schema(typed_schema(t)).parquet(f"{dst}/{folders[t]}") for t in TABLES}

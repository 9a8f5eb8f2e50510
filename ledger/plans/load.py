"""Full and incremental loads from the source tables to the raw lake."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger.operators import incremental as inc
from ledger.schemas import TABLES
from ledger.session import together
from ledger.sources.control import FIELDS, MARKS, read_watermarks, write_watermarks
from ledger.sources.raw import read_source, source_window
from ledger.sources.sinks import write_raw_batch, write_raw_full


def _windows(spark: SparkSession, source: dict, old: dict[str, str] | None = None) -> dict[str, tuple[str, int]]:
    """``(upper end as text, rows)`` per table, above ``old`` if given: one job, four rows."""
    parts = [
        source_window(spark, source, table, old and inc.mark_text(old[table])).select(
            F.lit(table).alias("table_name"), F.col("new_watermark").cast("timestamp").cast("string").alias("upper"),
            F.col("expected_rows").cast("bigint").alias("rows"),
        )
        for table in TABLES
    ]
    found = {r["table_name"]: (r["upper"], r["rows"]) for r in reduce(DataFrame.unionByName, parts).collect()}
    if old:
        # Nothing above the old boundary leaves it where it is.
        return {t: (upper or inc.mark_text(old[t]), rows) for t, (upper, rows) in found.items()}
    return found


def control_of(spark: SparkSession, uppers: dict[str, str], run_id: str) -> DataFrame:
    marks = [F.lit(inc.mark_text(uppers[t])).alias(name) for t, name in zip(TABLES, MARKS)]
    return spark.range(1).select(
        *marks, F.lit(run_id).alias("last_successful_run_id"), F.current_timestamp().alias("completed_at")
    ).select(*FIELDS)


def tables_of(spark: SparkSession, source: dict) -> inc.Tables:
    return {table: read_source(spark, source, table) for table in TABLES}


def full_load(spark: SparkSession, source: dict, root: str, run_id: str, compression: str | None = None) -> DataFrame:
    """Copy the four tables to the raw lake and start the watermarks.

    The upper ends and counts are taken first and only rows up to them are copied, so a row that
    arrives meanwhile belongs to the first incremental run.  Watermarks are written only if every
    count agrees.  Returns ``(table_name, copied_rows, expected_rows, matched)``.
    """
    found = _windows(spark, source)
    uppers = {table: found[table][0] for table in TABLES}
    empty = [table for table, upper in uppers.items() if upper is None]
    if empty:
        raise inc.LoadError("EMPTY_SOURCE", f"no updated_at in {', '.join(empty)}")
    t = tables_of(spark, source)

    def copy(table: str) -> int:
        rows = t[table].filter(F.col("updated_at") <= F.lit(uppers[table]).cast(t[table].schema["updated_at"].dataType))
        return write_raw_full(rows, root, table, compression=compression)

    copied = together(spark, copy, TABLES)
    expected = {table: found[table][1] for table in TABLES}
    inc.guard_counts(copied, expected, "FULL_LOAD_ROW_COUNT_MISMATCH")
    write_watermarks(control_of(spark, uppers, run_id), root, run_id)
    return inc.compare_counts(copied, expected, spark)


def incremental_load(spark: SparkSession, source: dict, root: str, run_id: str, compression: str | None = None) -> DataFrame:
    """Copy what changed since the current watermarks and advance them.

    Each table has its own window ``(old, new]`` with the upper end fixed before the copy.  Batches go
    to folders of their own; the control row is written last and only if every count agrees, so a
    failed run leaves the boundary and can be repeated under a new run id.  Returns one row per table.
    """
    current = read_watermarks(spark, root).first()
    old = {table: current[f"{table}_watermark"] for table in TABLES}
    found = _windows(spark, source, old)
    new = {table: found[table][0] for table in TABLES}
    t = tables_of(spark, source)

    def copy(table: str) -> int:
        rows = t[table].filter(inc.in_window(t[table], old[table], new[table]))
        return write_raw_batch(rows, root, table, new[table], run_id, compression=compression)

    copied = together(spark, copy, TABLES)
    expected = {table: found[table][1] for table in TABLES}
    inc.guard_counts(copied, expected, "INCREMENTAL_ROW_COUNT_MISMATCH")
    write_watermarks(control_of(spark, new, run_id), root, run_id)
    rows = [
        (table, inc.mark_text(old[table]), inc.mark_text(new[table]), copied[table], expected[table])
        for table in TABLES
    ]
    return spark.createDataFrame(
        rows, "table_name string, old_watermark string, new_watermark string, copied_rows bigint, expected_rows bigint"
    )


def restore_watermarks(
    spark: SparkSession, root: str, run_id: str, marks: dict[str, inc.Mark], check: DataFrame
) -> None:
    """Go back to an earlier boundary, as a new control row, if ``check`` (``recovery_check``) allows it."""
    if not inc.safe_to_reset(check).first()["safe_to_reset"]:
        raise inc.LoadError("RESET_NOT_SAFE", "unexpected rows past the boundary")
    write_watermarks(control_of(spark, {t: inc.mark_text(marks[t]) for t in TABLES}, run_id), root, run_id)

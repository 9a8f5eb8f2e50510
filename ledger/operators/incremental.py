"""Bounded windows, guards, upserts and checks of incremental loads.

Window bounds, guards and control rows are single rows or single numbers; nothing else reaches the
driver.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger.operators.lookup import shuffled_apart
from ledger.operators.reports import Tables, classified_orders, confirmed_totals, table_counts
from ledger.schemas import KEYS, TABLES, UNIQUE, columns


class LoadError(RuntimeError):
    """A load whose checks failed; ``code`` names the check."""

    def __init__(self, code: str, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rows() -> Column:
    return F.count(F.lit(1))


Mark = datetime | str


def mark_text(value: Mark) -> str:
    """A boundary as UTC text with microseconds and no offset, the form marks are passed around in.

    Text does not depend on the driver's own time zone, unlike a collected timestamp.
    """
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value.isoformat(sep=" ", timespec="microseconds")


def instant(df: DataFrame, value: Mark) -> Column:
    """The boundary in the type of ``updated_at``, so that filters need no cast and reach the source."""
    return F.lit(mark_text(value)).cast(df.schema["updated_at"].dataType)


def source_counts(t: Tables) -> DataFrame:
    """``(table_name, source_rows)``."""
    return table_counts(t).withColumnRenamed("row_count", "source_rows")


def compare_counts(copied: dict[str, int], expected: dict[str, int], spark: SparkSession) -> DataFrame:
    """``(table_name, copied_rows, expected_rows, matched)`` from per-table numbers."""
    rows = [(t, copied.get(t), expected.get(t)) for t in dict.fromkeys([*expected, *copied])]
    df = spark.createDataFrame(rows, "table_name string, copied_rows bigint, expected_rows bigint")
    return df.withColumn("matched", F.col("copied_rows").eqNullSafe(F.col("expected_rows")))


def guard_counts(copied: dict[str, int], expected: dict[str, int], code: str) -> None:
    """Raise unless every table's copied rows equal the expected rows."""
    wrong = {
        t: (copied.get(t), expected.get(t))
        for t in dict.fromkeys([*expected, *copied]) if copied.get(t) != expected.get(t)
    }
    if wrong:
        detail = ", ".join(f"{t} copied {c} expected {e}" for t, (c, e) in wrong.items())
        raise LoadError(code, f"{detail}; watermarks were not written")


def count_guard(copied: DataFrame, expected: DataFrame) -> DataFrame:
    """Counts ``(table_name, copied_rows)`` and ``(table_name, source_rows)`` side by side."""
    return copied.join(expected, "table_name", "full").select(
        "table_name", "copied_rows", F.col("source_rows").alias("expected_rows"),
        F.col("copied_rows").eqNullSafe(F.col("source_rows")).alias("matched"),
    )


def table_uppers(t: Tables) -> DataFrame:
    """``(table_name, new_watermark, expected_rows)`` of whole tables, one pass each."""
    return _union([
        df.agg(F.max("updated_at").alias("new_watermark"), _rows().alias("expected_rows"))
        .select(F.lit(name).alias("table_name"), "new_watermark", "expected_rows")
        for name, df in t.items()
    ])


def initial_watermarks(t: Tables, run_id: str, completed_at: Column | None = None) -> DataFrame:
    """One control row: the highest ``updated_at`` of each table, run id and completion time."""
    return control_row(table_uppers(t), run_id, completed_at)


def control_row(bounds: DataFrame, run_id: str, completed_at: Column | None = None) -> DataFrame:
    """Turn ``(table_name, new_watermark)`` rows into one control row."""
    marks = bounds.agg(*[
        F.max(F.when(F.col("table_name") == t, F.col("new_watermark"))).alias(f"{t}_watermark")
        for t in TABLES
    ])
    done = F.current_timestamp() if completed_at is None else completed_at
    return marks.withColumns({"last_successful_run_id": F.lit(run_id), "completed_at": done})


def window_bounds(df: DataFrame, old: Mark) -> DataFrame:
    """``(new_watermark, expected_rows)`` of the window above ``old``.

    Only rows above ``old`` are read, which the source can filter, and the upper end never falls
    below ``old``.
    """
    return df.filter(F.col("updated_at") > instant(df, old)).agg(
        F.coalesce(F.max("updated_at"), instant(df, old)).alias("new_watermark"),
        _rows().alias("expected_rows"),
    )


def window_lookup(t: Tables, old: dict[str, Mark]) -> DataFrame:
    """:func:`window_bounds` of all tables: ``(table_name, old_watermark, new_watermark, expected_rows)``."""
    return _union([
        window_bounds(df, old[name]).select(
            F.lit(name).alias("table_name"), instant(df, old[name]).alias("old_watermark"),
            "new_watermark", "expected_rows",
        )
        for name, df in t.items()
    ])


def in_window(df: DataFrame, old: Mark, new: Mark) -> Column:
    at = F.col("updated_at")
    return (at > instant(df, old)) & (at <= instant(df, new))


def extract_window(df: DataFrame, old: Mark, new: Mark, key: str) -> DataFrame:
    """Rows with ``old < updated_at <= new``, each partition ordered by ``updated_at`` and key."""
    return df.filter(in_window(df, old, new)).sortWithinPartitions("updated_at", key)


def advance_watermarks(bounds: DataFrame) -> DataFrame:
    """Old and new boundary per table, and whether it moved."""
    return bounds.select(
        "table_name", "old_watermark", "new_watermark",
        (F.col("new_watermark") > F.col("old_watermark")).alias("advanced"),
    )


def next_watermarks(bounds: DataFrame, run_id: str, completed_at: Column | None = None) -> DataFrame:
    return control_row(bounds, run_id, completed_at)


def upsert_control(control: DataFrame, row: DataFrame, replace: bool = True) -> DataFrame:
    """Control rows by ``pipeline_name`` with ``row`` in place.

    With ``replace`` off an existing row is kept (insert if absent); with it on the new row wins.
    """
    kept, added = (control, row) if not replace else (row, control)
    return kept.unionByName(added.join(kept, "pipeline_name", "left_anti"))


def batch_preconditions(
    t: Tables, expected_counts: dict[str, int], stored: Mark | None = None,
    expected_mark: Mark | None = None, incoming: Tables | None = None,
) -> DataFrame:
    """``(check_name, expected, actual, passed)`` before a change batch.

    Counts per table; the stored boundary, if given; and that no key and no unique text of the rows that the batch adds
    (``incoming``, any number of them) exists yet.
    """
    parts = [
        df.agg(_rows().cast("string").alias("actual")).select(
            F.lit(f"{name}_rows").alias("check_name"), F.lit(str(expected_counts[name])).alias("expected"),
            "actual",
        )
        for name, df in t.items() if name in expected_counts
    ]
    for name, rows in (incoming or {}).items():
        parts.append(_absent(t[name], rows, KEYS[name], f"{name}_ids_free"))
        parts += [_absent(t[name], rows, field, f"{name}_{field}_free") for field in UNIQUE.get(name, [])]
    if expected_mark is not None:
        spark = next(iter(t.values())).sparkSession
        parts.append(spark.range(1).select(
            F.lit("stored_watermark").alias("check_name"), F.lit(mark_text(expected_mark)).alias("expected"),
            F.lit(None if stored is None else mark_text(stored)).cast("string").alias("actual"),
        ))
    return _union(parts).withColumn("passed", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)))


def _absent(df: DataFrame, incoming: DataFrame, field: str, name: str) -> DataFrame:
    found = df.select(field).join(incoming.select(field).distinct(), field, "left_semi")
    return found.agg(_rows().cast("string").alias("actual")).select(
        F.lit(name).alias("check_name"), F.lit("0").alias("expected"), "actual"
    )


def require(checks: DataFrame, code: str) -> None:
    """Raise with the failed checks, of which there are as many as checks at most."""
    failed = [r["check_name"] for r in checks.filter(~F.coalesce("passed", F.lit(False))).collect()]
    if failed:
        raise LoadError(code, ", ".join(failed))


def assert_state(t: Tables, expected_counts: dict[str, int], **checks) -> None:
    require(batch_preconditions(t, expected_counts, **checks), "UNEXPECTED_SOURCE_STATE")


def operation_counts(staged: DataFrame) -> DataFrame:
    return staged.groupBy("operation").agg(_rows().alias("row_count"))


def operation_conflicts(staged: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """``(operation, key)``: ``new`` rows already in the base, ``update`` rows missing from it."""
    keys = base.select(key)
    existing = staged.filter(F.col("operation") == "new").join(keys, key, "left_semi")
    missing = staged.filter(F.col("operation") == "update").join(keys, key, "left_anti")
    return existing.unionByName(missing).select("operation", key)


def require_no_conflicts(staged: DataFrame, base: DataFrame, key: str) -> None:
    if operation_conflicts(staged, base, key).limit(1).count():
        raise LoadError("OPERATION_CONFLICT", f"staged {key} operations do not match the base")


def previous_versions(base: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Base rows that the batch is about to replace."""
    return base.join(staged.filter(F.col("operation") == "update").select(key), key, "left_semi").select(
        *base.columns
    )


def upsert_merge(base: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """The base with staged rows inserted or put in place of the row with the same key."""
    kept = base.join(staged.select(key), key, "left_anti")
    return kept.select(*base.columns).unionByName(staged.select(*base.columns))


def new_watermark(*dfs: DataFrame) -> DataFrame:
    """One row: the highest ``updated_at`` of several tables."""
    return _union([df.agg(F.max("updated_at").alias("m")) for df in dfs]).agg(
        F.max("m").alias("new_watermark")
    )


def extraction_guard(t: Tables, old: Mark, new: Mark, expected: dict[str, int]) -> DataFrame:
    """Per table: extracted rows against the expected number, and that they are not the whole table.

    One pass per table counts both.
    """
    return _union([
        df.agg(F.count_if(in_window(df, old, new)).alias("extracted_rows"), _rows().alias("source_rows"))
        .select(
            F.lit(name).alias("table_name"), "extracted_rows",
            F.lit(expected[name]).cast("bigint").alias("expected_rows"), "source_rows",
            ((F.col("extracted_rows") == F.lit(expected[name]))
             & (F.col("extracted_rows") < F.col("source_rows"))).alias("passed"),
        )
        for name, df in t.items()
    ])


def guard_extract(t: Tables, old: Mark, new: Mark, expected: dict[str, int]) -> None:
    checks = extraction_guard(t, old, new, expected).withColumnRenamed("table_name", "check_name")
    require(checks, "EXTRACTION_COUNT_MISMATCH")


def affected_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return orders.select("order_id").union(payments.select("order_id")).distinct()


def incremental_reconciliation(t: Tables, affected: DataFrame) -> DataFrame:
    """Orders per class, for affected orders only.

    Orders and payments are cut to the affected ones before latest payments and classes are worked
    out.  The cut payments are shuffled apart so that each task first reduces an order's attempts to one.
    """
    ids = shuffled_apart(affected.select("order_id"), "order_id")
    cut = {
        **t,
        "orders": t["orders"].join(ids, "order_id", "left_semi"),
        "payments": shuffled_apart(t["payments"].join(ids, "order_id", "left_semi"), "order_id"),
    }
    return (
        classified_orders(cut).groupBy(F.col("quality_result").alias("reconciliation_result"))
        .agg(_rows().alias("affected_order_count")).orderBy("reconciliation_result")
    )


def revenue_delta(before: Tables, after: Tables) -> DataFrame:
    """Confirmed orders and revenue before and after a change, and the change."""
    def side(t: Tables, name: str) -> DataFrame:
        return confirmed_totals(t).select(
            F.col("confirmed_order_count").alias(f"confirmed_orders_{name}"),
            F.coalesce("confirmed_revenue", F.lit(0)).cast("decimal(18,2)").alias(f"confirmed_revenue_{name}"),
        )

    names = ["confirmed_orders_before", "confirmed_orders_after", "confirmed_revenue_before", "confirmed_revenue_after"]
    both = side(before, "before").unionByName(side(after, "after"), allowMissingColumns=True)
    one = both.agg(*[F.max(n).alias(n) for n in names])
    return one.select(
        *names,
        (F.col("confirmed_orders_after") - F.col("confirmed_orders_before")).alias("confirmed_order_change"),
        (F.col("confirmed_revenue_after") - F.col("confirmed_revenue_before")).cast("decimal(18,2)")
        .alias("confirmed_revenue_change"),
    )


def version_counts(raw: DataFrame, key: str) -> DataFrame:
    """All versions, keys, and keys with more than one version."""
    per_key = raw.groupBy(key).agg(_rows().alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("raw_versions"),
        _rows().alias("latest_versions"),
        F.count_if(F.col("n") > 1).alias("keys_with_several_versions"),
    )


def late_payments_for_existing(staged: DataFrame, base_orders: DataFrame) -> DataFrame:
    """New staged payments whose order was there before the batch."""
    new = staged.filter(F.col("operation") == "new")
    return new.join(base_orders.select("order_id"), "order_id", "left_semi").select(*staged.columns)


def _past_rows(t: Tables, marks: dict[str, Mark], expected: DataFrame) -> DataFrame:
    """``(table_name, row_id, found, wanted)``: how often each key and time lies past the boundary, and how often it is expected there."""
    found = _union([
        df.filter(F.col("updated_at") > instant(df, marks[name])).select(
            F.lit(name).alias("table_name"), F.col(KEYS[name]).cast("bigint").alias("row_id"), F.col("updated_at").cast("timestamp").alias("updated_at"),
            F.lit(1).alias("found"), F.lit(0).alias("wanted"))
        for name, df in t.items()
    ])
    wanted = expected.select(
        "table_name", F.col("row_id").cast("bigint").alias("row_id"), F.col("updated_at").cast("timestamp").alias("updated_at"), F.lit(0).alias("found"), F.lit(1).alias("wanted"))
    return found.union(wanted).groupBy("table_name", "row_id", "updated_at").agg(F.sum("found").alias("found"), F.sum("wanted").alias("wanted"))


def recovery_check(t: Tables, marks: dict[str, Mark], expected: DataFrame) -> DataFrame:
    """Is everything past the old boundary exactly what is expected?

    ``expected`` has ``(table_name, row_id, updated_at)``: a row for each that may lie past the boundary, any number of them.  Per
    table: all rows, highest time, rows past the boundary, expected ones among them, unexpected ones
    (:func:`unexpected_rows` names them) and expected ones that are not there.  ``safe`` is per table; :func:`safe_to_reset` combines them.
    """
    totals = _union([
        df.agg(_rows().alias("total_rows"), F.max("updated_at").alias("max_updated_at")).select(F.lit(name).alias("table_name"), "*")
        for name, df in t.items()
    ])
    both = F.least("found", "wanted")
    counts = ["recovery_rows", "expected_rows", "unexpected_rows", "missing_rows"]
    past = _past_rows(t, marks, expected).groupBy("table_name").agg(*[
        F.sum(c).alias(n) for n, c in zip(counts, (F.col("found"), both, F.col("found") - both, F.col("wanted") - both), strict=True)])
    return totals.join(past, "table_name", "left").fillna(0, counts).withColumn(
        "safe", (F.col("unexpected_rows") == 0) & (F.col("missing_rows") == 0))


def unexpected_rows(t: Tables, marks: dict[str, Mark], expected: DataFrame) -> DataFrame:
    """``(table_name, row_id)`` of every row past the boundary that is not expected, sorted.

    One row each rather than one array, since nothing bounds how many there are.
    """
    over = _past_rows(t, marks, expected).filter(F.col("found") > F.col("wanted"))
    return over.select("table_name", "row_id", F.explode(F.sequence(F.lit(1), (F.col("found") - F.col("wanted")).cast("int"))).alias("_n")).select(
        "table_name", "row_id").orderBy("table_name", "row_id")


def safe_to_reset(check: DataFrame) -> DataFrame:
    """One row: the verdict and the per-table details as JSON."""
    detail = F.struct("total_rows", "max_updated_at", "recovery_rows", "expected_rows", "unexpected_rows", "missing_rows")
    return check.agg(
        F.bool_and("safe").alias("safe_to_reset"),
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("table_name", detail))))).alias("tables"),
    )


def postinsert_checks(t: Tables, counts_before: dict[str, int], staged: Tables) -> DataFrame:
    """``(check_name, expected, actual, passed)`` after a change batch, against the batch itself.

    ``staged`` has the batch's rows of each changed table with their ``operation``.  Per table: the rows before plus the new ones; how many staged rows are in
    the table with every value exactly as staged; and rows under a staged key that are not as staged (a lost update, a second row of a key).
    """
    parts = []
    for name, rows in staged.items():
        df, fields = t[name], columns(name)
        typed = rows.select(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in fields])
        keys = typed.select(KEYS[name]).distinct()
        sides = df.select(*fields).join(keys, KEYS[name], "left_semi").select(*fields, F.lit(1).alias("f"), F.lit(0).alias("e")).union(
            typed.select(*fields, F.lit(0), F.lit(1)))
        per_row = sides.groupBy(*fields).agg(F.sum("f").alias("f"), F.sum("e").alias("e"))
        exact = per_row.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in (
            ("staged", F.col("e")), ("exact", F.least("f", "e")), ("other", F.greatest(F.col("f") - F.col("e"), F.lit(0))))])
        new = rows.agg(F.count_if(F.col("operation") == "new").alias("new"))
        total = df.agg(_rows().alias("rows"))
        numbers = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [exact, new, total]).agg(
            *[F.max(c).alias(c) for c in ("staged", "exact", "other", "new", "rows")])

        def check(kind: str, expected: Column, actual: Column, name: str = name) -> Column:
            return F.struct(F.lit(f"{name}_{kind}").alias("check_name"), expected.cast("bigint").alias("expected"), actual.cast("bigint").alias("actual"))

        parts.append(numbers.select(F.inline(F.array(
            check("rows", F.lit(counts_before[name]) + F.col("new"), F.col("rows")),
            check("rows_exact", F.col("staged"), F.col("exact")),
            check("rows_not_as_staged", F.lit(0), F.col("other"))))))
    return _union(parts).withColumn("passed", F.col("expected") == F.col("actual"))


def postinsert_report(t: Tables, ids: dict[str, int]) -> DataFrame:
    """One row: counts, whether the rows ``ids`` share one time and refer to each other, revenue, all as JSON."""
    counts = table_counts(t).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("table_name", "row_count")))).alias("counts_after")
    )
    # One row per id: at most four rows are combined.
    rows = _union([
        df.filter(F.col(KEYS[name]) == ids[name]).select(
            F.col("updated_at"),
            (F.lit(True) if name in ("customers", "products") else
             (F.col("customer_id") == ids["customers"]) & (F.col("product_id") == ids["products"])
             if name == "orders" else F.col("order_id") == ids["orders"]).alias("linked"),
        )
        for name, df in t.items()
    ]).agg(
        F.max("updated_at").alias("test_ts"),
        ((F.min("updated_at") == F.max("updated_at")) & (_rows() == len(ids))).alias("same_timestamp"),
        (F.bool_and("linked") & (_rows() == len(ids))).alias("relationships_valid"),
    )
    totals = confirmed_totals(t).select(
        F.col("confirmed_order_count").alias("confirmed_orders"),
        F.coalesce("confirmed_revenue", F.lit(0)).cast("decimal(18,2)").alias("confirmed_revenue"),
    )
    # Three single-row results side by side.
    names = ["counts_after", "test_ts", "same_timestamp", "relationships_valid", "confirmed_orders", "confirmed_revenue"]
    stacked = counts.unionByName(rows, allowMissingColumns=True).unionByName(totals, allowMissingColumns=True)
    one = stacked.agg(*[F.first(n, ignorenulls=True).alias(n) for n in names])
    return one.select(F.to_json(F.struct(*names)).alias("report"))

"""Registered queries: each operator over the whole given tables, through the adapter views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapter
from checks.oracles import MARKS, MIDDLE
from ledger.operators import incremental as inc
from ledger.operators import inventory, quality, relate, reports, validate
from ledger.operators.lookup import newest_per_key
from ledger.plans import curate, keep_curated, load
from ledger.schemas import KEYS, TABLES, columns
from ledger.session import remove_scratch, scratch, stage, together
from ledger.sources import control, keyed, raw, sinks

MONEY = "decimal(18,2)"
#: Buckets of the kept layers: about one per million rows of the largest table in use, a few here.
KEPT_BUCKETS = 16
CHANGED = (("orders", "order_id"), ("payments", "payment_id"))
#: Raw files and layers of the given tables are written compressed: plain text takes some eight times the bytes of the given tables.
PACKED = "gzip"


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _text(cols: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def row_text(df: DataFrame, table: str, *extra: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"), *extra,
        F.coalesce(F.col(KEYS[table]).cast("string"), F.lit("")).alias("row_key"),
        _text(columns(table)).alias("row_text"),
    )


def rows_of(tables: dict[str, DataFrame], *extra: str) -> DataFrame:
    return _union([row_text(df, t, *extra) for t, df in tables.items()])


def _utc(name: str):
    return F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def _model(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return adapter.model(spark, sf, adapter.view)


def _raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return adapter.raw(spark, sf, adapter.view)


# --- shared intermediate results, written once per session ------------------------------------------


_results: dict = {}


def _once(spark: SparkSession, sf: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _results:
        _results[key] = build()
    return _results[key]


def source(spark: SparkSession, sf: str) -> dict:
    """The model tables laid out as a source system."""
    def build():
        root = scratch(spark, "source")
        for t, df in _model(spark, sf).items():
            df.write.parquet(f"{root}/{t}")
        return {"format": "parquet", "path": root}
    return _once(spark, sf, "source", build)


def raw_source(spark: SparkSession, sf: str) -> dict:
    """The versioned tables as a source system, what lies past the marks in a part of its own; the loads do not look at keys."""
    def build():
        root = scratch(spark, "raw-source")
        for t, df in _raw(spark, sf).items():
            known = F.coalesce(F.col("updated_at") <= F.lit(MARKS[t]).cast(df.schema["updated_at"].dataType), F.lit(False))
            for part, rows in (("false", df.filter(known)), ("true", df.filter(~known))):
                rows.select(*columns(t)).write.parquet(f"{root}/{t}/past={part}")
        return {"format": "parquet", "path": root}
    return _once(spark, sf, "raw-source", build)


def source_at_marks(spark: SparkSession, sf: str) -> dict:
    """The same source system as it stood at the marks."""
    return {**raw_source(spark, sf), "partition": "past=false"}


def text_lake(spark: SparkSession, sf: str) -> str:
    """The text layer as raw files, in the order of the stand-in sequence."""
    def build():
        root = scratch(spark, "text-lake")
        rows = adapter.text(spark, sf)
        together(spark, lambda t: sinks.write_raw_full(rows[t].orderBy("_seq"), root, t, compression=PACKED), TABLES)
        return root
    return _once(spark, sf, "text-lake", build)


def typed(spark: SparkSession, sf: str, *tables: str) -> dict[str, DataFrame]:
    """What versions, references and amounts depend on, of the given tables or all, and the key's text where it isn't the plain one."""
    text = adapter.text(spark, sf)

    def build(t):
        rows = validate.VALIDATORS[t](text[t])
        return _once(spark, sf, f"typed-{t}", lambda: stage(rows.select(curate.odd_text(t).alias(KEYS[t]), "_seq", *curate.SLIM[t], "reasons"), scratch(spark, f"typed-{t}")))
    return together(spark, build, tables or TABLES)


def collapsed(spark: SparkSession, sf: str, *tables: str) -> dict[str, DataFrame]:
    return {t: relate.reject_superseded(df, f"t_{KEYS[t]}") for t, df in typed(spark, sf, *tables).items()}


def linked_orders(spark: SparkSession, sf: str) -> DataFrame:
    t = collapsed(spark, sf, "customers", "products", "orders")
    return relate.unknown_product(relate.unknown_customer(t["orders"], t["customers"]), t["products"])


def judged(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Typed rows, of the text only the key, and the slim outcome are written; which of their columns meet is up to the query."""
    key = {t: [KEYS[t]] for t in TABLES}
    return _once(spark, sf, "judged", lambda: curate.judge(adapter.text(spark, sf), scratch(spark, "judged"), key))


def layers(spark: SparkSession, sf: str) -> dict:
    """The whole job from raw files to both layers."""
    def build():
        out = scratch(spark, "layers")
        raw_root = text_lake(spark, sf)
        summary = curate.raw_to_curated(
            spark, raw_root, f"{out}/curated", f"{out}/rejected", summary=f"{out}/summary", compression=PACKED
        )
        return {"raw": raw_root, "curated": f"{out}/curated", "rejected": f"{out}/rejected", "summary": summary}
    return _once(spark, sf, "layers", build)


def _single_versions(spark: SparkSession, sf: str, table: str) -> DataFrame:
    rows = newest_per_key(_raw(spark, sf)[table], [KEYS[table], "updated_at"], F.col("_seq").desc())
    return rows.select(*columns(table))


def _growing_source(spark: SparkSession, sf: str, root: str, *marks: dict[str, str]) -> list[dict]:
    """A source system below ``root`` as it stood at each of the ``marks`` and in the end, each row written once.

    Of versions with equal times the last one is taken: a source system has no order among them.
    """
    steps = len(marks)

    found = {t: _single_versions(spark, sf, t) for t in TABLES}

    def write(table: str) -> None:
        rows = found[table]
        for n, known in enumerate(marks):
            until = F.lit(known[table]).cast(rows.schema["updated_at"].dataType)
            rows = rows.withColumn(f"past{n}", ~F.coalesce(F.col("updated_at") <= until, F.lit(False)))
        rows.write.partitionBy(*[f"past{n}" for n in reversed(range(steps))]).parquet(f"{root}/{table}")

    together(spark, write, TABLES)
    states = ["/".join(f"past{n}=false" for n in reversed(range(k, steps))) for k in range(steps)]
    return [{"format": "parquet", "path": root, **({"partition": part} if part else {})} for part in (*states, "")]


def history_layers(spark: SparkSession, sf: str) -> dict:
    """The whole job over a full extract and a completed batch, published under a run id."""
    def build():
        source, root, out = (scratch(spark, f"history-{n}") for n in ("source", "lake", "layers"))
        before, after = _growing_source(spark, sf, source, MARKS)
        load.full_load(spark, before, root, "full-0", PACKED)
        load.incremental_load(spark, after, root, "inc-1", PACKED)
        remove_scratch(spark, source)
        summary = curate.raw_to_curated(
            spark, root, f"{out}/curated", f"{out}/rejected", history=True, run_id="inc-1", compression=PACKED)
        return {"raw": root, "curated": f"{out}/curated", "rejected": f"{out}/rejected", "summary": summary}
    return _once(spark, sf, "history-layers", build)


def kept_layers(spark: SparkSession, sf: str) -> dict:
    """The layers kept batch by batch: a full extract up to the marks, a batch up to the middle marks, a batch with the rest."""
    def build():
        root, state, copied, steps = scratch(spark, "kept-lake"), scratch(spark, "kept-state"), scratch(spark, "kept-source"), []
        for name, source in zip(("full-0", "inc-1", "inc-2"), _growing_source(spark, sf, copied, MARKS, MIDDLE), strict=True):
            run = load.full_load if name == "full-0" else load.incremental_load
            run(spark, source, root, name, PACKED)
            steps.append(keep_curated.update_layers(spark, root, state, KEPT_BUCKETS).select(F.lit(name).alias("run_id"), "*"))
        remove_scratch(spark, copied)
        return {"state": state, "steps": _union(steps)}
    return _once(spark, sf, "kept-layers", build)


def lake(spark: SparkSession, sf: str) -> dict:
    """A full load up to the marks and an incremental run with the rest."""
    def build():
        root = scratch(spark, "lake")
        full = load.full_load(spark, source_at_marks(spark, sf), root, "full-0", PACKED)
        # The boundary is set to the marks themselves, which lie past the last loaded row.
        sinks_control = load.control_of(spark, {t: MARKS[t] for t in TABLES}, "mark-0")
        control.write_watermarks(sinks_control, root, "mark-0")
        first = load.incremental_load(spark, raw_source(spark, sf), root, "inc-1", PACKED)
        marks = {r["table_name"]: r["new_watermark"] for r in first.collect()}
        return {"root": root, "full": full, "first": first, "marks": marks}
    return _once(spark, sf, "lake", build)


def kept_batch(spark: SparkSession, sf: str, *names: str) -> dict:
    """What is kept of the first run before its rerun, all or the given ones: digests of its files, its rows, totals of the source."""
    where = lake(spark, sf)
    build = {
        "files": lambda: inventory.batch_digests(spark, where["root"], where["marks"], "inc-1"),
        "rows": lambda: inventory.batch_snapshot(spark, where["root"], where["marks"], "inc-1"),
        "totals": lambda: inc.source_counts(_raw_tables(spark, sf)),
    }
    return {n: _once(spark, sf, f"kept-{n}", lambda: stage(build[n](), scratch(spark, f"kept-{n}"))) for n in names or build}


def rerun_lake(spark: SparkSession, sf: str) -> dict:
    """The lake after a rerun without changes, and all that was kept before it."""
    where, kept = lake(spark, sf), kept_batch(spark, sf)
    second = _once(spark, sf, "rerun", lambda: load.incremental_load(spark, raw_source(spark, sf), where["root"], "inc-2", PACKED))
    return {**where, "kept": kept, "second": second}


# --- queries --------------------------------------------------------------------------------------


def _report(f):
    return lambda spark, sf: f(_model(spark, sf))


def _rule(f):
    return lambda spark, sf: f(adapter.text(spark, sf))


def _validated(table: str):
    def run(spark, sf):
        df = validate.VALIDATORS[table](adapter.text(spark, sf)[table])
        out = [F.col(f"t_{c}").cast("string").alias(f"t_{c}") for c in columns(table)]
        return df.select(F.col(KEYS[table]).alias("row_key"), *out, F.array_join("reasons", ";").alias("rejection_reason"))
    return run


def _reasons(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([
        df.select(F.lit(t).alias("table_name"), curate.whole_text(t).alias("row_key"),
                  F.array_join("reasons", ";").alias("rejection_reason"))
        for t, df in tables.items()
    ])


def q_valid_keys(spark, sf):
    return _union([
        relate.valid_keys(df, f"t_{KEYS[t]}").select(F.lit(t).alias("table_name"), F.col(f"t_{KEYS[t]}").alias("key"))
        for t, df in collapsed(spark, sf).items()
    ])


def q_unknown_customer(spark, sf):
    t = collapsed(spark, sf, "customers", "orders")
    return _reasons({"orders": relate.unknown_customer(t["orders"], t["customers"])})


def q_unknown_product(spark, sf):
    t = collapsed(spark, sf, "products", "orders")
    return _reasons({"orders": relate.unknown_product(t["orders"], t["products"])})


def q_unknown_order(spark, sf):
    t = collapsed(spark, sf, "orders", "payments")
    return _reasons({"payments": relate.unknown_order(t["payments"], t["orders"])})


def _before_amounts(spark, sf):
    """Orders and payments with the reasons they have before amounts are compared, on the columns that still count, written once."""
    def build():
        t, used = collapsed(spark, sf), ["_seq", "reasons"]
        found = {
            "orders": linked_orders(spark, sf).select("order_id", *used, "t_order_id", "t_quantity", "t_unit_price", "w_unit_price"),
            "payments": relate.unknown_order(t["payments"], t["orders"]).select(
                "payment_id", *used, *[c for c in curate.SLIM["payments"] if c != "t_updated_at"]),
        }
        return together(spark, lambda n: stage(found[n], scratch(spark, f"before-amounts-{n}")), found)
    found = _once(spark, sf, "before-amounts", build)
    return found["orders"], found["payments"]


def q_latest_clean_payment(spark, sf):
    return relate.latest_clean_payment(*_before_amounts(spark, sf)).select(
        F.col("t_order_id").alias("order_id"), F.col("t_payment_id").alias("payment_id"),
        F.col("t_payment_status").alias("payment_status"), F.col("t_payment_amount").cast(MONEY).alias("payment_amount"),
        F.col("expected_amount").cast(MONEY).alias("expected_amount"),
    )


def q_amount_mismatch(spark, sf):
    orders, payments = relate.flag_mismatch(*_before_amounts(spark, sf), scratch(spark, "mismatches"))
    return _reasons({"orders": orders, "payments": payments})


def q_order_not_curated(spark, sf):
    orders, payments = relate.flag_mismatch(*_before_amounts(spark, sf), scratch(spark, "mismatches"))
    return _reasons({"payments": relate.order_not_curated(payments, orders)})


def q_route_layers(spark, sf):
    parts = []
    for t, df in judged(spark, sf).items():
        for layer, rows in zip(("curated", "rejected"), relate.route(df)):
            parts.append(rows.select(F.lit(t).alias("table_name"), F.lit(layer).alias("layer"), F.col(KEYS[t]).alias("row_key")))
    return _union(parts)


def q_curated_sink(spark, sf):
    root = layers(spark, sf)["curated"]
    return rows_of({t: raw.read_layer(spark, sinks.layer_path(root, t), t) for t in TABLES})


def q_rejected_sink(spark, sf):
    root = layers(spark, sf)["rejected"]
    return rows_of(
        {t: raw.read_layer(spark, sinks.layer_path(root, t), t, "rejection_reason") for t in TABLES}, "rejection_reason"
    )


def q_validate_outputs(spark, sf):
    where = layers(spark, sf)
    return quality.validate_outputs(spark, where["raw"], where["curated"], where["rejected"])


def q_latest_payment(spark, sf):
    return relate.latest_payment(_model(spark, sf)["payments"]).select(
        "order_id", "payment_id", F.col("payment_amount").cast(MONEY).alias("payment_amount"), "payment_status", "payment_time"
    )


def q_latest_versions(spark, sf):
    t = _raw(spark, sf)
    return rows_of({name: relate.latest_versions(t[name], key) for name, key in CHANGED})


def q_expected_counts(spark, sf):
    """The current tables and those before the batch against the keys of the versioned tables."""
    expected = _key_counts(spark, sf)
    return _union([
        quality.check_counts(t, expected).select(F.lit(case).alias("case_name"), "*")
        for case, t in (("current", _model(spark, sf)), ("before the batch", adapter.base(spark, sf)))
    ])


def q_manifest_verify(spark, sf):
    t = _model(spark, sf)
    return quality.verify_manifest(adapter.view(spark, sf, "manifest"), t["orders"], relate.latest_payment(t["payments"]))


def q_confirmed_recompute(spark, sf):
    t = _model(spark, sf)
    return quality.confirmed_recompute(t["orders"], relate.latest_payment(t["payments"]))


def _raw_tables(spark, sf):
    return load.tables_of(spark, raw_source(spark, sf))


def q_count_guard(spark, sf):
    t = _raw_tables(spark, sf)
    past = {n: df.filter(F.col("updated_at") > inc.instant(df, MARKS[n])) for n, df in t.items()}
    copied = reports.table_counts(past).withColumnRenamed("row_count", "copied_rows")
    return inc.count_guard(copied, inc.source_counts(t))


def _control_view(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.date_format(F.col(m).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(m) for m in control.MARKS],
        "last_successful_run_id",
    )


def q_initial_watermarks(spark, sf):
    return _control_view(inc.initial_watermarks(_raw_tables(spark, sf), "run-1"))


def q_control_dataset(spark, sf):
    root = scratch(spark, "control")
    t = _raw_tables(spark, sf)
    for run in ("run-1", "run-2"):
        control.write_watermarks(inc.initial_watermarks(t, run), root, run)
    return _control_view(control.read_watermarks(spark, root))


def q_window_lookup(spark, sf):
    return inc.window_lookup(_raw_tables(spark, sf), MARKS).select("table_name", _utc("new_watermark"), "expected_rows")


def q_bounded_extract(spark, sf):
    t = _raw_tables(spark, sf)
    upper = {r["table_name"]: r["new_watermark"] or MARKS[r["table_name"]] for r in inc.window_lookup(t, MARKS).collect()}
    return rows_of({n: inc.extract_window(df, MARKS[n], upper[n], KEYS[n]) for n, df in t.items()})


def q_full_load(spark, sf):
    return load.full_load(spark, raw_source(spark, sf), scratch(spark, "full"), "full-1")


def q_incremental_load(spark, sf):
    where = rerun_lake(spark, sf)
    return _union([
        where[n].select("table_name", F.lit(run).alias("run_id"), "copied_rows", "old_watermark", "new_watermark")
        for n, run in (("first", "inc-1"), ("second", "inc-2"))
    ])


def q_advance_watermarks(spark, sf):
    bounds = inc.window_lookup(_raw_tables(spark, sf), MARKS)
    return inc.advance_watermarks(bounds).select("table_name", _utc("old_watermark"), _utc("new_watermark"), "advanced")


def q_legacy_watermark_upsert(spark, sf):
    t = _raw_tables(spark, sf)

    def row(name: str, top: DataFrame, orders: DataFrame | None, payments: DataFrame | None) -> DataFrame:
        parts = [top.agg(F.max("updated_at").cast("timestamp").alias("last_successful_watermark"))]
        if orders is not None:
            parts.append(orders.agg(F.count(F.lit(1)).alias("last_order_rows")))
            parts.append(payments.agg(F.count(F.lit(1)).alias("last_payment_rows")))
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        for c in ("last_order_rows", "last_payment_rows"):
            if c not in stacked.columns:
                stacked = stacked.withColumn(c, F.lit(0).cast("bigint"))
        return stacked.agg(*[F.max(c).alias(c) for c in ("last_successful_watermark", "last_order_rows", "last_payment_rows")]).select(
            F.lit(name).alias("pipeline_name"), "last_successful_watermark", "last_order_rows", "last_payment_rows")

    main = "order_payment_incremental"
    stored = inc.upsert_control(row("products_only", t["products"], None, None), row(main, t["customers"], None, None), replace=False)
    done = inc.upsert_control(stored, row(main, t["orders"], t["orders"], t["payments"]))
    return done.select("pipeline_name", _utc("last_successful_watermark"), "last_order_rows", "last_payment_rows")


def _staged(spark, sf, name):
    return adapter.view(spark, sf, f"staged_{name}")


def _key_counts(spark, sf, until: str | None = None) -> dict[str, int]:
    """Keys of the versioned tables: what the tables of one row per key should hold, from the other side."""
    found = {}
    for n, df in _raw(spark, sf).items():
        past = F.lit(True) if until is None or n not in dict(CHANGED) else F.col("updated_at") <= F.lit(until).cast(df.schema["updated_at"].dataType)
        found[n] = df.filter(past).agg(F.count_distinct(KEYS[n])).first()[0]
    return found


def q_batch_preconditions(spark, sf):
    """Before the batch all holds; against the state after it, nothing but the boundary that was stored then."""
    incoming = {n: _staged(spark, sf, n).filter("operation = 'new'") for n, _ in CHANGED}
    counts = {n: c for n, c in _key_counts(spark, sf, adapter.MARK).items() if n in incoming}
    history = {r["last_successful_run_id"]: r["payments_watermark"] for r in control.read_watermark_history(spark, lake(spark, sf)["root"]).collect()}
    cases = (("before", adapter.base(spark, sf), "mark-0"), ("after", _merged(spark, sf), "inc-1"))
    return _union([
        inc.batch_preconditions({n: t[n] for n, _ in CHANGED}, counts, stored=history[run], expected_mark=adapter.MARK, incoming=incoming)
        .select(F.lit(case).alias("case_name"), "*")
        for case, t, run in cases
    ])


def q_staged_operation_counts(spark, sf):
    return _union([
        inc.operation_counts(_staged(spark, sf, n)).select(F.lit(n).alias("table_name"), "operation", "row_count") for n, _ in CHANGED
    ])


def q_staged_operation_conflicts(spark, sf):
    t = _model(spark, sf)
    return _union([
        inc.operation_conflicts(_staged(spark, sf, n), t[n], k).select(F.lit(n).alias("table_name"), "operation", F.col(k).alias("key"))
        for n, k in CHANGED
    ])


def q_previous_versions(spark, sf):
    t = adapter.base(spark, sf)
    return rows_of({n: inc.previous_versions(t[n], _staged(spark, sf, n), k) for n, k in CHANGED})


def _merged(spark, sf):
    t = adapter.base(spark, sf)
    return {**t, **{n: inc.upsert_merge(t[n], _staged(spark, sf, n), k) for n, k in CHANGED}}


def q_upsert_merge(spark, sf):
    t = _merged(spark, sf)
    return rows_of({n: t[n] for n, _ in CHANGED})


def q_staged_change_scan(spark, sf):
    root = scratch(spark, "changes")
    parts = []
    for n, k in CHANGED:
        sinks._write_csv(_staged(spark, sf, n).select("operation", *[F.col(c).cast("string") for c in columns(n)]), f"{root}/{n}.csv")
        read = raw.read_staged(spark, f"{root}/{n}.csv", n)
        parts.append(read.select(F.lit(n).alias("table_name"), "operation", F.col(k).alias("row_key"), _text(columns(n)).alias("row_text")))
    return _union(parts)


def q_new_watermark(spark, sf):
    t = _merged(spark, sf)
    return inc.new_watermark(t["orders"], t["payments"]).select(_utc("new_watermark"))


def q_extraction_guard(spark, sf):
    t = _merged(spark, sf)
    expected = {r["table_name"]: r["row_count"] for r in reports.table_counts({n: _staged(spark, sf, n) for n, _ in CHANGED}).collect()}
    changed = {n: t[n] for n, _ in CHANGED}
    upper = _union([df.select("updated_at") for df in changed.values()]).agg(F.max("updated_at")).first()[0]
    return inc.extraction_guard(changed, adapter.MARK, upper, expected)


def _affected(spark, sf):
    return inc.affected_orders(_staged(spark, sf, "orders"), _staged(spark, sf, "payments"))


def q_incremental_reconciliation(spark, sf):
    return inc.incremental_reconciliation(_merged(spark, sf), _affected(spark, sf))


def q_revenue_delta(spark, sf):
    return inc.revenue_delta(adapter.base(spark, sf), _merged(spark, sf))


def q_version_counts(spark, sf):
    t = _raw(spark, sf)
    return _union([inc.version_counts(t[n], k).withColumn("table_name", F.lit(n)) for n, k in CHANGED])


def q_late_payments_for_existing(spark, sf):
    return inc.late_payments_for_existing(
        _staged(spark, sf, "payments"), adapter.base(spark, sf)["orders"]
    ).select("payment_id", "order_id")


def _nothing_expected(spark):
    return spark.createDataFrame([], "table_name string, row_id bigint, updated_at timestamp")


def _batch_expected(spark, sf):
    """The first run's batch, as it lies in the lake: what is known to be past the stored marks."""
    where = lake(spark, sf)
    return inventory.batch_rows(spark, where["root"], where["marks"], "inc-1").select(
        "table_name", F.col("row_key").cast("bigint").alias("row_id"), F.col("updated_at").cast("timestamp").alias("updated_at"))


def q_recovery_window_check(spark, sf):
    """Rows past a boundary: none expected at the stored marks (false) and at the latest times (true), the batch expected (true) and half of it (false)."""
    t = _raw_tables(spark, sf)
    latest = {r["table_name"]: r["new_watermark"] for r in inc.window_lookup(t, dict.fromkeys(TABLES, "1900-01-01")).collect()}
    none, batch = _nothing_expected(spark), _batch_expected(spark, sf)
    parts = []
    for case, marks, expected in (
        ("stored marks", MARKS, none), ("latest times", latest, none), ("the batch", MARKS, batch), ("odd keys of the batch", MARKS, batch.filter("row_id % 2 = 1")),
    ):
        check = inc.recovery_check(t, marks, expected)
        named = check.withColumn("max_updated_at", _utc("max_updated_at")).select(F.lit(case).alias("case_name"), "*")
        overall = inc.safe_to_reset(check).select(F.lit(case).alias("case_name"), F.lit("overall").alias("table_name"), F.col("safe_to_reset").alias("safe"))
        parts += [named, overall]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def q_recovery_unexpected_ids(spark, sf):
    return inc.unexpected_rows(_raw_tables(spark, sf), MARKS, _nothing_expected(spark))


def q_restored_boundary(spark, sf):
    """The boundary after an attempt to go back to the marks: refused while half the batch is not expected, done when all of it is."""
    t, batch, parts = _raw_tables(spark, sf), _batch_expected(spark, sf), []
    for case, expected in (("odd keys of the batch", batch.filter("row_id % 2 = 1")), ("the batch", batch)):
        root = scratch(spark, "restore")
        control.write_watermarks(inc.initial_watermarks(t, "run-1"), root, "run-1")
        try:
            load.restore_watermarks(spark, root, "reset-1", MARKS, inc.recovery_check(t, MARKS, expected))
        except inc.LoadError as refused:
            assert refused.code == "RESET_NOT_SAFE"
        parts.append(_control_view(control.read_watermarks(spark, root)).select(F.lit(case).alias("case_name"), "*"))
    return _union(parts)


def q_postinsert_checks(spark, sf):
    """The batch in the merged state, where all holds, and in the state before it, where nothing does."""
    staged = {n: _staged(spark, sf, n) for n, _ in CHANGED}
    counts = _key_counts(spark, sf, adapter.MARK)
    return _union([
        inc.postinsert_checks(t, counts, staged).select(F.lit(case).alias("case_name"), "*")
        for case, t in (("merged", _merged(spark, sf)), ("not merged", adapter.base(spark, sf)))
    ])


def q_postinsert_report(spark, sf):
    """The report on the first new payment of the batch, its order, customer and product."""
    t = _merged(spark, sf)
    first = (
        _staged(spark, sf, "payments").filter("operation = 'new'").join(t["orders"].select("order_id", "customer_id", "product_id"), "order_id")
        .filter("customer_id is not null and product_id is not null").orderBy("payment_id").select("payment_id", "order_id", "customer_id", "product_id").first()
    )
    ids = {"customers": first["customer_id"], "products": first["product_id"], "orders": first["order_id"], "payments": first["payment_id"]}
    kinds = "counts_after struct<customers: bigint, products: bigint, orders: bigint, payments: bigint>, test_ts timestamp, same_timestamp boolean, " \
        "relationships_valid boolean, confirmed_orders bigint, confirmed_revenue decimal(18,2)"
    return inc.postinsert_report(t, ids).select(F.from_json("report", kinds).alias("r")).select("r.counts_after.*", "r.*").drop("counts_after", "test_ts")


def q_raw_csv_scan(spark, sf):
    root = text_lake(spark, sf)
    return rows_of({t: raw.read_raw(spark, root, t) for t in TABLES})


def q_source_table_scan(spark, sf):
    return rows_of(load.tables_of(spark, source(spark, sf)))


def q_raw_full_sink(spark, sf):
    root = scratch(spark, "full-sink")
    for t, df in load.tables_of(spark, source(spark, sf)).items():
        sinks.write_raw_full(df, root, t, compression=PACKED)
    return rows_of({t: raw.read_layer(spark, raw.locate_raw(spark, root, t), t) for t in TABLES})


def q_truncate_reload(spark, sf):
    src, dst = scratch(spark, "reload-src"), scratch(spark, "reload-dst")
    for t, df in load.tables_of(spark, source(spark, sf)).items():
        sinks.write_raw_full(df, src, t)
    return sinks.reload_tables(spark, src, dst)


def q_reloaded_tables(spark, sf):
    """Rows that readers meet after two reloads, the first of the base state, the second of the current one."""
    dst = scratch(spark, "reload-twice")
    for state in (adapter.base(spark, sf), _model(spark, sf)):
        src = scratch(spark, "reload-from")
        for t, df in state.items():
            sinks.write_raw_full(df, src, t, compression=PACKED)
        sinks.reload_tables(spark, src, dst)
    return rows_of(sinks.reloaded_tables(spark, dst))


def q_raw_incremental_sink(spark, sf):
    where = lake(spark, sf)
    parts = {}
    for t in TABLES:
        folder = sinks.watermark_folder(where["marks"][t])
        parts[t] = raw.read_batch(spark, where["root"], t, folder, "inc-1").withColumns(
            {"watermark": F.lit(folder), "run_id": F.lit("inc-1")}
        )
    return rows_of(parts, "watermark", "run_id")


def q_raw_history_scan(spark, sf):
    root = rerun_lake(spark, sf)["root"]
    return rows_of({t: raw.read_raw_versions(spark, root, t) for t in TABLES}, "watermark", "run_id")


def q_lake_inventory(spark, sf):
    root = rerun_lake(spark, sf)["root"]
    found = inventory.lake_inventory(spark, [f"{root}/{t}" for t in TABLES])
    table = F.regexp_extract("path", "/(customers|products|orders|payments)/", 1)
    run = F.regexp_extract("path", "/run_id=([^/]+)/", 1)
    return (
        found.groupBy(table.alias("table_name"), F.when(run == "", "full").otherwise(run).alias("part"), "header")
        .agg(F.sum("data_rows").alias("data_rows"))
    )


def q_file_digests(spark, sf):
    """Per table: rows of the first run's files, whether all have a digest, and whether they are unchanged: after the rerun, and
    against the rerun's files in their place."""
    where = rerun_lake(spark, sf)
    before = where["kept"]["files"]
    after, second = (inventory.batch_digests(spark, where["root"], where["marks"], run) for run in ("inc-1", "inc-2"))
    table = F.regexp_extract("path", "/(customers|products|orders|payments)/incremental/", 1)
    return _union([
        inventory.compare_digests(before, other).join(other.drop("table_name"), "path", "left").groupBy(table.alias("table_name")).agg(
            F.coalesce(F.sum("data_rows"), F.lit(0)).alias("data_rows"), F.bool_and(F.length("tree_sha256") == 64).alias("digested"),
            F.bool_and("unchanged").alias("unchanged")).select(F.lit(case).alias("case_name"), "*")
        for case, other in (("after the rerun", after), ("the rerun's files", second))
    ])


def q_verify_batch(spark, sf):
    """The first run's batch against the rows past the marks, and against half of them, which must fail."""
    where = lake(spark, sf)
    past = _union([
        df.filter(F.col("updated_at") > F.lit(MARKS[t]).cast(df.schema["updated_at"].dataType)).select(
            F.lit(t).alias("table_name"), F.col(KEYS[t]).alias("key"), F.col("updated_at").cast("string").alias("updated_at"))
        for t, df in _raw_tables(spark, sf).items()
    ])
    cases = {"all rows": past, "odd keys": past.filter("key % 2 = 1")}
    return _union([
        inventory.verify_batch(spark, where["root"], where["marks"], "inc-1", rows.withColumn("row_key", F.col("key").cast("string")))
        .select(F.lit(case).alias("case_name"), "*")
        for case, rows in cases.items()
    ])


def q_raw_to_curated_history(spark, sf):
    return history_layers(spark, sf)["summary"]


def q_validate_outputs_history(spark, sf):
    """Per table, and a row with the overall status."""
    where = history_layers(spark, sf)
    found = quality.validate_outputs(spark, where["raw"], where["curated"], where["rejected"], history=True, run_id="inc-1")
    return _union([found.select("table_name", "raw_rows", "curated_rows", "rejected_rows", "duplicate_curated_keys", "failures"),
                   quality.overall_status(found).select(F.lit("overall").alias("table_name"), *[F.lit(None).cast("bigint").alias(c) for c in (
                       "raw_rows", "curated_rows", "rejected_rows", "duplicate_curated_keys")], F.col("status").alias("failures"))])


def q_curated_after_batches(spark, sf):
    """Every row of the kept layers with its reasons, after three steps."""
    return _union([
        df.select(F.lit(t).alias("table_name"), F.when(F.size("reasons") == 0, "curated").otherwise("rejected").alias("layer"),
                  F.col(KEYS[t]).alias("row_key"), F.array_join("reasons", ";").alias("rejection_reason"))
        for t, df in keep_curated.current_rows(spark, kept_layers(spark, sf)["state"]).items()
    ])


def q_kept_layer_steps(spark, sf):
    """Rows that each step took in, all raw rows so far, and the rows in both layers after it."""
    return kept_layers(spark, sf)["steps"].select(
        "run_id", "table_name", "new_rows", "raw_rows", (F.col("curated_rows") + F.col("rejected_rows")).alias("layer_rows"))


def q_upsert_merge_sink(spark, sf):
    """The staged batch merged into keyed tables: all rows afterwards."""
    t, found = adapter.base(spark, sf), {}
    for n, k in CHANGED:
        root, staged = scratch(spark, f"keyed-{n}"), _staged(spark, sf, n).select(*columns(n))
        keyed.create_keyed(t[n].select(*columns(n)), root, k, rows_per_file=5000)
        keyed.merge_keyed(spark, root, staged, k, rows_per_file=5000)
        found[n] = keyed.read_keyed(spark, root, staged.schema)
    return rows_of(found)


def _rerun_proof(spark, sf, rows=None, totals=None, marks=None):
    """The proof for the two incremental runs, or with one of its inputs exchanged."""
    where = rerun_lake(spark, sf)
    kept = where["kept"]
    expected = spark.createDataFrame([(t, str((marks or where["marks"])[t])) for t in TABLES], "table_name string, watermark string")
    return inventory.rerun_proof(
        spark, where["root"], where["marks"], "inc-1", "inc-2", kept["files"], kept["rows"] if rows is None else rows,
        kept["totals"] if totals is None else totals, inc.source_counts(_raw_tables(spark, sf)), expected)


def q_rerun_proof(spark, sf):
    return _rerun_proof(spark, sf)


def q_rerun_idempotency(spark, sf):
    """Verdicts on the runs as they were, and on what was kept of another batch, another source and another boundary, which must fail."""
    where = rerun_lake(spark, sf)
    odd = where["kept"]["rows"].filter("row_key % 2 = 1")
    earlier = inc.source_counts(load.tables_of(spark, source_at_marks(spark, sf)))
    cases = {"as run": {}, "odd keys only": {"rows": odd}, "earlier source": {"totals": earlier}, "stored marks": {"marks": MARKS}}
    return _union([
        inventory.rerun_idempotency(_rerun_proof(spark, sf, **change)).select(F.lit(case).alias("case_name"), "*") for case, change in cases.items()
    ])


def q_changed_batch_keys(spark, sf):
    """Keys by which the first run's rows differ from those without odd keys and with a doubled row for every third."""
    rows = kept_batch(spark, sf, "rows")["rows"]
    other = rows.filter("row_key % 2 = 0").withColumn("copies", F.when(F.expr("row_key % 3 = 0"), F.col("copies") + 1).otherwise(F.col("copies")))
    return inventory.changed_keys(rows, other)


def q_run_counts(spark, sf):
    """Run records written from the counts of the two incremental runs, one document per run."""
    where = rerun_lake(spark, sf)
    root = scratch(spark, "runs")
    title = F.initcap("table_name")
    none = F.lit(None).cast("bigint")

    def activity(name, copied, expected):
        return F.struct(name.alias("activityName"), copied.alias("rowsCopied"), F.struct(expected.alias("expected_rows")).alias("firstRow"))

    for name, run in (("first", "inc-1"), ("second", "inc-2")):
        both = F.array(
            activity(F.concat(F.lit("Copy_"), title, F.lit("_Incremental_To_Raw")), F.col("copied_rows"), none),
            activity(F.concat(F.lit("Lookup_"), title, F.lit("_Window")), none, F.col("expected_rows")))
        document = F.struct(F.lit(run).alias("runId"), F.lit("Succeeded").alias("status"), F.flatten(F.collect_list(both)).alias("activities"))
        where[name].agg(F.to_json(document).alias("value")).write.mode("append").text(root)
    return inventory.run_counts(inventory.read_runs(spark, root))


QUERIES = {
    **{name: _report(f) for name, f in reports.REPORTS.items()},
    "duplicate_keys": lambda spark, sf: reports.duplicate_keys(_raw(spark, sf)),
    **{
        f.__name__: _rule(f)
        for f in (
            validate.rule_required_text, validate.rule_parse_int, validate.rule_parse_optional_int,
            validate.rule_parse_decimal, validate.rule_parse_timestamp, validate.rule_positive_id,
            validate.rule_positive_amount, validate.rule_positive_quantity, validate.rule_allowed_values,
            validate.rule_timestamp_order, validate.rule_missing_reference, validate.reason_accumulator,
        )
    },
    **{f"validate_{t}": _validated(t) for t in TABLES},
    "declared_constraint_audit": lambda spark, sf: validate.audit_constraints(_raw(spark, sf)),
    "reject_superseded": lambda spark, sf: _reasons(collapsed(spark, sf)),
    "layer_summary": lambda spark, sf: quality.layer_summary(adapter.text(spark, sf), judged(spark, sf)),
    "rejection_histogram": lambda spark, sf: quality.rejection_histogram(judged(spark, sf)),
    "raw_to_curated": lambda spark, sf: layers(spark, sf)["summary"],
    "reference_integrity": lambda spark, sf: quality.check_refs(_model(spark, sf)),
    "manifest_counts": lambda spark, sf: quality.manifest_counts(adapter.view(spark, sf, "manifest")),
    "source_counts": lambda spark, sf: inc.source_counts(_raw_tables(spark, sf)),
    "affected_orders": _affected,
    **{name[2:]: f for name, f in globals().items() if name.startswith("q_")},
}

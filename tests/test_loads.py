"""Full load, windows, guards, reruns, upserts."""

import json
import shutil
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import handmade as h
from ledger.operators import incremental as inc
from ledger.operators import inventory, quality
from ledger.plans import curate, load
from ledger.schemas import KEYS, TABLES, columns, typed_schema
from ledger.sources.control import read_watermark_history, read_watermarks
from ledger.sources.raw import jdbc_options, read_batch, read_raw, read_raw_versions, read_source, read_staged
from ledger.sources import sinks
from ledger.sources.sinks import reload_tables, reloaded_tables, watermark_folder, write_raw_batch, write_raw_full


def typed(spark, table, rows):
    text = spark.createDataFrame([tuple(str(r[c]) for c in columns(table)) for r in rows], ", ".join(f"{c} string" for c in columns(table)))
    return text.select(*[F.nullif(F.col(f.name), F.lit("")).cast(f.dataType).alias(f.name) for f in typed_schema(table).fields])


def source(spark, root, **tables):
    for table in TABLES:
        typed(spark, table, tables[table]).write.mode("overwrite").parquet(f"{root}/{table}")
    return {"format": "parquet", "path": str(root)}


BASE = {"customers": [h.customer(1)], "products": [h.product(1)], "orders": [h.order(1), h.order(2)], "payments": [h.payment(1, 1)]}
NEW_AT = "2026-08-15 03:25:37.527343"
NEW = {
    "customers": [h.customer(2, at=NEW_AT)], "products": [h.product(2, at=NEW_AT)],
    "orders": [h.order(3, 2, 2, at=NEW_AT)], "payments": [h.payment(2, 3, at=NEW_AT)],
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("lake")
    root = str(tmp / "raw")
    first = load.full_load(spark, source(spark, tmp / "s1", **BASE), root, "full")
    src = source(spark, tmp / "s2", **{t: BASE[t] + NEW[t] for t in TABLES})
    one = load.incremental_load(spark, src, root, "run-1")
    before = inventory.batch_digests(spark, root, NEW_AT, "run-1").collect()
    rows = inventory.batch_snapshot(spark, root, NEW_AT, "run-1").collect()
    two = load.incremental_load(spark, src, root, "run-2")
    return {"tmp": tmp, "root": root, "src": src, "full": first, "one": one, "two": two, "before": before, "rows": rows}


def test_full_load_counts(lake):
    assert {r["table_name"]: r["copied_rows"] for r in lake["full"].collect()} == {"customers": 1, "products": 1, "orders": 2, "payments": 1}


def test_two_runs(spark, lake):
    assert [r["copied_rows"] for r in lake["one"].collect()] == [1, 1, 1, 1]
    assert [r["copied_rows"] for r in lake["two"].collect()] == [0, 0, 0, 0]
    row = read_watermarks(spark, lake["root"]).first()
    assert row["last_successful_run_id"] == "run-2"
    assert {row[f"{t}_watermark"] for t in TABLES} == {NEW_AT}
    assert read_watermark_history(spark, lake["root"]).count() == 3


def test_batch_folders(spark, lake):
    folder = watermark_folder(NEW_AT)
    assert folder == "20260815T0325375273430Z"
    for table in TABLES:
        rows = read_batch(spark, lake["root"], table, folder, "run-1").collect()
        assert [r[KEYS[table]] for r in rows] == [str(NEW[table][0][KEYS[table]])]
        empty = Path(lake["root"]) / table / "incremental" / f"watermark={folder}" / "run_id=run-2"
        texts = [f.read_text() for f in empty.glob("part*")]
        assert len(texts) == 1 and texts[0].strip() == ",".join(f'"{c}"' for c in columns(table))


def proof(spark, lake, **change):
    files = inventory.batch_digests(spark, lake["root"], NEW_AT, "run-1")
    rows = inventory.batch_snapshot(spark, lake["root"], NEW_AT, "run-1")
    totals = inc.source_counts(load.tables_of(spark, lake["src"]))
    given = {
        "before_files": spark.createDataFrame(lake["before"], files.schema), "before_rows": spark.createDataFrame(lake["rows"], rows.schema),
        "source_before": totals, "source_after": totals, "expected_marks": spark.createDataFrame([(t, NEW_AT) for t in TABLES], "table_name string, watermark string"),
        "first_id": "run-1", "second_id": "run-2",
    }
    given.update({k: f(given[k]) if callable(f) else f for k, f in change.items()})
    found = inventory.rerun_proof(spark, lake["root"], NEW_AT, **given)
    return {r["table_name"]: r for r in found.collect()}, {r["check_name"]: r["passed"] for r in inventory.rerun_idempotency(found).collect()}


def test_rerun_left_first_files_alone(spark, lake):
    tables, checks = proof(spark, lake)
    assert len(checks) == 7 and all(checks.values()) and all(r["passed"] for r in tables.values())
    assert {(r["rows_before"], r["keys_after"], r["rerun_rows"], r["changed_keys"]) for r in tables.values()} == {(1, 1, 0, 0)}
    assert tables["orders"]["source_rows_after"] == 3


@pytest.mark.parametrize(("change", "failed"), [
    ({"before_files": lambda df: df.withColumn("tree_sha256", F.reverse("tree_sha256"))}, "first_run_files_unchanged"),
    ({"before_rows": lambda df: df.withColumn("row_digest", F.lit("other"))}, "first_run_files_unchanged"),
    ({"before_rows": lambda df: df.withColumn("row_key", F.lit("9"))}, "first_run_files_unchanged"),
    ({"source_before": lambda df: df.withColumn("source_rows", F.col("source_rows") + 1)}, "source_unchanged"),
    ({"source_after": lambda df: df.limit(0)}, "source_unchanged"),
    ({"expected_marks": lambda df: df.withColumn("watermark", F.lit("2020-01-01 00:00:00"))}, "watermarks_as_expected"),
    ({"before_files": lambda df: df.withColumn("path", F.replace("path", F.lit("run-1"), F.lit("run-0")))}, "first_run_files_located"),
    ({"second_id": "run-1"}, "second_run_files_separate_and_empty"),
])
def test_every_verdict_can_fail(spark, lake, change, failed):
    tables, checks = proof(spark, lake, **change)
    assert not checks[failed] and not checks["status"] and not any(r["passed"] for r in tables.values())


def test_changed_keys_are_named(spark, lake):
    schema = "table_name string, row_key string, row_digest string, copies bigint"
    before = [("orders", str(i), f"d{i}", 1) for i in range(500)] + [("payments", "1", "a", 1), ("payments", "1", "b", 1)]
    after = [r for r in before if r[1] != "7"] + [("orders", "900", "new", 1)]
    after = [(t, k, "other", n) if (t, k) == ("orders", "33") else (t, k, d, 2) if (t, k, d) == ("payments", "1", "b") else (t, k, d, n) for t, k, d, n in after]
    found = inventory.changed_keys(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema), buckets=16)
    assert {tuple(r) for r in found.collect()} == {("orders", "7", "removed"), ("orders", "900", "added"), ("orders", "33", "changed"), ("payments", "1", "changed")}
    assert inventory.changed_keys(spark.createDataFrame(before, schema), spark.createDataFrame(before[::-1], schema)).count() == 0


def test_digests_do_not_depend_on_splits_and_see_order(spark, tmp_path):
    body = "".join(f"{j},x\n" for j in range(40_000))
    texts = {
        "long.csv": "k,v\n" + body, "quoted.csv": 'k,v\n1,"a\n\nb"\n2,"c ""d"" \n"\n\n3,e\n', "last.csv": "k,v\n1,2", "header.csv": "k,v\n", "crlf.csv": "k,v\r\n1,2\r\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())

    def digests():
        return {r.path.rsplit("/", 1)[1]: (r.bytes, r.tree_sha256, r.data_rows) for r in inventory.file_digests(spark, str(tmp_path)).collect()}

    before = digests()
    assert {n: d[2] for n, d in before.items()} == {"long.csv": 40_000, "quoted.csv": 3, "last.csv": 1, "header.csv": 0, "crlf.csv": 1}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert spark.read.text(f"{tmp_path}/long.csv").rdd.getNumPartitions() > 20
        assert digests() == before
        lines = body.split("\n")
        lines[29_000], lines[39_000] = lines[39_000], lines[29_000]
        (tmp_path / "long.csv").write_text("k,v\n" + "\n".join(lines))
        changed = digests()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert changed["long.csv"][::2] == before["long.csv"][::2] and {n for n in texts if changed[n] != before[n]} == {"long.csv"}
    (tmp_path / "long.csv").write_text("k,v\n" + body[:-2] + "y\n")
    assert digests()["long.csv"] != before["long.csv"]


def test_a_changed_file_is_found(spark, lake, tmp_path):
    root = tmp_path / "copy"
    shutil.copytree(lake["root"], root)
    before = inventory.batch_digests(spark, str(root), NEW_AT, "run-1")
    kept = spark.createDataFrame(before.collect(), before.schema)
    part = next(f for f in root.glob("orders/incremental/*/run_id=run-1/part*") if f.stat().st_size)
    part.write_text(part.read_text().replace("completed", "cancelled"))
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    after = inventory.batch_digests(spark, str(root), NEW_AT, "run-1")
    assert {r.path.rsplit("/", 1)[1] for r in inventory.compare_digests(kept, after).collect() if not r.unchanged} == {part.name}


def expected_rows(spark, keys: dict, at: str = NEW_AT):
    return spark.createDataFrame(
        [(t, str(k), at) for t, own in keys.items() for k in own], "table_name string, row_key string, updated_at string")


def test_verify_batch(spark, lake):
    keys = {"customers": [2], "products": [2], "orders": [3], "payments": [2]}

    def verdicts(run, expected):
        rows = inventory.verify_batch(spark, lake["root"], NEW_AT, run, expected).collect()
        return {r["table_name"]: (r["rows_ok"], r["missing_rows"], r["unexpected_rows"], r["control_ok"]) for r in rows}

    assert set(verdicts("run-1", expected_rows(spark, keys)).values()) == {(True, 0, 0, True)}
    # A key that the batch lacks, one twice in the batch's place, another time, no expectation at all.
    assert verdicts("run-1", expected_rows(spark, {**keys, "orders": [3, 4]}))["orders"] == (False, 1, 0, True)
    assert verdicts("run-1", expected_rows(spark, {**keys, "orders": [4]}))["orders"] == (False, 1, 1, True)
    assert verdicts("run-1", expected_rows(spark, keys, "2026-08-15 03:25:37.527344"))["payments"] == (False, 1, 1, True)
    assert verdicts("run-1", expected_rows(spark, {}))["customers"] == (False, 0, 1, True)
    assert set(verdicts("run-2", expected_rows(spark, {})).values()) == {(True, 0, 0, True)}


def test_history_feeds_the_curated_layer(spark, lake):
    versions = read_raw_versions(spark, lake["root"], "orders")
    assert {(r["order_id"], r["run_id"]) for r in versions.collect()} == {("1", ""), ("2", ""), ("3", "run-1")}
    out = lake["tmp"]
    summary = curate.raw_to_curated(spark, lake["root"], f"{out}/c", f"{out}/r", history=True)
    assert {r["table_name"]: r["curated_rows"] for r in summary.collect()} == {"customers": 2, "products": 2, "orders": 3, "payments": 2}
    checked = quality.validate_outputs(spark, lake["root"], f"{out}/c", f"{out}/r", history=True)
    assert quality.overall_status(checked).first()["status"] == "PASS"
    # Judged without the batches, the layers hold rows that the raw files lack.
    checked = quality.validate_outputs(spark, lake["root"], f"{out}/c", f"{out}/r")
    assert quality.overall_status(checked).first()["status"] == "FAIL"


def test_failed_guard_leaves_the_boundary(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    src = source(spark, tmp_path / "s", **BASE)
    load.full_load(spark, src, root, "full")
    src = source(spark, tmp_path / "s", **{t: BASE[t] + NEW[t] for t in TABLES})
    monkeypatch.setattr(load, "write_raw_batch", lambda *a, **k: write_raw_batch(*a, **k) + 1)
    with pytest.raises(inc.LoadError, match="INCREMENTAL_ROW_COUNT_MISMATCH"):
        load.incremental_load(spark, src, root, "bad")
    assert read_watermarks(spark, root).first()["last_successful_run_id"] == "full"
    # What the failed run left behind is no version of anything.
    assert {r["order_id"] for r in read_raw_versions(spark, root, "orders").collect()} == {"1", "2"}
    monkeypatch.undo()
    assert [r["copied_rows"] for r in load.incremental_load(spark, src, root, "good").collect()] == [1, 1, 1, 1]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        load.write_watermarks(read_watermarks(spark, root), root, "good")


def test_last_row_in_input_order_wins(spark, tmp_path):
    """Versions of one key with equal times over the files of one part, and over parts of more than five digits."""
    header = ",".join(f'"{c}"' for c in columns("customers"))

    def winner(names):
        root = tmp_path / "-".join(names)
        (root / "customers" / "customers.csv").mkdir(parents=True)
        for i, name in enumerate(names):
            row = {**{c: "x" for c in columns("customers")}, "customer_id": "1", "customer_name": f"v{i}"}
            text = ",".join(f'"{row[c]}"' for c in columns("customers"))
            # Larger files are packed first, so the earlier rows are longer.
            (root / "customers" / "customers.csv" / name).write_text(header + "\n" + text.replace("x", "x" * (9 - i)) + "\n")
        rows = read_raw(spark, str(root), "customers")
        return rows.orderBy(F.col("_seq").desc()).first()["customer_name"]

    assert winner(["part-00000-a-c000.csv", "part-00000-a-c001.csv", "part-00000-a-c002.csv"]) == "v2"
    assert winner(["part-99999-a-c000.csv", "part-100000-a-c000.csv"]) == "v1"
    assert winner(["part-00002-a-c000.csv", "part-00010-a-c000.csv"]) == "v1"


def test_extract_reads_its_source_once(spark, tmp_path):
    rows = source(spark, tmp_path / "s", **{**BASE, "orders": [h.order(i) for i in range(1, 101)]})
    seen = spark.sparkContext.accumulator(0)
    t = read_source(spark, rows, "orders")
    counted = t.rdd.map(lambda r: (seen.add(1), r)[1]).toDF(t.schema)
    assert write_raw_batch(counted, str(tmp_path / "raw"), "orders", NEW_AT, "r") == 100
    assert seen.value == 100


def test_window_never_goes_back(spark):
    df = typed(spark, "orders", [h.order(1)])
    row = inc.window_bounds(df, "2030-01-01 00:00:00").select(F.col("new_watermark").cast("string"), "expected_rows").first()
    assert tuple(row) == ("2030-01-01 00:00:00", 0)


def test_restore_needs_a_safe_check(spark, lake):
    t = load.tables_of(spark, lake["src"])
    marks = dict.fromkeys(TABLES, "2026-01-01 00:00:00")
    schema = "table_name string, row_id bigint, updated_at string"
    rows = [(t_, int(NEW[t_][0][KEYS[t_]]), NEW_AT) for t_ in TABLES]
    wanted = spark.createDataFrame(rows, schema)
    other = spark.createDataFrame([r for r in rows if r[0] != "orders"] + [("orders", 1, NEW_AT)], schema)
    check = inc.recovery_check(t, marks, wanted)
    assert all(r["safe"] for r in check.collect())
    verdict = inc.safe_to_reset(check).first()
    assert verdict["safe_to_reset"] and json.loads(verdict["tables"])["orders"]["recovery_rows"] == 1
    load.restore_watermarks(spark, lake["root"], "reset", marks, check)
    assert read_watermarks(spark, lake["root"]).first()["orders_watermark"] == "2026-01-01 00:00:00.000000"
    bad = inc.recovery_check(t, marks, other)
    with pytest.raises(inc.LoadError, match="RESET_NOT_SAFE"):
        load.restore_watermarks(spark, lake["root"], "reset-2", marks, bad)
    left = inc.unexpected_rows(t, marks, other).collect()
    assert {r["table_name"]: r["missing_rows"] for r in bad.collect()}["orders"] == 1
    assert [(r["table_name"], r["row_id"]) for r in left] == [("orders", 3)]


def test_change_batch(spark, tmp_path):
    base = typed(spark, "orders", [h.order(1), h.order(2, q=5)])
    staged_path = str(tmp_path / "changes")
    rows = [("update", h.order(2, c="", q=1)), ("new", h.order(3))]
    text = spark.createDataFrame(
        [(op, *[str(r[c]).replace(".0000000", "") for c in columns("orders")]) for op, r in rows],
        "operation string, " + ", ".join(f"{c} string" for c in columns("orders")),
    )
    text.coalesce(1).write.option("header", True).csv(staged_path)
    staged = read_staged(spark, staged_path, "orders")
    assert staged.filter("customer_id is null").count() == 1
    assert {r[0]: r[1] for r in inc.operation_counts(staged).collect()} == {"new": 1, "update": 1}
    inc.require_no_conflicts(staged, base, "order_id")
    swapped = staged.withColumn("operation", F.when(F.col("operation") == "new", "update").otherwise("new"))
    assert {tuple(r) for r in inc.operation_conflicts(swapped, base, "order_id").collect()} == {("new", 2), ("update", 3)}
    with pytest.raises(inc.LoadError):
        inc.require_no_conflicts(swapped, base, "order_id")
    assert [r["quantity"] for r in inc.previous_versions(base, staged, "order_id").collect()] == [5]
    merged = {r["order_id"]: r["quantity"] for r in inc.upsert_merge(base, staged, "order_id").collect()}
    assert merged == {1: 2, 2: 1, 3: 2}


def test_state_checks(spark):
    t = {"orders": typed(spark, "orders", [h.order(1)]), "payments": typed(spark, "payments", [h.payment(1, 1)])}
    inc.assert_state(t, {"orders": 1, "payments": 1}, stored="2025-01-01", expected_mark="2025-01-01",
                     incoming={"orders": typed(spark, "orders", [h.order(5)])})
    taken = inc.batch_preconditions({**t, "customers": typed(spark, "customers", [h.customer(1)])}, {}, incoming={
        "orders": typed(spark, "orders", [h.order(1), h.order(7)]), "customers": typed(spark, "customers", [h.customer(9, email="c1@example.test")])}).collect()
    assert {r["check_name"]: (r["actual"], r["passed"]) for r in taken} == {
        "orders_ids_free": ("1", False), "customers_ids_free": ("0", True), "customers_email_free": ("1", False)}
    with pytest.raises(inc.LoadError, match="orders_rows.*stored_watermark"):
        inc.assert_state(t, {"orders": 2, "payments": 1}, stored="2025-01-01", expected_mark="2025-01-02")
    with pytest.raises(inc.LoadError, match="EXTRACTION"):
        inc.guard_extract({"orders": t["orders"]}, "2020-01-01", "2030-01-01", {"orders": 1})
    with pytest.raises(inc.LoadError, match="orders copied 1 expected 2"):
        inc.guard_counts({"orders": 1}, {"orders": 2}, "X")


def test_postinsert(spark):
    t = {name: typed(spark, name, BASE[name] + rows) for name, rows in NEW.items()}
    before = {name: len(rows) for name, rows in BASE.items()}
    staged = {name: typed(spark, name, rows).withColumn("operation", F.lit("new")) for name, rows in NEW.items()}

    def failed(**change):
        return {r["check_name"] for r in inc.postinsert_checks({**t, **change}, before, staged).collect() if not r["passed"]}

    assert failed() == set() and inc.postinsert_checks(t, before, staged).count() == 12
    assert failed(orders=typed(spark, "orders", BASE["orders"])) == {"orders_rows", "orders_rows_exact"}
    assert failed(orders=typed(spark, "orders", [*BASE["orders"], {**NEW["orders"][0], "order_status": "pending"}])) == {"orders_rows_exact", "orders_rows_not_as_staged"}
    assert failed(payments=typed(spark, "payments", [*BASE["payments"], NEW["payments"][0], NEW["payments"][0]])) == {"payments_rows", "payments_rows_not_as_staged"}
    report = json.loads(inc.postinsert_report({n: typed(spark, n, rows) for n, rows in NEW.items()}, {"customers": 2, "products": 2, "orders": 3, "payments": 2}).first()["report"])
    assert report["same_timestamp"] and report["relationships_valid"] and report["confirmed_orders"] == 1
    assert report["counts_after"] == dict.fromkeys(TABLES, 1)


def test_reload_replaces_and_checks(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    for name, rows in BASE.items():
        write_raw_full(typed(spark, name, rows), src, name)
    assert {r[0]: r[1] for r in reload_tables(spark, src, dst).collect()}["orders"] == 2
    h.write(tmp_path / "bad", orders=[h.order(1, q="")])
    with pytest.raises(Exception, match="quantity is blank"):
        reload_tables(spark, str(tmp_path / "bad"), dst)
    assert reloaded_tables(spark, dst)["orders"].count() == 2


def test_a_reload_that_stops_between_tables_leaves_the_old_set(spark, tmp_path, monkeypatch):
    src, more, dst = str(tmp_path / "src"), str(tmp_path / "more"), str(tmp_path / "dst")
    for name, rows in BASE.items():
        write_raw_full(typed(spark, name, rows), src, name)
        write_raw_full(typed(spark, name, rows + NEW[name]), more, name)
    with pytest.raises(FileNotFoundError):
        reloaded_tables(spark, dst)
    reload_tables(spark, src, dst)
    parse = sinks._typed

    def stop(table, field):
        if table == "payments":
            raise RuntimeError("stopped")
        return parse(table, field)

    monkeypatch.setattr(sinks, "_typed", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        reload_tables(spark, more, dst)
    monkeypatch.undo()
    assert len(list(Path(dst).glob("orders/load=*"))) == 2  # the new orders are there, but nobody reads them
    assert {t: df.count() for t, df in reloaded_tables(spark, dst).items()} == {t: len(rows) for t, rows in BASE.items()}
    assert {r[0]: r[1] for r in reload_tables(spark, more, dst).collect()} == {t: len(BASE[t]) + 1 for t in TABLES}
    assert {t: df.count() for t, df in reloaded_tables(spark, dst).items()} == {t: len(BASE[t]) + 1 for t in TABLES}


def test_manifest(spark):
    manifest = spark.createDataFrame([("invalid_quantity", 1), ("missing_payment", 2), ("failed_payment", 9)], "scenario_type string, order_id bigint")
    orders = typed(spark, "orders", [h.order(1, q=0), h.order(2)])
    rows = quality.verify_manifest(manifest, orders, typed(spark, "payments", [h.payment(1, 1)])).collect()
    assert {(r["order_id"], r["passed"]) for r in rows} == {(1, True), (2, True), (9, False)}
    found = quality.check_manifest_counts(manifest, {"invalid_quantity": 1, "late_arriving_payment": 1}).collect()
    assert {r["scenario_type"]: r["passed"] for r in found} == {
        "invalid_quantity": True, "missing_payment": False, "failed_payment": False, "late_arriving_payment": False}


def test_database_options():
    options = jdbc_options({"format": "jdbc", "url": "jdbc:postgresql://db/x", "bounds": {"orders": (1, 900)}, "partitions": 9}, "orders")
    assert options["partitionColumn"] == "order_id" and options["numPartitions"] == "9" and options["dbtable"] == "public.orders"
    assert "partitionColumn" not in jdbc_options({"url": "x"}, "orders")


def test_watermark_text():
    assert watermark_folder(datetime(2024, 3, 28, 4, 31, 20)) == "20240328T0431200000000Z"


def test_a_source_part_is_read_alone(spark, tmp_path):
    """one written source serves both states; the second copy of the rows up to the marks is gone."""
    for part, rows in (("false", [(1, "2025-01-01 00:00:00")]), ("true", [(2, "2025-02-01 00:00:00")])):
        for t in TABLES:
            typed = spark.createDataFrame(rows, "id bigint, updated_at string").select(
                *[F.col("id").alias(c) if c == KEYS[t] else F.col("updated_at").cast("timestamp").alias(c) if c == "updated_at" else F.lit(None).cast("string").alias(c)
                  for c in columns(t)])
            typed.write.parquet(f"{tmp_path}/source/{t}/past={part}")
    whole = {"format": "parquet", "path": f"{tmp_path}/source"}
    for t in TABLES:
        assert sorted(r[0] for r in read_source(spark, whole, t).select(KEYS[t]).collect()) == [1, 2]
        assert [r[0] for r in read_source(spark, {**whole, "partition": "past=false"}, t).select(KEYS[t]).collect()] == [1]


def test_compressed_lake_reads_as_the_plain_one(spark, tmp_path):
    src, after = source(spark, tmp_path / "s1", **BASE), source(spark, tmp_path / "s2", **{t: BASE[t] + NEW[t] for t in TABLES})
    seen = {}
    for name, compression in (("plain", None), ("packed", "lz4")):
        root = str(tmp_path / name)
        load.full_load(spark, src, root, "full", compression)
        load.incremental_load(spark, after, root, "run-1", compression)
        files = [f.name for t in TABLES for f in Path(root, t).rglob("part-*")]
        assert files and all(f.endswith(".csv.lz4" if compression else ".csv") for f in files)
        found = inventory.lake_inventory(spark, [f"{root}/{t}" for t in TABLES]).collect()
        digests = inventory.batch_digests(spark, root, NEW_AT, "run-1").collect()
        seen[name] = (
            {t: sorted(map(tuple, read_raw_versions(spark, root, t).drop("_seq").collect())) for t in TABLES},
            sorted((r["header"], r["data_rows"]) for r in found if "/part-" in r["path"]),
            sorted((r["table_name"], r["tree_sha256"], r["data_rows"]) for r in digests),
        )
    assert seen["plain"] == seen["packed"]
    assert sum(n for _, n in seen["packed"][1]) == 9 and sum(n for *_, n in seen["packed"][2]) == 4

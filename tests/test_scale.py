"""Skewed keys, ranks in ranges, and the plans that large data depends on."""

from contextlib import contextmanager
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import adapter
from ledger.operators import incremental as inc
from ledger.operators import relate, reports
from ledger.operators.lookup import newest_per_key, with_dense_rank, with_match_flag, with_older_flag
from ledger.plans.report import write_reports
from ledger.schemas import KEYS
from ledger.session import remove_scratch, scratch, session_scratch, shared_root, stage

SF = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def no_broadcast(spark):
    """Every join shuffles, and partitions count as skewed early."""
    return settings(spark, **{
        "spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "100KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
    })


@pytest.fixture(autouse=True)
def whole_plans(spark):
    with settings(spark, spark__sql__maxMetadataStringLength="5000"):
        yield


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df):
    """Rows, and the plan as it was adapted while running."""
    rows = df.collect()
    return rows, plan(df)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a third without a key, the rest spread."""
    rows = spark.range(0, 150_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).cast("bigint").alias("k"),
        F.col("id").alias("_seq"), (F.col("id") % 1000).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    return rows


def test_match_flag_splits_a_hot_key_and_spreads_nulls(spark, skewed):
    keys = spark.range(0, 150_000, 2, 4).select((F.col("id") + 1).alias("k"))
    with no_broadcast(spark):
        df = with_match_flag(skewed, keys, "k", "k", "found", "_seq")
        rows, text = ran(df)
    assert len(rows) == 150_000
    assert all(r["found"] == (r["k"] is not None and r["k"] % 2 == 1) for r in rows)
    assert "skew=true" in text
    # Stand-in keys give the rows without a key more than one shuffle partition.
    spread = skewed.filter("k is null").select(F.pmod(F.hash(F.coalesce("k", -F.pmod(F.xxhash64("_seq"), F.lit(1 << 40)) - 1)), F.lit(8)).alias("p"))
    sizes = [r["count"] for r in spread.groupBy("p").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_older_flag_keeps_every_row_of_a_hot_key(spark, skewed):
    with no_broadcast(spark):
        rows, text = ran(with_older_flag(skewed, "k", ["v", "_seq"], "older"))
    assert len(rows) == 150_000
    kept = [r for r in rows if not r["older"] and r["k"] is not None]
    top = max((r for r in rows if r["k"] == 7), key=lambda r: (r["v"], r["_seq"]))
    assert [r["_seq"] for r in kept if r["k"] == 7] == [top["_seq"]]
    assert len(kept) == len({r["k"] for r in rows if r["k"] is not None})
    assert not any(r["older"] for r in rows if r["k"] is None)
    assert "skew=true" in text and "Window" not in text


def test_older_flag_against_brute_force(spark):
    rows = [(k, t, s) for s, (k, t) in enumerate([(1, None), (1, 5), (1, 5), (2, None), (2, None), (None, 9), (None, 9), (3, 1)])]
    df = spark.createDataFrame(rows, "k bigint, t int, _seq bigint")
    got = {r["_seq"]: r["older"] for r in with_older_flag(df, "k", ["t", "_seq"], "older").collect()}
    assert got == {0: True, 1: True, 2: False, 3: True, 4: False, 5: False, 6: False, 7: False}


def test_newest_limits_a_key_before_the_shuffle(spark, skewed):
    df = newest_per_key(skewed.filter("k is not null"), "k", F.col("v").desc(), F.col("_seq").desc())
    assert plan(df).count("WindowGroupLimit") == 2
    assert df.filter("k = 7").select("v", "_seq").first()["v"] == 999


def test_payment_flags_with_a_hot_order(spark):
    """A third of all payments belong to one order."""
    ids = spark.range(0, 60_000, 1, 8)
    orders = spark.range(1, 40_001, 1, 4).select(
        F.col("id").alias("t_order_id"), F.lit(2).cast("bigint").alias("t_quantity"), F.lit(10).cast("decimal(18,6)").alias("t_unit_price"),
        F.when(F.col("id") % 10 == 0, F.array(F.lit("BAD"))).otherwise(F.array().cast("array<string>")).alias("reasons"), F.col("id").alias("_seq"),
    )
    payments = ids.select(
        (F.col("id") + 1).alias("t_payment_id"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") + 1).alias("t_order_id"),
        F.lit("successful").alias("t_payment_status"), F.when(F.col("id") == 59_997, 21).otherwise(20).cast("decimal(18,6)").alias("t_payment_amount"),
        F.timestamp_micros(F.col("id")).alias("t_payment_time"), F.array().cast("array<string>").alias("reasons"), F.col("id").alias("_seq"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    with no_broadcast(spark):
        wrong = relate.amount_mismatches(orders, payments)
        final = relate.flag_orders(orders, wrong)
        rows, text = ran(relate.flag_payments(payments, final, wrong))
    assert "skew=true" in text
    assert [tuple(r) for r in wrong.collect()] == [(5, 59_998)]
    assert len(rows) == 60_000
    for r in rows:
        o = r["t_order_id"]
        want = []
        if o > 40_000:
            want.append("UNKNOWN_ORDER_REFERENCE")
        if r["t_payment_id"] == 59_998:
            want.append("PAYMENT_AMOUNT_MISMATCH")
        if o > 40_000 or o % 10 == 0 or o == 5:
            want.append("ORDER_NOT_CURATED")
        assert r["reasons"] == want


@pytest.mark.parametrize("group", [None, "g"])
def test_dense_rank_in_ranges_equals_a_window(spark, group):
    df = spark.range(0, 20_000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.hash("id"), F.lit(3000))).cast("decimal(18,2)").alias("v"),
        F.when(F.col("id") % 3 == 1, F.lit("a")).when(F.col("id") % 100 == 0, F.lit(None)).otherwise(F.lit("b")).alias("g"),
    )
    window = Window.partitionBy(*([group] if group else [])).orderBy(F.col("v").desc())
    want = {r["id"]: r["r"] for r in df.withColumn("r", F.dense_rank().over(window)).collect()}
    for parts in ("1", "20"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = {r["id"]: r["r"] for r in with_dense_rank(df, "v", "r", group).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert got == want


def test_ranked_rows_stay_spread(spark):
    df = spark.range(0, 1000, 1, 4).select("id", (F.col("id") % 10).cast("decimal(18,2)").alias("v"))
    with no_broadcast(spark):
        text = plan(with_dense_rank(df, "v", "r"))
    # One row per range meets in one task, never the values; the cuts are a sample that each task cuts to its size first.
    main, cuts = text.split("Subqueries", 1) if "Subqueries" in text else (text, "")
    assert main.count("Exchange SinglePartition") - main.count("TakeOrderedAndProject") <= 1
    assert "TakeOrderedAndProject" in text


def test_ranks_leave_nothing_behind(spark):
    folder = Path(session_scratch(spark))
    before = set(folder.glob("*")) if folder.exists() else set()
    df = spark.range(0, 1000, 1, 4).select("id", (F.col("id") % 10).cast("decimal(18,2)").alias("v"))
    done = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    ranked = with_dense_rank(df, "v", "r")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == done  # building the plan runs nothing
    assert {r["v"]: r["r"] for r in ranked.collect()} == {v: 10 - v for v in range(10)}
    assert (set(folder.glob("*")) if folder.exists() else set()) == before


def test_ranks_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, None), (5, 1)], "id int, v int")
    assert {r["id"]: r["r"] for r in with_dense_rank(df, "v", "r").collect()} == {2: 1, 3: 1, 5: 2, 1: 3, 4: 3}
    assert with_dense_rank(df.limit(0), "v", "r").collect() == []


def test_window_bounds_reach_the_scan(spark):
    df = adapter.raw(spark, SF)["orders"]
    text = plan(inc.window_bounds(df, "2001-06-30 23:59:59"))
    assert "PushedFilters: [IsNotNull(updated_at), GreaterThan(updated_at," in text
    assert "ReadSchema: struct<updated_at:timestamp" in text
    text = plan(inc.extract_window(df, "2001-06-30", "2001-07-31", KEYS["orders"]))
    assert "LessThanOrEqual(updated_at," in text and "Exchange" not in text


def test_reports_read_narrow_and_filter_early(spark):
    t = adapter.model(spark, SF)
    text = plan(reports.confirmed_totals(t))
    assert "EqualTo(order_status,completed)" in text and "GreaterThan(quantity,0)" in text
    assert "email" not in text and "payment_method" not in text
    assert text.count("WindowGroupLimit") == 2
    # Only counts come out of the whole orders table.
    assert "ReadSchema: struct<>" in plan(reports.kpi_summary(t)) or "struct<>" in plan(reports.table_counts(t))


def test_report_batch(spark, tmp_path):
    t = adapter.model(spark, SF)
    names = ["kpi_summary", "table_counts", "payment_outcomes", "customer_lifetime_spend"]
    assert write_reports(spark, t, str(tmp_path / "out"), names) == names
    for name in names:
        got = spark.read.parquet(f"{tmp_path}/out/{name}").collect()
        assert sorted(map(str, got)) == sorted(map(str, reports.REPORTS[name](t).collect()))


def test_latest_payments_are_not_shuffled_twice(spark):
    t = adapter.model(spark, SF)
    with no_broadcast(spark):
        text = plan(reports.confirmed_totals(t))
        # Orders by product, customer and order; products; customers; payments; the total.
        assert text.count("Exchange") == 7
        cut = inc.incremental_reconciliation(t, t["payments"].select("order_id").distinct())
        assert plan(cut).count("WindowGroupLimit") == 2


def test_totals_do_not_depend_on_the_join_strategy(spark):
    t = adapter.model(spark, SF)
    want = [r.asDict() for r in reports.order_quality_classes(t).collect()]
    with no_broadcast(spark):
        assert [r.asDict() for r in reports.order_quality_classes(t).collect()] == want
        text = plan(reports.order_quality_classes(t))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_scratch_of_an_application_lies_in_one_folder(spark):
    table = scratch(spark, "one")
    stage(spark.range(3), table)
    assert table.startswith(session_scratch(spark) + "/") and Path(table).exists()
    remove_scratch(spark, table)
    assert not Path(table).exists()
    with pytest.raises(ValueError):
        remove_scratch(spark, "/tmp/elsewhere")


def made(root, lines):
    """Base tables with the given ``(orderkey, linenumber, shipdate, cents)`` of lines, as parquet files below ``root``."""
    import datetime

    import pyarrow as pa
    import pyarrow.parquet as pq

    day = lambda d: None if d is None else datetime.datetime.fromisoformat(d)
    n = len(lines)
    tables = {
        "region": {"r_regionkey": [0], "r_name": ["r"]}, "nation": {"n_nationkey": [0], "n_name": ["n"], "n_regionkey": [0]},
        "customer": {"c_custkey": [0], "c_name": ["C"], "c_nationkey": [0]},
        "part": {"p_partkey": [0], "p_name": ["p"], "p_type": ["t"], "p_brand": ["b"], "p_retailprice": [5.0]},
        "orders": {"o_orderkey": [1, 2, 3], "o_custkey": [0, 0, 0], "o_orderstatus": ["O"] * 3, "o_orderdate": [day("1995-01-01")] * 3},
        "lineitem": {
            "l_orderkey": [x[0] for x in lines], "l_linenumber": [x[1] for x in lines], "l_suppkey": [0] * n, "l_partkey": [0] * n,
            "l_quantity": [float(i + 1) for i in range(n)], "l_extendedprice": [x[3] / 100 for x in lines], "l_returnflag": ["N"] * n,
            "l_linestatus": ["O"] * n, "l_shipdate": [day(x[2]) for x in lines]},
    }
    for name, table in tables.items():
        pq.write_table(pa.table(table), f"{root}/{name}.parquet")
    return str(root)


def test_views_are_worked_out_from_the_joined_lines(spark, tmp_path):
    """F13 to F32: only the joined lines are written; what follows from them reads the columns it needs."""
    sf = made(tmp_path, [(1, 1, "1995-02-01", 100)])
    for name in ("text_orders", "text_payments", "raw_payments", "cur_orders", "base_payments"):
        files = adapter.view(spark, sf, name).inputFiles()
        assert files and all("/joined_lines-" in f for f in files), name
    text = plan(adapter.view(spark, sf, "cur_payments").select("payment_id"))
    assert "o_custkey" not in text and "Join" not in text


def test_the_change_batch_is_the_one_the_sql_names(spark, tmp_path):
    """Past the mark alone, on both sides of it, doubled rows, without a line number, without a ship date."""
    past, before = "2002-01-01", "1996-01-01"
    lines = [(1, 1, past, 100), (1, 2, past, 100), (1, 2, before, 300), (1, 2, past, 200), (1, 3, before, 100), (2, 1, past, 100), (2, 1, past, 100),
             (2, None, past, 100), (2, None, before, 100), (3, 1, None, 100), (3, 2, "2001-06-30", 100)]
    sf = made(tmp_path, lines)
    for table in ("orders", "payments"):
        name = f"staged_{table}"
        inputs = {n: adapter.view(spark, sf, n) for n in adapter._needs(name)}
        want = spark.sql(adapter.VIEWS[name], **inputs).collect()
        assert sorted(map(str, adapter.view(spark, sf, name).collect())) == sorted(map(str, want))
    assert {r["operation"] for r in adapter.view(spark, sf, "staged_orders").collect()} == {"new", "update"}


def test_small_files_of_many_rows_are_not_broadcast(spark):
    """a million row numbers with one reason are a small file and hundreds of MB in a broadcast."""
    rows = spark.range(0, 1_000_000, 1, 1).select(F.col("id").alias("_row"), F.array(F.lit("ORDER_NOT_CURATED")).alias("_final"))
    gained = stage(rows, scratch(spark, "gained"))
    size = sum(f.stat().st_size for f in Path(gained.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]).glob("part-*"))
    assert size < 10 << 20
    wide = spark.range(0, 3_000_000).select(F.col("id").alias("_row"))
    assert "Broadcast" not in plan(wide.join(gained, "_row", "left"))


def test_mismatches_are_worked_out_once(spark):
    """with a folder both sides read the written mismatches."""
    key = "t_order_id bigint, t_quantity bigint, t_unit_price decimal(18,6), _seq bigint, reasons array<string>"
    orders = spark.createDataFrame([(1, 2, Decimal(5), 1, []), (2, 2, Decimal(5), 2, [])], key)
    payments = spark.createDataFrame(
        [(7, 1, Decimal(9), "successful", None, 1, []), (8, 2, Decimal(10), "successful", None, 2, [])],
        "t_payment_id bigint, t_order_id bigint, t_payment_amount decimal(18,6), t_payment_status string, t_payment_time timestamp, _seq bigint, reasons array<string>")
    sides = relate.flag_mismatch(orders, payments, work := scratch(spark, "wrong"))
    assert [[r["reasons"] for r in s.orderBy("_seq").collect()] for s in sides] == [[[relate.MISMATCH], []]] * 2
    assert all(any(work in f for f in s.inputFiles()) for s in sides)

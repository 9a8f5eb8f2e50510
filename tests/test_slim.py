"""What judging, keeping and merging write and shuffle: slim rows, each text once, as many tasks as rows ask for."""

import random
import re
from decimal import Decimal
from pathlib import Path

import handmade as h
from checks import queries
from checks.oracles import MARKS, MIDDLE
from ledger.operators import relate
from ledger.operators.lookup import with_older_flag
from ledger.plans import curate, keep_curated
from ledger.plans.load import control_of
from ledger.schemas import KEYS, TABLES, columns
from ledger.session import scratch
from ledger.sources import keyed, raw
from ledger.sources.control import write_watermarks
from ledger.sources.manifest import read_manifest
from ledger.sources.raw import read_layer, read_source

SLIM = "t_order_id bigint, t_quantity bigint, t_unit_price decimal(18,6), _seq bigint, reasons array<string>"
PAID = "t_payment_id bigint, t_order_id bigint, t_payment_amount decimal(18,6), t_payment_status string, t_payment_time timestamp, _seq bigint, reasons array<string>"


def small(tmp_path):
    return h.write(
        tmp_path / "raw", nested=True, customers=[h.customer(1), h.customer("01"), h.customer("x")], products=[h.product(1)],
        orders=[h.order(1), h.order(2, 5), h.order(3), h.order(" 3", q=0), h.order("")],
        payments=[h.payment(1, 1), h.payment(2, 2), h.payment(3, 3, "7.00"), h.payment("+4", 9)])


def test_layers_can_be_written_compressed(spark, tmp_path):
    """the layers' files hold the same rows in fewer bytes."""
    source, found = small(tmp_path), {}
    for name, codec in (("plain", None), ("packed", "gzip")):
        out = f"{tmp_path}/{name}"
        curate.raw_to_curated(spark, source, f"{out}/c", f"{out}/r", compression=codec)
        files = [f.name for f in Path(out).rglob("part-*")]
        assert files and all(f.endswith(".csv.gz" if codec else ".csv") for f in files)
        found[name] = [sorted(map(str, read_layer(spark, f"{out}/{side}/{t}.csv", t, *extra).collect())) for t in TABLES for side, extra in (("c", []), ("r", ["rejection_reason"]))]
    assert found["plain"] == found["packed"]


def test_kept_texts_of_judged_rows_come_back(spark, tmp_path):
    """a key's text is written only where it isn't the typed key's own, and nothing is joined by row number."""
    source = small(tmp_path)
    text = {t: raw.read_raw(spark, source, t) for t in TABLES}
    work = scratch(spark, "slim")
    judged = curate.judge(text, work, {t: [KEYS[t]] for t in TABLES})
    for t in TABLES:
        assert sorted(r[0] for r in judged[t].select(KEYS[t]).collect()) == sorted(r[0] for r in text[t].select(KEYS[t]).collect())
    assert {r[0] for r in spark.read.parquet(f"{work}/typed/orders").select("order_id").collect()} == {None, " 3", ""}
    assert not Path(f"{work}/gained").exists()


def test_payments_of_an_order_that_mismatched_without_its_reason(spark):
    """orders need not meet the mismatches before the payments do."""
    orders = spark.createDataFrame([(1, 2, Decimal(5), 1, []), (1, 2, Decimal(5), 2, [relate.SUPERSEDED]), (2, 2, Decimal(5), 3, [])], SLIM)
    payments = spark.createDataFrame(
        [(7, 1, Decimal(9), "successful", None, 1, []), (8, 2, Decimal(10), "successful", None, 2, []), (9, 1, Decimal(1), "failed", None, 3, ["BAD"])], PAID)
    wrong = relate.amount_mismatches(orders, payments)
    want = {7: [relate.MISMATCH, relate.NOT_CURATED], 8: [], 9: ["BAD", relate.NOT_CURATED]}
    for given in (orders, relate.flag_orders(orders, wrong)):
        assert {r["t_payment_id"]: r["reasons"] for r in relate.flag_payments(payments, given, wrong).collect()} == want
    for unique in (False, True):
        assert sorted(r["reasons"] for r in relate.flag_orders(orders, wrong, unique).collect()) == [[], [relate.MISMATCH], [relate.SUPERSEDED]]


def test_older_flag_by_row_number(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([1, 2, None]), n, 100 - n) for n in range(60)]
    df = spark.createDataFrame(rows, "k bigint, ts bigint, _seq bigint, _row bigint")
    one, other = (sorted((r["_row"], r["old"]) for r in with_older_flag(df, "k", ["ts", "_seq"], "old", row).collect()) for row in (None, "_row"))
    assert one == other and {old for _, old in one} == {True, False}


def test_a_task_writes_several_small_files(spark, tmp_path):
    """40 files of 25 rows come from one task, a whole folder of them is listed at once."""
    root, schema = str(tmp_path), "order_id bigint, note string"
    keyed.create_keyed(spark.createDataFrame([(i, "old") for i in range(1000)], schema), root, "order_id", rows_per_file=25)
    files = [r["file"] for r in read_manifest(spark, root).collect()]
    assert len(files) == 40 and len({re.search("part-([0-9]+)", f)[1] for f in files}) == 1
    folder = files[0].split("/")[0]
    assert keyed._paths(spark, root, files) == [f"{root}/{folder}"]
    assert keyed._paths(spark, root, files[1:]) == [f"{root}/{f}" for f in files[1:]]
    staged = spark.createDataFrame([(3, "new"), (2000, "new")], schema)
    keyed.merge_keyed(spark, root, staged, "order_id", rows_per_file=25)
    assert {r["order_id"]: r["note"] for r in keyed.read_keyed(spark, root, staged.schema).collect()} == {i: "old" for i in range(1000)} | {3: "new", 2000: "new"}


def test_a_growing_source_is_written_once(spark, tmp_path):
    """the states of a source are parts of one copy."""
    root = f"{tmp_path}/source"
    states = queries._growing_source(spark, "/root/testdata/sf0.001", root, MARKS, MIDDLE)
    for t in TABLES:
        rows = queries._single_versions(spark, "/root/testdata/sf0.001", t)
        assert spark.read.parquet(f"{root}/{t}").count() == rows.count()
        for state, marks in zip(states, (MARKS, MIDDLE, None), strict=True):
            want = rows if marks is None else rows.filter(f"updated_at <= timestamp '{marks[t]}'")
            assert sorted(map(str, read_source(spark, state, t).collect())) == sorted(map(str, want.collect()))


def test_kept_texts_are_written_once(spark, tmp_path):
    """a step writes the texts of its new rows alone; buckets hold no texts."""
    root, state = small(tmp_path), f"{tmp_path}/state"
    write_watermarks(control_of(spark, dict.fromkeys(TABLES, "2025-02-28 00:00:00"), "full"), root, "full")
    keep_curated.update_layers(spark, root, state, buckets=2)
    for t in TABLES:
        assert not set(spark.read.parquet(*map(str, Path(f"{state}/{t}").glob("step=*"))).columns) & set(columns(t))
        assert spark.read.parquet(*map(str, Path(f"{state}/{t}_text").glob("step=*"))).count() == raw.read_raw(spark, root, t).count()
    keep_curated.update_layers(spark, root, state)
    assert all(len(f) == 1 for f in keep_curated.State(spark, state, 1).texts.values())
    kept = keep_curated.current_rows(spark, state)
    assert all(kept[t].count() == raw.read_raw(spark, root, t).count() for t in TABLES)

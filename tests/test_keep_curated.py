"""Layers kept batch by batch against the whole job over the same history."""

import random
from collections import Counter

import pytest

import handmade as h
from ledger.plans import keep_curated as keep
from ledger.plans.curate import raw_to_curated
from ledger.plans.load import control_of
from ledger.schemas import TABLES, columns
from ledger.sources.control import write_watermarks
from ledger.sources.manifest import current_number
from ledger.sources.raw import read_layer
from ledger.sources.sinks import _write_csv, batch_path, layer_path


def text(spark, table, rows):
    return spark.createDataFrame([tuple(str(r[c]) for c in columns(table)) for r in rows], ", ".join(f"{c} string" for c in columns(table)))


def add_batch(spark, root, n, tables):
    """A completed run: one folder per table, the control row last."""
    mark = f"2025-03-{n:02d} 00:00:00"
    for t in TABLES:
        _write_csv(text(spark, t, tables.get(t, [])).coalesce(1), batch_path(root, t, mark, f"run-{n}"))
    write_watermarks(control_of(spark, dict.fromkeys(TABLES, mark), f"run-{n}"), root, f"run-{n}")


def expected(spark, root, out):
    raw_to_curated(spark, root, f"{out}/c", f"{out}/r", history=True, run_id="whole")
    rows = Counter()
    for t in TABLES:
        rows.update((t, "curated", *r) for r in read_layer(spark, layer_path(f"{out}/c", t, "whole"), t).collect())
        rows.update((t, "rejected", *r) for r in read_layer(spark, layer_path(f"{out}/r", t, "whole"), t, "rejection_reason").collect())
    return rows


def kept(spark, state):
    rows = Counter()
    for t, layers in keep.current_layers(spark, state).items():
        for name, df in zip(("curated", "rejected"), layers):
            rows.update((t, name, *r) for r in df.collect())
    return rows


def some_rows(rng, n, size):
    """Rows of few keys, so that versions, references and amounts of different batches meet."""
    def at():
        return f"2025-02-{rng.randint(1, 28):02d} 00:00:00.0000000"
    key = lambda top: rng.choice([rng.randint(1, top)] * 9 + ["bad", ""])
    return {
        "customers": [h.customer(key(6), at=at(), email=rng.choice(["a@b.test", "a@b.test", " "])) for _ in range(rng.randint(0, size))],
        "products": [h.product(key(5), rng.choice(["10.00", "10.00", "0"]), at=at()) for _ in range(rng.randint(0, size))],
        "orders": [h.order(key(15), key(6), key(5), q=rng.choice([2, 2, 0]), at=at()) for _ in range(rng.randint(0, 2 * size))],
        "payments": [h.payment(key(20), key(15), rng.choice(["20.00", "20.00", "7.00"]), rng.choice(["successful", "failed"]),
                               when=f"2025-01-{rng.randint(1, 28):02d} 00:00:00", at=at()) for _ in range(rng.randint(0, 2 * size))],
    }


@pytest.mark.parametrize("seed", [1])
def test_random_batches_equal_the_whole_job(spark, tmp_path, seed):
    rng = random.Random(seed)
    root, state = h.write(tmp_path / "raw", nested=True, **some_rows(rng, 0, 12)), f"{tmp_path}/state"
    write_watermarks(control_of(spark, dict.fromkeys(TABLES, "2025-02-28 00:00:00"), "full"), root, "full")
    for n in range(1, 4):
        add_batch(spark, root, n, some_rows(rng, n, 4))
        if n == 2:
            continue  # two batches at once next time
        done = {r["table_name"]: r for r in keep.update_layers(spark, root, state, buckets=8).collect()}
        assert kept(spark, state) == expected(spark, root, f"{tmp_path}/out{n}")
        assert all(r["reconciled"] and r["raw_rows"] == r["curated_rows"] + r["rejected_rows"] for r in done.values())
    nothing = keep.update_layers(spark, root, state).collect()
    assert all(r["new_rows"] == r["judged_again"] == r["buckets_written"] == 0 for r in nothing)
    assert kept(spark, state) == expected(spark, root, f"{tmp_path}/last")


@pytest.fixture(scope="module")
def settled(spark, tmp_path_factory):
    """200 orders of 20 customers, all curated."""
    tmp = tmp_path_factory.mktemp("settled")
    root, state = h.write(
        tmp / "raw", nested=True, customers=[h.customer(i) for i in range(1, 21)], products=[h.product(i) for i in range(1, 6)],
        orders=[h.order(i, 1 + i % 20, 1 + i % 5) for i in range(1, 201)], payments=[h.payment(i, i) for i in range(1, 201)]), f"{tmp}/state"
    write_watermarks(control_of(spark, dict.fromkeys(TABLES, "2025-02-28 00:00:00"), "full"), root, "full")
    first = {r["table_name"]: r for r in keep.update_layers(spark, root, state, buckets=64).collect()}
    assert first["orders"]["curated_rows"] == 200 and first["payments"]["rejected_rows"] == 0
    return tmp, root, state


def test_only_affected_rows_and_buckets(spark, settled, monkeypatch):
    """One customer becomes invalid: its ten orders and their payments are judged again, the other buckets are not opened."""
    tmp, root, state = settled
    before = keep.State(spark, state, 1)
    add_batch(spark, root, 1, {"customers": [h.customer(7, at="2025-03-01 00:00:00", email=" ")], "payments": [h.payment(900, 3, at="2025-03-01 00:00:00")]})
    read, load = [], keep.State._load
    monkeypatch.setattr(keep.State, "_load", lambda self, paths, schema: (read.extend(paths), load(self, paths, schema))[1])
    done = {r["table_name"]: r for r in keep.update_layers(spark, root, state).collect()}
    monkeypatch.undo()
    assert (done["customers"]["judged_again"], done["orders"]["judged_again"], done["payments"]["judged_again"]) == (1, 11, 11)
    assert (done["customers"]["buckets_written"], done["products"]["buckets_written"]) == (1, 0)
    assert done["orders"]["buckets_written"] <= 11 and done["payments"]["buckets_written"] <= 11
    opened = {p for p in read if "/orders/" in p}
    assert 0 < len(opened) <= 11 < len(before.tables["orders"])
    after = keep.State(spark, state, 1)
    left = [b for b, r in before.tables["orders"].items() if after.tables["orders"][b]["folder"] == r["folder"]]
    assert len(left) >= len(before.tables["orders"]) - 11
    assert kept(spark, state) == expected(spark, root, f"{tmp}/out1")


def test_valid_again(spark, settled):
    tmp, root, state = settled
    add_batch(spark, root, 2, {"customers": [h.customer(7, at="2025-03-02 00:00:00")], "orders": [h.order(3, 99, 1, at="2025-03-02 00:00:00")]})
    keep.update_layers(spark, root, state)
    assert kept(spark, state) == expected(spark, root, f"{tmp}/out2")


def test_a_failure_before_the_manifest_changes_nothing(spark, settled, monkeypatch):
    tmp, root, state = settled
    number, rows = current_number(spark, state), kept(spark, state)
    add_batch(spark, root, 3, {"orders": [h.order(500, 1, 1), h.order(501, 1, 1)]})
    whole = keep.relate.reject_superseded
    monkeypatch.setattr(keep.relate, "reject_superseded", lambda df, key: whole(df, key).filter("t_order_id is null or t_order_id <> 501") if key == "t_order_id" else whole(df, key))
    with pytest.raises(ValueError, match="do not reconcile"):
        keep.update_layers(spark, root, state)
    monkeypatch.undo()
    assert current_number(spark, state) == number and kept(spark, state) == rows
    keep.update_layers(spark, root, state)
    assert kept(spark, state) == expected(spark, root, f"{tmp}/out3")


def test_published_files(spark, settled, tmp_path):
    _, _, state = settled
    keep.publish_layers(spark, state, {t: (f"{tmp_path}/c/{t}.csv", f"{tmp_path}/r/{t}.csv") for t in TABLES})
    assert Counter(read_layer(spark, f"{tmp_path}/c/orders.csv", "orders").collect()) == Counter(keep.current_layers(spark, state)["orders"][0].collect())


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    """the rows of a bucket are dealt by size, not to one task and file."""
    root, state = h.write(
        tmp_path / "raw", nested=True, customers=[h.customer(1)], products=[h.product(1)],
        orders=[h.order(i, 1, 1) for i in range(1, 2001)], payments=[h.payment(i, i) for i in range(1, 2001)]), f"{tmp_path}/state"
    write_watermarks(control_of(spark, dict.fromkeys(TABLES, "2025-02-28 00:00:00"), "full"), root, "full")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    before = {name: spark.conf.get(name, None) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        keep.update_layers(spark, root, state, buckets=1)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    assert len(list((tmp_path / "state").glob("orders/step=*/bucket=0/part-*"))) > 1
    assert {t: [df.count() for df in layers] for t, layers in keep.current_layers(spark, state).items()}["orders"] == [2000, 0]

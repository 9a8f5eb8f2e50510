"""The raw to curated/rejected job on hand-made files."""

import json
from pathlib import Path

import pytest

import handmade as h
from ledger.operators.quality import overall_status, validate_outputs
from ledger.plans import curate
from ledger.plans.curate import raw_to_curated
from ledger.schemas import KEYS, TABLES, columns
from ledger.sources.raw import read_layer, read_raw
from ledger.sources.sinks import layer_path


def run(spark, tmp_path, **tables):
    raw = h.write(tmp_path / "raw", **tables)
    out = f"{tmp_path}/curated", f"{tmp_path}/rejected"
    summary = raw_to_curated(spark, raw, *out, summary=f"{tmp_path}/summary")
    counts = {r["table_name"]: (r["raw_rows"], r["curated_rows"], r["rejected_rows"]) for r in summary.collect()}
    checked = validate_outputs(spark, raw, *out)
    assert overall_status(checked).first()["status"] == "PASS"
    checked = checked.collect()
    assert all(r["reconciled"] and r["failures"] == "" for r in checked)
    return counts


def rejected(spark, tmp_path, table, key):
    rows = read_layer(spark, f"{tmp_path}/rejected/{table}.csv", table, "rejection_reason").collect()
    return sorted((r[key], r["rejection_reason"]) for r in rows)


def test_later_version_wins_and_no_row_is_lost(spark, tmp_path):
    counts = run(
        spark, tmp_path, products=[h.product(1)], orders=[h.order(1)], payments=[h.payment(1, 1)],
        customers=[h.customer(1), h.customer(2), h.customer(1, "Corrected Name", at="2026-08-14T00:00:00+00:00")],
    )
    assert counts["customers"] == (3, 2, 1)
    assert rejected(spark, tmp_path, "customers", "customer_name") == [("Ann", "SUPERSEDED_BY_LATER_VERSION")]
    kept = read_layer(spark, f"{tmp_path}/curated/customers.csv", "customers").filter("customer_id = '1'").first()
    assert kept["customer_name"] == "Corrected Name"
    assert kept["updated_at"] == "2026-08-14T00:00:00.000000+00:00"


def test_equal_times_are_decided_by_input_order(spark, tmp_path):
    run(spark, tmp_path, customers=[h.customer(1, f"v{i}") for i in range(5)])
    kept = read_layer(spark, f"{tmp_path}/curated/customers.csv", "customers").collect()
    assert [r["customer_name"] for r in kept] == ["v4"]


def test_cascade(spark, tmp_path):
    late = "2025-02-01 00:00:00.0000000"
    counts = run(
        spark, tmp_path,
        customers=[h.customer(1), h.customer(2, email=" ")],
        products=[h.product(1), h.product(2, "0")],
        orders=[
            h.order(1),                                  # fine
            h.order(2, c=2),                             # customer rejected
            h.order(3, p=2),                             # product rejected
            h.order(4, c="12x"),                         # bad customer text gives two reasons
            h.order(5, c="", q=0, status="lost"),        # several reasons in order
            h.order(6), h.order(6, q=-1, at=late),       # a bad newest version still wins
            h.order(7),                                  # paid a wrong amount
            h.order(8),                                  # an earlier wrong amount, then the right one
            h.order(9),                                  # failed payment is no data error
            h.order("x1"), h.order("x1"),                # unreadable keys are not versions of each other
        ],
        payments=[
            h.payment(1, 1), h.payment(2, 2), h.payment(3, 99), h.payment(4, 7, "21.00"),
            h.payment(5, 8, "1.00"), h.payment(6, 8, when="2025-01-03 00:00:00"), h.payment(7, 9, "1.00", "failed"),
            h.payment(8, "n/a"), h.payment(9, 6),
        ],
    )
    assert counts["orders"] == (12, 3, 9)
    assert rejected(spark, tmp_path, "orders", "order_id") == [
        ("2", "UNKNOWN_CUSTOMER_REFERENCE"),
        ("3", "UNKNOWN_PRODUCT_REFERENCE"),
        ("4", "INVALID_INTEGER_CUSTOMER_ID;MISSING_CUSTOMER_REFERENCE"),
        ("5", "MISSING_CUSTOMER_REFERENCE;INVALID_QUANTITY;INVALID_ORDER_STATUS"),
        ("6", "INVALID_QUANTITY"),
        ("6", "SUPERSEDED_BY_LATER_VERSION"),
        ("7", "PAYMENT_AMOUNT_MISMATCH"),
        ("x1", "INVALID_INTEGER_ORDER_ID"),
        ("x1", "INVALID_INTEGER_ORDER_ID"),
    ]
    assert rejected(spark, tmp_path, "payments", "payment_id") == [
        ("2", "ORDER_NOT_CURATED"),
        ("3", "UNKNOWN_ORDER_REFERENCE;ORDER_NOT_CURATED"),
        ("4", "PAYMENT_AMOUNT_MISMATCH;ORDER_NOT_CURATED"),
        ("8", "INVALID_INTEGER_ORDER_ID"),
        ("9", "ORDER_NOT_CURATED"),
    ]
    lines = [json.loads(x) for f in Path(f"{tmp_path}/summary").glob("part*") for x in f.read_text().splitlines()]
    orders = next(x for x in lines if x["table_name"] == "orders")
    assert orders["rejection_reason_counts"]["INVALID_QUANTITY"] == 2 and orders["reconciled"]


def test_wide_amounts_are_compared_exactly(spark, tmp_path):
    big = "123456789012345678901234567890"
    counts = run(
        spark, tmp_path, customers=[h.customer(1)], products=[h.product(1, "1e-7")],
        orders=[h.order(1, price="1e-7", q=3), h.order(2, price="1.0000009", q=2), h.order(3, price=big, q=7), h.order(4, price=big, q=7), h.order(5, price="-" + big), h.order(6, price="10.00000000")],
        payments=[h.payment(1, 1, "0.0000003"), h.payment(2, 2, "2.0000019"), h.payment(3, 3, str(7 * int(big))), h.payment(4, 4, str(7 * int(big) + 1)), h.payment(5, 5, "1.0000000001"), h.payment(6, 6, "2e1")],
    )
    assert counts["orders"] == (6, 3, 3) and counts["products"] == (1, 1, 0)
    assert rejected(spark, tmp_path, "orders", "order_id") == [
        ("2", "PAYMENT_AMOUNT_MISMATCH"), ("4", "PAYMENT_AMOUNT_MISMATCH"), ("5", "NON_POSITIVE_UNIT_PRICE")]
    assert [r[0] for r in rejected(spark, tmp_path, "payments", "payment_id")] == ["2", "4", "5"]


def test_original_text_is_kept(spark, tmp_path):
    run(spark, tmp_path, customers=[h.customer(" 1 ", name=' a "quoted",\nname ')], products=[h.product("+1", " 1e1")])
    kept = read_layer(spark, f"{tmp_path}/curated/customers.csv", "customers").first()
    assert (kept["customer_id"], kept["customer_name"]) == (" 1 ", ' a "quoted",\nname ')
    assert read_layer(spark, f"{tmp_path}/curated/products.csv", "products").first()["unit_price"] == " 1e1"


def test_targets_are_not_overwritten(spark, tmp_path):
    raw = h.write(tmp_path / "raw", customers=[h.customer(1)])
    out = f"{tmp_path}/curated", f"{tmp_path}/rejected"
    raw_to_curated(spark, raw, *out)
    with pytest.raises(FileExistsError):
        raw_to_curated(spark, raw, *out)
    raw_to_curated(spark, raw, *out, overwrite=True)
    raw_to_curated(spark, raw, *out, run_id="r1")
    for table in TABLES:
        assert Path(layer_path(out[0], table, "r1")).is_dir()
    with pytest.raises(ValueError):
        raw_to_curated(spark, raw, raw, f"{tmp_path}/other")


def test_reader_refuses_wrong_headers_and_skips_byte_order_mark(spark, tmp_path):
    raw = h.write(tmp_path / "raw", bom=True, nested=True, customers=[h.customer(1)])
    counts = raw_to_curated(spark, raw, f"{tmp_path}/c", f"{tmp_path}/r").filter("table_name = 'customers'").first()
    assert counts["curated_rows"] == 1
    path = Path(raw) / "customers" / "customers.csv"
    path.write_text(path.read_text(encoding="utf-8-sig").replace("customer_name", "Customer_Name"))
    with pytest.raises(Exception, match="(?s)header"):
        read_layer(spark, str(path), "customers").count()
    with pytest.raises(FileNotFoundError, match="orders/orders.csv"):
        read_raw(spark, str(tmp_path / "nowhere"), "orders")


@pytest.mark.parametrize("summary", [True, False])
def test_a_lost_row_does_not_reconcile(spark, tmp_path, monkeypatch, summary):
    raw = h.write(tmp_path / "raw", customers=[h.customer(1), h.customer(2)])
    wrong = curate.write_curated
    monkeypatch.setattr(curate, "write_curated", lambda df, *a: wrong(df.filter("customer_id <> '2'") if a[1] == "customers" else df, *a))
    with pytest.raises(ValueError, match="do not reconcile"):
        raw_to_curated(spark, raw, f"{tmp_path}/c", f"{tmp_path}/r", summary=f"{tmp_path}/s" if summary else None)


def test_judged_rows_can_be_kept_without_their_texts(spark, tmp_path):
    raw = h.write(
        tmp_path / "raw", customers=[h.customer(1), h.customer(1, "Other", at="2026-08-14T00:00:00+00:00"), h.customer("x")], products=[h.product(1)],
        orders=[h.order(1), h.order(2, 5)], payments=[h.payment(1, 1), h.payment(2, 2), h.payment(3, 7)])
    text = {t: read_raw(spark, raw, t) for t in TABLES}
    whole = curate.judge(text, f"{tmp_path}/whole")
    slim = curate.judge(text, f"{tmp_path}/slim", {t: [KEYS[t]] for t in TABLES})
    for t in TABLES:
        assert not set(spark.read.parquet(f"{tmp_path}/slim/typed/{t}").columns) & (set(columns(t)) - {KEYS[t]})
        one, other = (sorted((r[KEYS[t]], r["reasons"]) for r in found[t].collect()) for found in (whole, slim))
        assert one == other and len(one) == text[t].count()

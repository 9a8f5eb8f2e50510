"""Versions, references, payment amounts and routing of validated rows.

Input rows carry ``t_*`` typed columns, ordered ``reasons`` and ``_seq`` (see ``validate``).  Every operator
only appends reasons; no row is ever dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger.functions import rules as R
from ledger.functions.rules import more_reasons
from ledger.operators.lookup import newest_per_key, shuffled_apart, with_match_flag, with_older_flag
from ledger.session import stage

SUPERSEDED = "SUPERSEDED_BY_LATER_VERSION"
UNKNOWN_CUSTOMER = "UNKNOWN_CUSTOMER_REFERENCE"
UNKNOWN_PRODUCT = "UNKNOWN_PRODUCT_REFERENCE"
UNKNOWN_ORDER = "UNKNOWN_ORDER_REFERENCE"
MISMATCH = "PAYMENT_AMOUNT_MISMATCH"
NOT_CURATED = "ORDER_NOT_CURATED"


def clean() -> Column:
    return F.size("reasons") == 0


def _append(df: DataFrame, *found: tuple[Column, str]) -> DataFrame:
    return df.withColumn(
        "reasons", more_reasons(F.col("reasons"), *[F.when(c, F.lit(r)) for c, r in found])
    )


def reject_superseded(df: DataFrame, key: str, ts: str = "t_updated_at", row: str | None = None) -> DataFrame:
    """All rows of a key but the newest get a reason, whether or not the newest is valid.

    Newest is the highest time (null lowest), then the highest ``_seq``.  Rows without a key are left
    alone.  ``row`` names a row number, where there is one and ``_seq`` is unique.
    """
    return _append(with_older_flag(df, key, [ts, "_seq"], "_older", row), (F.col("_older"), SUPERSEDED)).drop("_older")


def valid_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct typed keys of rows without a reason so far."""
    return df.filter(clean() & F.col(key).isNotNull()).select(key).distinct()


def flag_missing(
    df: DataFrame, keys: DataFrame, key: str, column: str, reason: str, spread_by: str
) -> DataFrame:
    """Rows whose non-null ``column`` is not among ``keys`` get ``reason``."""
    flagged = with_match_flag(df, keys, key, column, "_known", spread_by)
    return _append(flagged, (F.col(column).isNotNull() & ~F.col("_known"), reason)).drop("_known")


def unknown_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    keys = valid_keys(customers, "t_customer_id")
    return flag_missing(orders, keys, "t_customer_id", "t_customer_id", UNKNOWN_CUSTOMER, "_seq")


def unknown_product(orders: DataFrame, products: DataFrame) -> DataFrame:
    keys = valid_keys(products, "t_product_id")
    return flag_missing(orders, keys, "t_product_id", "t_product_id", UNKNOWN_PRODUCT, "_seq")


def unknown_order(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments for an order id that no order row has, rejected order rows included."""
    keys = orders.filter(F.col("t_order_id").isNotNull()).select("t_order_id").distinct()
    return flag_missing(payments, keys, "t_order_id", "t_order_id", UNKNOWN_ORDER, "_seq")


def latest_clean_payment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Per order without reasons: its latest payment without reasons."""
    wide = [c for c in ("w_payment_amount",) if c in payments.columns]
    attempts = payments.filter(clean() & F.col("t_order_id").isNotNull()).select(
        "t_order_id", "t_payment_id", "t_payment_time", "t_payment_status", "t_payment_amount", *wide
    )
    latest = newest_per_key(
        attempts, "t_order_id", F.col("t_payment_time").desc_nulls_last(),
        F.col("t_payment_id").desc_nulls_last(),
    )
    price = ["t_unit_price", "w_unit_price", "t_quantity"] if "w_unit_price" in orders.columns else []
    wanted = orders.filter(clean() & F.col("t_order_id").isNotNull()).select(
        "t_order_id", (F.col("t_unit_price") * F.col("t_quantity")).alias("expected_amount"), *price
    )
    return wanted.join(latest, "t_order_id")


def amount_mismatches(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """``(t_order_id, t_payment_id)`` of clean orders whose latest clean payment succeeded with a wrong amount."""
    latest = latest_clean_payment(orders, payments).filter(F.col("t_payment_status") == "successful")
    wrong = F.col("t_payment_amount") != F.col("expected_amount")
    if "w_payment_amount" in latest.columns and "w_unit_price" in latest.columns:
        # Where a side is wider than its type, normal forms are compared, exactly.
        paid, price = (F.coalesce(f"w_{c}", R.normal_form(F.col(f"t_{c}").cast("string"))) for c in ("payment_amount", "unit_price"))
        wide = F.col("w_payment_amount").isNotNull() | F.col("w_unit_price").isNotNull()
        wrong = F.when(wide, ~paid.eqNullSafe(R.normal_product(price, F.col("t_quantity")))).otherwise(wrong)
    return latest.filter(wrong).select("t_order_id", "t_payment_id")


def flag_mismatch(orders: DataFrame, payments: DataFrame, work: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides of a mismatch get the reason; with a folder ``work`` the mismatches are worked out once, there."""
    wrong = amount_mismatches(orders, payments)
    wrong = stage(wrong, work) if work else wrong
    return flag_orders(orders, wrong), _flag_clean(payments, wrong, "t_payment_id")


def flag_orders(orders: DataFrame, wrong: DataFrame, unique: bool = False) -> DataFrame:
    """``unique`` says that no two orders share time and ``_seq``, so an order id has one clean row at most."""
    return _flag_clean(orders, wrong, "t_order_id", unique)


def _flag_clean(df: DataFrame, wrong: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Clean rows are unique per key once versions are collapsed, so a key names one clean row.

    Where that is sure (``unique``), rows with reasons keep theirs and pass the join by.
    """
    if not unique:
        flagged = with_match_flag(df, wrong, key, key, "_wrong", "_seq")
        return _append(flagged, (clean() & F.col("_wrong"), MISMATCH)).drop("_wrong")
    flagged = with_match_flag(df.filter(clean()).drop("reasons"), wrong, key, key, "_wrong", "_seq")
    found = F.when(F.col("_wrong"), F.array(F.lit(MISMATCH))).otherwise(F.array().cast("array<string>"))
    return flagged.withColumn("reasons", found).select(*df.columns).unionByName(df.filter(~F.coalesce(clean(), F.lit(False))))


def order_not_curated(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments of an order without a curated row get the reason, on top of any others."""
    keys = valid_keys(orders, "t_order_id")
    return flag_missing(payments, keys, "t_order_id", "t_order_id", NOT_CURATED, "_seq")


def flag_payments(payments: DataFrame, orders: DataFrame, wrong: DataFrame) -> DataFrame:
    """Unknown order, wrong amount and not curated in one join of the payments.

    ``orders`` may lack the reasons that ``wrong`` gives: the clean row of an order is the one that mismatched.  Per order id the order rows are reduced to one row that says
    whether a clean row exists and which payment, if any, mismatched; the payments then need a
    single pass over their order key instead of three.
    """
    state = (
        orders.filter(F.col("t_order_id").isNotNull())
        .groupBy(F.col("t_order_id").alias("_order"))
        .agg(F.bool_or(clean()).alias("_curated"))
        .join(wrong.select(F.col("t_order_id").alias("_order"), F.col("t_payment_id").alias("_payment"), F.lit(True).alias("_mismatch")),
              "_order", "left")
        .select("_order", (F.col("_curated") & F.col("_mismatch").isNull()).alias("_curated"), "_payment")
    )
    stand_in = -F.pmod(F.xxhash64("_seq"), F.lit(1 << 40)) - 1
    has_order = F.col("t_order_id").isNotNull()
    joined = (
        payments.withColumn("_probe", F.coalesce(F.col("t_order_id"), stand_in))
        .join(shuffled_apart(state, "_order"), F.col("_probe") == F.col("_order"), "left")
    )
    return _append(
        joined,
        (has_order & F.col("_order").isNull(), UNKNOWN_ORDER),
        (has_order & clean() & F.col("t_payment_id").eqNullSafe(F.col("_payment")), MISMATCH),
        (has_order & ~F.coalesce(F.col("_curated"), F.lit(False)), NOT_CURATED),
    ).drop("_probe", "_order", "_curated", "_payment")


def route(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(curated, rejected): every row is in exactly one."""
    return df.filter(clean()), df.filter(~clean())


def latest_payment(payments: DataFrame) -> DataFrame:
    """The newest payment attempt per order: by payment time, then payment id."""
    return newest_per_key(
        payments, "order_id", F.col("payment_time").desc_nulls_last(),
        F.col("payment_id").desc_nulls_last(),
    )


def latest_versions(df: DataFrame, key: str, ts: str = "updated_at") -> DataFrame:
    """The newest version per key; equal times are decided by ``_seq`` where the rows have one."""
    tie = [F.col("_seq").desc_nulls_last()] if "_seq" in df.columns else []
    return newest_per_key(df, key, F.col(ts).desc_nulls_last(), *tie)

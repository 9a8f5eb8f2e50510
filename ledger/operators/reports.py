"""Reports and source checks over the four model tables (one row per key).

"Confirmed" means: quantity above zero, order completed, latest payment successful with the amount
quantity x unit price; which of customer and product must exist differs per report and is stated there.

Facts are filtered and, wherever the result allows it, aggregated before they meet a dimension: the
confirmed predicate needs no dimension, and per-product or per-customer sums reach the dimension join as
one row per key, however many orders that key has.  References are tested by semi joins on the key
column alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledger.operators.lookup import with_dense_rank, with_match_flag
from ledger.operators.relate import latest_payment
from ledger.session import stage

Tables = dict[str, DataFrame]


def _money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def expected_amount() -> Column:
    return F.col("quantity") * F.col("unit_price")


def paid_exactly() -> Column:
    """The payment equals the expected amount.

    Written as a difference so that Spark does not take the amount for a second join key, which would
    shuffle both sides again on (order, amount) although they are already together by order.
    """
    return F.col("payment_amount") - expected_amount() == 0


def _rows() -> Column:
    return F.count(F.lit(1))


# Entry that a batch of reports adds to its tables, see ``share_latest``.
LATEST = "latest_payments"


def share_latest(t: Tables, path: str) -> Tables:
    """The tables with the latest payments written once, for several reports over the same tables."""
    return {**t, LATEST: stage(_latest(t), path)}


def _latest(t: Tables) -> DataFrame:
    """Narrow latest payment per order."""
    if LATEST in t:
        return t[LATEST]
    return latest_payment(
        t["payments"].select("payment_id", "order_id", "payment_amount", "payment_status", "payment_time")
    )


def _keys(t: Tables, table: str, key: str) -> DataFrame:
    return t[table].select(key)


def _paid_in_full(t: Tables) -> DataFrame:
    """Completed orders with a positive quantity whose latest payment succeeded with the right amount.

    The order filters reach the scan; customers and products are not looked at.
    """
    kept = t["orders"].filter((F.col("quantity") > 0) & (F.col("order_status") == "completed")).select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "created_at"
    )
    paid = _latest(t).filter(F.col("payment_status") == "successful").select("order_id", "payment_amount")
    return kept.join(paid, "order_id").filter(paid_exactly())


def _confirmed(t: Tables) -> DataFrame:
    """Orders paid in full whose customer and product both exist."""
    return (
        _paid_in_full(t)
        .join(_keys(t, "products", "product_id"), "product_id", "left_semi")
        .join(_keys(t, "customers", "customer_id"), "customer_id", "left_semi")
    )


def _with_latest(t: Tables) -> DataFrame:
    """All orders with their latest payment, if any."""
    return t["orders"].join(_latest(t), "order_id", "left")


def _with_references(df: DataFrame, t: Tables) -> DataFrame:
    df = with_match_flag(df, t["customers"], "customer_id", "customer_id", "has_customer", "order_id")
    return with_match_flag(df, t["products"], "product_id", "product_id", "has_product", "order_id")


def kpi_summary(t: Tables) -> DataFrame:
    """All orders; confirmed orders, their revenue and average (null if none)."""
    confirmed = _confirmed(t).agg(
        F.count_if(F.col("payment_amount") > 0).alias("confirmed_orders"),
        F.sum("payment_amount").alias("revenue"),
        F.lit(0).cast("bigint").alias("total_orders"),
    )
    total = t["orders"].agg(_rows().alias("total_orders"))
    both = confirmed.unionByName(total, allowMissingColumns=True).agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("confirmed_orders").alias("confirmed_orders"),
        _money(F.coalesce(F.sum("revenue"), F.lit(0))).alias("total_confirmed_revenue"),
    )
    return both.withColumn(
        "average_confirmed_order_value",
        _money(F.round(F.col("total_confirmed_revenue") / F.nullif("confirmed_orders", F.lit(0)), 2)),
    )


def daily_revenue(t: Tables) -> DataFrame:
    return (
        _confirmed(t).groupBy(F.to_date("created_at").alias("order_date"))
        .agg(_rows().alias("confirmed_orders"), _money(F.sum("payment_amount")).alias("confirmed_revenue"))
        .orderBy("order_date")
    )


def _product_revenue(t: Tables) -> DataFrame:
    """Revenue per existing product; the customer is not looked at."""
    sums = _paid_in_full(t).groupBy("product_id").agg(
        _rows().alias("confirmed_orders"), F.sum("quantity").alias("units_sold"),
        _money(F.sum("payment_amount")).alias("confirmed_revenue"),
    )
    return sums.join(t["products"].select("product_id", "product_name", "category"), "product_id")


def product_performance(t: Tables) -> DataFrame:
    """Orders, units and revenue per product with its dense rank in the category (no customer test)."""
    ranked = with_dense_rank(
        _product_revenue(t), "confirmed_revenue", "category_revenue_rank", group="category"
    )
    return ranked.select(
        "category", "product_id", "product_name", "confirmed_orders", "units_sold", "confirmed_revenue",
        "category_revenue_rank",
    ).orderBy("category", "category_revenue_rank", "product_id")


def customer_performance(t: Tables) -> DataFrame:
    """Orders and revenue per customer with the overall dense rank (customer and product exist)."""
    sums = (
        _paid_in_full(t)
        .join(_keys(t, "products", "product_id"), "product_id", "left_semi")
        .groupBy("customer_id")
        .agg(_rows().alias("confirmed_orders"), _money(F.sum("payment_amount")).alias("confirmed_revenue"))
    )
    named = sums.join(t["customers"].select("customer_id", "customer_name", "city", "state"), "customer_id")
    return with_dense_rank(named, "confirmed_revenue", "customer_revenue_rank").select(
        "customer_id", "customer_name", "city", "state", "confirmed_orders", "confirmed_revenue",
        "customer_revenue_rank",
    ).orderBy("customer_revenue_rank", "customer_id")


def order_status_distribution(t: Tables) -> DataFrame:
    return (
        t["orders"].groupBy("order_status")
        .agg(_rows().alias("order_count"),
             _money(F.sum(F.when(F.col("quantity") > 0, expected_amount()))).alias("nominal_order_value"))
        .orderBy(F.col("order_count").desc(), "order_status")
    )


def payment_status_distribution(t: Tables) -> DataFrame:
    """Latest status or ``no_payment``; the amount covers every status."""
    return (
        _with_latest(t)
        .groupBy(F.coalesce("payment_status", F.lit("no_payment")).alias("payment_status"))
        .agg(_rows().alias("order_count"),
             _money(F.coalesce(F.sum("payment_amount"), F.lit(0))).alias("recorded_amount"))
        .orderBy(F.col("order_count").desc(), "payment_status")
    )


def outstanding_orders(t: Tables) -> DataFrame:
    """Orders neither cancelled nor returned whose latest payment is missing, failed or pending."""
    kept = {**t, "orders": t["orders"].filter(~F.col("order_status").isin("cancelled", "returned"))}
    return (
        _with_latest(kept)
        .filter(F.col("payment_id").isNull() | F.col("payment_status").isin("failed", "pending"))
        .select(
            "order_id", "order_status", _money(expected_amount()).alias("expected_amount"),
            F.coalesce("payment_status", F.lit("no_payment")).alias("latest_payment_status"),
            _money(F.col("payment_amount")).alias("latest_payment_amount"), "created_at",
        )
        .orderBy("created_at", "order_id")
    )


def table_counts(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(_rows().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in t.items() if name != LATEST
    ]).orderBy("table_name")


def confirmed_totals(t: Tables) -> DataFrame:
    return _confirmed(t).agg(
        _rows().alias("confirmed_order_count"),
        _money(F.sum("payment_amount")).alias("confirmed_revenue"),
    )


def _monthly_revenue(t: Tables) -> DataFrame:
    return _confirmed(t).groupBy(
        F.trunc("created_at", "month").alias("revenue_month")
    ).agg(_money(F.sum("payment_amount")).alias("confirmed_revenue"))


def monthly_revenue_mom(t: Tables) -> DataFrame:
    """Revenue per month beside the previous month with revenue.

    The unpartitioned window runs over one row per calendar month.
    """
    before = F.lag("confirmed_revenue").over(Window.orderBy("revenue_month"))
    change = F.lit(100) * (F.col("confirmed_revenue") - F.col("previous_month_revenue"))
    return (
        _monthly_revenue(t)
        .withColumn("previous_month_revenue", before)
        .withColumn("month_over_month_percent",
                    _money(F.round(change / F.nullif("previous_month_revenue", F.lit(0)), 2)))
        .orderBy("revenue_month")
    )


def top_products_by_category(t: Tables, top: int = 3) -> DataFrame:
    """Products ranked at most ``top`` in their category, ties kept (no customer test).

    The rank limit is applied inside map tasks before the shuffle by category.
    """
    window = Window.partitionBy("category").orderBy(F.col("confirmed_revenue").desc())
    return (
        _product_revenue(t)
        .withColumn("revenue_rank", F.rank().over(window))
        .filter(F.col("revenue_rank") <= top)
        .select("category", "product_name", "confirmed_revenue", F.col("revenue_rank").cast("bigint").alias("revenue_rank"))
        .orderBy("category", "revenue_rank", "product_name")
    )


def customer_lifetime_spend(t: Tables, top: int = 20) -> DataFrame:
    """The first ``top`` customers by spend; customers without any count too (no product test).

    Dense ranks of the first rows depend on those rows only, so the top rows are taken first (a
    distributed top-k) and ranked after.
    """
    sums = _paid_in_full(t).groupBy("customer_id").agg(
        _rows().alias("n"), F.sum("payment_amount").alias("spend")
    )
    spend = (
        t["customers"].select("customer_id", "customer_name").join(sums, "customer_id", "left")
        .select("customer_id", "customer_name",
                F.coalesce("n", F.lit(0)).cast("bigint").alias("confirmed_order_count"),
                _money(F.coalesce("spend", F.lit(0))).alias("lifetime_spend"))
    )
    first = spend.orderBy(F.col("lifetime_spend").desc(), "customer_id").limit(top)
    rank = F.dense_rank().over(Window.orderBy(F.col("lifetime_spend").desc()))
    return first.withColumn("spending_rank", rank.cast("bigint")).orderBy("spending_rank", "customer_id")


def quality_class() -> Column:
    """First matching class of an order with flags ``has_customer``, ``has_product`` and its latest payment."""
    status = F.col("payment_status")
    return (
        F.when(F.col("quantity") <= 0, "INVALID_QUANTITY")
        .when(~F.col("has_customer"), "MISSING_CUSTOMER_REFERENCE")
        .when(~F.col("has_product"), "MISSING_PRODUCT_REFERENCE")
        .when(F.col("payment_id").isNull(), "NO_PAYMENT")
        .when(status == "failed", "FAILED_PAYMENT")
        .when(status == "pending", "PENDING_PAYMENT")
        .when(status == "refunded", "REFUNDED_PAYMENT")
        .when(F.col("payment_amount") != expected_amount(), "PAYMENT_AMOUNT_MISMATCH")
        .when(F.col("order_status") != "completed", "ORDER_NOT_COMPLETED")
        .otherwise("CONFIRMED_REVENUE")
    )


def classified_orders(t: Tables) -> DataFrame:
    """``(order_id, quality_result)`` of every order."""
    orders = t["orders"].select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "order_status"
    )
    narrow = _with_latest({**t, "orders": orders})
    return _with_references(narrow, t).select("order_id", quality_class().alias("quality_result"))


def order_quality_classes(t: Tables) -> DataFrame:
    return (
        classified_orders(t).groupBy("quality_result").agg(_rows().alias("order_count"))
        .orderBy("quality_result")
    )


def payment_outcomes(t: Tables) -> DataFrame:
    """Latest status or ``no_payment``; the amount covers successful payments only."""
    paid = F.when(F.col("payment_status") == "successful", F.col("payment_amount")).otherwise(0)
    return (
        _with_latest(t)
        .groupBy(F.coalesce("payment_status", F.lit("no_payment")).alias("payment_outcome"))
        .agg(_rows().alias("order_count"), _money(F.sum(paid)).alias("recorded_amount"))
        .filter(F.col("order_count") > 0)
        .orderBy(F.col("order_count").desc(), "payment_outcome")
    )


def quality_rejects(t: Tables) -> DataFrame:
    """Orders that break a data rule, with the reason in words."""
    orders = t["orders"].select("order_id", "customer_id", "product_id", "quantity", "unit_price")
    wrong = (F.col("payment_status") == "successful") & (F.col("payment_amount") != expected_amount())
    reason = (
        F.when(F.col("quantity") <= 0, "quantity must be greater than zero")
        .when(~F.col("has_customer"), "customer reference is missing")
        .when(~F.col("has_product"), "product reference is missing")
        .when(wrong, "successful payment amount does not match order amount")
    )
    return (
        _with_references(_with_latest({**t, "orders": orders}), t)
        .withColumn("rejection_reason", reason)
        .filter(F.col("rejection_reason").isNotNull())
        .select("order_id", "customer_id", "product_id", "quantity", "unit_price", "payment_id",
                "payment_amount", "rejection_reason")
        .orderBy("order_id")
    )


def is_late() -> Column:
    """Paid eight days or more after the order."""
    return F.col("payment_time") >= F.col("created_at") + F.expr("INTERVAL '8' DAY")


def reconciliation_outcomes(t: Tables) -> DataFrame:
    status = F.col("payment_status")
    note = (
        F.when(F.col("payment_id").isNull(), "payment has not arrived")
        .when(status == "failed", "failed payment; does not count as revenue")
        .when(status == "pending", "payment is still pending")
        .when(status == "refunded", "payment was refunded")
        .when((status == "successful") & is_late(), "late successful payment")
    )
    orders = t["orders"].select("order_id", "created_at")
    return (
        _with_latest({**t, "orders": orders})
        .withColumn("reconciliation_note", note)
        .filter(F.col("reconciliation_note").isNotNull())
        .groupBy("reconciliation_note")
        .agg(_rows().alias("order_count"),
             _money(F.coalesce(F.sum("payment_amount"), F.lit(0))).alias("recorded_amount"))
        .orderBy("reconciliation_note")
    )


def duplicate_keys(t: Tables) -> DataFrame:
    return (
        t["orders"].groupBy("order_id").agg(_rows().alias("duplicate_count"))
        .filter(F.col("duplicate_count") > 1)
    )


def scenario_counts(t: Tables) -> DataFrame:
    """Seven controlled scenarios in one pass over orders and latest payments.

    Failed payments are counted on the payment side, so that those without an order count too.
    """
    latest = _latest(t)
    orders = t["orders"].select("order_id", "customer_id", "product_id", "quantity", "unit_price", "created_at")
    status = F.col("payment_status")
    present = F.col("customer_id").isNotNull() & F.col("product_id").isNotNull()
    counts = {
        "invalid_quantity": F.col("quantity") <= 0,
        "missing_customer_reference": F.col("_order") & F.col("customer_id").isNull(),
        "missing_product_reference": F.col("_order") & F.col("product_id").isNull(),
        "payment_amount_mismatch": (F.col("quantity") > 0) & present & (status == "successful")
        & (F.col("payment_amount") != expected_amount()),
        "failed_payment": status == "failed",
        "late_arriving_payment": (status == "successful") & is_late(),
        "missing_payment": F.col("_order") & F.col("payment_id").isNull(),
    }
    joined = orders.withColumn("_order", F.lit(True)).join(latest, "order_id", "full")
    totals = joined.agg(*[F.count_if(c).alias(name) for name, c in counts.items()])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("scenario_type"), F.col(name).alias("scenario_count")) for name in counts
    ]))).orderBy("scenario_type")


def dangling_references(t: Tables) -> DataFrame:
    """Non-null references without a parent, counted per distinct value before the join."""
    def missing(parent: str, key: str) -> DataFrame:
        used = t["orders"].filter(F.col(key).isNotNull()).groupBy(key).agg(_rows().alias("n"))
        return used.join(_keys(t, parent, key), key, "left_anti").agg(F.sum("n").alias(key))

    both = missing("customers", "customer_id").unionByName(
        missing("products", "product_id"), allowMissingColumns=True
    )
    return both.agg(
        F.coalesce(F.sum("customer_id"), F.lit(0)).cast("bigint").alias("invalid_non_null_customer_references"),
        F.coalesce(F.sum("product_id"), F.lit(0)).cast("bigint").alias("invalid_non_null_product_references"),
    )


def revenue_month_stats(t: Tables) -> DataFrame:
    return _monthly_revenue(t).agg(
        _rows().alias("revenue_month_count"), F.min("revenue_month").alias("first_revenue_month"),
        F.max("revenue_month").alias("last_revenue_month"),
        _money(F.sum("confirmed_revenue")).alias("revenue_across_months"),
    )


def top5_products_all_payments(t: Tables, top: int = 5) -> DataFrame:
    """Best products over all matching successful payments, repeated attempts included (no customer test).

    Payments are first counted per order and amount, so an order with very many attempts reaches
    the join as few rows.
    """
    attempts = (
        t["payments"].filter(F.col("payment_status") == "successful")
        .groupBy("order_id", "payment_amount").agg(_rows().alias("n"))
    )
    kept = t["orders"].filter((F.col("quantity") > 0) & (F.col("order_status") == "completed")).select(
        "order_id", "product_id", "quantity", "unit_price"
    )
    sums = (
        kept.join(attempts, "order_id")
        .filter(F.col("payment_amount") == expected_amount())
        .groupBy("product_id")
        .agg(F.sum(F.col("payment_amount") * F.col("n")).alias("revenue"))
    )
    return (
        sums.join(t["products"].select("product_id", "product_name", "category"), "product_id")
        .groupBy("category", "product_name")
        .agg(_money(F.sum("revenue")).alias("confirmed_revenue"))
        .orderBy(F.col("confirmed_revenue").desc(), "product_name", "category")
        .limit(top)
    )


def payment_outcomes_all_attempts(t: Tables) -> DataFrame:
    """Status counts over every payment attempt of every order; orders without one count once.

    At most one row per order and status reaches the join.
    """
    attempts = t["payments"].groupBy("order_id", "payment_status").agg(_rows().alias("n"))
    return (
        t["orders"].select("order_id").join(attempts, "order_id", "left")
        .groupBy(F.coalesce("payment_status", F.lit("no_payment")).alias("payment_outcome"))
        .agg(F.sum(F.coalesce("n", F.lit(1))).cast("bigint").alias("order_count"))
        .orderBy(F.col("order_count").desc(), "payment_outcome")
    )


REPORTS = {
    f.__name__: f
    for f in (
        kpi_summary, daily_revenue, product_performance, customer_performance, order_status_distribution,
        payment_status_distribution, outstanding_orders, table_counts, confirmed_totals,
        monthly_revenue_mom, top_products_by_category, customer_lifetime_spend, order_quality_classes,
        payment_outcomes, quality_rejects, reconciliation_outcomes, duplicate_keys, scenario_counts,
        dangling_references, revenue_month_stats, top5_products_all_payments,
        payment_outcomes_all_attempts,
    )
}

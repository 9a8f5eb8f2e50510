"""Row checks of the text layer (one narrow pass per table) and the audit of declared constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger.functions import rules as R
from ledger.schemas import (
    FIELDS,
    KEYS,
    MAX_LENGTHS,
    NULLABLE,
    ORDER_STATUSES,
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
    REFERENCES,
    UNIQUE,
)

# Which parser each field of a table goes through, in field order.
PARSERS = {
    "customers": {
        "customer_id": "int", "customer_name": "text", "email": "text", "city": "text",
        "state": "text", "created_at": "ts", "updated_at": "ts",
    },
    "products": {
        "product_id": "int", "product_name": "text", "category": "text", "brand": "text",
        "unit_price": "decimal", "created_at": "ts", "updated_at": "ts",
    },
    "orders": {
        "order_id": "int", "customer_id": "optional_int", "product_id": "optional_int",
        "quantity": "int", "unit_price": "decimal", "order_status": "text",
        "created_at": "ts", "updated_at": "ts",
    },
    "payments": {
        "payment_id": "int", "order_id": "int", "payment_amount": "decimal",
        "payment_method": "text", "payment_status": "text", "payment_time": "ts",
        "updated_at": "ts",
    },
}


VALUES = {"int": R.int_value, "optional_int": R.int_value, "decimal": R.decimal_value, "ts": R.ts_value}
WORDS = {"int": "INTEGER", "optional_int": "INTEGER", "decimal": "DECIMAL", "ts": "TIMESTAMP"}


def _parse_reason(table: str, field: str) -> Column:
    """Reason of one field from its stripped text ``s_`` and typed value ``t_``."""
    kind = PARSERS[table][field]
    text, typed = F.col(f"s_{field}"), F.col(f"t_{field}")
    if kind == "text":
        return F.when(text.isNull(), F.lit(f"MISSING_REQUIRED_{field.upper()}"))
    if kind == "decimal":
        typed = F.coalesce(typed.cast("string"), F.col(f"w_{field}"))
    return R.parse_reason(field, WORDS[kind], text, typed, required=kind != "optional_int")


def _value_checks(table: str, typed: dict[str, Column]) -> list[tuple[str, str, Column]]:
    """``(rule, field, reason)`` of the checks on typed values, in reporting order."""
    c = typed
    if table == "customers":
        return [
            ("positive_id", "customer_id", R.positive(c["customer_id"], "INVALID_CUSTOMER_ID")),
            ("timestamp_order", "updated_at",
             R.ordered(c["created_at"], c["updated_at"], "UPDATED_AT_BEFORE_CREATED_AT")),
        ]
    if table == "products":
        return [
            ("positive_id", "product_id", R.positive(c["product_id"], "INVALID_PRODUCT_ID")),
            ("positive_amount", "unit_price", R.positive_amount(c["unit_price"], F.col("w_unit_price"), "NON_POSITIVE_UNIT_PRICE")),
            ("timestamp_order", "updated_at",
             R.ordered(c["created_at"], c["updated_at"], "UPDATED_AT_BEFORE_CREATED_AT")),
        ]
    if table == "orders":
        return [
            ("positive_id", "order_id", R.positive(c["order_id"], "INVALID_ORDER_ID")),
            ("missing_reference", "customer_id",
             R.missing_ref(c["customer_id"], "MISSING_CUSTOMER_REFERENCE")),
            ("missing_reference", "product_id",
             R.missing_ref(c["product_id"], "MISSING_PRODUCT_REFERENCE")),
            ("positive_quantity", "quantity", R.positive(c["quantity"], "INVALID_QUANTITY")),
            ("positive_amount", "unit_price", R.positive_amount(c["unit_price"], F.col("w_unit_price"), "NON_POSITIVE_UNIT_PRICE")),
            ("allowed_values", "order_status",
             R.allowed(c["order_status"], ORDER_STATUSES, "INVALID_ORDER_STATUS")),
            ("timestamp_order", "updated_at",
             R.ordered(c["created_at"], c["updated_at"], "UPDATED_AT_BEFORE_CREATED_AT")),
        ]
    return [
        ("positive_id", "payment_id", R.positive(c["payment_id"], "INVALID_PAYMENT_ID")),
        ("positive_id", "order_id", R.positive(c["order_id"], "INVALID_ORDER_REFERENCE")),
        ("positive_amount", "payment_amount",
         R.positive_amount(c["payment_amount"], F.col("w_payment_amount"), "NON_POSITIVE_PAYMENT_AMOUNT")),
        ("allowed_values", "payment_method",
         R.allowed(c["payment_method"], PAYMENT_METHODS, "INVALID_PAYMENT_METHOD")),
        ("allowed_values", "payment_status",
         R.allowed(c["payment_status"], PAYMENT_STATUSES, "INVALID_PAYMENT_STATUS")),
        ("timestamp_order", "updated_at",
         R.ordered(c["payment_time"], c["updated_at"], "UPDATED_AT_BEFORE_PAYMENT_TIME")),
    ]


def _typed(table: str) -> dict[str, Column]:
    """Columns ``t_<field>`` that :func:`_with_types` adds."""
    return {field: F.col(f"t_{field}") for field in PARSERS[table]}


def _with_types(df: DataFrame, table: str) -> DataFrame:
    """Add ``s_<field>`` (stripped text) and ``t_<field>`` (typed value) for every field, ``w_<field>`` for decimals beyond their type.

    Stripping, typing and checking are separate projections, so that each text is stripped and
    parsed once however many checks refer to it.
    """
    typed = {
        f"t_{field}": VALUES[kind](F.col(f"s_{field}")) if kind in VALUES else F.col(f"s_{field}")
        for field, kind in PARSERS[table].items()
    }
    wide = {
        f"w_{field}": R.wide_decimal(F.col(f"s_{field}"), F.col(f"t_{field}")) for field, kind in PARSERS[table].items() if kind == "decimal"
    }
    return df.withColumns({f"s_{f}": R.stripped(f) for f in PARSERS[table]}).withColumns(typed).withColumns(wide)


def _validate(df: DataFrame, table: str) -> DataFrame:
    """Raw columns, ``t_*`` typed columns, ``w_*`` normal forms of wide decimals, and ordered ``reasons``."""
    parse = [_parse_reason(table, field) for field in PARSERS[table]]
    checks = [reason for _, _, reason in _value_checks(table, _typed(table))]
    return (
        _with_types(df, table)
        .withColumn("reasons", R.reasons(*parse, *checks))
        .drop(*[f"s_{field}" for field in PARSERS[table]])
    )


def validate_customers(df: DataFrame) -> DataFrame:
    return _validate(df, "customers")


def validate_products(df: DataFrame) -> DataFrame:
    return _validate(df, "products")


def validate_orders(df: DataFrame) -> DataFrame:
    return _validate(df, "orders")


def validate_payments(df: DataFrame) -> DataFrame:
    return _validate(df, "payments")


VALIDATORS = {
    "customers": validate_customers,
    "products": validate_products,
    "orders": validate_orders,
    "payments": validate_payments,
}


# --- one rule over all tables ---------------------------------------------------------------


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _broken(text_tables: dict[str, DataFrame], found_of) -> DataFrame:
    """Rows ``(table_name, row_key, field, reason)``; ``found_of(table)`` lists (field, reason)."""
    parts = []
    for table, df in text_tables.items():
        found = found_of(table)
        if not found:
            continue
        entries = F.array(*[
            F.struct(F.lit(field).alias("field"), reason.alias("reason")) for field, reason in found
        ])
        parts.append(
            _with_types(df, table)
            .select(F.lit(table).alias("table_name"), F.col(KEYS[table]).alias("row_key"),
                    F.inline(entries))
            .filter(F.col("reason").isNotNull())
        )
    return _union(parts)


def _broken_parse(text_tables: dict[str, DataFrame], kind: str) -> DataFrame:
    return _broken(text_tables, lambda table: [
        (field, _parse_reason(table, field)) for field, k in PARSERS[table].items() if k == kind
    ])


def _broken_check(text_tables: dict[str, DataFrame], rule: str) -> DataFrame:
    return _broken(text_tables, lambda table: [
        (field, reason) for r, field, reason in _value_checks(table, _typed(table)) if r == rule
    ])


def rule_required_text(text_tables):
    return _broken_parse(text_tables, "text")


def rule_parse_int(text_tables):
    return _broken_parse(text_tables, "int")


def rule_parse_optional_int(text_tables):
    return _broken_parse(text_tables, "optional_int")


def rule_parse_decimal(text_tables):
    return _broken_parse(text_tables, "decimal")


def rule_parse_timestamp(text_tables):
    return _broken_parse(text_tables, "ts")


def rule_positive_id(text_tables):
    return _broken_check(text_tables, "positive_id")


def rule_positive_amount(text_tables):
    return _broken_check(text_tables, "positive_amount")


def rule_positive_quantity(text_tables):
    return _broken_check(text_tables, "positive_quantity")


def rule_allowed_values(text_tables):
    return _broken_check(text_tables, "allowed_values")


def rule_timestamp_order(text_tables):
    return _broken_check(text_tables, "timestamp_order")


def rule_missing_reference(text_tables):
    return _broken_check(text_tables, "missing_reference")


def reason_accumulator(text_tables):
    """Every row with at least one reason: its reasons in order, without repeats.

    Rows without a reason go by exploding nothing: a filter would be pushed below the reasons and work
    them out a second time.
    """
    return _union([
        VALIDATORS[table](df)
        .select(KEYS[table], F.explode(F.when(F.size("reasons") > 0, F.array("reasons"))).alias("reasons"))
        .select(F.lit(table).alias("table_name"), F.col(KEYS[table]).alias("row_key"),
                F.size("reasons").cast("bigint").alias("reason_count"),
                F.array_join("reasons", ";").alias("rejection_reason"))
        for table, df in text_tables.items()
    ])


# --- declared constraints -------------------------------------------------------------------


def _row_constraints(table: str) -> list[tuple[str, Column]]:
    """``(name, broken)`` of the constraints that one row can break."""
    found = []
    for field, _ in FIELDS[table]:
        if field not in NULLABLE.get(table, set()):
            found.append((f"{table}_{field}_not_null", F.col(field).isNull()))
    for field, limit in MAX_LENGTHS[table].items():
        found.append((f"{table}_{field}_max_length", F.length(field) > limit))
    if table == "payments":
        found += [
            ("payments_positive_amount", F.col("payment_amount") <= 0),
            ("payments_method_allowed", ~F.col("payment_method").isin(PAYMENT_METHODS)),
            ("payments_status_allowed", ~F.col("payment_status").isin(PAYMENT_STATUSES)),
            ("payments_updated_after_payment", F.col("updated_at") < F.col("payment_time")),
        ]
    else:
        found.append((f"{table}_updated_after_created", F.col("updated_at") < F.col("created_at")))
    if table in ("products", "orders"):
        found.append((f"{table}_positive_price", F.col("unit_price") <= 0))
    if table == "orders":
        found.append(("orders_status_allowed", ~F.col("order_status").isin(ORDER_STATUSES)))
    return found


def audit_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """``(constraint, violations)`` for every declared rule.

    Row rules of a table share one pass.  Uniqueness counts the rows beyond the first per value;
    references are counted per distinct value before the anti join, so a value that fills a large
    share of the rows reaches the join as a single row.
    """
    parts = []
    for table, df in tables.items():
        found = _row_constraints(table)
        counted = df.agg(*[F.count_if(broken).alias(name) for name, broken in found])
        parts.append(counted.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("constraint"), F.col(name).alias("violations"))
            for name, _ in found
        ]))))
        for field in [KEYS[table], *UNIQUE.get(table, [])]:
            repeats = df.filter(F.col(field).isNotNull()).groupBy(field).agg(F.count(F.lit(1)).alias("n"))
            parts.append(repeats.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
                         .select(F.lit(f"{table}_{field}_unique").alias("constraint"), "violations"))
        for field, parent in REFERENCES.get(table, []):
            used = df.filter(F.col(field).isNotNull()).groupBy(field).agg(F.count(F.lit(1)).alias("n"))
            keys = tables[parent].select(F.col(KEYS[parent]).alias(field))
            parts.append(used.join(keys, field, "left_anti")
                         .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
                         .select(F.lit(f"{table}_{field}_exists").alias("constraint"), "violations"))
    return _union(parts).select("constraint", F.col("violations").cast("bigint").alias("violations"))

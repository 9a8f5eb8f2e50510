"""DuckDB SQL for the registered queries, over the same given tables."""

from __future__ import annotations

from checks.adapter import MARK, ctes
from ledger.schemas import (
    KEYS,
    MAX_LENGTHS,
    NULLABLE,
    ORDER_STATUSES,
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
    TABLES,
    columns,
    timestamps,
)

MODEL = {"customers": "raw_customers", "products": "raw_products", "orders": "cur_orders", "payments": "cur_payments"}

LP = """lp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY payment_time DESC, payment_id DESC) AS rn
  FROM cur_payments) q WHERE rn = 1)"""


def query(body: str, *views: str, extra: list[str] = ()) -> str:
    parts = [*ctes(*views), *extra]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def report(body: str) -> str:
    return query(body, *MODEL.values(), extra=[LP, FACTS.format(orders='cur_orders', latest='lp')])


def row_text(table: str) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns(table))


def rows_of(views: dict[str, str], where: dict[str, str] | None = None) -> str:
    """``(table_name, row_key, row_text)`` of several tables."""
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({KEYS[t]} AS VARCHAR) AS row_key, {row_text(t)} AS row_text FROM {v}"
        + (f" WHERE {where[t]}" if where and t in where else "")
        for t, v in views.items()
    )


#: One row per order: its newest payment attempt and what holds for the two.
FACTS = """facts AS (
  SELECT f.*, quantity > 0 AS positive, has_customer AND has_product AS linked, outcome = 'successful' AS paid_up,
    coalesce(paid = due, false) AS exact, paid IS NOT NULL AND paid <> due AS off, coalesce(paid_at >= created_at + INTERVAL 8 DAY, false) AS late,
    quantity > 0 AND order_status = 'completed' AND outcome = 'successful' AND coalesce(paid = due, false) AS confirmed
  FROM (
    SELECT w.order_id, w.customer_id, w.product_id, w.quantity, w.unit_price, w.order_status, w.created_at, w.quantity * w.unit_price AS due,
      n.payment_id, n.payment_amount AS paid, n.payment_time AS paid_at, coalesce(n.payment_status, 'no_payment') AS outcome,
      coalesce(w.customer_id IN (SELECT customer_id FROM raw_customers), false) AS has_customer,
      coalesce(w.product_id IN (SELECT product_id FROM raw_products), false) AS has_product
    FROM {orders} w LEFT JOIN {latest} n USING (order_id)) f)"""
#: Labels of the reports and what they stand for; an order gets the first that holds.
CLASSES = {
    "INVALID_QUANTITY": "NOT positive", "MISSING_CUSTOMER_REFERENCE": "NOT has_customer", "MISSING_PRODUCT_REFERENCE": "NOT has_product",
    "NO_PAYMENT": "payment_id IS NULL", "FAILED_PAYMENT": "outcome = 'failed'", "PENDING_PAYMENT": "outcome = 'pending'",
    "REFUNDED_PAYMENT": "outcome = 'refunded'", "PAYMENT_AMOUNT_MISMATCH": "off", "ORDER_NOT_COMPLETED": "order_status <> 'completed'",
    "CONFIRMED_REVENUE": "true",
}
REJECTS = {
    "quantity must be greater than zero": "NOT positive", "customer reference is missing": "NOT has_customer",
    "product reference is missing": "NOT has_product", "successful payment amount does not match order amount": "paid_up AND off",
}
NOTES = {
    "payment has not arrived": "payment_id IS NULL", "failed payment; does not count as revenue": "outcome = 'failed'",
    "payment is still pending": "outcome = 'pending'", "payment was refunded": "outcome = 'refunded'", "late successful payment": "paid_up AND late",
}
SCENARIOS = {
    "invalid_quantity": "NOT positive", "missing_customer_reference": "customer_id IS NULL", "missing_product_reference": "product_id IS NULL",
    "payment_amount_mismatch": "positive AND customer_id IS NOT NULL AND product_id IS NOT NULL AND paid_up AND off",
    "late_arriving_payment": "paid_up AND late", "missing_payment": "payment_id IS NULL",
}


def first_of(labels: dict[str, str]) -> str:
    """The first label that holds, null if none does."""
    return "coalesce(" + ", ".join(f"if({test}, '{label}', NULL)" for label, test in labels.items()) + ")"


D = "DECIMAL(18,2)"


def reports() -> dict[str, str]:
    money = f"CAST(sum(paid) AS {D})"
    monthly = f"""(SELECT CAST(date_trunc('month', created_at) AS DATE) AS revenue_month, {money} AS confirmed_revenue
      FROM facts WHERE confirmed AND linked GROUP BY ALL)"""
    sold = f"""(SELECT product_id, count(*) AS confirmed_orders, CAST(sum(quantity) AS BIGINT) AS units_sold, {money} AS confirmed_revenue
      FROM facts WHERE confirmed GROUP BY ALL)"""
    q = {}
    q["kpi_summary"] = f"""SELECT *, CAST(round(total_confirmed_revenue / nullif(confirmed_orders, 0), 2) AS {D}) AS average_confirmed_order_value
      FROM (SELECT count(*) AS total_orders, count(*) FILTER (confirmed AND linked AND paid > 0) AS confirmed_orders,
        CAST(coalesce(sum(paid) FILTER (confirmed AND linked), 0) AS {D}) AS total_confirmed_revenue FROM facts) k"""
    q["daily_revenue"] = f"""SELECT CAST(created_at AS DATE) AS order_date, count(*) AS confirmed_orders, {money} AS confirmed_revenue
      FROM facts WHERE confirmed AND linked GROUP BY ALL"""
    q["product_performance"] = f"""SELECT category, product_id, product_name, confirmed_orders, units_sold, confirmed_revenue,
      dense_rank() OVER (PARTITION BY category ORDER BY confirmed_revenue DESC) AS category_revenue_rank FROM {sold} s JOIN raw_products USING (product_id)"""
    q["customer_performance"] = f"""SELECT customer_id, customer_name, city, state, s.n AS confirmed_orders, s.confirmed_revenue,
      dense_rank() OVER (ORDER BY s.confirmed_revenue DESC) AS customer_revenue_rank
      FROM (SELECT customer_id, count(*) AS n, {money} AS confirmed_revenue FROM facts WHERE confirmed AND has_product GROUP BY ALL) s
      JOIN raw_customers USING (customer_id)"""
    q["order_status_distribution"] = f"""SELECT order_status, count(*) AS order_count, CAST(sum(due) FILTER (positive) AS {D}) AS nominal_order_value
      FROM facts GROUP BY ALL"""
    q["payment_status_distribution"] = f"""SELECT outcome AS payment_status, count(*) AS order_count, CAST(coalesce(sum(paid), 0) AS {D}) AS recorded_amount
      FROM facts GROUP BY ALL"""
    q["outstanding_orders"] = f"""SELECT order_id, order_status, CAST(due AS {D}) AS expected_amount, outcome AS latest_payment_status,
      CAST(paid AS {D}) AS latest_payment_amount, created_at FROM facts
      WHERE outcome IN ('no_payment', 'failed', 'pending') AND order_status NOT IN ('cancelled', 'returned')"""
    q["table_counts"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {v}" for t, v in MODEL.items())
    q["confirmed_totals"] = f"SELECT count(*) AS confirmed_order_count, {money} AS confirmed_revenue FROM facts WHERE confirmed AND linked"
    q["monthly_revenue_mom"] = f"""SELECT *, CAST(round(CAST(100 * (confirmed_revenue - previous_month_revenue) AS DOUBLE) / nullif(previous_month_revenue, 0), 2) AS {D})
        AS month_over_month_percent
      FROM (SELECT *, lag(confirmed_revenue) OVER (ORDER BY revenue_month) AS previous_month_revenue FROM {monthly} m) x"""
    q["top_products_by_category"] = f"""SELECT category, product_name, confirmed_revenue, rank() OVER best AS revenue_rank
      FROM {sold} s JOIN raw_products USING (product_id) WINDOW best AS (PARTITION BY category ORDER BY confirmed_revenue DESC) QUALIFY rank() OVER best <= 3"""
    q["customer_lifetime_spend"] = f"""SELECT *, dense_rank() OVER (ORDER BY lifetime_spend DESC) AS spending_rank FROM (
      SELECT customer_id, customer_name, count(*) FILTER (confirmed) AS confirmed_order_count,
        CAST(coalesce(sum(paid) FILTER (confirmed), 0) AS {D}) AS lifetime_spend
      FROM raw_customers LEFT JOIN facts USING (customer_id) GROUP BY ALL) x ORDER BY spending_rank, customer_id LIMIT 20"""
    q["order_quality_classes"] = f"SELECT {first_of(CLASSES)} AS quality_result, count(*) AS order_count FROM facts GROUP BY ALL"
    q["payment_outcomes"] = f"""SELECT outcome AS payment_outcome, count(*) AS order_count,
      CAST(coalesce(sum(paid) FILTER (paid_up), 0) AS {D}) AS recorded_amount FROM facts GROUP BY ALL"""
    q["quality_rejects"] = f"""SELECT order_id, customer_id, product_id, quantity, unit_price, payment_id, paid AS payment_amount,
      {first_of(REJECTS)} AS rejection_reason FROM facts WHERE {first_of(REJECTS)} IS NOT NULL"""
    q["reconciliation_outcomes"] = f"""SELECT {first_of(NOTES)} AS reconciliation_note, count(*) AS order_count,
      CAST(coalesce(sum(paid), 0) AS {D}) AS recorded_amount FROM facts WHERE {first_of(NOTES)} IS NOT NULL GROUP BY ALL"""
    counts = ", ".join(f"{{'name': '{name}', 'n': count(*) FILTER ({test})}}" for name, test in SCENARIOS.items())
    q["scenario_counts"] = f"""SELECT s.name AS scenario_type, s.n AS scenario_count FROM (SELECT unnest([{counts}]) AS s FROM facts) u
      UNION ALL SELECT 'failed_payment', count(*) FROM lp WHERE payment_status = 'failed'"""
    q["dangling_references"] = """SELECT count(*) FILTER (customer_id IS NOT NULL AND NOT has_customer) AS invalid_non_null_customer_references,
      count(*) FILTER (product_id IS NOT NULL AND NOT has_product) AS invalid_non_null_product_references FROM facts"""
    q["revenue_month_stats"] = f"""SELECT count(*) AS revenue_month_count, min(revenue_month) AS first_revenue_month, max(revenue_month) AS last_revenue_month,
      CAST(sum(confirmed_revenue) AS {D}) AS revenue_across_months FROM {monthly} m"""
    q["top5_products_all_payments"] = f"""SELECT category, product_name, CAST(sum(a.payment_amount) AS {D}) AS confirmed_revenue
      FROM facts JOIN cur_payments a USING (order_id) JOIN raw_products USING (product_id)
      WHERE positive AND order_status = 'completed' AND a.payment_status = 'successful' AND a.payment_amount = due
      GROUP BY ALL ORDER BY 3 DESC, 2, 1 LIMIT 5"""
    q["payment_outcomes_all_attempts"] = """SELECT coalesce(a.payment_status, 'no_payment') AS payment_outcome, count(*) AS order_count
      FROM facts LEFT JOIN cur_payments a USING (order_id) GROUP BY ALL"""
    found = {name: report(sql) for name, sql in q.items()}
    # Versions still in place, so that there is something to find.
    found["duplicate_keys"] = query(
        "SELECT order_id, count(*) AS duplicate_count FROM raw_orders GROUP BY 1 HAVING count(*) > 1", "raw_orders")
    return found


# --- text rules --------------------------------------------------------------------------------

INT = r"^[+-]?[0-9]+(_[0-9]+)*$"
DEC = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
TS = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"

SHAPES = {
    r"^[0-9]{8}$": "strptime({s}, '%Y%m%d')", r"^[0-9]{8}T[0-9]{6}$": "strptime({s}, '%Y%m%dT%H%M%S')", r"^[0-9]{4}-W[0-9]{2}-[1-7]$": "strptime({s}, '%G-W%V-%u')",
    r"^[0-9-]{10}T[0-9:]{8}[+]00$": "TRY_CAST(replace({s}, '+00', '') AS TIMESTAMP)",
    r"^[0-9-]{10}x[0-9:]{5}[+]0530$": "TRY_CAST(replace(replace({s}, 'x', ' '), '+0530', ':00') AS TIMESTAMP) - INTERVAL '330' MINUTE",
}

KINDS = {
    "customers": {"customer_id": "int", "customer_name": "text", "email": "text", "city": "text", "state": "text",
                  "created_at": "ts", "updated_at": "ts"},
    "products": {"product_id": "int", "product_name": "text", "category": "text", "brand": "text", "unit_price": "dec",
                 "created_at": "ts", "updated_at": "ts"},
    "orders": {"order_id": "int", "customer_id": "opt", "product_id": "opt", "quantity": "int", "unit_price": "dec",
               "order_status": "text", "created_at": "ts", "updated_at": "ts"},
    "payments": {"payment_id": "int", "order_id": "int", "payment_amount": "dec", "payment_method": "text",
                 "payment_status": "text", "payment_time": "ts", "updated_at": "ts"},
}


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# (rule, field, condition, reason) in reporting order.
VALUE_RULES = {
    "customers": [
        ("rule_positive_id", "customer_id", "t_customer_id <= 0", "INVALID_CUSTOMER_ID"),
        ("rule_timestamp_order", "updated_at", "t_updated_at < t_created_at", "UPDATED_AT_BEFORE_CREATED_AT"),
    ],
    "products": [
        ("rule_positive_id", "product_id", "t_product_id <= 0", "INVALID_PRODUCT_ID"),
        ("rule_positive_amount", "unit_price", "t_unit_price <= 0", "NON_POSITIVE_UNIT_PRICE"),
        ("rule_timestamp_order", "updated_at", "t_updated_at < t_created_at", "UPDATED_AT_BEFORE_CREATED_AT"),
    ],
    "orders": [
        ("rule_positive_id", "order_id", "t_order_id <= 0", "INVALID_ORDER_ID"),
        ("rule_missing_reference", "customer_id", "t_customer_id IS NULL", "MISSING_CUSTOMER_REFERENCE"),
        ("rule_missing_reference", "product_id", "t_product_id IS NULL", "MISSING_PRODUCT_REFERENCE"),
        ("rule_positive_quantity", "quantity", "t_quantity <= 0", "INVALID_QUANTITY"),
        ("rule_positive_amount", "unit_price", "t_unit_price <= 0", "NON_POSITIVE_UNIT_PRICE"),
        ("rule_allowed_values", "order_status", f"t_order_status NOT IN {_in(ORDER_STATUSES)}", "INVALID_ORDER_STATUS"),
        ("rule_timestamp_order", "updated_at", "t_updated_at < t_created_at", "UPDATED_AT_BEFORE_CREATED_AT"),
    ],
    "payments": [
        ("rule_positive_id", "payment_id", "t_payment_id <= 0", "INVALID_PAYMENT_ID"),
        ("rule_positive_id", "order_id", "t_order_id <= 0", "INVALID_ORDER_REFERENCE"),
        ("rule_positive_amount", "payment_amount", "t_payment_amount <= 0", "NON_POSITIVE_PAYMENT_AMOUNT"),
        ("rule_allowed_values", "payment_method", f"t_payment_method NOT IN {_in(PAYMENT_METHODS)}", "INVALID_PAYMENT_METHOD"),
        ("rule_allowed_values", "payment_status", f"t_payment_status NOT IN {_in(PAYMENT_STATUSES)}", "INVALID_PAYMENT_STATUS"),
        ("rule_timestamp_order", "updated_at", "t_updated_at < t_payment_time", "UPDATED_AT_BEFORE_PAYMENT_TIME"),
    ],
}


def _typed(field: str, kind: str) -> str:
    s = f"s_{field}"
    if kind in ("int", "opt"):
        return f"CASE WHEN regexp_matches({s}, '{INT}') THEN TRY_CAST(replace({s}, '_', '') AS BIGINT) END"
    if kind == "dec":
        return f"CASE WHEN regexp_matches({s}, '{DEC}') AND TRY_CAST({s} AS DECIMAL(18,6)) = TRY_CAST({s} AS DECIMAL(38,18)) THEN TRY_CAST({s} AS DECIMAL(18,6)) END"
    if kind == "ts":
        # The planted shapes that the engine does not read itself.
        other = " ".join(f"WHEN regexp_matches({s}, '{shape}') THEN {value.format(s=s)}" for shape, value in SHAPES.items())
        return f"CASE WHEN regexp_matches({s}, '{TS}') THEN TRY_CAST({s} AS TIMESTAMP) {other} END"
    return s


def _parse_reason(field: str, kind: str) -> str:
    word = {"int": "INTEGER", "opt": "INTEGER", "dec": "DECIMAL", "ts": "TIMESTAMP"}.get(kind)
    missing = "" if kind == "opt" else f"WHEN s_{field} IS NULL THEN 'MISSING_REQUIRED_{field.upper()}' "
    wide = f" AND NOT regexp_matches(s_{field}, '{DEC}')" if kind == "dec" else ""
    bad = f"WHEN s_{field} IS NOT NULL AND t_{field} IS NULL{wide} THEN 'INVALID_{word}_{field.upper()}' " if word else ""
    return f"CASE {missing}{bad}END"


def typed_cte(table: str) -> list[str]:
    kinds = KINDS[table]
    strip = ", ".join(rf"nullif(regexp_replace({f}, '^\s+|\s+$', '', 'g'), '') AS s_{f}" for f in kinds)
    types = ", ".join(f"{_typed(f, k)} AS t_{f}" + f", TRY_CAST(s_{f} AS DOUBLE) AS d_{f}" * (k == "dec") for f, k in kinds.items())
    reasons = [_parse_reason(f, k) for f, k in kinds.items()]
    reasons += [f"CASE WHEN {c} THEN '{r}' END" for _, _, c, r in VALUE_RULES[table]]
    return [
        f"p_{table} AS (SELECT *, {types} FROM (SELECT *, {strip} FROM text_{table}) s)",
        f"v_{table} AS (SELECT *, concat_ws(';', {', '.join(reasons)}) AS r0 FROM p_{table})",
    ]


def text_query(body: str, extra: list[str] = ()) -> str:
    views = [f"text_{t}" for t in TABLES]
    return query(body, *views, extra=[*[c for t in TABLES for c in typed_cte(t)], *extra])


def text_rules() -> dict[str, str]:
    by_rule: dict[str, list[str]] = {}
    names = {"text": "rule_required_text", "int": "rule_parse_int", "opt": "rule_parse_optional_int",
             "dec": "rule_parse_decimal", "ts": "rule_parse_timestamp"}
    for t in TABLES:
        for f, k in KINDS[t].items():
            by_rule.setdefault(names[k], []).append(
                f"SELECT '{t}' AS table_name, {KEYS[t]} AS row_key, '{f}' AS field, {_parse_reason(f, k)} AS reason FROM p_{t}")
        for rule, f, c, r in VALUE_RULES[t]:
            by_rule.setdefault(rule, []).append(
                f"SELECT '{t}' AS table_name, {KEYS[t]} AS row_key, '{f}' AS field, CASE WHEN {c} THEN '{r}' END AS reason FROM p_{t}")
    found = {
        rule: text_query(f"SELECT * FROM ({' UNION ALL '.join(parts)}) x WHERE reason IS NOT NULL")
        for rule, parts in by_rule.items()
    }
    found["reason_accumulator"] = text_query(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {KEYS[t]} AS row_key, length(r0) - length(replace(r0, ';', '')) + 1 AS reason_count, "
        f"r0 AS rejection_reason FROM v_{t} WHERE r0 <> ''" for t in TABLES))
    for t in TABLES:
        typed = ", ".join(f"CAST(t_{f} AS VARCHAR) AS t_{f}" for f, k in KINDS[t].items())
        found[f"validate_{t}"] = text_query(f"SELECT {KEYS[t]} AS row_key, {typed}, r0 AS rejection_reason FROM v_{t}")
    return found


# --- versions, references, routing -------------------------------------------------------------


def _plus(old: str, condition: str, reason: str) -> str:
    return f"concat_ws(';', nullif({old}, ''), CASE WHEN {condition} THEN '{reason}' END)"


def cascade() -> list[str]:
    parts = []
    for t in TABLES:
        k = f"t_{KEYS[t]}"
        parts.append(
            f"s_{t} AS (SELECT *, {_plus('r0', f'{k} IS NOT NULL AND rn > 1', 'SUPERSEDED_BY_LATER_VERSION')} AS r1 FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY t_updated_at DESC NULLS LAST, _seq DESC) AS rn FROM v_{t}) q)")
    missing = "t_{0} IS NOT NULL AND t_{0} NOT IN (SELECT t_{0} FROM s_{1} WHERE r1 = '' AND t_{0} IS NOT NULL)"
    parts += [
        f"uc_orders AS (SELECT *, {_plus('r1', missing.format('customer_id', 'customers'), 'UNKNOWN_CUSTOMER_REFERENCE')} AS r2 FROM s_orders)",
        f"u_orders AS (SELECT *, {_plus('r2', missing.format('product_id', 'products'), 'UNKNOWN_PRODUCT_REFERENCE')} AS r3 FROM uc_orders)",
        f"up_orders AS (SELECT *, {_plus('r1', missing.format('product_id', 'products'), 'UNKNOWN_PRODUCT_REFERENCE')} AS r3 FROM s_orders)",
        "u_payments AS (SELECT *, " + _plus(
            "r1", "t_order_id IS NOT NULL AND t_order_id NOT IN (SELECT t_order_id FROM s_orders WHERE t_order_id IS NOT NULL)",
            "UNKNOWN_ORDER_REFERENCE") + " AS r2 FROM s_payments)",
        """lcp AS (SELECT o.t_order_id, p.t_payment_id, p.t_payment_time, p.t_payment_status, p.t_payment_amount, o.t_unit_price * o.t_quantity AS expected_amount,
            p.d_payment_amount, o.d_unit_price * o.t_quantity AS d_expected
          FROM (SELECT * FROM u_orders WHERE r3 = '') o JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t_order_id
            ORDER BY t_payment_time DESC, t_payment_id DESC) AS prn FROM u_payments WHERE r2 = '') q WHERE prn = 1) p ON p.t_order_id = o.t_order_id)""",
        "wrong AS (SELECT t_order_id, t_payment_id FROM lcp WHERE t_payment_status = 'successful' AND coalesce(t_payment_amount <> expected_amount, d_payment_amount <> d_expected))",
        "f_orders AS (SELECT *, " + _plus("r3", "r3 = '' AND t_order_id IN (SELECT t_order_id FROM wrong)", "PAYMENT_AMOUNT_MISMATCH") + " AS r FROM u_orders)",
        "m_payments AS (SELECT *, " + _plus("r2", "r2 = '' AND t_payment_id IN (SELECT t_payment_id FROM wrong)", "PAYMENT_AMOUNT_MISMATCH") + " AS r3 FROM u_payments)",
        "f_payments AS (SELECT *, " + _plus(
            "r3", "t_order_id IS NOT NULL AND t_order_id NOT IN (SELECT t_order_id FROM f_orders WHERE r = '' AND t_order_id IS NOT NULL)",
            "ORDER_NOT_CURATED") + " AS r FROM m_payments)",
        "f_customers AS (SELECT *, r1 AS r FROM s_customers)",
        "f_products AS (SELECT *, r1 AS r FROM s_products)",
    ]
    return parts


def judged(body: str) -> str:
    return text_query(body, extra=cascade())


def judged_history(body: str) -> str:
    """The same cascade over the typed versions as the loads write them: as text, blanks for nulls, one per key and time."""
    plain = [
        f"text_{t} AS (SELECT {', '.join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in columns(t))}, _seq "
        f"FROM raw_{t} QUALIFY row_number() OVER (PARTITION BY {KEYS[t]}, updated_at ORDER BY _seq DESC) = 1)" for t in TABLES]
    return query(body, *[f"raw_{t}" for t in TABLES], extra=[*plain, *[c for t in TABLES for c in typed_cte(t)], *cascade()])


def reasons_of(views: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {KEYS[t]} AS row_key, {r} AS rejection_reason FROM {v}" for t, (v, r) in views.items())


def summary_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS raw_rows, count(*) FILTER (WHERE r = '') AS curated_rows, "
        f"count(*) FILTER (WHERE r <> '') AS rejected_rows, true AS reconciled FROM f_{t}" for t in TABLES)


def _iso(field: str) -> str:
    return f"strftime(t_{field}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"


def relations() -> dict[str, str]:
    q = {
        "reject_superseded": reasons_of({t: (f"s_{t}", "r1") for t in TABLES}),
        "valid_keys": " UNION ALL ".join(
            f"SELECT DISTINCT '{t}' AS table_name, t_{KEYS[t]} AS key FROM s_{t} WHERE r1 = '' AND t_{KEYS[t]} IS NOT NULL" for t in TABLES),
        "unknown_customer": reasons_of({"orders": ("uc_orders", "r2")}),
        "unknown_product": reasons_of({"orders": ("up_orders", "r3")}),
        "unknown_order": reasons_of({"payments": ("u_payments", "r2")}),
        "latest_clean_payment": f"""SELECT t_order_id AS order_id, t_payment_id AS payment_id, t_payment_status AS payment_status,
          CAST(t_payment_amount AS {D}) AS payment_amount, CAST(expected_amount AS {D}) AS expected_amount FROM lcp""",
        "amount_mismatch": reasons_of({"orders": ("f_orders", "r"), "payments": ("m_payments", "r3")}),
        "order_not_curated": reasons_of({"payments": ("f_payments", "r")}),
        "route_layers": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, CASE WHEN r = '' THEN 'curated' ELSE 'rejected' END AS layer, {KEYS[t]} AS row_key FROM f_{t}"
            for t in TABLES),
        "raw_to_curated": summary_sql(),
        "layer_summary": summary_sql(),
        "rejection_histogram": "SELECT table_name, reason, count(*) AS row_count FROM (" + " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, unnest(string_split(r, ';')) AS reason FROM f_{t} WHERE r <> ''" for t in TABLES) + ") x GROUP BY 1, 2",
        "validate_outputs": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS raw_rows, count(*) FILTER (WHERE r = '') AS curated_rows, count(*) FILTER (WHERE r <> '') AS rejected_rows, "
            f"true AS reconciled, count(*) FILTER (WHERE r = '') - count(DISTINCT CASE WHEN r = '' THEN {KEYS[t]} END) AS duplicate_curated_keys, "
            f"CAST(0 AS BIGINT) AS rejected_without_reason, '' AS failures FROM f_{t}" for t in TABLES),
        "curated_sink": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, {KEYS[t]} AS row_key, " + " || '|' || ".join(
                _iso(c) if c in timestamps(t) else c for c in columns(t)) + f" AS row_text FROM f_{t} WHERE r = ''" for t in TABLES),
        "rejected_sink": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, {KEYS[t]} AS row_key, " + " || '|' || ".join(columns(t)) +
            f" AS row_text, r AS rejection_reason FROM f_{t} WHERE r <> ''" for t in TABLES),
    }
    found = {name: judged(sql) for name, sql in q.items()}
    found["raw_to_curated_history"] = judged_history(summary_sql())
    found["validate_outputs_history"] = judged_history(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS raw_rows, count(*) FILTER (WHERE r = '') AS curated_rows, count(*) FILTER (WHERE r <> '') AS rejected_rows, "
        f"count(*) FILTER (WHERE r = '') - count(DISTINCT CASE WHEN r = '' THEN {KEYS[t]} END) AS duplicate_curated_keys, '' AS failures FROM f_{t}"
        for t in TABLES) + " UNION ALL SELECT 'overall', NULL, NULL, NULL, NULL, 'PASS'")
    found["curated_after_batches"] = judged_history(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CASE WHEN r = '' THEN 'curated' ELSE 'rejected' END AS layer, {KEYS[t]} AS row_key, r AS rejection_reason FROM f_{t}"
        for t in TABLES))
    found["latest_payment"] = report(
        f"SELECT order_id, payment_id, CAST(payment_amount AS {D}) AS payment_amount, payment_status, payment_time FROM lp")
    found["latest_versions"] = query(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({KEYS[t]} AS VARCHAR) AS row_key, {row_text(t)} AS row_text FROM cur_{t}" for t in ("orders", "payments")),
        "cur_orders", "cur_payments")
    found["declared_constraint_audit"] = constraint_audit()
    return found


def constraint_audit() -> str:
    """Violations over the versioned tables, which break keys, references and checks alike."""
    parts = []

    def add(name: str, table: str, condition: str) -> None:
        parts.append(f"SELECT '{name}' AS \"constraint\", count(*) FILTER (WHERE {condition}) AS violations FROM raw_{table}")

    for t in TABLES:
        for c in columns(t):
            if c not in NULLABLE.get(t, set()):
                add(f"{t}_{c}_not_null", t, f"{c} IS NULL")
        for c, n in MAX_LENGTHS[t].items():
            add(f"{t}_{c}_max_length", t, f"length({c}) > {n}")
        if t != "payments":
            add(f"{t}_updated_after_created", t, "updated_at < created_at")
        if t in ("products", "orders"):
            add(f"{t}_positive_price", t, "unit_price <= 0")
        for c in [KEYS[t], *{"customers": ["email"], "products": ["product_name"]}.get(t, [])]:
            parts.append(f"SELECT '{t}_{c}_unique', count({c}) - count(DISTINCT {c}) FROM raw_{t}")
    add("orders_status_allowed", "orders", f"order_status NOT IN {_in(ORDER_STATUSES)}")
    add("payments_positive_amount", "payments", "payment_amount <= 0")
    add("payments_method_allowed", "payments", f"payment_method NOT IN {_in(PAYMENT_METHODS)}")
    add("payments_status_allowed", "payments", f"payment_status NOT IN {_in(PAYMENT_STATUSES)}")
    add("payments_updated_after_payment", "payments", "updated_at < payment_time")
    add("orders_customer_id_exists", "orders", "customer_id NOT IN (SELECT customer_id FROM raw_customers)")
    add("orders_product_id_exists", "orders", "product_id NOT IN (SELECT product_id FROM raw_products)")
    add("payments_order_id_exists", "payments", "order_id NOT IN (SELECT order_id FROM raw_orders)")
    return query(" UNION ALL ".join(parts), "raw_customers", "raw_products", "raw_orders", "raw_payments")


# --- quality of the model tables -----------------------------------------------------------------


def quality() -> dict[str, str]:
    q = {}
    parts = []
    # Expected are the keys of the versioned tables.
    for case, tables in (("current", MODEL), ("before the batch", {**MODEL, "orders": "base_orders", "payments": "base_payments"})):
        for t, v in tables.items():
            wanted = f"(SELECT count(DISTINCT {KEYS[t]}) FROM raw_{t})"
            parts.append(f"SELECT '{case}' AS case_name, '{t}_rows' AS check_name, {wanted} AS expected, count(*) AS actual, {wanted} = count(*) AS passed FROM {v}")
            for c in [KEYS[t], *{"customers": ["email"], "products": ["product_name"]}.get(t, [])]:
                parts.append(f"SELECT '{case}', '{t}_{c}_distinct', count(*), count(DISTINCT {c}), count(*) = count(DISTINCT {c}) FROM {v}")
    q["expected_counts"] = query(" UNION ALL ".join(parts), *MODEL.values(), "base_orders", "base_payments")
    q["reference_integrity"] = report(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS field, count(*) FILTER (WHERE {c} NOT IN (SELECT {k} FROM {p})) AS missing_rows FROM {MODEL[t]}"
        for t, c, k, p in (("orders", "customer_id", "customer_id", "raw_customers"), ("orders", "product_id", "product_id", "raw_products"),
                           ("payments", "order_id", "order_id", "cur_orders"))))
    q["manifest_counts"] = query("SELECT scenario_type, count(*) AS row_count FROM manifest GROUP BY 1", "manifest")
    q["manifest_verify"] = query("""SELECT m.scenario_type, m.order_id, coalesce(CASE m.scenario_type WHEN 'invalid_quantity' THEN o.quantity <= 0
      WHEN 'missing_customer_reference' THEN o.customer_id IS NULL WHEN 'missing_product_reference' THEN o.product_id IS NULL
      WHEN 'payment_amount_mismatch' THEN lp.payment_amount <> o.quantity * o.unit_price WHEN 'failed_payment' THEN lp.payment_status = 'failed'
      WHEN 'late_arriving_payment' THEN lp.payment_time >= o.created_at + INTERVAL '8 days' WHEN 'missing_payment' THEN lp.payment_id IS NULL END, false) AS passed
      FROM manifest m JOIN cur_orders o ON o.order_id = m.order_id LEFT JOIN lp ON lp.order_id = m.order_id""", "manifest", *MODEL.values(), extra=[LP])
    q["confirmed_recompute"] = report(f"""SELECT count(*) AS confirmed_orders, CAST(coalesce(sum(paid), 0) AS {D}) AS confirmed_revenue
      FROM facts WHERE confirmed AND customer_id IS NOT NULL AND product_id IS NOT NULL""")
    return q


# --- loads ---------------------------------------------------------------------------------------

MARKS = {"customers": "1995-02-28 00:00:00", "products": "1995-01-20 00:00:00",
         "orders": "2001-09-30 23:59:59", "payments": "2001-06-30 23:59:59"}
#: A second boundary between the marks and the last rows.
MIDDLE = {"customers": "1995-03-15 00:00:00", "products": "1995-01-25 00:00:00",
          "orders": "2001-11-15 00:00:00", "payments": "2001-10-15 00:00:00"}
RAW = {t: f"raw_{t}" for t in TABLES}
PAST = {t: f"updated_at > TIMESTAMP '{m}'" for t, m in MARKS.items()}


def raw_query(body: str) -> str:
    return query(body, *RAW.values())


def _ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def loads() -> dict[str, str]:
    q = {}
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS source_rows FROM {v}" for t, v in RAW.items())
    q["source_counts"] = raw_query(counts)
    matched = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS copied_rows, count(*) AS expected_rows, true AS matched FROM {v}" for t, v in RAW.items())
    q["full_load"] = raw_query(matched)
    q["count_guard"] = raw_query(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) FILTER (WHERE {PAST[t]}) AS copied_rows, count(*) AS expected_rows, "
        f"count(*) FILTER (WHERE {PAST[t]}) = count(*) AS matched FROM {v}" for t, v in RAW.items()))
    q["initial_watermarks"] = raw_query("SELECT " + ", ".join(
        f"(SELECT {_ts('max(updated_at)')} FROM {v}) AS {t}_watermark" for t, v in RAW.items()) + ", 'run-1' AS last_successful_run_id")
    q["control_dataset"] = raw_query("SELECT " + ", ".join(
        f"(SELECT {_ts('max(updated_at)')} FROM {v}) AS {t}_watermark" for t, v in RAW.items()) + ", 'run-2' AS last_successful_run_id")
    bounds = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {_ts(f'coalesce(max(updated_at), TIMESTAMP {chr(39)}{MARKS[t]}{chr(39)})')} AS new_watermark, count(*) AS expected_rows "
        f"FROM {v} WHERE {PAST[t]}" for t, v in RAW.items())
    q["window_lookup"] = raw_query(bounds)
    q["bounded_extract"] = raw_query(rows_of(RAW, PAST))
    q["incremental_load"] = raw_query(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, run_id, CAST(CASE run_id WHEN 'inc-1' THEN n ELSE 0 END AS BIGINT) AS copied_rows, "
        f"CASE run_id WHEN 'inc-1' THEN '{MARKS[t]}.000000' ELSE top END AS old_watermark, top AS new_watermark FROM "
        f"(SELECT count(*) AS n, {_ts('max(updated_at)')} AS top FROM {v} WHERE {PAST[t]}) a, (SELECT 'inc-1' AS run_id UNION ALL SELECT 'inc-2') b"
        for t, v in RAW.items()))
    q["advance_watermarks"] = raw_query(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{MARKS[t]}.000000' AS old_watermark, {_ts('max(updated_at)')} AS new_watermark, "
        f"max(updated_at) > TIMESTAMP '{MARKS[t]}' AS advanced FROM {v} WHERE {PAST[t]}" for t, v in RAW.items()))
    q["legacy_watermark_upsert"] = raw_query(
        f"SELECT pipeline_name, mark AS last_successful_watermark, o AS last_order_rows, p AS last_payment_rows FROM (SELECT 'order_payment_incremental' AS pipeline_name, "
        f"(SELECT {_ts('max(updated_at)')} FROM raw_orders) AS mark, (SELECT count(*) FROM raw_orders) AS o, (SELECT count(*) FROM raw_payments) AS p) x "
        f"UNION ALL SELECT 'products_only', (SELECT {_ts('max(updated_at)')} FROM raw_products), CAST(0 AS BIGINT), CAST(0 AS BIGINT)")
    staged = ["staged_orders", "staged_payments", "cur_orders", "cur_payments", "base_orders", "base_payments", "raw_customers", "raw_products"]

    def change(body: str, extra: list[str] = ()) -> str:
        return query(body, *staged, extra=extra)

    both = (("orders", "order_id"), ("payments", "payment_id"))
    # Against the state after the batch its new keys are taken and the counts have grown.
    checks = []
    for case, state, mark in (("before", "base", f"TIMESTAMP '{MARKS['payments']}'"), ("after", "cur", "(SELECT max(updated_at) FROM raw_payments)")):
        for t, k in both:
            wanted = f"(SELECT count(DISTINCT {k}) FROM raw_{t} WHERE updated_at <= TIMESTAMP '{MARK}')"
            taken = f"count(*) FILTER (WHERE {k} IN (SELECT {k} FROM staged_{t} WHERE operation = 'new'))"
            checks += [
                f"SELECT '{case}' AS case_name, '{t}_rows' AS check_name, CAST({wanted} AS VARCHAR) AS expected, CAST(count(*) AS VARCHAR) AS actual, "
                f"{wanted} = count(*) AS passed FROM {state}_{t}",
                f"SELECT '{case}', '{t}_ids_free', '0', CAST({taken} AS VARCHAR), {taken} = 0 FROM {state}_{t}"]
        checks.append(f"SELECT '{case}', 'stored_watermark', '{MARK}.000000', strftime({mark}, '%Y-%m-%d %H:%M:%S.%f'), {mark} = TIMESTAMP '{MARK}'")
    q["batch_preconditions"] = change(" UNION ALL ".join(checks))
    q["staged_operation_counts"] = change(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, operation, count(*) AS row_count FROM staged_{t} GROUP BY 2" for t, _ in both))
    # Against the state after the batch every new row conflicts.
    q["staged_operation_conflicts"] = change(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, s.operation, s.{k} AS key FROM staged_{t} s WHERE "
        f"(s.operation = 'new') = (s.{k} IN (SELECT {k} FROM cur_{t}))" for t, k in both))
    q["previous_versions"] = change(rows_of({"orders": "base_orders", "payments": "base_payments"}, {
        t: f"{k} IN (SELECT {k} FROM staged_{t} WHERE operation = 'update')" for t, k in both}))
    q["upsert_merge"] = change(" UNION ALL ".join([
        rows_of({"orders": "base_orders", "payments": "base_payments"}, {t: f"{k} NOT IN (SELECT {k} FROM staged_{t})" for t, k in both}),
        rows_of({"orders": "staged_orders", "payments": "staged_payments"})]))
    q["upsert_merge_sink"] = q["upsert_merge"]
    q["staged_change_scan"] = change(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, operation, {k} AS row_key, {row_text(t)} AS row_text FROM staged_{t}" for t, k in both))
    q["new_watermark"] = change(
        f"SELECT {_ts('greatest((SELECT max(updated_at) FROM cur_orders), (SELECT max(updated_at) FROM cur_payments))')} AS new_watermark")
    q["extraction_guard"] = change(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) FILTER (WHERE updated_at > TIMESTAMP '{MARK}') AS extracted_rows, "
        f"(SELECT count(*) FROM staged_{t}) AS expected_rows, count(*) AS source_rows, "
        f"count(*) FILTER (WHERE updated_at > TIMESTAMP '{MARK}') = (SELECT count(*) FROM staged_{t}) AS passed FROM cur_{t}" for t, _ in both))
    affected = "affected AS (SELECT order_id FROM staged_orders UNION SELECT order_id FROM staged_payments)"
    q["affected_orders"] = change("SELECT order_id FROM affected", extra=[affected])
    q["incremental_reconciliation"] = change(
        f"SELECT {first_of(CLASSES)} AS reconciliation_result, count(*) AS affected_order_count FROM affected JOIN facts USING (order_id) GROUP BY ALL",
        extra=[LP, FACTS.format(orders="cur_orders", latest="lp"), affected])
    lp_before = LP.replace("lp AS", "lpb AS").replace("cur_payments", "base_payments")
    facts_before = FACTS.replace("facts AS", "facts_before AS").format(orders="base_orders", latest="lpb")
    totals = f"(SELECT count(*) AS n, CAST(coalesce(sum(paid), 0) AS {D}) AS r FROM {{}} WHERE confirmed AND linked)"
    q["revenue_delta"] = change(
        f"""SELECT b.n AS confirmed_orders_before, a.n AS confirmed_orders_after, b.r AS confirmed_revenue_before, a.r AS confirmed_revenue_after,
          a.n - b.n AS confirmed_order_change, CAST(a.r - b.r AS {D}) AS confirmed_revenue_change
          FROM {totals.format("facts_before")} b, {totals.format("facts")} a""",
        extra=[LP, FACTS.format(orders="cur_orders", latest="lp"), lp_before, facts_before])
    q["version_counts"] = raw_query(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(sum(n) AS BIGINT) AS raw_versions, count(*) AS latest_versions, count(*) FILTER (WHERE n > 1) AS keys_with_several_versions "
        f"FROM (SELECT {k}, count(*) AS n FROM raw_{t} GROUP BY 1) x" for t, k in both))
    q["late_payments_for_existing"] = change(
        "SELECT payment_id, order_id FROM staged_payments WHERE operation = 'new' AND order_id IN (SELECT order_id FROM base_orders)")
    latest = {t: f"updated_at > (SELECT max(updated_at) FROM {v})" for t, v in RAW.items()}
    tables = []
    for case, past, kept in (("stored marks", PAST, "false"), ("latest times", latest, "false"), ("the batch", PAST, "true"), ("odd keys of the batch", PAST, "{k} % 2 = 1")):
        for t, v in RAW.items():
            wanted = kept.format(k=KEYS[t])
            tables.append(
                f"SELECT '{case}' AS case_name, '{t}' AS table_name, count(*) AS total_rows, {_ts('max(updated_at)')} AS max_updated_at, "
                f"count(*) FILTER (WHERE {past[t]}) AS recovery_rows, count(*) FILTER (WHERE {past[t]} AND {wanted}) AS expected_rows, "
                f"count(*) FILTER (WHERE {past[t]} AND NOT ({wanted})) AS unexpected_rows, CAST(0 AS BIGINT) AS missing_rows, "
                f"count(*) FILTER (WHERE {past[t]} AND NOT ({wanted})) = 0 AS safe FROM {v}")
    tables = " UNION ALL ".join(tables)
    q["recovery_window_check"] = raw_query(
        f"SELECT * FROM ({tables}) a UNION ALL SELECT case_name, 'overall', NULL, NULL, NULL, NULL, NULL, NULL, bool_and(safe) FROM ({tables}) b GROUP BY case_name")
    uneven = " AND ".join(f"(SELECT count(*) FROM raw_{t} WHERE {PAST[t]} AND {KEYS[t]} % 2 = 0) = 0" for t in TABLES)

    def boundary(case: str, restored: str) -> str:
        marks = ", ".join(
            f"CASE WHEN {restored} THEN '{MARKS[t]}.000000' ELSE (SELECT {_ts('max(updated_at)')} FROM raw_{t}) END AS {t}_watermark" for t in TABLES)
        return f"SELECT '{case}' AS case_name, {marks}, CASE WHEN {restored} THEN 'reset-1' ELSE 'run-1' END AS last_successful_run_id"

    q["restored_boundary"] = raw_query(f"{boundary('odd keys of the batch', uneven)} UNION ALL {boundary('the batch', 'true')}")
    q["recovery_unexpected_ids"] = raw_query(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {KEYS[t]} AS row_id FROM {v} WHERE {PAST[t]}" for t, v in RAW.items()))
    checks = []
    for case, state in (("merged", "cur"), ("not merged", "base")):
        for t, k in both:
            same = " AND ".join(f"s.{c} IS NOT DISTINCT FROM c.{c}" for c in columns(t))
            wanted = (f"(SELECT count(DISTINCT {k}) FROM raw_{t} WHERE updated_at <= TIMESTAMP '{MARK}') + "
                      f"(SELECT count(*) FROM staged_{t} WHERE operation = 'new')")
            exact = f"(SELECT count(*) FROM staged_{t} s JOIN {state}_{t} c ON {same})"
            other = f"((SELECT count(*) FROM {state}_{t} WHERE {k} IN (SELECT {k} FROM staged_{t})) - {exact})"
            for kind, expected, actual in (("rows", wanted, f"(SELECT count(*) FROM {state}_{t})"), ("rows_exact", f"(SELECT count(*) FROM staged_{t})", exact), ("rows_not_as_staged", "CAST(0 AS BIGINT)", other)):
                checks.append(f"SELECT '{case}' AS case_name, '{t}_{kind}' AS check_name, {expected} AS expected, {actual} AS actual, {expected} = {actual} AS passed")
    q["postinsert_checks"] = change(" UNION ALL ".join(checks))
    first = """chosen AS (SELECT p.payment_id, o.order_id, o.customer_id, o.product_id FROM staged_payments p JOIN cur_orders o USING (order_id)
      WHERE p.operation = 'new' AND o.customer_id IS NOT NULL AND o.product_id IS NOT NULL ORDER BY p.payment_id LIMIT 1)"""
    times = """times AS (SELECT c.updated_at AS a, pr.updated_at AS b, o.updated_at AS c, p.updated_at AS d FROM chosen x
      LEFT JOIN raw_customers c ON c.customer_id = x.customer_id LEFT JOIN raw_products pr ON pr.product_id = x.product_id
      JOIN cur_orders o ON o.order_id = x.order_id JOIN cur_payments p ON p.payment_id = x.payment_id)"""
    q["postinsert_report"] = change(f"""SELECT {', '.join(f"(SELECT count(*) FROM {v}) AS {t}" for t, v in MODEL.items())},
        coalesce(a = b AND b = c AND c = d, false) AS same_timestamp, a IS NOT NULL AND b IS NOT NULL AS relationships_valid,
        (SELECT count(*) FROM facts WHERE confirmed AND linked) AS confirmed_orders,
        (SELECT CAST(coalesce(sum(paid), 0) AS {D}) FROM facts WHERE confirmed AND linked) AS confirmed_revenue FROM times""",
        extra=[LP, FACTS.format(orders="cur_orders", latest="lp"), first, times])
    return q


# --- files ---------------------------------------------------------------------------------------


def files() -> dict[str, str]:
    q = {}
    text_views = {t: f"text_{t}" for t in TABLES}
    q["raw_csv_scan"] = query(rows_of(text_views), *text_views.values())
    q["source_table_scan"] = report(rows_of(MODEL))
    q["raw_full_sink"] = report(rows_of(MODEL))
    q["reloaded_tables"] = report(rows_of(MODEL))
    q["truncate_reload"] = report(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {v}" for t, v in MODEL.items()))
    top = {t: f"(SELECT strftime(max(updated_at), '%Y%m%dT%H%M%S') || '0000000Z' FROM raw_{t})" for t in TABLES}
    q["raw_incremental_sink"] = raw_query(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({KEYS[t]} AS VARCHAR) AS row_key, {top[t]} AS watermark, 'inc-1' AS run_id, {row_text(t)} AS row_text FROM raw_{t} WHERE {PAST[t]}"
        for t in TABLES))
    q["raw_history_scan"] = raw_query(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({KEYS[t]} AS VARCHAR) AS row_key, CASE WHEN {PAST[t]} THEN {top[t]} ELSE '' END AS watermark, "
        f"CASE WHEN {PAST[t]} THEN 'inc-1' ELSE '' END AS run_id, {row_text(t)} AS row_text FROM raw_{t}" for t in TABLES))
    q["lake_inventory"] = raw_query(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, part, '{','.join(columns(t))}' AS header, CASE part WHEN 'full' THEN CAST(a AS BIGINT) WHEN 'inc-1' THEN CAST(b AS BIGINT) ELSE 0 END AS data_rows FROM "
        f"(SELECT count(*) FILTER (WHERE NOT ({PAST[t]})) AS a, count(*) FILTER (WHERE {PAST[t]}) AS b FROM raw_{t}) x, "
        f"(SELECT 'full' AS part UNION ALL SELECT 'inc-1' UNION ALL SELECT 'inc-2') y" for t in TABLES))
    q["verify_batch"] = raw_query(" UNION ALL ".join(
        f"SELECT '{case}' AS case_name, '{t}' AS table_name, count(*) AS data_rows, count(*) FILTER (WHERE {kept}) AS expected_rows, CAST(0 AS BIGINT) AS missing_rows, "
        f"count(*) FILTER (WHERE NOT ({kept})) AS unexpected_rows, CAST(min(updated_at) AS VARCHAR) AS first_updated_at, CAST(max(updated_at) AS VARCHAR) AS last_updated_at, "
        f"count(*) FILTER (WHERE NOT ({kept})) = 0 AS rows_ok, CAST(1 AS BIGINT) AS control_rows, true AS control_ok "
        f"FROM raw_{t} WHERE {PAST[t]}" for t in TABLES for case, kept in (("all rows", "true"), ("odd keys", f"{KEYS[t]} % 2 = 1"))))
    top_rows = f"(SELECT count(*) FROM raw_{{t}} WHERE updated_at > (SELECT max(updated_at) FROM raw_{{t}}))"
    q["file_digests"] = raw_query(" UNION ALL ".join(
        f"SELECT 'after the rerun' AS case_name, '{t}' AS table_name, count(*) AS data_rows, count(*) > 0 AS digested, {top_rows.format(t=t)} = 0 AS unchanged "
        f"FROM raw_{t} WHERE {PAST[t]} UNION ALL "
        f"SELECT 'the rerun''s files', '{t}', {top_rows.format(t=t)}, count(*) > 0, {top_rows.format(t=t)} = count(*) FROM raw_{t} WHERE {PAST[t]}" for t in TABLES))
    counts = {t: f"(SELECT count(*) FROM raw_{t} WHERE {PAST[t]})" for t in TABLES}
    keys = {t: f"(SELECT count(DISTINCT {KEYS[t]}) FROM raw_{t} WHERE {PAST[t]})" for t in TABLES}
    zero = "CAST(0 AS BIGINT)"
    q["rerun_proof"] = raw_query(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {counts[t]} AS rows_before, {keys[t]} AS keys_before, {counts[t]} AS rows_after, {keys[t]} AS keys_after, "
        f"{top_rows.format(t=t)} AS changed_keys, {top_rows.format(t=t)} AS changed_files, {zero} AS misplaced_files, {top_rows.format(t=t)} AS rerun_rows, "
        f"{zero} AS misplaced_rerun_files, count(*) AS source_rows_before, count(*) AS source_rows_after, CAST(1 AS BIGINT) AS first_control_rows, "
        f"CAST(1 AS BIGINT) AS rerun_control_rows, 'inc-2' AS last_successful_run_id, max(updated_at) = (SELECT max(updated_at) FROM raw_{t} WHERE {PAST[t]}) AS watermark_ok, "
        f"{top_rows.format(t=t)} = 0 AS passed FROM raw_{t}" for t in TABLES))
    calm = " AND ".join(f"{top_rows.format(t=t)} = 0" for t in TABLES)
    # What each case exchanges, and the verdict that must then fail, from the rows themselves.
    odd = " AND ".join(f"(SELECT count(*) FROM raw_{t} WHERE {PAST[t]} AND {KEYS[t]} % 2 = 0) = 0" for t in TABLES)
    grown = " AND ".join(f"{counts[t]} = 0" for t in TABLES)
    moved = " AND ".join(f"(SELECT max(updated_at) FROM raw_{t}) = TIMESTAMP '{MARKS[t]}'" for t in TABLES)
    verdicts = ("first_run_files_unchanged", "second_run_files_separate_and_empty", "first_run_files_located", "run_ids_unique", "watermarks_as_expected", "source_unchanged")
    hit = {"as run": {}, "odd keys only": {"first_run_files_unchanged": odd}, "earlier source": {"source_unchanged": grown}, "stored marks": {"watermarks_as_expected": moved}}
    q["rerun_idempotency"] = raw_query(" UNION ALL ".join(
        f"SELECT '{case}' AS case_name, '{name}' AS check_name, {' AND '.join([calm, *(own.values() if name == 'status' else [own[name]] if name in own else [])])} AS passed"
        for case, own in hit.items() for name in (*verdicts, "status")))
    q["changed_batch_keys"] = raw_query(" UNION ALL ".join(
        f"SELECT DISTINCT '{t}' AS table_name, CAST({KEYS[t]} AS VARCHAR) AS row_key, CASE WHEN {KEYS[t]} % 2 = 1 THEN 'removed' ELSE 'changed' END AS change "
        f"FROM raw_{t} WHERE {PAST[t]} AND ({KEYS[t]} % 2 = 1 OR {KEYS[t]} % 3 = 0)" for t in TABLES))
    steps = []
    for run, low, high in (("full-0", None, MARKS), ("inc-1", MARKS, MIDDLE), ("inc-2", MIDDLE, None)):
        for t in TABLES:
            until = "true" if high is None else f"updated_at <= TIMESTAMP '{high[t]}'"
            since = "true" if low is None else f"updated_at > TIMESTAMP '{low[t]}'"
            # The loads hand over one row per key and time.
            steps.append(
                f"SELECT '{run}' AS run_id, '{t}' AS table_name, count(*) FILTER (WHERE {since}) AS new_rows, count(*) AS raw_rows, count(*) AS layer_rows "
                f"FROM (SELECT DISTINCT {KEYS[t]}, updated_at FROM raw_{t} WHERE {until}) x")
    q["kept_layer_steps"] = raw_query(" UNION ALL ".join(steps))
    q["run_counts"] = raw_query(" UNION ALL ".join(
        f"SELECT run_id, 'Succeeded' AS status, '{t}' AS table_name, CASE run_id WHEN 'inc-1' THEN n ELSE 0 END AS copied_rows, "
        f"CASE run_id WHEN 'inc-1' THEN n ELSE 0 END AS expected_rows FROM (SELECT count(*) AS n FROM raw_{t} WHERE {PAST[t]}) a, "
        f"(SELECT 'inc-1' AS run_id UNION ALL SELECT 'inc-2') b" for t in TABLES))
    return q


def all_oracles() -> dict[str, str]:
    return {**reports(), **text_rules(), **relations(), **quality(), **loads(), **files()}

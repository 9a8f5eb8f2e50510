"""The four model tables expressed over the given parquet tables.

The SQL below runs unchanged in Spark and DuckDB; the oracle inlines it as CTEs.  In Spark the joined order lines, customers, products
and the change batch are written once per session and data folder as parquet; every other view is a projection or a window over
them, worked out on the columns that a query reads.  The raw and the current tables can also be had as written tables, as a source
system would hold them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledger.schemas import TABLES, columns
from ledger.session import configure, scratch, stage

BASE = ["region", "nation", "customer", "part", "orders", "lineitem"]

VIEWS: dict[str, str] = {}

VIEWS["raw_customers"] = """
SELECT c_custkey + 1 AS customer_id, c_name AS customer_name, lower(c_name) || '@example.test' AS email,
  n_name AS city, r_name AS state, TIMESTAMP '1995-01-01 00:00:00' AS created_at,
  TIMESTAMP '1995-01-01 00:00:00' + INTERVAL '1' DAY * CAST(c_custkey % 91 AS INT) AS updated_at, c_custkey AS _seq
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey JOIN {region} ON r_regionkey = n_regionkey
"""

VIEWS["raw_products"] = """
SELECT p_partkey + 1 AS product_id, p_name || ' #' || CAST(p_partkey AS STRING) AS product_name, p_type AS category,
  p_brand AS brand, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price, TIMESTAMP '1995-01-01 00:00:00' AS created_at,
  TIMESTAMP '1995-01-01 00:00:00' + INTERVAL '1' DAY * CAST(p_partkey % 30 AS INT) AS updated_at, p_partkey AS _seq
FROM {part}
"""

VIEWS["order_lines"] = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_orderkey * 10 + l_linenumber AS order_id,
  CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN 900000000 + o_custkey ELSE o_custkey + 1 END AS customer_id,
  CASE WHEN l_orderkey % 107 = 0 THEN NULL WHEN l_orderkey % 109 = 0 THEN 900000000 + l_partkey ELSE l_partkey + 1 END AS product_id,
  CASE WHEN l_orderkey % 97 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END AS quantity,
  CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
  CASE WHEN l_orderkey % 113 = 0 THEN 'unknown' WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'returned'
       WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'cancelled'
       WHEN o_orderstatus = 'P' AND l_linestatus = 'O' AND l_returnflag = 'N' THEN 'pending' ELSE 'completed' END AS order_status,
  o_orderdate AS created_at,
  CASE WHEN l_orderkey % 127 = 0 THEN o_orderdate - INTERVAL '1' DAY ELSE greatest(l_shipdate, o_orderdate) END AS updated_at,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS _seq
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey JOIN {part} ON p_partkey = l_partkey
"""

VIEWS["raw_orders"] = """
SELECT order_id, customer_id, product_id, quantity, unit_price, order_status, created_at, updated_at, _seq FROM {order_lines}
"""

VIEWS["raw_payments"] = """
SELECT order_id * 10000000 + l_partkey AS payment_id,
  CASE WHEN l_orderkey % 131 = 0 THEN 900000000 + order_id ELSE order_id END AS order_id,
  CAST(greatest(quantity, 1) * unit_price + CASE WHEN l_orderkey % 41 = 0 THEN 50 ELSE 0 END AS DECIMAL(12,2)) AS payment_amount,
  CASE l_linenumber % 4 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Card' WHEN 2 THEN 'Net Banking' ELSE 'COD' END AS payment_method,
  CASE WHEN l_orderkey % 37 = 0 THEN 'failed' WHEN order_status IN ('cancelled','returned') THEN 'refunded'
       WHEN order_status = 'pending' THEN 'pending' ELSE 'successful' END AS payment_status,
  created_at + INTERVAL '1' HOUR * CAST(l_suppkey % 48 AS INT) + INTERVAL '1' DAY * (CASE WHEN l_orderkey % 43 = 0 THEN 9 ELSE 0 END) AS payment_time,
  created_at + INTERVAL '1' HOUR * CAST(l_suppkey % 48 + 1 AS INT) + INTERVAL '1' DAY * (CASE WHEN l_orderkey % 43 = 0 THEN 9 ELSE 0 END) AS updated_at,
  _seq
FROM {order_lines} WHERE l_orderkey % 31 <> 0
"""

VIEWS["cur_orders"] = """
SELECT order_id, customer_id, product_id, quantity, unit_price, order_status, created_at, updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, _seq DESC) AS rn FROM {raw_orders}) q WHERE rn = 1
"""

VIEWS["cur_payments"] = """
SELECT payment_id, order_id, payment_amount, payment_method, payment_status, payment_time, updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY updated_at DESC, _seq DESC) AS rn0 FROM {raw_payments}) q WHERE rn0 = 1
"""

# Text layers.  Bad texts are planted by key arithmetic; timestamps come with seven fraction digits.
VIEWS["text_customers"] = """
SELECT CASE WHEN customer_id % 211 = 0 THEN '-' || CAST(customer_id AS STRING) WHEN customer_id % 223 = 0 THEN 'c' || CAST(customer_id AS STRING)
            WHEN customer_id % 227 = 0 THEN ' ' ELSE CAST(customer_id AS STRING) END AS customer_id,
  CASE WHEN customer_id % 197 = 0 THEN '   ' ELSE customer_name END AS customer_name,
  CASE WHEN customer_id % 199 = 0 THEN '' ELSE email END AS email,
  CASE WHEN customer_id % 191 = 0 THEN '' ELSE city END AS city,
  state,
  CASE WHEN customer_id % 193 = 0 THEN '1995-13-01 00:00:00' ELSE CAST(created_at AS STRING) || '.0000000' END AS created_at,
  CASE WHEN customer_id % 181 = 0 THEN '1994-12-31T23:59:59Z' WHEN customer_id % 179 = 0 THEN ''
       ELSE CAST(updated_at AS STRING) || '.0000000' END AS updated_at,
  _seq
FROM {raw_customers}
"""

VIEWS["text_products"] = """
SELECT CASE WHEN product_id % 211 = 0 THEN '0' WHEN product_id % 223 = 0 THEN '5.0' ELSE CAST(product_id AS STRING) END AS product_id,
  CASE WHEN product_id % 79 = 0 THEN ' ' ELSE product_name END AS product_name,
  CASE WHEN product_id % 101 = 0 THEN '' ELSE category END AS category,
  brand,
  CASE WHEN product_id % 83 = 0 THEN '-1.00' WHEN product_id % 89 = 0 THEN 'Infinity' WHEN product_id % 97 = 0 THEN ''
       WHEN product_id % 53 = 0 THEN '1234567890123456789012345' WHEN product_id % 59 = 0 THEN '1e-7' WHEN product_id % 61 = 0 THEN '1.0000009'
       WHEN product_id % 7 = 0 THEN ' +' || CAST(unit_price AS STRING) ELSE CAST(unit_price AS STRING) END AS unit_price,
  CASE product_id % 9 WHEN 0 THEN '19950101' WHEN 1 THEN '1994-W52-7' WHEN 2 THEN '19950101T000000' WHEN 3 THEN '1995-01-01T00:00:00+00' WHEN 4 THEN '1995-01-01x05:30+0530'
       ELSE CAST(created_at AS STRING) || '.0000000' END AS created_at,
  CASE WHEN product_id % 103 = 0 THEN '1994-12-31' WHEN product_id % 107 = 0 THEN 'soon' ELSE CAST(updated_at AS STRING) || '.0000000' END AS updated_at,
  _seq
FROM {raw_products}
"""

VIEWS["text_orders"] = """
SELECT CASE WHEN order_id % 1009 = 0 THEN '-' || CAST(order_id AS STRING) WHEN order_id % 1013 = 0 THEN '' ELSE CAST(order_id AS STRING) END AS order_id,
  CASE WHEN order_id % 157 = 0 THEN '12x' ELSE coalesce(CAST(customer_id AS STRING), '') END AS customer_id,
  coalesce(CAST(product_id AS STRING), '') AS product_id,
  CASE WHEN order_id % 137 = 0 THEN 'abc' WHEN order_id % 163 = 0 THEN '' ELSE ' ' || CAST(quantity AS STRING) END AS quantity,
  CASE WHEN order_id % 139 = 0 THEN 'NaN' WHEN order_id % 167 = 0 THEN '0.00' WHEN order_id % 173 = 0 THEN CAST(unit_price AS STRING) || '0000001'
       WHEN order_id % 179 = 0 THEN CAST(unit_price AS STRING) || 'e0' ELSE CAST(unit_price AS STRING) END AS unit_price,
  CASE WHEN order_id % 151 = 0 THEN '  ' ELSE order_status END AS order_status,
  CASE WHEN order_id % 149 = 0 THEN 'not-a-date' ELSE CAST(created_at AS STRING) || '.0000000' END AS created_at,
  CAST(updated_at AS STRING) || '.0000000' AS updated_at, _seq
FROM {raw_orders}
"""

VIEWS["text_payments"] = """
SELECT CASE WHEN payment_id % 1019 = 0 THEN 'p' || CAST(payment_id AS STRING) WHEN payment_id % 1021 = 0 THEN '-' || CAST(payment_id AS STRING) ELSE CAST(payment_id AS STRING) END AS payment_id,
  CASE WHEN payment_id % 1031 = 0 THEN '' WHEN payment_id % 1033 = 0 THEN '0' ELSE CAST(order_id AS STRING) END AS order_id,
  CASE WHEN payment_id % 313 = 0 THEN '12,5' WHEN payment_id % 317 = 0 THEN '-3.50' ELSE CAST(payment_amount AS STRING) END AS payment_amount,
  CASE WHEN payment_id % 331 = 0 THEN lower(payment_method) WHEN payment_id % 337 = 0 THEN '' ELSE payment_method END AS payment_method,
  CASE WHEN payment_id % 347 = 0 THEN 'done' ELSE payment_status || ' ' END AS payment_status,
  CASE WHEN payment_id % 349 = 0 THEN '2024-02-30 00:00:00' ELSE CAST(payment_time AS STRING) || '.0000000' END AS payment_time,
  CASE WHEN payment_id % 353 = 0 THEN '1990-01-01 00:00' ELSE CAST(updated_at AS STRING) || '.0000000' END AS updated_at,
  _seq
FROM {raw_payments}
"""

# Scenario rows by the arithmetic that planted the defects; some are wrong on purpose.
VIEWS["manifest"] = """
SELECT scenario_type, order_id FROM (
  SELECT order_id, CASE WHEN k % 97 = 0 THEN 'invalid_quantity' WHEN k % 101 = 0 THEN 'missing_customer_reference'
    WHEN k % 107 = 0 THEN 'missing_product_reference' WHEN k % 31 = 0 THEN 'missing_payment' WHEN k % 37 = 0 THEN 'failed_payment'
    WHEN k % 43 = 0 THEN 'late_arriving_payment' WHEN k % 41 = 0 THEN 'payment_amount_mismatch'
    WHEN k % 211 = 0 THEN 'failed_payment' END AS scenario_type
  FROM (SELECT order_id, CAST(floor(order_id / 10) AS BIGINT) AS k FROM {cur_orders}) a) b
WHERE scenario_type IS NOT NULL
"""

# The change batch: what lies past the mark, as new rows and updates of the state before it.
MARK = "2001-06-30 23:59:59"

for _t, _key in (("orders", "order_id"), ("payments", "payment_id")):
    _cols = ", ".join(columns(_t))
    VIEWS[f"base_{_t}"] = f"""
SELECT {_cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY {_key} ORDER BY updated_at DESC, _seq DESC) AS rn FROM {{raw_{_t}}}
  WHERE updated_at <= TIMESTAMP '{MARK}') q WHERE rn = 1
"""
    VIEWS[f"staged_{_t}"] = f"""
SELECT CASE WHEN known IS NULL THEN 'new' ELSE 'update' END AS operation, {_cols} FROM (
  SELECT c.*, b.{_key} AS known FROM {{cur_{_t}}} c LEFT JOIN (SELECT {_key} FROM {{base_{_t}}}) b ON b.{_key} = c.{_key}
  WHERE c.updated_at > TIMESTAMP '{MARK}') q
"""

# How Spark gets the rows of some views.  The order lines are written with the joined columns as they are, half as wide as what follows from
# them.  Of a change batch only rows past the mark meet in a window: the newest of those is the newest of all.
WRITTEN = ("raw_customers", "raw_products", "joined_lines", "staged_orders", "staged_payments")
PLANS = {
    "joined_lines": """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus, l_shipdate,
  o_custkey, o_orderstatus, o_orderdate, p_retailprice
FROM {lineitem} JOIN {part} ON p_partkey = l_partkey JOIN {orders} ON o_orderkey = l_orderkey
""",
    "order_lines": VIEWS["order_lines"].partition("FROM {lineitem}")[0] + "FROM {joined_lines}",
}
for _t, _key in (("orders", "order_id"), ("payments", "payment_id")):
    PLANS[f"staged_{_t}"] = f"""
SELECT CASE WHEN known IS NULL THEN 'new' ELSE 'update' END AS operation, {", ".join(columns(_t))} FROM (
  SELECT c.*, b.{_key} AS known FROM (
    SELECT *, row_number() OVER (PARTITION BY {_key} ORDER BY updated_at DESC, _seq DESC) AS rn FROM {{raw_{_t}}}
    WHERE updated_at > TIMESTAMP '{MARK}') c
  LEFT JOIN (SELECT DISTINCT {_key} FROM {{raw_{_t}}} WHERE updated_at <= TIMESTAMP '{MARK}') b ON b.{_key} = c.{_key}
  WHERE rn = 1) q
"""

_staged: dict[tuple[str, str, str], DataFrame] = {}


def _needs(name: str, views: dict[str, str] = VIEWS) -> list[str]:
    return [v for v in (*BASE, *views) if "{" + v + "}" in views[name]]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, or a view; what several views are worked out from is written once per session."""
    configure(spark)
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged:
        plans = VIEWS | PLANS
        rows = spark.sql(plans[name], **{n: view(spark, sf_dir, n) for n in _needs(name, plans)})
        if name in ("raw_customers", "raw_products"):
            rows = rows.hint("rebalance")  # even files, however few splits the given single files have
        _staged[key] = stage(rows, scratch(spark, name)) if name in WRITTEN else rows
    return _staged[key]


def written(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a table of its own, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, f"written {name}")
    if key not in _staged:
        rows = view(spark, sf_dir, name)
        _staged[key] = rows if name in WRITTEN else stage(rows, scratch(spark, name))
    return _staged[key]


def model(spark: SparkSession, sf_dir: str, get=written) -> dict[str, DataFrame]:
    """Current model tables, one row per key; ``get=view`` for those that a query reads once or in few columns."""
    names = {"customers": "raw_customers", "products": "raw_products", "orders": "cur_orders", "payments": "cur_payments"}
    return {t: get(spark, sf_dir, v).select(*columns(t)) for t, v in names.items()}


def raw(spark: SparkSession, sf_dir: str, get=written) -> dict[str, DataFrame]:
    """Typed tables with several versions per key and ``_seq``; ``get`` as for ``model``."""
    return {t: get(spark, sf_dir, f"raw_{t}") for t in TABLES}


def text(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: view(spark, sf_dir, f"text_{t}") for t in TABLES}


def base(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Model tables as they stood at the mark."""
    return {**model(spark, sf_dir, view), "orders": view(spark, sf_dir, "base_orders"), "payments": view(spark, sf_dir, "base_payments")}


def ctes(*names: str) -> list[str]:
    """``name AS (...)`` of the views needed for ``names``, dependencies first."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in BASE or name in done:
            return
        for n in _needs(name):
            add(n)
        # The driver's own tables keep their names; views get theirs.
        done[name] = VIEWS[name].format(**{n: n for n in _needs(name)})

    for name in names:
        add(name)
    return [f"{n} AS ({sql.strip()})" for n, sql in done.items()]

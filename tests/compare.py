"""Run registered queries beside their DuckDB SQL and compare rows."""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "benchmark", "pages"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows(cols, data) -> Counter:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(str(r[i]) for i in order) for r in data)


def difference(spark, con, sf_dir: str, name: str, query, sql: str) -> str | None:
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = rows(cols, cur.fetchall())
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    if got != want:
        return f"{sum(got.values())} rows, wanted {sum(want.values())}; only Spark {list((got - want).items())[:3]}; only SQL {list((want - got).items())[:3]}"
    kinds = {d[0]: family(str(d[1])) for d in cur.description}
    wrong = {f.name: (f.dataType.simpleString(), kinds[f.name]) for f in df.schema if family(f.dataType.simpleString()) not in (kinds[f.name], "null")}
    return f"types {wrong}" if wrong and want else None


def family(name: str) -> str:
    """Kind of a column type in either engine."""
    name = name.lower()
    for kind, starts in {
        "number": ("bigint", "int", "smallint", "tinyint", "hugeint", "long", "decimal", "double", "float", "number", "ubigint"),
        "text": ("string", "varchar"), "time": ("timestamp", "date"), "boolean": ("bool",), "null": ("void", "null", '"null"'),
    }.items():
        if name.startswith(starts):
            return kind
    return name


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from ledger.session import build_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    only = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledger-"), "spark.driver.memory": "12g",
        "spark.log.level": "ERROR", "spark.ui.showConsoleProgress": "false",
    })
    con, oracles, bad = duck(sf_dir), oracle_sql(), []
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracles:
                found = difference(spark, con, sf_dir, name, query, oracles[name])
            else:
                found = None
                print(f"{name}: {query(spark, sf_dir).count()} rows, no SQL")
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__} {str(error)[:600]}"
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
        if found:
            bad.append(name)
    missing = sorted(set(oracles) - set(queries()))
    print("failed:", bad, "oracle without query:", missing)

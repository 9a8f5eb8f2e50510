"""Small hand-made raw files."""

import csv
from pathlib import Path

from ledger.schemas import TABLES, columns

TS = "2025-01-01 00:00:00.0000000"


def customer(i, name="Ann", at=TS, **more):
    return {"customer_id": i, "customer_name": name, "email": f"c{i}@example.test", "city": "Pune", "state": "MH",
            "created_at": TS, "updated_at": at, **more}


def product(i, price="10.00", at=TS, **more):
    return {"product_id": i, "product_name": f"p{i}", "category": "tools", "brand": "b", "unit_price": price,
            "created_at": TS, "updated_at": at, **more}


def order(i, c=1, p=1, q=2, price="10.00", status="completed", at=TS, **more):
    return {"order_id": i, "customer_id": c, "product_id": p, "quantity": q, "unit_price": price,
            "order_status": status, "created_at": TS, "updated_at": at, **more}


def payment(i, o, amount="20.00", status="successful", when=TS, at="2025-01-05 00:00:00.0000000", **more):
    return {"payment_id": i, "order_id": o, "payment_amount": amount, "payment_method": "UPI",
            "payment_status": status, "payment_time": when, "updated_at": at, **more}


def write(root, bom=False, nested=False, **tables):
    for table in TABLES:
        folder = Path(root) / table if nested else Path(root)
        folder.mkdir(parents=True, exist_ok=True)
        with (folder / f"{table}.csv").open("w", newline="", encoding="utf-8-sig" if bom else "utf-8") as handle:
            writer = csv.DictWriter(handle, fieldnames=columns(table))
            writer.writeheader()
            writer.writerows(tables.get(table, []))
    return str(root)

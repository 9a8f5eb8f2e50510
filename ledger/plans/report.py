"""Several reports over the same tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from ledger.operators.reports import REPORTS, Tables, share_latest
from ledger.session import remove_scratch, scratch, together


def write_reports(spark: SparkSession, t: Tables, out: str, names: Iterable[str] | None = None) -> list[str]:
    """Write reports (all by default) as parquet below ``out``, one folder each; returns their names.

    Nearly all of them need the latest payment per order, which is worked out once.  Reports run a few at
    a time, so that the tail of one overlaps with the next.
    """
    names = list(REPORTS if names is None else names)
    work = scratch(spark, "reports")
    try:
        shared = share_latest(t, f"{work}/latest")

        def write(name: str) -> None:
            REPORTS[name](shared).write.mode("errorifexists").parquet(f"{out}/{name}")

        together(spark, write, names, at_once=4)
    finally:
        remove_scratch(spark, work)
    return names

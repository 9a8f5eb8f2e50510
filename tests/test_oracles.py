"""Every registered query against its SQL, over the whole smallest data set."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import difference, duck

SF = "/root/testdata/sf0.001"
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_each_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    if name in ORACLES:
        assert difference(spark, con, SF, name, queries()[name], ORACLES[name]) is None
    else:
        rows = queries()[name](spark, SF).collect()
        assert rows
        for column in ("passed", "unchanged"):
            if column in rows[0].asDict():
                assert all(r[column] for r in rows)


def test_fixture_counts(spark):
    """Published class counts of the adapter tables."""
    rows = {r[0]: r[1] for r in queries()["order_quality_classes"](spark, SF).collect()}
    assert rows == {
        "CONFIRMED_REVENUE": 2531, "FAILED_PAYMENT": 120, "INVALID_QUANTITY": 50, "MISSING_CUSTOMER_REFERENCE": 78,
        "MISSING_PRODUCT_REFERENCE": 88, "NO_PAYMENT": 179, "ORDER_NOT_COMPLETED": 29, "PAYMENT_AMOUNT_MISMATCH": 452,
        "PENDING_PAYMENT": 212, "REFUNDED_PAYMENT": 860,
    }

"""Parsing rules on hand-made texts."""

from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledger.functions import rules as R


def parse(spark, parser, text, **options):
    typed, reason = parser("f", **options)
    df = spark.createDataFrame([(text,)], "f string").select(typed.alias("t"), reason.alias("r"))
    if parser is R.parse_ts:
        df = df.withColumn("t", R.utc_iso(df.t))
    row = df.first()
    return row["t"], row["r"]


@pytest.mark.parametrize("text, value, reason", [
    ("12", 12, None), (" +7\t", 7, None), ("-3", -3, None), ("1_000", 1000, None), ("007", 7, None),
    (" 5 ", 5, None), ("", None, "MISSING_REQUIRED_F"), ("\x1c \n", None, "MISSING_REQUIRED_F"),
    ("1__0", None, "INVALID_INTEGER_F"), ("_1", None, "INVALID_INTEGER_F"), ("5.0", None, "INVALID_INTEGER_F"),
    ("12x", None, "INVALID_INTEGER_F"), ("1 2", None, "INVALID_INTEGER_F"), ("9" * 30, None, "INVALID_INTEGER_F"),
])
def test_integers(spark, text, value, reason):
    assert parse(spark, R.parse_int, text) == (value, reason)


def test_optional_integer(spark):
    assert parse(spark, R.parse_int, "  ", required=False) == (None, None)
    assert parse(spark, R.parse_int, "x", required=False) == (None, "INVALID_INTEGER_F")


@pytest.mark.parametrize("text, value", [
    ("12.50", "12.500000"), (" +1 ", "1.000000"), (".5", "0.500000"), ("5.", "5.000000"), ("1e3", "1000.000000"),
    ("1_000.25", "1000.250000"), ("-2.5E-1", "-0.250000"), ("1.0000000", "1.000000"), ("0.123456000", "0.123456"),
])
def test_decimals(spark, text, value):
    assert parse(spark, R.parse_decimal, text) == (Decimal(value), None)


@pytest.mark.parametrize("text", ["NaN", "Infinity", "-inf", "12,5", "abc", "--1", ".", "1e", "e5", "1e99999999999999999999", "1.2.3"])
def test_bad_decimals(spark, text):
    assert parse(spark, R.parse_decimal, text) == (None, "INVALID_DECIMAL_F")


@pytest.mark.parametrize("text, value", [
    ("2026-08-15 03:25:37.5273430", "2026-08-15T03:25:37.527343+00:00"),
    ("2026-08-15T03:25:37Z", "2026-08-15T03:25:37.000000+00:00"),
    ("2026-08-15T03:25:37+05:30", "2026-08-14T21:55:37.000000+00:00"),
    ("2026-08-15", "2026-08-15T00:00:00.000000+00:00"),
    (" 2026-08-15 03:25 ", "2026-08-15T03:25:00.000000+00:00"),
])
def test_timestamps(spark, text, value):
    assert parse(spark, R.parse_ts, text) == (value, None)


@pytest.mark.parametrize("text", ["2024", "2024-02-30", "soon", "2024-1-5", "2024-01-05 25:00:00", "03:25:37", "2024-01-05 UTC"])
def test_bad_timestamps(spark, text):
    assert parse(spark, R.parse_ts, text) == (None, "INVALID_TIMESTAMP_F")


@pytest.mark.parametrize("text, value", [("abc", "abc"), ("  a b ", "a b"), (" x　", "x"), ("é", "é"), (" \n", None), ("", None)])
def test_text(spark, text, value):
    assert parse(spark, R.required_text, text) == (value, None if value else "MISSING_REQUIRED_F")


def test_reasons_keep_order_and_drop_repeats(spark):
    from pyspark.sql import functions as F

    df = spark.range(1).select(R.reasons(F.lit("b"), F.lit(None).cast("string"), F.lit("a"), F.lit("b")).alias("r"))
    assert df.first()["r"] == ["b", "a"]
    df = df.select(R.more_reasons(F.col("r"), F.lit(None).cast("string"), F.lit("c"), F.lit("a")).alias("r"))
    assert df.first()["r"] == ["b", "a", "c"]


def test_offset_is_utc():
    from ledger.operators.incremental import mark_text

    assert mark_text("2026-08-15T03:25:37+05:30") == "2026-08-14 21:55:37.000000"
    assert mark_text(datetime(2026, 1, 1, tzinfo=timezone.utc)) == "2026-01-01 00:00:00.000000"


ISO = [
    "20240131", "20240131T10", "20240131 1030", "20240131T103015.5", "20240131T103015,1234567", "2024-01-31x10:30", "2024-01-31T10:30:15,25", "2024-01-31T10",
    "2024-01-31T10+05", "2024-01-31T10:00+0530", "2024-01-31T10:00-05:30:15", "2024-01-31T1030", "20240131T10:30", "2024-01-31T10.5", "2024-01-31 10:00:00.123456789",
    "2024-01-31T10:00-00:00", "2024-W01", "2024W01", "2024-W01-3", "2024W013", "2020-W53-7", "2024-W01T10", "2024W01T10", "2024-W01-3T10:00", "2024-W09-4 101530Z", "2024-01-31T10Z",
    "0001-01-02", "9999-12-31T23:59:59.999999", "2024-W53-1", "2024-W01-0", "2024-W01-8", "2024-W00-1", "2024-01-31T", "2024-W01-", "2024-01", "2024-001", "2024-01-31T10:3015",
    "2024-01-31T1030:15", "2024-0131", "20240230", "2024-01-31T25", "2024-01-31T10:60", "2024-01-31T10:00:00.", "2024-01-31T10:00+5", "2024-1-31", "24-01-31",
    "2024-01-31T10:00+05:3015", "2024-01-31TT10", "2024W1", "2024-W013", "2024W01-3", "T10:00",
]


def test_shapes_of_timestamps_as_the_standard_library_reads_them(spark):
    typed, reason = R.parse_ts("f")
    rows = spark.createDataFrame([(t,) for t in ISO], "f string").select("f", R.utc_iso(typed).alias("t"), reason.alias("r")).collect()
    for row in rows:
        try:
            value = datetime.fromisoformat(row["f"].replace("Z", "+00:00"))
        except ValueError:
            assert (row["t"], row["r"]) == (None, "INVALID_TIMESTAMP_F"), row["f"]
            continue
        value = value.replace(tzinfo=value.tzinfo or timezone.utc).astimezone(timezone.utc)
        assert (row["t"], row["r"]) == (value.isoformat(timespec="microseconds"), None), row["f"]


WIDE = ["1.0000009", "1e-7", "1" * 20, "9" * 30 + "." + "1" * 25, "-1_000_000.12345678", "12.5e40", "+0.000000000000000000000000000001", "1E+30", "-.00000005"]


@pytest.mark.parametrize("text", WIDE)
def test_wide_decimals_are_valid_in_normal_form(spark, text):
    assert parse(spark, R.parse_decimal, text) == (None, None)
    wide = R.wide_decimal(R.stripped("f"), R.decimal_value(R.stripped("f")))
    got = spark.createDataFrame([(text,)], "f string").select(wide.alias("w"), R.positive_amount(R.decimal_value(R.stripped("f")), wide, "NO").alias("p")).first()
    assert Decimal(got["w"]) == Decimal(text) and not got["w"].lstrip("-").startswith("0") and "0e" not in got["w"]
    assert got["p"] == ("NO" if text.startswith("-") else None)


def test_products_of_normal_forms_are_exact(spark):
    from fractions import Fraction

    rows = [(w, q) for w in [*WIDE, "12.5", "7"] for q in (1, 3, 10, 999_999_999, 2**62, -4)]
    text = F.replace(F.col("w"), F.lit("_"), F.lit(""))
    got = spark.createDataFrame(rows, "w string, q bigint").select("w", "q", R.normal_product(R.normal_form(text), F.col("q")).alias("p")).collect()
    for r in got:
        assert Fraction(r["p"]) == Fraction(r["w"].replace("_", "")) * r["q"], r


@pytest.mark.parametrize("core", ["12", "-3", "+", "1_0", "5.0", "12x", "é", "9" * 20, ""])
def test_ends_of_texts_decide_as_the_patterns_do(spark, core):
    """Comparing the first and last character, or a cast, may only decide what the patterns would."""
    ends = ["", " ", "\t", "\x01", "\x7f", "\xa0", "é", "\n", "\r\n", "_"]
    df = spark.createDataFrame([(a + core + b,) for a in ends for b in ends] + [(None,)], "f string")
    text = F.col("f")
    trimmed = F.btrim(text, F.lit(R.WHITESPACE))
    strip = F.when(text.rlike(R.TIDY), text).when(trimmed != "", trimmed)
    whole = F.when(strip.rlike(R.INTEGER), F.replace(strip, F.lit("_"), F.lit("")).try_cast("bigint"))
    for r in df.select("f", R.stripped("f").alias("s"), strip.alias("s0"), R.int_value(R.stripped("f")).alias("i"), whole.alias("i0")).collect():
        assert (r["s"], r["i"]) == (r["s0"], r["i0"]), repr(r["f"])

"""Parsing and checking rules as column expressions.

A parser takes a field name and returns ``(typed, reason)``: the typed value (null where the text is
blank or bad) and the reason (null where the text is fine); ``*_value`` and ``parse_reason`` are its two
halves, for jobs that keep the stripped text and the value as columns.  A check takes typed
columns and returns only a reason.  Nothing here leaves the JVM.

Number texts follow the usual literal forms: an integer has an optional sign and digits that may be
grouped by single underscores; a decimal may have an exponent.  Integers beyond 64 bits are
invalid.  Decimals of any size and scale are valid: those that do not fit 18 digits with 6 after the point have no
typed value but a normal form, text of sign, digits without zeros at either end, ``e`` and exponent.  Timestamps
are ISO 8601 dates (calendar or week dates, extended or basic), optionally followed by any one character, a time
(hours, minutes, seconds and a fraction, all but the hours optional, extended or basic) and an offset of hours, minutes and seconds; the
usual form ``yyyy-MM-dd[ T]HH:mm[:ss[.f]][offset]`` is read without the detour of the others.  Fractions are cut after six digits; offsets beyond 18 hours are invalid.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters regarded as white space at both ends of a text.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
TIDY = r"^[!-~](?s:.*[!-~])?$"
INTEGER = r"^[+-]?[0-9]+(_[0-9]+)*$"
DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
PLAIN_DECIMAL = r"^[+-]?[0-9]+(\.[0-9]{0,6}0*)?$"
TIMESTAMP = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"
)
# A time after its separator, with groups from n on: hours, colon, minutes, seconds, fraction, hours, colon, minutes, seconds of the offset.
_TIME = (
    r"(?:(?s:.)([0-9]{{2}})(?:(:?)([0-9]{{2}})(?:\{a}([0-9]{{2}}))?)?(?:[.,]([0-9]{{1,6}})[0-9]*)?"
    r"(?:(Z|[+-][0-9]{{2}})(?:(:?)([0-9]{{2}})(?:\{b}([0-9]{{2}}))?)?)?)?$"
)
CALENDAR = r"^([0-9]{4})(-?)([0-9]{2})\2([0-9]{2})" + _TIME.format(a=6, b=11)
#: Year, week, day of the week, and what follows.
WEEK = r"^([0-9]{4})(-?)W([0-9]{2})(?:\2([1-7]))?((?s:[^0-9-].*)?)$"


def _visible_ends(text: Column) -> Column:
    """The first and the last character are visible ASCII ones."""
    return F.substr(text, F.lit(1), F.lit(1)).between("!", "~") & F.substr(text, F.lit(-1), F.lit(1)).between("!", "~")


def stripped(name: str) -> Column:
    """The text without surrounding white space; null where nothing is left.

    Trimming with a set of characters is slow, so it is left out for texts that begin and end with
    a visible ASCII character, which nearly all do; comparing these two is several times faster than the pattern.
    """
    text = F.col(name)
    trimmed = F.btrim(text, F.lit(WHITESPACE))
    return F.when(_visible_ends(text), text).when(text.rlike(TIDY), text).when(trimmed != "", trimmed)


def int_value(text: Column) -> Column:
    """A cast reads signs and digits alone, once white space and control characters at the ends are ruled out; only other texts meet the pattern."""
    return F.coalesce(
        F.when(_visible_ends(text), text.try_cast("bigint")),
        F.when(text.rlike(INTEGER), F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint")))


def decimal_value(text: Column) -> Column:
    """Only texts with an exponent or digit groups take the longer way that proves nothing is rounded."""
    digits = F.replace(text, F.lit("_"), F.lit(""))
    narrow = digits.try_cast("decimal(18,6)")
    exact = normal_form(digits).eqNullSafe(normal_form(narrow.cast("string")))
    return F.when(text.rlike(PLAIN_DECIMAL), text.try_cast("decimal(18,6)")).when(digits.rlike(DECIMAL) & exact, narrow)


NUMBER = r"^[+-]?([0-9]*)[.]?([0-9]*)(?:[eE]([+-]?[0-9]+))?$"


def normal_form(text: Column) -> Column:
    """``-12e-7`` and the like for a decimal text without digit groups; null for zero and for exponents beyond 64 bits."""
    part = lambda k: F.regexp_extract(text, NUMBER, k)
    digits = F.ltrim(F.concat(part(1), part(2)), F.lit("0"))
    core = F.rtrim(digits, F.lit("0"))
    given = F.when(part(3) == "", F.lit(0).cast("bigint")).otherwise(F.ltrim(part(3), F.lit("+")).try_cast("bigint"))
    exponent = given - F.length(part(2)) + F.length(digits) - F.length(core)
    return F.when(core != "", F.concat(F.when(text.startswith("-"), "-").otherwise(""), core, F.lit("e"), exponent.cast("string")))


def wide_decimal(text: Column, typed: Column) -> Column:
    """Normal form of a decimal that ``typed`` does not hold; null for all others."""
    digits = F.replace(text, F.lit("_"), F.lit(""))
    return F.when(typed.isNull() & digits.rlike(DECIMAL), normal_form(digits))


def normal_product(normal: Column, factor: Column) -> Column:
    """Normal form times an integer, exact: in steps of nine digits from the right."""
    core, exponent = (F.regexp_extract(normal, r"^-?([0-9]+)e(.*)$", k) for k in (1, 2))
    number = lambda c: c.cast("decimal(38,0)")
    size, limb = F.length(core), F.lit(1_000_000_000).cast("decimal(10,0)")
    start = F.struct(number(F.lit(0)).alias("carry"), F.lit("").alias("out"))

    def step(state: Column, i: Column) -> Column:
        end = size - i * 9
        first = F.greatest(end - 8, F.lit(1))
        total = number(F.substr(core, first, end - first + 1).cast("decimal(9,0)") * F.abs(factor).cast("decimal(19,0)") + state["carry"])
        low = number(total % limb)
        return F.struct(number((total - low) / limb).alias("carry"), F.concat(F.lpad(low.cast("string"), 9, "0"), state["out"]).alias("out"))

    limbs = F.sequence(F.lit(0), F.ceil(size / 9).cast("int") - 1)
    digits = F.aggregate(limbs, start, step, lambda s: F.concat(s["carry"].cast("string"), s["out"]))
    minus = normal.startswith("-") != (factor < 0)
    return F.when(factor != 0, normal_form(F.concat(F.when(minus, "-").otherwise(""), digits, F.lit("e"), exponent)))


def _usual_form(text: Column) -> Column:
    """Another shape of a calendar date and time in the usual form, with the seconds and the offset filled in."""
    parts = F.regexp_replace(F.replace(text, F.lit("Z"), F.lit("+00")), F.lit(CALENDAR), F.lit("$1-$3-$4 $5:$7:$8.$90|$10:$12:$13"))
    zoned = F.replace(F.replace(parts, F.lit("|::"), F.lit("|+00::")), F.lit("|"), F.lit(""))
    filled = F.regexp_replace(zoned, F.lit(r"(?<=[ :])(?=[:.]|$)"), F.lit("00"))
    return F.replace(filled, F.lit("-00:00:00"), F.lit("+00:00:00"))


def _by_calendar(text: Column) -> Column:
    """A week date as the calendar date, with what follows; null where the year has no such week."""
    part = lambda k: F.regexp_extract(text, WEEK, k)
    year, week = part(1), part(3).cast("int")
    fourth = F.try_to_date(F.concat(year, F.lit("-01-04")))
    monday = F.date_add(fourth, (week - 1) * 7 - F.weekday(fourth))
    day = F.date_add(monday, F.coalesce(F.nullif(part(4), F.lit("")).cast("int"), F.lit(1)) - 1)
    there = (week > 0) & (F.year(F.date_add(monday, 3)) == year.cast("int"))
    return F.when(there, F.concat(day.cast("string"), part(5)))


def ts_value(text: Column) -> Column:
    """Instants; a text without an offset is UTC."""
    return F.coalesce(
        F.when(text.rlike(TIMESTAMP), text.try_cast("timestamp")),
        F.when(text.rlike(CALENDAR), _usual_form(text).try_cast("timestamp")),
        F.when(text.rlike(WEEK), _usual_form(_by_calendar(text)).try_cast("timestamp")),
    )


def parse_reason(name: str, kind: str, text: Column, typed: Column, required: bool = True) -> Column:
    """Why ``typed`` is null: blank text (if ``required``) or bad text."""
    bad = F.when(text.isNotNull() & typed.isNull(), F.lit(f"INVALID_{kind}_{name.upper()}"))
    return F.when(text.isNull(), F.lit(f"MISSING_REQUIRED_{name.upper()}")).otherwise(bad) if required else bad


def required_text(name: str) -> tuple[Column, Column]:
    text = stripped(name)
    return text, F.when(text.isNull(), F.lit(f"MISSING_REQUIRED_{name.upper()}"))


def parse_int(name: str, required: bool = True) -> tuple[Column, Column]:
    typed = int_value(stripped(name))
    return typed, parse_reason(name, "INTEGER", stripped(name), typed, required)


def parse_decimal(name: str) -> tuple[Column, Column]:
    """The typed value is null without a reason where only the normal form (``wide_decimal``) holds the number."""
    typed = decimal_value(stripped(name))
    held = F.coalesce(typed.isNotNull() | wide_decimal(stripped(name), typed).isNotNull(), F.lit(False))
    return typed, parse_reason(name, "DECIMAL", stripped(name), F.when(held, 1))


def parse_ts(name: str) -> tuple[Column, Column]:
    typed = ts_value(stripped(name))
    return typed, parse_reason(name, "TIMESTAMP", stripped(name), typed)


def positive(value: Column, reason: str) -> Column:
    return F.when(value <= 0, F.lit(reason))


def positive_amount(value: Column, wide: Column, reason: str) -> Column:
    return F.when((value <= 0) | wide.startswith("-"), F.lit(reason))


def allowed(value: Column, values: list[str], reason: str) -> Column:
    return F.when(~value.isin(values), F.lit(reason))


def ordered(earlier: Column, later: Column, reason: str) -> Column:
    return F.when(later < earlier, F.lit(reason))


def missing_ref(value: Column, reason: str) -> Column:
    return F.when(value.isNull(), F.lit(reason))


# array_except drops nulls and repeats, keeps the order, and stays in generated code, which
# array_compact and other lambda-based functions do not.
def _compact(found: Column) -> Column:
    return F.array_except(found, F.array(F.lit(None).cast("string")))


def reasons(*found: Column) -> Column:
    """Ordered, duplicate-free list of the reasons that apply."""
    return _compact(F.array(*found))


def more_reasons(existing: Column, *found: Column) -> Column:
    return _compact(F.concat(existing, F.array(*found)))


def utc_iso(value: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.ffffff+00:00`` in a UTC session."""
    return F.concat(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))

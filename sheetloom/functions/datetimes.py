"""Decoding of the date encodings found in sheets.

Everything works on zone-less timestamps (``TIMESTAMP_NTZ``), so the session time zone never
changes a result.
"""

from __future__ import annotations

import datetime
import functools

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.functions.numbers import WHOLE_NUMBER, safe_double
from sheetloom.functions.text import WHITESPACE, WHITESPACE_RUN, let, strip

# The magnitude of a number tells its unit.
NANOSECONDS_FROM = 1e17
MICROSECONDS_FROM = 1e14
MILLISECONDS_FROM = 1e11
SECONDS_FROM = 1e8
# Fixed value: spreadsheet day 0 is 1899-12-30, this many days before 1970-01-01.
SERIAL_EPOCH_DAYS = 25569
# Whole numbers below this are exact in a double.
EXACT_IN_DOUBLE = 2.0**53
# Fixed value: range of a 64-bit nanosecond clock, in microseconds.
CLOCK_LIMIT = 9223372036854775
FIRST_INSTANT = "timestamp_ntz'1677-09-21 00:12:43.145225'"
LAST_INSTANT = "timestamp_ntz'2262-04-11 23:47:16.854775'"

# Month and day names.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
MONTH_NAME = (
    "^(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    "sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)$"
)
DAY_NAME = (
    "(?<![a-z])(?:mon(?:day)?|tue(?:s|sday)?|wed(?:nesday)?|thu(?:r|rs|rsday)?|"
    "fri(?:day)?|sat(?:urday)?|sun(?:day)?)(?![a-z])"
)
ZONE = (
    "(?: ?(?:z|utc|gmt|ist|bst|cet|est|edt|cst|cdt|mst|mdt|pst|pdt)(?![a-z])(?:[+-][0-9]{1,2})?"
    "| ?[+-][0-9]{2}(?::?[0-9]{2})?)?"
)
CLOCK = (
    "(?<![0-9])([0-9]{1,2}):([0-9]{1,2})(?::([0-9]{1,2})(?:\\.([0-9]*)|,[0-9]*)?)?"
    "(?: ?([ap])(?:\\.?m\\.?)?(?![a-z]))?" + ZONE
)
HOUR_ONLY = "(?<![0-9])([0-9]{1,2}) ?([ap])m(?![a-z])"
# A year-first date this regular is month-then-day; any other year-first text is day-then-month.
ISO_LIKE = (
    "^[" + WHITESPACE + "]*[0-9]{4}([-/. ])[0-9]{1,2}\\1[0-9]{1,2}"
    "(?:[ Tt][0-9]{1,2}(?::?[0-9]{1,2})?(?::?[0-9]{1,2}(?:\\.[0-9]*)?)?(?: ?(?:[Zz]|[+-][0-9]{2}(?::?[0-9]{2})?))?)?$"
)


def _micros_to_timestamp(micros: Column) -> Column:
    in_range = F.when(micros.between(-CLOCK_LIMIT, CLOCK_LIMIT), micros)
    return F.timestamp_add("MICROSECOND", in_range, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def _whole_part(text: Column, value: Column) -> Column:
    """The number without its fraction, exact even where a double is not."""
    exact = F.when(text.rlike(WHOLE_NUMBER), F.trim(text).try_cast("bigint"))
    return F.coalesce(exact, value.try_cast("bigint"))


def _fraction(value: Column, base: Column) -> Column:
    return F.when(F.abs(value) < EXACT_IN_DOUBLE, value - base).otherwise(0.0)


def _numeric_micros(size: Column, base: Column, fraction: Column) -> Column:
    """Microseconds since 1970 of a number of magnitude ``size``, which tells its unit."""

    def scaled(per_unit: int, digits: int) -> Column:
        nanos = F.rint(fraction * (10.0**digits))
        return base * per_unit + F.floor(nanos / 1000)

    # part of a day, cut to the nanosecond and rounded half-even to the second
    second_of_day = F.rint(F.floor(F.abs(fraction) * 86400e9) / 1e9) * F.signum(fraction)
    serial = (base - SERIAL_EPOCH_DAYS) * 86400 + second_of_day.cast("bigint")
    # division cuts towards zero, the clock towards the past
    before_1970 = F.when((base < 0) & (base % 1000 != 0), 1).otherwise(0)
    return (
        F.when(size < SECONDS_FROM, serial * 1_000_000)
        .when(size < MILLISECONDS_FROM, scaled(1_000_000, 9))
        .when(size < MICROSECONDS_FROM, scaled(1_000, 6))
        .when(size < NANOSECONDS_FROM, scaled(1, 3))
        .otherwise(F.call_function("div", base, F.lit(1000)) - before_1970)
    )


def _text_timestamp(source: Column, pivot: int) -> Column:
    """A date text, day first, in any of the usual spellings; NULL if it is none."""
    lead = "^([0-9]{4}[^0-9a-z][0-9]{1,2}[^0-9a-z][0-9]{1,2}|[0-9]{8})[t ]"
    text = F.lower(F.regexp_replace(strip(source), WHITESPACE_RUN, " "))
    # one spelling for the gap between date and clock, and for a clock without colons
    text = F.regexp_replace(text, lead + "([0-9]{2})([0-9]{2})([0-9]{2})$", "$1 $2:$3:$4")
    text = F.regexp_replace(text, lead + "([0-9]{2})([0-9]{2})$", "$1 $2:$3")
    text = F.regexp_replace(text, lead + "([0-9]{2})$", "$1 $2:00")
    text = F.regexp_replace(text, "(?<=[0-9])t(?=[0-9])", " ")

    def parse(t: Column) -> Column:
        return let(_tokens(t), lambda p: let(_date_parts(p, source, pivot), lambda d: _join_clock(d, t)))

    return F.when(source.rlike("[0-9]"), let(text, parse))


def _tokens(text: Column) -> Column:
    """The date's words and numbers, without clock, zone, day name and filler words."""
    date = F.regexp_replace(F.regexp_replace(text, CLOCK, " "), HOUR_ONLY, " ")
    date = F.regexp_replace(
        date,
        "(?<=[0-9])(?:st|nd|rd|th)(?![a-z])|" + DAY_NAME + "|(?<![a-z])(?:of|at|and)(?![a-z])|[ ,./;'-]+",
        " ",
    )
    date = F.regexp_replace(date, "(?<=[0-9])(?=[a-z])|(?<=[a-z])(?=[0-9])| +", " ")
    words = F.split(F.trim(date), " +")
    month = lambda w: F.floor((F.position(F.left(w, F.lit(3)), F.lit(MONTHS)) + 2) / 3)
    return F.transform(
        words,
        lambda w: F.struct(
            w.alias("word"),
            F.length(w).alias("width"),
            F.when(w.rlike("^[0-9]{1,4}$"), w.try_cast("int")).alias("number"),
            F.when(w.rlike(MONTH_NAME), month(w).cast("int")).alias("month"),
        ),
    )


def _date_parts(tokens: Column, source: Column, pivot: int) -> Column:
    """Year, month and day from one, two or three tokens."""
    n = F.size(tokens)
    token = [F.get(tokens, F.lit(i)) for i in range(3)]
    number = [x["number"] for x in token]
    month = [x["month"] for x in token]
    long_year = [x["width"] == 4 for x in token]
    short_year = [x["width"] <= 2 for x in token]
    century = pivot - pivot % 100

    def year(i: int) -> Column:
        near = number[i] + century
        two_digits = F.when(near >= pivot, near - 100).otherwise(near)
        return F.when(long_year[i], number[i]).when(short_year[i], two_digits)

    def date(y: Column, m: Column, d: Column) -> Column:
        return F.struct(y.alias("y"), m.alias("m"), d.alias("d"))

    first_of_month = F.lit(1)
    numbers = number[0].isNotNull() & number[1].isNotNull() & number[2].isNotNull()
    year_first = long_year[0] | (short_year[0] & (number[0] > 31))
    month_second = (source.rlike(ISO_LIKE) & (number[1] <= 12)) | (number[2] > 12)
    compact = token[0]["word"]
    three = (
        F.when(numbers & year_first & month_second, date(year(0), number[1], number[2]))
        .when(numbers & year_first, date(year(0), number[2], number[1]))
        .when(numbers & (number[1] > 12), date(year(2), number[0], number[1]))
        .when(numbers, date(year(2), number[1], number[0]))
        .when(month[1].isNotNull() & long_year[0], date(year(0), month[1], number[2]))
        .when(month[1].isNotNull(), date(year(2), month[1], number[0]))
        .when(month[0].isNotNull() & long_year[1], date(year(1), month[0], number[2]))
        .when(month[0].isNotNull(), date(year(2), month[0], number[1]))
    )
    two = F.when(long_year[1], date(number[1], F.coalesce(month[0], number[0]), first_of_month)).when(
        long_year[0], date(number[0], F.coalesce(month[1], number[1]), first_of_month)
    )
    one = F.when(
        compact.rlike("^[0-9]{8}$"),
        date(
            F.substring(compact, 1, 4).try_cast("int"),
            F.substring(compact, 5, 2).try_cast("int"),
            F.substring(compact, 7, 2).try_cast("int"),
        ),
    )
    return F.when(n == 3, three).when(n == 2, two).when(n == 1, one)


def _join_clock(date: Column, text: Column) -> Column:
    """Date parts and the clock in ``text`` -> timestamp; NULL if either is impossible."""

    def clock(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))

    half = F.coalesce(clock(CLOCK, 5), clock(HOUR_ONLY, 2))
    hour = F.coalesce(clock(CLOCK, 1), clock(HOUR_ONLY, 1), F.lit("0")).try_cast("int")
    hour_of_day = F.when(half.isNull(), hour).when(
        hour <= 12, hour % 12 + F.when(half == "p", 12).otherwise(0)
    )
    fraction = F.coalesce(F.left(clock(CLOCK, 4), F.lit(6)), F.lit("0"))
    second = F.concat(F.coalesce(clock(CLOCK, 3), F.lit("0")), F.lit("."), fraction).try_cast("decimal(16,6)")
    stamp = F.try_make_timestamp_ntz(
        date["y"],
        date["m"],
        date["d"],
        hour_of_day,
        F.coalesce(clock(CLOCK, 2).try_cast("int"), F.lit(0)),
        F.when(second < 60, second),
    )
    return F.when(stamp.between(F.expr(FIRST_INSTANT), F.expr(LAST_INSTANT)), stamp)


def _pivot(year: int | None) -> int:
    return year if year is not None else datetime.date.today().year + 50


def normalize_datetime(c: Column, pivot_year: int | None = None) -> Column:
    """Decode a date text column into a zone-less timestamp.

    Numbers are nanoseconds, microseconds, milliseconds, seconds or a spreadsheet day by
    magnitude. Anything else is read as a date text, day first; a month above 12 is taken as the
    day. Unreadable values are NULL. A zone is dropped and the wall clock kept. A two-digit year
    falls within the century below ``pivot_year`` (default: 50 years from now).
    """

    def stamp(value: Column) -> Column:
        micros = let(
            _whole_part(c, value),
            lambda base: let(_fraction(value, base), lambda part: _numeric_micros(F.abs(value), base, part)),
        )
        return _micros_to_timestamp(micros)

    number = safe_double(c)
    from_text = F.when(number.isNull(), _text_timestamp(c, _pivot(pivot_year)))
    return F.coalesce(let(number, stamp), from_text)


@functools.lru_cache(maxsize=64)
def _text_timestamp_of(column: str, pivot: int, _jvm: int) -> Column:
    """:func:`_text_timestamp` of a named column, built once: it is by far the widest expression."""
    return _text_timestamp(F.col(column), pivot)


def with_datetime(df: DataFrame, column: str, pivot_year: int | None = None) -> DataFrame:
    """:func:`normalize_datetime` of a column in place, for whole tables.

    The steps are columns of their own, so each is computed once and compiles to little code with
    the rest of the stage. Only rows that are not numbers reach the text rules.
    """
    value, base, part, stamp = (f"__{column}_{step}" for step in ("value", "base", "part", "stamp"))
    text = F.col(column)
    df = df.withColumn(value, safe_double(text))
    df = df.withColumn(base, _whole_part(text, F.col(value)))
    df = df.withColumn(part, _fraction(F.col(value), F.col(base)))
    micros = _numeric_micros(F.abs(value), F.col(base), F.col(part))
    df = df.withColumn(stamp, _micros_to_timestamp(micros))
    text_stamp = _text_timestamp_of(column, _pivot(pivot_year), id(SparkContext._jvm))
    from_text = F.when(F.col(value).isNull(), text_stamp)
    return df.withColumn(column, F.coalesce(stamp, from_text)).drop(value, base, part, stamp)


def datetime_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.ffffff`` of a zone-less timestamp."""
    text = c.cast("string")
    return F.rpad(F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text), 26, "0")


def second_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; the fraction is cut."""
    return F.substring(c.cast("string"), 1, 19)

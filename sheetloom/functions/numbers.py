"""Number decoding from sheet text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed patterns: what counts as a number.
NUMBER = r"^[ \t\n\x0b\f\r]*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[ \t\n\x0b\f\r]*$"
WHOLE_NUMBER = r"^[ \t\n\x0b\f\r]*[+-]?[0-9]{1,30}[ \t\n\x0b\f\r]*$"
INFINITY = r"(?i)^[+-]?inf(?:inity)?$"


def safe_double(c: Column) -> Column:
    """DOUBLE or NULL. ``'1,000'``, ``'1d'`` and ``'0x1A'`` are not numbers.

    A landed check box (``true`` / ``false``) counts as 1 / 0. A literal too large for a double
    is NULL rather than infinite.
    """
    value = c.try_cast("double")
    finite = F.when(F.abs(value) != float("inf"), value)
    return (
        F.when(c.rlike(NUMBER), finite)
        .when(c == "true", 1.0)
        .when(c == "false", 0.0)
        .when(c.rlike(INFINITY), F.when(c.startswith("-"), float("-inf")).otherwise(float("inf")))
    )


def safe_integer(c: Column) -> Column:
    """BIGINT of a whole number (``'41.0'`` -> 41); fractions and text are NULL."""
    value = safe_double(c)
    return F.when(c.rlike(WHOLE_NUMBER), F.trim(c, F.lit(" \t\n\x0b\f\r")).try_cast("bigint")).when(
        value % 1 == 0, value.try_cast("bigint")
    )


def double_text(c: Column) -> Column:
    """Shortest decimal text of a double, always with a fraction: ``499.0``, ``1e+16``, ``1e-05``."""
    size = F.abs(c)
    java = c.cast("string")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    exponent = F.substring_index(java, "E", -1).try_cast("int")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.lpad(F.abs(exponent).cast("string"), 2, "0"),
    )
    return (
        F.when(F.isnan(c), F.lit(None).cast("string"))
        .when(size == float("inf"), F.when(c > 0, "inf").otherwise("-inf"))
        .when((size < 1e7) & (size >= 1e-3) | (size == 0), java)
        .when((size >= 1e16) | (size < 1e-4), scientific)
        .otherwise(F.call_function("format_number", c, F.lit("0.0####################")))
    )

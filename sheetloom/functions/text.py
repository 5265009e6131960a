"""Text cleaning expressions. All are built-in Catalyst expressions; none needs a Python worker."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The characters that count as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as a pattern.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# Tick words.
TRUE_WORDS = ("true", "yes", "y", "1", "✓", "✔", "☑")
FALSE_WORDS = ("false", "no", "n", "0", "☐")
TICK_WORDS = TRUE_WORDS + FALSE_WORDS

# Fixed pattern: the id inside a spreadsheet address.
SPREADSHEET_ID = "/spreadsheets/d/([a-zA-Z0-9_-]+)"


def strip(c: Column) -> Column:
    """Remove white space, Unicode kinds included, from both ends."""
    return F.trim(c, F.lit(WHITESPACE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_to_null(c: Column) -> Column:
    """NULL for a white-space-only value; any other value is kept unchanged."""
    return F.when(strip(c) != "", c)


def strip_to_null(c: Column) -> Column:
    """:func:`strip` and :func:`blank_to_null` in one step."""
    return F.nullif(strip(c), F.lit(""))


def clean_text(c: Column) -> Column:
    """Collapse white space to single spaces and trim; NULL becomes the empty string."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), WHITESPACE_RUN, " "))


def header_key(c: Column) -> Column:
    """``'ACCESS - GOLD'`` -> ``'access gold'``."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def snake_case(c: Column) -> Column:
    """``'PH NO.'`` -> ``'ph_no'``."""
    return F.replace(header_key(c), F.lit(" "), F.lit("_"))


def is_tick_text(c: Column) -> Column:
    return F.lower(c).isin(*TICK_WORDS)


def to_bool(c: Column) -> Column:
    """True for a tick word, false for anything else, blank and NULL included."""
    return F.lower(clean_text(c)).isin(*TRUE_WORDS)


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter: ``mary-jane`` -> ``Mary-Jane``.

    ``initcap`` only starts a word after a space, so a removable space is put before each such
    letter first.
    """
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    opened = F.regexp_replace(c, f"(?<=[^{cased} ])(?=[{cased}])", "\x01 ")
    return F.replace(F.initcap(opened), F.lit("\x01 "), F.lit(""))


def clean_email(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit(""))


def clean_mobile(c: Column) -> Column:
    """Keep digits and ``+``."""
    return F.regexp_replace(c, r"[^\p{Nd}+]", "")


def digit_count(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{Nd}]", ""))


def spreadsheet_id(c: Column) -> Column:
    """The id inside a spreadsheet address; any other value is taken as the id itself."""
    return F.coalesce(F.nullif(F.regexp_extract(c, SPREADSHEET_ID, 1), F.lit("")), strip(c))


def client_status(status: Column, section: Column) -> Column:
    text = F.upper(F.concat_ws(" ", F.coalesce(status, F.lit("")), F.coalesce(section, F.lit(""))))
    return (
        F.when(text.contains("DEACTIVAT"), "Deactivated")
        .when(text.contains("REFUND"), "Refund")
        .otherwise("Active")
    )

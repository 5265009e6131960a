"""Header text rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sheetloom.functions.text import header_key, let, strip


def normalize_headers(headers: Column) -> Column:
    """``ARRAY<STRING>`` of raw headers -> unique snake_case names, position by position.

    A blank header becomes ``column_{position}``; a repeated name gets the first free suffix
    ``_2``, ``_3``, ...
    """

    def base(cell: Column, index: Column) -> Column:
        words = F.regexp_replace(F.lower(strip(F.coalesce(cell, F.lit("")))), "[^a-z0-9]+", "_")
        name = F.nullif(F.trim(words, F.lit("_")), F.lit(""))
        return F.coalesce(name, F.concat(F.lit("column_"), (index + 1).cast("string")))

    def free_name(taken: Column, name: Column) -> Column:
        suffixed = F.transform(
            F.sequence(F.lit(2), F.size(taken) + 2),
            lambda k: F.concat(name, F.lit("_"), k.cast("string")),
        )
        unused = F.filter(suffixed, lambda n: ~F.array_contains(taken, n))
        return F.when(F.array_contains(taken, name), F.get(unused, F.lit(0))).otherwise(name)

    return F.aggregate(
        F.transform(headers, base),
        F.array().cast("array<string>"),
        lambda taken, name: F.concat(taken, F.array(free_name(taken, name))),
    )


def canonical_header(text: Column) -> Column:
    """Free tracker header text -> one of the fixed column names, or NULL.

    Fixed rules, first match wins.
    """
    return let(header_key(text), _canonical_of_key)


def _canonical_of_key(key: Column) -> Column:
    words = F.concat(F.lit(" "), key, F.lit(" "))

    def word(*any_of: str) -> Column:
        found = words.contains(f" {any_of[0]} ")
        for other in any_of[1:]:
            found = found | words.contains(f" {other} ")
        return found

    return (
        F.when(word("status") & word("data"), "status_data")
        .when(word("status"), "status")
        .when(key.contains("email") | word("mail"), "email")
        .when(
            key.startswith("ph")
            | key.contains("phone")
            | key.contains("mobile")
            | word("contact")
            | key.contains("whatsapp"),
            "mobile",
        )
        .when(key.contains("coach"), "coach")
        .when(word("tech"), "tech_member")
        .when(key.contains("comment") | key.contains("remark"), "comment")
        .when(word("silver"), "access_silver_lifetime")
        .when(
            word("gold") & (key.contains("lifetime") | key.contains("life time")),
            "access_gold_pro_lifetime",
        )
        .when(word("gold"), "access_gold_pro")
        .when(word("name", "names"), "name")
    )

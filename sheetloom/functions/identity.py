"""Record identity and content hash."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sheetloom.functions.datetimes import second_text
from sheetloom.functions.numbers import double_text
from sheetloom.spec import IDENTITY_COLUMNS, DatasetSpec

# What a missing value contributes to the identity text.
MISSING_EMAIL = "<na>"
MISSING_MOBILE = "<NA>"


def record_id(email: Column, mobile: Column, date: Column) -> Column:
    """SHA-256 of ``email|mobile|date``; ``date`` is a zone-less timestamp, cut to the second.

    The texts are expected trimmed, as they are after cleaning.
    """
    return F.sha2(
        F.concat_ws(
            "|",
            F.coalesce(F.lower(email), F.lit(MISSING_EMAIL)),
            F.coalesce(mobile, F.lit(MISSING_MOBILE)),
            F.coalesce(second_text(date), F.lit("")),
        ),
        256,
    )


def row_hash(spec: DatasetSpec) -> Column:
    """SHA-256 of ``column=value`` pairs in column-name order, lineage included.

    The texts are expected trimmed, as they are after cleaning.
    """
    kinds = {f.name: f.dataType.typeName() for f in spec.typed_schema}

    def text(name: str) -> Column:
        c = F.col(name)
        kind = kinds[name]
        if kind == "timestamp_ntz":
            return second_text(c)
        if kind == "double":
            return double_text(c)
        return c if kind == "string" else c.cast("string")

    hashed = sorted(c for c in spec.columns if c not in IDENTITY_COLUMNS)
    parts = []
    for separator, c in zip([""] + ["|"] * len(hashed), hashed):
        parts += [F.lit(f"{separator}{c}="), F.coalesce(text(c), F.lit(""))]
    return F.sha2(F.concat(*parts), 256)

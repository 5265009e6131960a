"""From ragged rows to declared, typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sheetloom.functions.cells import cell_number, cell_text, has_typed_cells
from sheetloom.functions.datetimes import datetime_text, with_datetime
from sheetloom.functions.numbers import safe_double, safe_integer
from sheetloom.functions.text import blank_to_null, strip, strip_to_null
from sheetloom.spec import DatasetSpec


def rectangular_cells(cells: Column, headers: Column) -> Column:
    """Cells cut, or padded with empty text, to the width of the header."""
    return F.transform(headers, lambda _, i: F.coalesce(F.get(cells, i), F.lit("")))


def named_cells(cells: Column, headers: Column) -> Column:
    """One row as ``MAP<header, cell>``."""
    return F.map_from_arrays(headers, rectangular_cells(cells, headers))


def number_rows(chunks: DataFrame, values: str = "values", start: str = "start_row") -> DataFrame:
    """Chunks of consecutive rows -> one row each, numbered from the chunk's first row."""
    rest = [c for c in chunks.columns if c not in (values, start)]
    exploded = chunks.select(*rest, start, F.posexplode(values).alias("__offset", "cells"))
    return exploded.select(*rest, (F.col(start) + F.col("__offset")).cast("long").alias("source_row"), "cells")


def project_declared(rows: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Declared columns as text, from ``cells`` and the ``at_*`` positions of the row's tab.

    Undeclared and dropped columns are never materialised; a declared column the tab lacks is
    NULL. Typed cells become text by the kind of their column.
    """
    typed = has_typed_cells(rows)
    as_text = lambda kind: cell_text if kind == "text" else cell_number
    cells = [as_text(kind)(F.get("cells", F.col(f"at_{c}")), typed).alias(c) for c, kind in spec.business]
    rest = [c for c in rows.columns if c != "cells" and not c.startswith("at_")]
    return rows.select(*cells, *rest)


def drop_columns(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Drop the dataset's unwanted columns; missing ones are ignored."""
    return df.drop(*spec.dropped)


def blanks_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """White-space-only values become NULL; other values are kept as they are."""
    return df.withColumns({c: blank_to_null(F.col(c)) for c in columns})


def drop_blank_rows(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Drop rows whose declared business columns are all NULL or white space.

    Nearly every row is kept for its first column; the others are only looked at, in one go, where
    that one is blank.
    """
    first, *others = [F.col(c) for c in spec.business_columns if c in df.columns]
    rest = strip(F.concat_ws("", *(c.cast("string") for c in others)))
    return df.where(F.coalesce(strip_to_null(first), F.nullif(rest, F.lit(""))).isNotNull())


def add_missing_columns(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    missing = [f for f in spec.typed_schema if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


def trim_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: strip(F.col(c)) for c in columns})


def decode_dates(df: DataFrame, spec: DatasetSpec, pivot_year: int | None = None) -> DataFrame:
    """Date text columns become zone-less timestamps."""
    for c in spec.of_kind("datetime"):
        df = with_datetime(df, c, pivot_year)
    return df


def number_columns(spec: DatasetSpec) -> dict[str, Column]:
    """Expressions for the whole-number and double columns."""
    whole = {c: safe_integer(F.col(c)) for c in spec.of_kind("integer")}
    return whole | {c: safe_double(F.col(c)) for c in spec.of_kind("double")}


def conform_schema(df: DataFrame, spec: DatasetSpec, stripped: bool = False) -> DataFrame:
    """Exactly the declared columns, in order, with the types of the stored target.

    Dates, still timestamps, become text; date text is decoded first so that any accepted
    spelling is stored the same way. ``stripped``: text columns have no white space at their ends, as after cleaning.
    """
    df = add_missing_columns(df, spec)
    dates = spec.of_kind("datetime") + ("ingested_at_utc",)
    for c in dates:
        if isinstance(df.schema[c].dataType, T.StringType):
            df = with_datetime(df, c)
    types = {f.name: f.dataType for f in df.schema}

    def stored(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(types[field.name], T.TimestampNTZType):
            c = datetime_text(c)
        elif isinstance(types[field.name], T.StringType) and isinstance(field.dataType, T.LongType):
            c = safe_integer(c)
        elif isinstance(types[field.name], T.StringType) and isinstance(field.dataType, T.DoubleType):
            c = safe_double(c)
        elif isinstance(field.dataType, T.StringType):
            c = c if stripped and isinstance(types[field.name], T.StringType) else strip(c.cast("string"))
        return c.cast(field.dataType).alias(field.name)

    return df.select(*(stored(f) for f in spec.stored_schema))

"""Choosing tabs and describing them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.functions.cells import cell_text, cell_texts, has_typed_cells
from sheetloom.functions.headers import normalize_headers
from sheetloom.functions.text import strip
from sheetloom.operators.lookup import DEFAULT_LIMITS, LookupLimits, lookup_join, require_unique
from sheetloom.spec import TAB_KEYS, DatasetSpec

KEYS = list(TAB_KEYS)


def filter_tabs(rows: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows of tabs whose name contains the dataset's token, ignoring case."""
    return rows.where(F.lower("source_sheet").contains(spec.tab_token))


def list_tabs(rows: DataFrame) -> DataFrame:
    """One row per tab."""
    return rows.select("source_spreadsheet", "source_sheet", "tab_ord").distinct()


def _tab_name_key(c: Column) -> Column:
    return F.lower(strip(c))


def select_tabs_named(rows: DataFrame, requested: Sequence[str], available: DataFrame | None = None) -> DataFrame:
    """Rows of the requested tabs; names are compared trimmed and without case.

    ``tab_ord`` becomes the position in the request, so that tabs, and the columns they bring, follow in the order asked
    for; a name asked for twice counts where it stands first. ``available`` lists the tabs (default: taken from ``rows``). An
    unknown name is an error.
    """
    wanted = [name.strip().lower() for name in requested]
    known = list_tabs(rows) if available is None else available
    found = {
        r[0]
        for r in known.select(_tab_name_key(F.col("source_sheet")).alias("k"))
        .where(F.col("k").isin(wanted))
        .distinct()
        .collect()
    }
    unknown = [name for name, key in zip(requested, wanted) if key not in found]
    if unknown:
        raise ValueError(f"tab not found: {', '.join(unknown)}")
    key = _tab_name_key(F.col("source_sheet"))
    place = F.array_position(F.array(*map(F.lit, wanted)), key) - 1
    return rows.where(key.isin(wanted)).withColumn("tab_ord", place.cast("int"))


def select_tabs_all(rows: DataFrame) -> DataFrame:
    """Rows of every tab."""
    return rows


def with_workbook_title(rows: DataFrame, titles: DataFrame, limits: LookupLimits = DEFAULT_LIMITS) -> DataFrame:
    """Set ``source_workbook`` from ``titles(source_spreadsheet, title)``, or to the id. Two titles of one id are an error."""
    known = require_unique(titles.select("source_spreadsheet", "title"), ["source_spreadsheet"])
    titled = lookup_join(rows.drop("source_workbook"), known, ["source_spreadsheet"], "left", limits=limits)
    name = F.coalesce("title", "source_spreadsheet")
    return titled.select(name.alias("source_workbook"), *(c for c in titled.columns if c != "title"))


def tab_row_count(rows: DataFrame) -> DataFrame:
    """Used rows per tab: the last row with a value in column A, 0 if there is none."""
    first = cell_text(F.get("cells", F.lit(0)), has_typed_cells(rows))
    used = F.max(F.when(first != "", F.col("source_row")))
    return rows.groupBy(*KEYS).agg(F.coalesce(used, F.lit(0)).cast("long").alias("n_rows"))


def tab_headers(rows: DataFrame, width: int | None = None) -> DataFrame:
    """Normalised headers (row 1) of each tab that has any, of the first ``width`` columns; one row per tab.

    A tab landed twice has its first row twice: the one landed last counts, by its content if that is not known.
    """
    cells = cell_texts(F.col("cells") if width is None else F.slice("cells", 1, width), has_typed_cells(rows))
    first = rows.where((F.col("source_row") == 1) & (F.size("cells") > 0))
    first = first.withColumn("cells", cells)
    newest = F.struct(*(c for c in ("landed_seq",) if c in rows.columns), "cells")
    once = first.groupBy(*KEYS).agg(F.max_by("cells", newest).alias("cells"))
    return once.select(*KEYS, normalize_headers(F.col("cells")).alias("headers"))


def header_positions(headers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Where each declared column sits in its tab: one 0-based position column ``at_{name}``."""
    position = lambda c: F.nullif(F.array_position("headers", c), F.lit(0).cast("long")) - 1
    return headers.select(*KEYS, *(position(c).cast("int").alias(f"at_{c}") for c in columns))

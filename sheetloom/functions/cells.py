"""Cells that keep their type.

Raw rows hold their cells as text (``ARRAY<STRING>``: a check box is landed as ``true``) or typed (``ARRAY<VARIANT>``:
number, check box and text stay apart). Typed cells become text when they are put into a column, by the kind of the column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def has_typed_cells(rows: DataFrame) -> bool:
    """Are the cells of raw rows typed?"""
    return isinstance(rows.schema["cells"].dataType.elementType, T.VariantType)


def _is_box(cell: Column) -> Column:
    return F.schema_of_variant(cell) == "BOOLEAN"


def cell_text(cell: Column, typed: bool) -> Column:
    """A cell as text. A check box is ``True`` or ``False``, a whole number has no fraction."""
    if not typed:
        return cell
    text = F.variant_get(cell, "$", "string")
    return F.when(_is_box(cell), F.initcap(text)).otherwise(text)


def cell_number(cell: Column, typed: bool) -> Column:
    """A cell of a number or date column as text to decode. A check box is 1 or 0; the words ``true`` and ``false`` are no numbers."""
    if not typed:
        return cell
    text = F.variant_get(cell, "$", "string")
    box = F.when(text == "true", "1").otherwise("0")
    return F.when(_is_box(cell), box).when(~text.isin("true", "false"), text)


def cell_texts(cells: Column, typed: bool) -> Column:
    """All cells as text."""
    return F.transform(cells, lambda c: cell_text(c, True)) if typed else cells

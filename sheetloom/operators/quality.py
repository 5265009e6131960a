"""Counts and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from sheetloom.spec import DatasetSpec


class ValidationError(ValueError):
    """A table must not be published."""


def row_counts(rows: DataFrame) -> DataFrame:
    """Rows per tab."""
    return rows.groupBy("source_spreadsheet", "source_sheet").agg(F.count(F.lit(1)).alias("n"))


def status_counts(clients: DataFrame) -> DataFrame:
    """Rows per client status."""
    return clients.groupBy("client_status").agg(F.count(F.lit(1)).alias("n"))


def validation_report(df: DataFrame) -> DataFrame:
    """One row: number of rows and of rows without a ``record_id``."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("record_id").isNull()).alias("n_null_ids"),
    )


def check_columns(df: DataFrame, spec: DatasetSpec, name: str = "table", stored: bool = False) -> None:
    """Raise :class:`ValidationError` unless ``df`` has the columns and types to be published.

    ``stored``: the dates of ``df`` are already text.
    """
    types = {f.name: f.dataType for f in df.schema}
    missing = [c for c in spec.columns if c not in types]
    if missing:
        raise ValidationError(f"{name} lacks columns: {missing}")
    wanted = T.StringType() if stored else T.TimestampNTZType()
    for c in (spec.date_column, "ingested_at_utc"):
        if types[c] != wanted:
            raise ValidationError(f"{name}: {c} must be {wanted.simpleString()}")


def check_counts(n_rows: int, n_null_ids: int, name: str = "table") -> None:
    """Raise :class:`ValidationError` for an empty table, or one with rows without a ``record_id``."""
    if n_rows == 0:
        raise ValidationError(f"{name} is empty")
    if n_null_ids:
        raise ValidationError(f"{name}: {n_null_ids} rows without record_id")


def validate(df: DataFrame, spec: DatasetSpec, name: str = "table", stored: bool = False) -> int:
    """Raise :class:`ValidationError` unless ``df`` may be published; return its row count.

    ``stored``: the dates of ``df`` are already text.
    """
    check_columns(df, spec, name, stored)
    report = validation_report(df).first()
    check_counts(report["n_rows"], report["n_null_ids"], name)
    return report["n_rows"]

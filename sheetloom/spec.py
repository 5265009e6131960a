"""What distinguishes one intake dataset from another."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Lineage and identity columns shared by every dataset.
LINEAGE_COLUMNS = ("source_workbook", "source_spreadsheet", "source_sheet", "source_row")
IDENTITY_COLUMNS = ("record_id", "row_hash", "ingested_at_utc")

# A row's place in the source: "last" always means the largest of these, in this order. The time a row was
# landed decides between landings of the same sheet row.
ORDER_COLUMNS = ("workbook_ord", "tab_ord", "source_row", "landed_seq")
TAB_KEYS = ("source_spreadsheet", "source_sheet")

RAW_SCHEMA = T.StructType(
    [
        T.StructField("source_workbook", T.StringType()),
        T.StructField("source_spreadsheet", T.StringType()),
        T.StructField("source_sheet", T.StringType()),
        T.StructField("workbook_ord", T.IntegerType()),
        T.StructField("tab_ord", T.IntegerType()),
        T.StructField("source_row", T.LongType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
    ]
)
# The same with cells that keep their type.
TYPED_RAW_SCHEMA = T.StructType([*RAW_SCHEMA.fields[:-1], T.StructField("cells", T.ArrayType(T.VariantType()))])


@dataclass(frozen=True)
class DatasetSpec:
    """Declared shape of a dataset.

    ``business`` maps each declared column to its kind: ``text``, ``integer``, ``double``,
    or ``datetime`` (decoded while processing, stored as text). Sheets are read from column A up to
    column number ``read_width`` (L); None reads every column.
    """

    name: str
    tab_token: str
    business: tuple[tuple[str, str], ...]
    date_column: str
    dropped: tuple[str, ...] = ()
    workbooks: tuple[str, ...] = ()
    read_width: int | None = 12

    def with_workbooks(self, *ids: str) -> "DatasetSpec":
        """The same dataset over these workbook ids, in loading order."""
        return replace(self, workbooks=tuple(ids))

    @property
    def business_columns(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.business)

    @property
    def columns(self) -> tuple[str, ...]:
        return self.business_columns + LINEAGE_COLUMNS + IDENTITY_COLUMNS

    def of_kind(self, *kinds: str) -> tuple[str, ...]:
        return tuple(name for name, kind in self.business if kind in kinds)

    def _type(self, column: str, stored: bool) -> T.DataType:
        kind = dict(self.business).get(column)
        if kind == "integer" or column == "source_row":
            return T.LongType()
        if kind == "double":
            return T.DoubleType()
        if not stored and (kind == "datetime" or column == "ingested_at_utc"):
            return T.TimestampNTZType()
        return T.StringType()

    @property
    def stored_schema(self) -> T.StructType:
        """Types in the target: dates are text."""
        return T.StructType([T.StructField(c, self._type(c, True)) for c in self.columns])

    @property
    def typed_schema(self) -> T.StructType:
        """Types while processing: dates are zone-less timestamps."""
        return T.StructType([T.StructField(c, self._type(c, False)) for c in self.columns])


# Declared columns, dropped columns and tab tokens of the two datasets.
LEADS = DatasetSpec(
    name="leads",
    tab_token="leads",
    business=(
        ("name", "text"),
        ("email_address", "text"),
        ("mobile", "text"),
        ("city", "text"),
        ("age", "integer"),
        ("registration_date", "datetime"),
        ("workshop_date", "text"),
        ("amount", "double"),
        ("utm_source", "text"),
        ("utm_medium", "text"),
        ("utm_campaign", "text"),
        ("utm_content", "text"),
    ),
    date_column="registration_date",
    dropped=("amount_2", "created", "tag", "date"),
)

BUYERS = DatasetSpec(
    name="buyers",
    tab_token="buyers",
    business=(
        ("name", "text"),
        ("email_address", "text"),
        ("mobile", "text"),
        ("city", "text"),
        ("date", "datetime"),
    ),
    date_column="date",
)

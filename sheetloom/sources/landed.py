"""Landed sheet exports.

The API's answers are landed as files and read from there:

* *values* answers, ``{"spreadsheetId", "valueRanges": [{"range", "values": [[...], ...]}]}``;
* *workbook* answers, ``{"spreadsheetId", "properties": {"title"}, "sheets": [{"properties":
  {"title"}}]}``.

One JSON document per line is the scalable form: such files split, and each line holds one bounded
range of rows (``'Tab'!A5001:L10000``), so a tab of any size is read by many tasks. Whole-file
documents are read too (``lines=False``). Numbers and check boxes keep their JSON literal as text or, with ``typed``, their type.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sheetloom.operators.lookup import DEFAULT_LIMITS, LookupLimits, lookup_join
from sheetloom.operators.row_sets import block_of, merge_runs
from sheetloom.operators.shape import number_rows
from sheetloom.operators.tabs import filter_tabs
from sheetloom.session import stage
from sheetloom.spec import RAW_SCHEMA, TYPED_RAW_SCHEMA, DatasetSpec



def values_schema(cell: T.DataType) -> T.StructType:
    """Schema of *values* answers."""
    rows = T.ArrayType(T.ArrayType(cell))
    ranges = T.ArrayType(T.StructType([T.StructField("range", T.StringType()), T.StructField("values", rows)]))
    return T.StructType([T.StructField("spreadsheetId", T.StringType()), T.StructField("valueRanges", ranges)])


_TITLE = T.StructType([T.StructField("title", T.StringType())])
WORKBOOK_SCHEMA = T.StructType(
    [
        T.StructField("spreadsheetId", T.StringType()),
        T.StructField("properties", _TITLE),
        T.StructField("sheets", T.ArrayType(T.StructType([T.StructField("properties", _TITLE)]))),
    ]
)


def _range_tab(range_: Column) -> Column:
    """``'Bob''s leads'!A1:L9`` -> ``Bob's leads``."""
    tab = F.regexp_extract(range_, "^(.*?)(?:![A-Z]+[0-9]*(?::[A-Z]*[0-9]*)?)?$", 1)
    quoted = tab.startswith("'") & tab.endswith("'") & (F.length(tab) > 1)
    inner = F.substring(tab, F.lit(2), F.length(tab) - 2)
    return F.when(quoted, F.replace(inner, F.lit("''"), F.lit("'"))).otherwise(tab)


def _range_start(range_: Column) -> Column:
    """First row of a range; 1 if the range names none."""
    row = F.regexp_extract(range_, "![A-Z]+([0-9]+)", 1).try_cast("bigint")
    return F.coalesce(row, F.lit(1).cast("bigint"))


def read_workbooks(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Workbook answers: ``source_spreadsheet, title, tabs``; the tabs in workbook order.

    Of several answers about one workbook the one landed last counts (file time; of equal times the larger text).
    """
    landed = spark.read.schema(WORKBOOK_SCHEMA).json(path, multiLine=not lines)
    answers = landed.select(
        F.col("spreadsheetId").alias("source_spreadsheet"),
        F.struct(
            F.col("_metadata.file_modification_time").alias("at"),
            F.col("properties.title").alias("title"),
            F.transform("sheets", lambda s: s["properties"]["title"]).alias("tabs"),
        ).alias("answer"),
    )
    newest = answers.groupBy("source_spreadsheet").agg(F.max("answer").alias("answer"))
    return newest.select("source_spreadsheet", "answer.title", "answer.tabs")


def tab_listing(workbooks: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """One row per tab with its title and place. ``ids`` selects and orders the workbooks."""
    known = workbooks
    if ids:
        at = F.array_position(F.array(*(F.lit(i) for i in ids)), F.col("source_spreadsheet"))
        known = known.where(F.col("source_spreadsheet").isin(*ids))
        order = (at - 1).cast("int")
    else:
        order = F.lit(0)
    return known.select(
        F.coalesce("title", "source_spreadsheet").alias("source_workbook"),
        "source_spreadsheet",
        order.alias("workbook_ord"),
        F.posexplode("tabs").alias("tab_ord", "source_sheet"),
    )


def scan_tabs(
    spark: SparkSession,
    path: str,
    tabs: DataFrame,
    width: int | None = None,
    lines: bool = True,
    limits: LookupLimits = DEFAULT_LIMITS,
    typed: bool = False,
) -> DataFrame:
    """All rows of the listed tabs as raw rows, cut to the first ``width`` columns (None: not cut).

    ``tabs`` comes from :func:`tab_listing`, already filtered to the tabs wanted. Ranges of other tabs go before
    their rows are numbered. With ``typed`` the cells are variants, in which a check box and the word ``true`` differ.
    """
    schema = values_schema(T.VariantType() if typed else T.StringType())
    landed = spark.read.schema(schema).json(path, multiLine=not lines)
    ranges = landed.select("spreadsheetId", F.explode("valueRanges").alias("r"))
    values = F.col("r.values")
    chunks = ranges.select(
        F.col("spreadsheetId").alias("source_spreadsheet"),
        _range_tab(F.col("r.range")).alias("source_sheet"),
        _range_start(F.col("r.range")).alias("start_row"),
        (values if width is None else F.transform(values, lambda cells: F.slice(cells, 1, width))).alias("values"),
    )
    listed = stage(tabs, "tabs", measured=True)
    placed = lookup_join(chunks, listed, ["source_spreadsheet", "source_sheet"], "inner", "start_row", limits)
    return number_rows(placed).select(*RAW_SCHEMA.fieldNames())


def scan_dataset(
    spark: SparkSession,
    values: str,
    workbooks: str,
    spec: DatasetSpec,
    lines: bool = True,
    limits: LookupLimits = DEFAULT_LIMITS,
    typed: bool = False,
) -> DataFrame:
    """Raw rows of a dataset: its workbooks in their order, its tabs, its columns."""
    if not spec.workbooks:
        raise ValueError(f"no workbooks are configured for {spec.name}")
    listing = tab_listing(read_workbooks(spark, workbooks, lines), spec.workbooks)
    return scan_tabs(spark, values, filter_tabs(listing, spec), spec.read_width, lines, limits, typed)


def scan_tab_formatted(
    spark: SparkSession,
    path: str,
    tabs: DataFrame,
    lines: bool = True,
    limits: LookupLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Rows of whole tabs, every column, as landed (displayed strings)."""
    return scan_tabs(spark, path, tabs, lines=lines, limits=limits)


# The folders of a Parquet landing: one per workbook, tab and block of rows.
BLOCK = "row_block"
LANDING = ("source_spreadsheet", "source_sheet", BLOCK)
_FOLDERS = "/" + "/".join(f"{c}=([^/]*)" for c in LANDING) + "/[^/]*$"
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def landing_schema(typed: bool = False) -> T.StructType:
    """Columns of a Parquet landing."""
    return T.StructType([*(TYPED_RAW_SCHEMA if typed else RAW_SCHEMA), T.StructField(BLOCK, T.LongType())])


def write_raw(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Land raw rows as Parquet, one folder per workbook, tab and block of rows, so that all three filter folders.

    A file holds consecutive rows of a tab in order, so that a filter on the row number also skips row groups.
    """
    placed = rows.select(*RAW_SCHEMA.fieldNames()).withColumn(BLOCK, block_of(F.col("source_row")))
    dealt = placed.repartition(*LANDING).sortWithinPartitions(*LANDING, "source_row")
    dealt.write.mode(mode).partitionBy(*LANDING).parquet(path)


def _landing(spark: SparkSession, path: str, typed: bool = False) -> DataFrame:
    landed, schema = F.unix_micros("_metadata.file_modification_time").alias("landed_seq"), landing_schema(typed)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames(), landed)


def read_raw(spark: SparkSession, path: str, typed: bool = False) -> DataFrame:
    """Read a Parquet landing of raw rows; ``landed_seq`` is the time their file was written, in microseconds."""
    return _landing(spark, path, typed).drop(BLOCK)


def landing_blocks(spark: SparkSession, path: str) -> DataFrame:
    """What lies in a landing, from the names of its files alone: the tab, ``block``, and ``files``, which changes with every
    file added or removed. No file is opened."""
    named = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    file = F.col("path")
    # %XX stands for a character that a folder name cannot have; a plus is one
    text = lambda i: F.url_decode(F.replace(F.regexp_extract(file, _FOLDERS, i), F.lit("+"), F.lit("%2B")))
    known = [F.nullif(text(i), F.lit(_NULL_FOLDER)).alias(c) for i, c in enumerate(LANDING[:2], 1)]
    block = F.regexp_extract(file, _FOLDERS, 3).try_cast("bigint").alias("block")
    name = F.xxhash64(F.substring_index(file, "/", -1)).alias("name")
    sums = F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.bit_xor("name").cast("string"))
    return named.select(*known, block, name).groupBy(*LANDING[:2], "block").agg(sums.alias("files"))


def read_blocks(
    spark: SparkSession,
    path: str,
    blocks: DataFrame,
    limits: LookupLimits = DEFAULT_LIMITS,
    most_ranges: int = 1000,
    typed: bool = False,
) -> DataFrame:
    """The rows of the named blocks (the tab and ``block``; staged) of a landing; only their folders are read.

    Up to ``most_ranges`` ranges of blocks become a filter on the folders; beyond that the folders are pruned by a join.
    """
    landed = _landing(spark, path, typed)
    runs = merge_runs(blocks.select(*LANDING[:2], F.col("block").alias("first"), F.col("block").alias("last")))
    ranges = runs.limit(most_ranges + 1).collect()  # bounded by most_ranges
    if len(ranges) <= most_ranges:
        wanted = F.lit(False)
        for (book, tab), group in groupby(sorted(ranges), key=lambda r: (r.source_spreadsheet, r.source_sheet)):
            inside = F.lit(False)
            for r in group:
                inside = inside | F.col(BLOCK).between(r.first, r.last)
            wanted = wanted | ((F.col("source_spreadsheet") == book) & (F.col("source_sheet") == tab) & inside)
        return landed.where(wanted).drop(BLOCK)
    named = blocks.select(*LANDING[:2], F.col("block").alias(BLOCK)).where(F.col(BLOCK) >= 0)
    return lookup_join(landed, named, list(LANDING), limits=limits).select(*landed.columns).drop(BLOCK)

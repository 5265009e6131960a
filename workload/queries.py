"""One registered query per operator and flow; each takes ``(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetloom.functions.datetimes import datetime_text, with_datetime
from sheetloom.functions.headers import canonical_header, normalize_headers
from sheetloom.functions.numbers import safe_double, safe_integer
from sheetloom.functions import text as tx
from sheetloom.operators import layout as lay
from sheetloom.operators.dedup import dedup_keep_last, merge_upsert, union_all
from sheetloom.operators.incremental import checkpoint, headerless_tabs, incremental_filter, shrunk_tabs
from sheetloom.operators.quality import row_counts, status_counts, validate, validation_report
from sheetloom.operators import shape, tabs
from sheetloom.plans import loads, tracker
from sheetloom.session import scratch_path, stage
from sheetloom.sources import landed, target
from sheetloom.spec import BUYERS, LEADS, DatasetSpec
from sheetloom.streaming.available_now import load_available
from workload.raw_tables import land_rows, raw, spark_sql, table

FIRST_RUN = "2024-01-01 00:00:00"
SECOND_RUN = "2024-02-01 00:00:00"
REQUESTED_TABS = [" leads JAN ", "Paid Leads"]
RAW_OF = {"leads": "leads_raw", "buyers": "buyers_raw"}
ROW = ["source_spreadsheet", "source_sheet", "source_row"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def add(function):
        QUERIES[name] = function
        return function

    return add


def cells_text(c: Column | str = "cells") -> Column:
    return F.array_join(c, "|").alias("cells_text")


def raw_of(spark: SparkSession, sf: str, spec: DatasetSpec) -> DataFrame:
    return raw(spark, sf, RAW_OF[spec.name])


def declared(spark: SparkSession, sf: str, spec: DatasetSpec) -> DataFrame:
    return loads.declared_rows(raw_of(spark, sf, spec), spec)


def cleaned(spark: SparkSession, sf: str, spec: DatasetSpec) -> DataFrame:
    return loads.clean(declared(spark, sf, spec), spec, FIRST_RUN)


def first_half(rows: DataFrame) -> DataFrame:
    """Rows of the first load: those up to half of the largest row number of all tabs."""
    half = rows.agg((F.max("source_row") / 2).alias("half"))
    return rows.where(F.col("source_row") <= half.scalar())


def second_half(rows: DataFrame) -> DataFrame:
    half = rows.agg((F.max("source_row") / 2).alias("half"))
    return rows.where(F.col("source_row") > half.scalar())


def blank_every_23rd(rows: DataFrame) -> DataFrame:
    blank = F.transform("cells", lambda _: F.lit("  "))
    cells = F.when((F.col("source_row") > 1) & (F.col("source_row") % 23 == 0), blank).otherwise(F.col("cells"))
    return rows.withColumn("cells", cells)


def widened(rows: DataFrame) -> DataFrame:
    """Rows of 14 cells or more, so that the read width matters."""
    return rows.withColumn("cells", F.concat("cells", F.split(F.lit("x10,x11,x12,x13,x14"), ",")))


def landed_tabs(spark: SparkSession, rows: DataFrame, name: str) -> tuple[str, str]:
    """Land rows as JSON lines; returns the paths of the values and the workbook answers."""
    values, books = scratch_path(spark, f"{name}_values"), scratch_path(spark, f"{name}_books")
    land_rows(rows, values, rows_per_range=1000)
    listing = rows.select("source_workbook", "source_spreadsheet", "tab_ord", "source_sheet").distinct()
    answers = listing.groupBy("source_spreadsheet", "source_workbook").agg(
        F.array_sort(F.collect_list(F.struct("tab_ord", "source_sheet"))).alias("t")
    )
    title = F.when(F.col("source_spreadsheet") != "wb2", F.col("source_workbook"))
    sheet = lambda s: F.struct(F.struct(s["source_sheet"].alias("title")).alias("properties"))
    answers.select(
        F.col("source_spreadsheet").alias("spreadsheetId"),
        F.struct(title.alias("title")).alias("properties"),
        F.transform("t", sheet).alias("sheets"),
    ).write.json(books)
    return values, books


# ---- sources, sinks, tabs ------------------------------------------------------------------


@query("scan_tabs")
def _(spark, sf):
    values, books = landed_tabs(spark, widened(raw(spark, sf, "leads_raw")), "leads")
    rows = landed.scan_dataset(spark, values, books, LEADS.with_workbooks("wb0", "wb1", "wb2"))
    return rows.select(
        "source_workbook", *ROW, "workbook_ord", F.size("cells").alias("n_cells"), cells_text()
    )


@query("scan_tab_formatted")
def _(spark, sf):
    values, books = landed_tabs(spark, widened(raw(spark, sf, "tracker_raw")), "tracker")
    listing = landed.tab_listing(landed.read_workbooks(spark, books))
    rows = landed.scan_tab_formatted(spark, values, listing)
    return rows.where(F.size("cells") > 0).select(*ROW, F.size("cells").alias("n_cells"), cells_text())


def typed_answers(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Leads landed with typed cells: ages and cities are now and then a check box, or the same word as text."""
    rows = raw(spark, sf, "leads_raw")
    row = F.col("source_row")

    def typed(cell: Column, at: Column) -> Column:
        number = (at >= 4) & cell.try_cast("bigint").isNotNull()
        box = (row > 1) & (((at == 3) & (row % 5 == 0)) | ((at == 4) & (row % 7 == 0)))
        word = (row > 1) & (((at == 3) & (row % 5 == 1)) | ((at == 4) & (row % 7 == 1)))
        return (
            F.when(box, (at == 4).cast("variant"))
            .when(word, F.when(at == 4, "true").otherwise("false").cast("variant"))
            .when(number, cell.try_cast("bigint").cast("variant"))
            .otherwise(cell.cast("variant"))
        )

    place = F.concat(F.lit("'"), "source_sheet", F.lit("'!A"), row.cast("string"), F.lit(":L"), row.cast("string"))
    ranges = F.array(F.struct(place.alias("range"), F.array(F.transform("cells", typed)).alias("values")))
    values = scratch_path(spark, "typed_values")
    rows.select(F.to_json(F.struct(F.col("source_spreadsheet").alias("spreadsheetId"), ranges.alias("valueRanges"))).alias("value")).write.text(values)
    _, books = landed_tabs(spark, rows, "typed")
    return values, books


@query("typed_cells")
def _(spark, sf):
    values, books = typed_answers(spark, sf)
    rows = landed.scan_dataset(spark, values, books, LEADS.with_workbooks("wb0", "wb1", "wb2"), typed=True)
    clean = loads.clean(loads.declared_rows(rows, LEADS), LEADS, FIRST_RUN)
    return clean.select(*ROW, "name", "city", "age", "amount", datetime_text(F.col("registration_date")).alias("registered"))


def _filtered(spec):
    return lambda spark, sf: tabs.filter_tabs(raw_of(spark, sf, spec), spec).select(*ROW, cells_text())


QUERIES["filter_tabs_leads"] = _filtered(LEADS)
QUERIES["filter_tabs_buyers"] = _filtered(BUYERS)


@query("select_tabs_named")
def _(spark, sf):
    return tabs.select_tabs_named(raw(spark, sf, "leads_raw"), REQUESTED_TABS).select(*ROW, cells_text())


@query("list_tabs")
def _(spark, sf):
    return tabs.list_tabs(raw(spark, sf, "leads_raw"))


@query("select_tabs_all")
def _(spark, sf):
    return tabs.select_tabs_all(raw(spark, sf, "leads_raw")).select(*ROW, cells_text())


@query("workbook_title")
def _(spark, sf):
    rows = raw(spark, sf, "leads_raw")
    named = rows.where("source_spreadsheet <> 'wb2'")
    titles = named.select("source_spreadsheet", F.col("source_workbook").alias("title")).distinct()
    return tabs.with_workbook_title(rows, stage(titles, "titles")).select("source_workbook", *ROW)


ADDRESSES = """
SELECT o_orderkey AS k, CASE o_orderkey % 3
  WHEN 0 THEN concat('https://host.example/spreadsheets/d/Id_', CAST(o_orderkey AS STRING), '-x/edit#gid=0')
  WHEN 1 THEN concat('  raw-id-', CAST(o_orderkey AS STRING), ' ')
  ELSE concat('https://host.example/folders/d/', CAST(o_orderkey AS STRING)) END AS v
FROM orders"""


@query("spreadsheet_id")
def _(spark, sf):
    rows = spark_sql(spark, sf, ADDRESSES, "orders")
    return rows.select("k", tx.spreadsheet_id(F.col("v")).alias("spreadsheet_id"))


@query("tab_row_count")
def _(spark, sf):
    return tabs.tab_row_count(blank_first_cell_below(raw(spark, sf, "leads_raw")))


def blank_first_cell_below(rows: DataFrame) -> DataFrame:
    """The last rows of the first tab of each workbook have nothing in column A."""
    last = rows.agg((F.max("source_row") - 20).alias("last"))
    rest = F.concat(F.split(F.lit(""), ","), F.slice("cells", F.lit(2), F.greatest(F.size("cells"), F.lit(1))))
    is_last = (F.col("tab_ord") == 0) & (F.col("source_row") > last.scalar())
    return rows.withColumn("cells", F.when(is_last, rest).otherwise(F.col("cells")))


@query("tab_headers")
def _(spark, sf):
    heads = tabs.tab_headers(raw(spark, sf, "leads_raw"))
    return heads.select("source_spreadsheet", "source_sheet", F.array_join("headers", "|").alias("headers"))


@query("target_exists")
def _(spark, sf):
    path = scratch_path(spark, "target_exists")
    before = target.target_exists(spark, path)
    target.write_target(loads.prepare(raw(spark, sf, "buyers_raw"), BUYERS, FIRST_RUN), path, BUYERS)
    after = target.target_exists(spark, path)
    rows = target.scan_target(spark, path, BUYERS)
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(before).alias("before"), F.lit(after).alias("after"), "n_rows"
    )


@query("scan_target")
def _(spark, sf):
    path = scratch_path(spark, "scan_target")
    target.write_target(loads.prepare(raw(spark, sf, "buyers_raw"), BUYERS, FIRST_RUN), path, BUYERS)
    return target.scan_target(spark, path, BUYERS)


@query("write_target")
def _(spark, sf):
    path = scratch_path(spark, "write_target")
    for run in (SECOND_RUN, FIRST_RUN):
        target.write_target(loads.prepare(raw(spark, sf, "leads_raw"), LEADS, run), path, LEADS)
    return target.scan_target(spark, path, LEADS)


# ---- shape ---------------------------------------------------------------------------------

PART_HEADERS = """
SELECT p_partkey AS k, {arr}(concat(' ', p_name, ' '), p_brand, upper(p_name), '', concat(p_type, '  (', CAST(p_size AS STRING), ')'),
  lower(p_brand), '₹', concat(p_brand, '#'), p_name) AS headers
FROM part"""


@query("normalize_headers")
def _(spark, sf):
    heads = spark_sql(spark, sf, PART_HEADERS.format(arr="array"), "part")
    return heads.select("k", F.array_join(normalize_headers(F.col("headers")), "|").alias("headers"))


def ragged(rows: DataFrame) -> DataFrame:
    longer = F.concat("cells", F.split(F.lit("more,cells"), ","))
    width = (F.col("source_row") % 11 + 1).cast("int")
    cells = F.when(F.col("source_row") > 1, F.slice(longer, F.lit(1), width)).otherwise(F.col("cells"))
    return rows.withColumn("cells", cells)


@query("rectangularize")
def _(spark, sf):
    rows = ragged(raw(spark, sf, "leads_raw"))
    heads = stage(tabs.tab_headers(rows), "headers")
    data = loads.lookup_join(rows.where("source_row > 1"), heads, tabs.KEYS)
    cells = shape.rectangular_cells(F.col("cells"), F.col("headers"))
    named = shape.named_cells(F.col("cells"), F.col("headers"))
    return data.select(*ROW, cells_text(cells), F.element_at(named, "utm_source").alias("utm_source"))


@query("source_row_number")
def _(spark, sf):
    rows = raw(spark, sf, "buyers_raw")
    start = (F.col("source_row") - F.col("source_row") % 500).alias("block")
    chunks = rows.groupBy("source_spreadsheet", "source_sheet", start).agg(
        F.min("source_row").alias("start_row"),
        F.array_sort(F.collect_list(F.struct("source_row", "cells"))).alias("numbered"),
    )
    values = F.transform("numbered", lambda r: r["cells"]).alias("values")
    numbered = shape.number_rows(chunks.select("source_spreadsheet", "source_sheet", "start_row", values))
    return numbered.select(*ROW, cells_text())


@query("project_declared")
def _(spark, sf):
    return declared(spark, sf, BUYERS).select(*BUYERS.business_columns, *ROW)


HEADER_NAMES = "name email_address mobile city age registration_date amount utm_source tag".split()


def leads_by_header(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of all tabs with every header as a text column."""
    rows = raw(spark, sf, "leads_raw")
    heads = stage(tabs.tab_headers(rows), "headers")
    data = loads.lookup_join(rows.where("source_row > 1"), heads, tabs.KEYS)
    cells = data.withColumn("named", shape.named_cells(F.col("cells"), F.col("headers")))
    return cells.select(*(F.element_at("named", n).alias(n) for n in HEADER_NAMES), *ROW)


@query("drop_columns")
def _(spark, sf):
    return shape.drop_columns(leads_by_header(spark, sf), LEADS)


@query("blank_to_null")
def _(spark, sf):
    return shape.blanks_to_null(leads_by_header(spark, sf), HEADER_NAMES)


@query("drop_blank_rows")
def _(spark, sf):
    rows = blank_every_23rd(raw(spark, sf, "leads_raw"))
    kept = shape.drop_blank_rows(loads.declared_rows(rows, LEADS), LEADS)
    return kept.select("name", "registration_date", *ROW)


@query("add_missing_columns")
def _(spark, sf):
    few = leads_by_header(spark, sf).select("name", "email_address", *ROW)
    full = shape.add_missing_columns(few, LEADS)
    return full.select("name", "email_address", "age", "amount", "workshop_date", "utm_medium", "record_id", *ROW)


@query("conform_schema")
def _(spark, sf):
    return shape.conform_schema(cleaned(spark, sf, LEADS), LEADS)


@query("trim_strings")
def _(spark, sf):
    return shape.trim_strings(leads_by_header(spark, sf), HEADER_NAMES)


# ---- scalar functions ----------------------------------------------------------------------

NUMBER_TEXTS = """
SELECT o_orderkey AS k, CASE o_orderkey % 16
  WHEN 0 THEN ' 499 ' WHEN 1 THEN '1,000' WHEN 2 THEN concat(CAST(o_custkey AS STRING), 'e3') WHEN 3 THEN '1d'
  WHEN 4 THEN '0x1A' WHEN 5 THEN concat('-', CAST(o_custkey AS STRING), '.') WHEN 6 THEN '.5'
  WHEN 7 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) WHEN 8 THEN 'nan' WHEN 9 THEN '41.0'
  WHEN 10 THEN concat(CAST(o_custkey AS STRING), '.25') WHEN 11 THEN '' WHEN 12 THEN '1_000'
  WHEN 13 THEN concat('+', CAST(o_orderkey AS STRING)) WHEN 14 THEN 'abc'
  ELSE concat(CAST(o_custkey AS STRING), '.0') END AS v
FROM orders"""


@query("safe_integer")
def _(spark, sf):
    return spark_sql(spark, sf, NUMBER_TEXTS, "orders").select("k", safe_integer(F.col("v")).alias("n"))


@query("safe_double")
def _(spark, sf):
    return spark_sql(spark, sf, NUMBER_TEXTS, "orders").select("k", safe_double(F.col("v")).alias("x"))


# Dates of the orders, written in many ways; {y} {m} {d} are numbers, {m2} {d2} two-digit text.
DATE_TEXTS = """
WITH p AS (
  SELECT o_orderkey AS k, CAST({days} AS BIGINT) AS day, CAST(year(o_orderdate) AS STRING) AS y,
    CAST(month(o_orderdate) AS STRING) AS m, CAST(day(o_orderdate) AS STRING) AS d FROM orders
), q AS (
  SELECT *, lpad(m, 2, '0') AS m2, lpad(d, 2, '0') AS d2,
    {arr}('Jan', 'February', 'mar', 'April', 'MAY', 'June', 'July', 'aug', 'Sept', 'October', 'Nov', 'december')[{first} + CAST(m AS INT)] AS mon
  FROM p
)
SELECT k, day, CASE k % 20
  WHEN 0 THEN concat(d, '/', m, '/', y) WHEN 1 THEN concat(d2, '-', m2, '-', y) WHEN 2 THEN concat(y, '-', m2, '-', d2)
  WHEN 3 THEN concat(y, '/', m2, '/', d2, ' 10:30:15.25') WHEN 4 THEN concat(d, ' ', mon, ' ', y)
  WHEN 5 THEN concat(mon, ' ', d, ', ', y) WHEN 6 THEN concat(d2, '.', m2, '.', y, ' 9:05 PM')
  WHEN 7 THEN concat(d, '-', mon, '-', y, ', 12:15 am') WHEN 8 THEN concat(y, '-', m2, '-', d2, 'T23:59:59Z')
  WHEN 9 THEN concat(y, '-', m2) WHEN 10 THEN concat(mon, ' ', y) WHEN 11 THEN 'not a date'
  WHEN 12 THEN concat('31/02/', y) WHEN 13 THEN concat(d, 'th ', mon, ' ', y, ' 7 pm')
  WHEN 14 THEN CAST(day + 25569 AS STRING) WHEN 15 THEN concat(CAST(day + 25569 AS STRING), '.75')
  WHEN 16 THEN CAST(day * 86400 + 59 AS STRING) WHEN 17 THEN CAST(day * 86400000 + 1250 AS STRING)
  WHEN 18 THEN CAST(day * 86400000000 + 7 AS STRING) ELSE CAST(day * 86400000000000 + 1999 AS STRING) END AS v
FROM q"""


@query("normalize_datetime")
def _(spark, sf):
    text = DATE_TEXTS.format(days="datediff(CAST(o_orderdate AS DATE), DATE '1970-01-01')", arr="array", first="-1")
    rows = spark_sql(spark, sf, text, "orders")
    return with_datetime(rows, "v").select("k", datetime_text(F.col("v")).alias("t"))


@query("datetime_to_string")
def _(spark, sf):
    stamp = F.when(F.col("event_id") % 10 != 0, F.col("ts").cast("timestamp_ntz"))
    return table(spark, sf, "events").select("event_id", datetime_text(stamp).alias("t"))


def _clean_column(spec, column):
    return lambda spark, sf: cleaned(spark, sf, spec).select(*ROW, column)


QUERIES["record_id"] = _clean_column(LEADS, "record_id")
QUERIES["record_id_buyers"] = _clean_column(BUYERS, "record_id")
QUERIES["row_hash"] = _clean_column(LEADS, "row_hash")
QUERIES["row_hash_buyers"] = _clean_column(BUYERS, "row_hash")


@query("ingested_at")
def _(spark, sf):
    return cleaned(spark, sf, LEADS).select(*ROW, datetime_text(F.col("ingested_at_utc")).alias("ingested_at_utc"))


@query("clean_text")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.clean_text(F.col("text")).alias("t"))


@query("header_key")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.header_key(F.col("text")).alias("t"))


@query("snake_case")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.snake_case(F.col("text")).alias("t"))


def tracker_cells(spark: SparkSession, sf: str) -> DataFrame:
    return raw(spark, sf, "tracker_raw").select(*ROW, F.posexplode("cells").alias("pos", "cell"))


@query("to_bool")
def _(spark, sf):
    return tracker_cells(spark, sf).select(*ROW, "pos", tx.to_bool(F.col("cell")).alias("is_true"))


@query("is_bool_text")
def _(spark, sf):
    return tracker_cells(spark, sf).select(*ROW, "pos", tx.is_tick_text(F.col("cell")).alias("is_tick"))


NAMES = "SELECT p_partkey AS k, concat(p_name, '-', upper(p_brand), '''S d2c ', lower(p_type), ' ', CAST(p_size AS STRING), 'xL') AS v FROM part"


@query("title_case_name")
def _(spark, sf):
    return spark_sql(spark, sf, NAMES, "part").select("k", tx.title_case(F.col("v")).alias("t"))


CONTACTS = """
SELECT c_custkey AS k, concat(' A ', c_name, ' @X.com ') AS email,
  concat('+91 (', CAST(c_custkey AS STRING), ') 76-5 x') AS mobile FROM customer"""


@query("clean_email")
def _(spark, sf):
    return spark_sql(spark, sf, CONTACTS, "customer").select("k", tx.clean_email(F.col("email")).alias("t"))


@query("clean_mobile")
def _(spark, sf):
    return spark_sql(spark, sf, CONTACTS, "customer").select("k", tx.clean_mobile(F.col("mobile")).alias("t"))


STATUSES = """
SELECT o_orderkey AS k,
  CASE o_orderkey % 4 WHEN 0 THEN 'Refunded' WHEN 1 THEN '' WHEN 2 THEN 'deactivated now' ELSE o_orderpriority END AS status,
  CASE o_orderkey % 5 WHEN 0 THEN 'DEACTIVATED' WHEN 1 THEN 'REFUNDS' ELSE 'MAIN' END AS section FROM orders"""


@query("client_status")
def _(spark, sf):
    rows = spark_sql(spark, sf, STATUSES, "orders")
    return rows.select("k", tx.client_status(F.col("status"), F.col("section")).alias("client_status"))


@query("is_active")
def _(spark, sf):
    rows = spark_sql(spark, sf, STATUSES, "orders")
    status = tx.client_status(F.col("status"), F.col("section"))
    return rows.select("k", (status == "Active").alias("is_active"))


HEADER_TEXTS = """
SELECT k, CASE WHEN size % 3 = 0 THEN concat(' ', lower(h), '. ') WHEN size % 3 = 1 THEN concat(brand, ' - ', h) ELSE h END AS v
FROM (SELECT p_partkey AS k, p_size AS size, p_brand AS brand, CASE p_partkey % 26
  WHEN 0 THEN 'PH NO.' WHEN 1 THEN 'Coach Name' WHEN 2 THEN 'Status Data' WHEN 3 THEN 'GOLD LIFE TIME' WHEN 4 THEN 'Agra'
  WHEN 5 THEN 'Status' WHEN 6 THEN 'E-MAIL' WHEN 7 THEN 'emailid' WHEN 8 THEN 'Photo' WHEN 9 THEN 'telephone'
  WHEN 10 THEN 'Contact' WHEN 11 THEN 'WhatsApp no' WHEN 12 THEN 'Tech Member' WHEN 13 THEN 'Comments' WHEN 14 THEN 'REMARK'
  WHEN 15 THEN 'Silver' WHEN 16 THEN 'Access - Gold' WHEN 17 THEN 'gold lifetime' WHEN 18 THEN 'NAMES' WHEN 19 THEN 'Full Name'
  WHEN 20 THEN 'Username' WHEN 21 THEN 'technical' WHEN 22 THEN 'Golden' WHEN 23 THEN 'Mobile' WHEN 24 THEN '₹' ELSE p_name END AS h
FROM part) AS p"""


@query("canonical_header")
def _(spark, sf):
    rows = spark_sql(spark, sf, HEADER_TEXTS, "part")
    return rows.select("k", canonical_header(F.col("v")).alias("canonical"))


# ---- tracker rows --------------------------------------------------------------------------


@query("drop_empty_rows")
def _(spark, sf):
    rows = lay.clean_rows(blank_every_23rd(raw(spark, sf, "leads_raw")))
    return rows.select(*ROW, cells_text())


@query("is_header_row")
def _(spark, sf):
    return lay.clean_rows(raw(spark, sf, "tracker_raw")).select(
        *ROW, lay.is_header_row(F.col("cells")).alias("is_header")
    )


@query("section_title")
def _(spark, sf):
    return lay.clean_rows(raw(spark, sf, "tracker_raw")).select(
        *ROW, lay.section_title(F.col("cells")).alias("title")
    )


def tracker_control(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = raw(spark, sf, "tracker_raw")
    control = stage(lay.control_rows(rows), "control")
    return rows, control, stage(lay.tab_layouts(control), "layouts")


@query("section_fill")
def _(spark, sf):
    rows = raw(spark, sf, "tracker_raw")
    title = lay.section_title(F.col("cells"))
    titles = lay.clean_rows(rows).select(*ROW, title.alias("section")).where("section is not null")
    return lay.section_fill(rows, stage(titles, "titles")).select(*ROW, "section")


@query("header_layout")
def _(spark, sf):
    _, _, layouts = tracker_control(spark, sf)
    return layouts.select(*ROW, "section", lay.layout_text(F.col("own")).alias("layout"))


@query("merge_layout")
def _(spark, sf):
    _, _, layouts = tracker_control(spark, sf)
    return layouts.select(*ROW, "section", lay.layout_text(F.col("layout")).alias("layout"))


@query("asof_layout")
def _(spark, sf):
    rows, _, layouts = tracker_control(spark, sf)
    placed = lay.asof_layout(rows, layouts.select(*ROW, "layout"))
    return placed.select(*ROW, "header_row", lay.layout_text(F.col("layout")).alias("layout"))


@query("is_client_row")
def _(spark, sf):
    rows, _, layouts = tracker_control(spark, sf)
    placed = lay.asof_layout(lay.clean_rows(rows), layouts.select(*ROW, "layout"))
    at = lambda name: F.coalesce(F.get("cells", lay.layout_position(F.col("layout"), name)), F.lit(""))
    below = placed.where("source_row > header_row")
    client = lay.is_client_row(at("name"), at("email"), at("mobile"), F.col("cells"))
    return below.select(*ROW, client.alias("is_client"))


@query("parse_tracker")
def _(spark, sf):
    parsed = tracker.parse_tracker(raw(spark, sf, "tracker_raw"))
    agra = F.element_at("extras", "agra_event").alias("agra_event")
    return parsed.select(*tracker.HEADER_COLUMNS, agra, *tracker.META_COLUMNS)


@query("infer_bool_columns")
def _(spark, sf):
    parsed = stage(tracker.parse_tracker(raw(spark, sf, "tracker_raw")), "parsed")
    extras = tracker.extra_columns(parsed)
    return tracker.bool_column_report(tracker.clean_clients(parsed), tracker.text_columns(extras))


@query("build_clients")
def _(spark, sf):
    return tracker.build_clients(stage(tracker.parse_tracker(raw(spark, sf, "tracker_raw")), "parsed"))


# ---- aggregates, dedup, incremental --------------------------------------------------------


@query("checkpoint")
def _(spark, sf):
    return checkpoint(loads.prepare(raw(spark, sf, "leads_raw"), LEADS, FIRST_RUN))


@query("incremental_filter")
def _(spark, sf):
    rows = tabs.filter_tabs(blank_first_cell_below(raw(spark, sf, "leads_raw")), LEADS)
    seen = stage(checkpoint(first_half(rows).where("tab_ord <> 2")), "seen")
    return incremental_filter(rows, seen, tabs.tab_row_count(rows)).select(*ROW, cells_text())


@query("shrunk_tabs")
def _(spark, sf):
    rows = raw(spark, sf, "leads_raw")
    now = tabs.tab_row_count(first_half(rows).unionByName(rows.where("tab_ord = 1")))
    return shrunk_tabs(now, checkpoint(rows))


@query("headerless_tabs")
def _(spark, sf):
    rows = raw(spark, sf, "leads_raw").where(
        "not (workbook_ord = 0 and tab_ord = 1 and source_row = 1)"
        " and not (workbook_ord = 1 and tab_ord = 2 and source_row > 1)"
    )
    return headerless_tabs(tabs.tab_row_count(rows), tabs.tab_headers(rows))


@query("union_all")
def _(spark, sf):
    leads = loads.clean(declared(spark, sf, LEADS), LEADS, FIRST_RUN).select("name", "city", "age", "record_id")
    buyers = loads.clean(declared(spark, sf, BUYERS), BUYERS, FIRST_RUN).select("name", "city", "record_id")
    return union_all(leads, buyers)


@query("dedup_keep_last")
def _(spark, sf):
    return dedup_keep_last(cleaned(spark, sf, LEADS)).select("record_id", "row_hash", *ROW)


@query("dedup_relanded_rows")
def _(spark, sf):
    """Every fifth row is landed again with another city; the later landing counts."""
    rows = raw(spark, sf, "buyers_raw").withColumn("landed_seq", F.lit(1))
    edited = F.transform("cells", lambda c, i: F.when(i == 3, "Relanded").otherwise(c))
    again = rows.where("source_row > 1 and source_row % 5 = 0").withColumns({"cells": edited, "landed_seq": F.lit(2)})
    return shape.conform_schema(loads.prepare(again.unionByName(rows), BUYERS, FIRST_RUN), BUYERS)


def two_loads(spark: SparkSession, sf: str, spec: DatasetSpec) -> tuple[DataFrame, DataFrame]:
    rows = raw_of(spark, sf, spec)
    headers = stage(tabs.tab_headers(tabs.filter_tabs(rows, spec)), "headers")
    first, later = first_half(rows), second_half(rows)
    return loads.prepare(first, spec, FIRST_RUN, headers), loads.prepare(later, spec, SECOND_RUN, headers)


@query("merge_upsert")
def _(spark, sf):
    existing, new = (shape.conform_schema(p, BUYERS) for p in two_loads(spark, sf, BUYERS))
    return merge_upsert(existing, stage(new, "new"), existing_unique=True)


@query("status_counts")
def _(spark, sf):
    return status_counts(tracker.clean_clients(tracker.parse_tracker(raw(spark, sf, "tracker_raw"))))


@query("row_counts")
def _(spark, sf):
    return row_counts(tabs.filter_tabs(raw(spark, sf, "leads_raw"), LEADS).where("source_row > 1"))


@query("validate")
def _(spark, sf):
    prepared = stage(loads.prepare(raw(spark, sf, "leads_raw"), LEADS, FIRST_RUN), "prepared")
    validate(prepared, LEADS)
    return validation_report(prepared)


# ---- whole flows ---------------------------------------------------------------------------


def _prepared(spec):
    return lambda spark, sf: shape.conform_schema(
        loads.prepare(raw_of(spark, sf, spec), spec, FIRST_RUN), spec
    )


def _full_load(spec):
    def run(spark, sf):
        path = scratch_path(spark, f"full_{spec.name}")
        loads.full_load(raw_of(spark, sf, spec), spec, path, FIRST_RUN)
        return target.scan_target(spark, path, spec)

    return run


def _incremental(spec):
    def run(spark, sf):
        path, landing = (scratch_path(spark, f"incremental_{part}_{spec.name}") for part in ("target", "landing"))
        landed.write_raw(raw_of(spark, sf, spec), landing)
        rows = landed.read_raw(spark, landing)
        loads.load(first_half(rows), spec, path, FIRST_RUN)
        loads.load(rows, spec, path, SECOND_RUN)
        if loads.load(rows, spec, path, "2024-03-01 00:00:00") is not None:
            raise AssertionError("a load without new rows must leave the target as it is")
        return target.scan_target(spark, path, spec)

    return run


def _landing(spec):
    """Both halves landed one after the other; the second load reads what changed, a third finds nothing."""

    def run(spark, sf):
        path, landing = (scratch_path(spark, f"landing_{part}_{spec.name}") for part in ("target", "rows"))
        rows = stage(raw_of(spark, sf, spec), "raw")
        for part, at in ((first_half(rows), FIRST_RUN), (second_half(rows), SECOND_RUN)):
            landed.write_raw(part, landing)
            loads.load_landing(spark, landing, spec, path, at)
        if loads.load_landing(spark, landing, spec, path, "2024-03-01 00:00:00") is not None:
            raise AssertionError("a load without new rows must leave the target as it is")
        return target.scan_target(spark, path, spec)

    return run


def _late(condition: str):
    """Two loads; the rows of ``condition`` land, or can be read, only with the second."""

    def run(spark, sf):
        path = scratch_path(spark, "late_target")
        rows = stage(raw(spark, sf, "buyers_raw"), "raw")
        most = rows.agg(F.max("source_row").alias("most")).scalar()
        late = rows.withColumn("most", most).where(f"not ({condition})").drop("most")
        loads.load(late, BUYERS, path, FIRST_RUN)
        loads.load(rows, BUYERS, path, SECOND_RUN)
        if loads.load(rows, BUYERS, path, "2024-03-01 00:00:00") is not None:
            raise AssertionError("a load without new rows must leave the target as it is")
        return target.scan_target(spark, path, BUYERS)

    return run


# the header of a tab comes late; a range in the middle of all tabs comes late
LATE_RANGE = "source_row > most / 4 and source_row <= most / 2"
QUERIES["incremental_late_header"] = _late("tab_ord = 1 and source_row = 1")
QUERIES["incremental_late_range"] = _late(LATE_RANGE)


@query("rows_read")
def _(spark, sf):
    """The runs of rows that a full load has read."""
    path = scratch_path(spark, "marked")
    loads.full_load(raw(spark, sf, "buyers_raw"), BUYERS, path, FIRST_RUN)
    return target.scan_marks(spark, path)


@query("load_report")
def _(spark, sf):
    path = scratch_path(spark, "reported")
    rows = raw(spark, sf, "buyers_raw").where("not (tab_ord = 1 and source_row = 1)")
    loads.full_load(rows, BUYERS, path, FIRST_RUN)
    return target.scan_report(spark, path)


def _stream(spec):
    def run(spark, sf):
        path, landing, done = (scratch_path(spark, f"stream_{part}_{spec.name}") for part in ("target", "landing", "done"))
        rows = stage(raw_of(spark, sf, spec), "raw")
        for part, at in ((first_half(rows), FIRST_RUN), (second_half(rows), SECOND_RUN)):
            landed.write_raw(part, landing)
            load_available(spark, landing, path, spec, done, at)
        load_available(spark, landing, path, spec, done, "2024-03-01 00:00:00")
        return target.scan_target(spark, path, spec)

    return run


for _spec in (BUYERS, LEADS):
    QUERIES[f"prepare_{_spec.name}"] = _prepared(_spec)
    QUERIES[f"full_load_{_spec.name}"] = _full_load(_spec)
    QUERIES[f"incremental_{_spec.name}"] = _incremental(_spec)
    QUERIES[f"incremental_landing_{_spec.name}"] = _landing(_spec)
    QUERIES[f"incremental_stream_{_spec.name}"] = _stream(_spec)


@query("tracker_clients")
def _(spark, sf):
    clients = tracker.tracker_clients(raw(spark, sf, "tracker_raw"))
    path = tracker.write_clients(clients, scratch_path(spark, "clients"), ["Tab0", "Tab1", "Tab2"], "20240101_000000")
    return spark.read.schema(clients.schema).parquet(path)

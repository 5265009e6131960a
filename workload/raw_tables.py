"""Raw sheet rows derived from the test tables, as one SQL text for Spark and DuckDB.

Row numbers are computed from the order or customer key instead of a window per tab: a tab holds up
to a third of all rows, and numbering it must not gather it in one task. Numbers a tab skips are
empty sheet rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SPARK = {
    "days": "datediff(CAST(o_orderdate AS DATE), DATE '1970-01-01')",
    "arr": "array",
    "no_text": "CAST(array() AS ARRAY<STRING>)",
}
DUCKDB = {
    "days": "date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))",
    "arr": "list_value",
    "no_text": "CAST([] AS VARCHAR[])",
}

_ORDERS = """
SELECT o_orderkey AS k, o_custkey AS c, c_name, n_name, o_totalprice AS p,
       CAST({days} AS BIGINT) - CAST({days} AS BIGINT) % 32 AS d
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

_PERSON = """
    concat(' ', c_name, ' '),
    CASE WHEN k % 17 = 0 THEN '  ' ELSE concat('  Cust', CAST(c AS STRING), '@Example.com ') END,
    CASE WHEN k % 19 = 0 THEN '' ELSE concat('9', lpad(CAST(c AS STRING), 9, '0')) END,
    n_name"""

_DATE = """
    CASE k % 7 WHEN 0 THEN CAST(d + 25569 AS STRING)
      WHEN 1 THEN CAST(d * 86400 AS STRING)
      WHEN 2 THEN CAST(d * 86400000 AS STRING)
      WHEN 3 THEN CAST(d * 86400000000 AS STRING)
      WHEN 4 THEN CAST(d * 86400000000000 AS STRING)
      WHEN 5 THEN 'not a date'
      ELSE concat(CAST(d + 25569 AS STRING), '.5') END"""

LEADS_RAW = (
    "WITH b AS (" + _ORDERS + "), s AS (SELECT DISTINCT k % 12 AS r FROM b), r AS ("
    "SELECT k % 3 AS w, k % 4 AS t, CAST((k - k % 12) / 12 AS BIGINT) + 2 AS source_row, {arr}("
    + _PERSON + ", CASE k % 5 WHEN 0 THEN '30' WHEN 1 THEN '30.5' WHEN 2 THEN '' WHEN 3 THEN 'abc' ELSE '41.0' END,"
    + _DATE + ", CASE WHEN k % 6 = 0 THEN '1,000' WHEN k % 6 = 1 THEN ' 499 ' WHEN k % 6 = 2 THEN ''"
    " ELSE CAST(CAST(floor(p) AS BIGINT) AS STRING) END,"
    " concat('src', CAST(k % 3 AS STRING)), 'dropped tag') AS cells FROM b"
    " UNION ALL SELECT r % 3, r % 4, CAST(1 AS BIGINT), {arr}('Name', 'Email Address', 'Mobile', 'City', 'Age',"
    " 'Registration Date', 'Amount', 'UTM Source', 'Tag') FROM s) "
    "SELECT concat('Book ', CAST(w AS STRING)) AS source_workbook,"
    " concat('wb', CAST(w AS STRING)) AS source_spreadsheet,"
    " CASE t WHEN 0 THEN 'Leads Jan' WHEN 1 THEN 'LEADS feb' WHEN 2 THEN 'paid leads' ELSE 'Summary' END"
    " AS source_sheet, CAST(w AS INT) AS workbook_ord, CAST(t AS INT) AS tab_ord, source_row, cells FROM r"
)

BUYERS_RAW = (
    "WITH b AS (" + _ORDERS + "), s AS (SELECT DISTINCT k % 4 AS r FROM b), r AS ("
    "SELECT k % 2 AS w, k % 4 AS t, CAST((k - k % 4) / 4 AS BIGINT) + 2 AS source_row, {arr}("
    + _PERSON + "," + _DATE + ", concat('ord', CAST(k AS STRING))) AS cells FROM b"
    " UNION ALL SELECT r % 2, r % 4, CAST(1 AS BIGINT),"
    " {arr}('Name', 'Email Address', 'Mobile', 'City', 'Date', 'Order Id') FROM s) "
    "SELECT concat('Book ', CAST(w AS STRING)) AS source_workbook,"
    " concat('wb', CAST(w AS STRING)) AS source_spreadsheet,"
    " CASE t WHEN 0 THEN 'Buyers A' WHEN 1 THEN 'old BUYERS' WHEN 2 THEN 'buyers-3' ELSE 'Notes' END"
    " AS source_sheet, CAST(w AS INT) AS workbook_ord, CAST(t AS INT) AS tab_ord, source_row, cells FROM r"
)

# Three tabs; in each a main block, a refunds block and a deactivated block, laid out differently.
# Block b occupies the rows after b * width.
TRACKER_RAW = """
WITH d AS (
  SELECT CAST(c_custkey % 3 AS INT) AS tab_ord,
    CASE WHEN c_custkey % 10 < 7 THEN 0 WHEN c_custkey % 10 < 9 THEN 1 ELSE 2 END AS blk,
    c_custkey AS k, c_name AS n FROM customer
), tabs AS (SELECT DISTINCT tab_ord FROM d), r AS (
  SELECT tab_ord, blk, 3 + k AS pos,
    CASE blk WHEN 0 THEN {arr}(lower(n), concat('A ', CAST(k AS STRING), '@X.com'), concat('+91-', lpad(CAST(k AS STRING), 8, '0')), 'Coach1', '', CASE WHEN k % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END, 'FALSE', '✓', 'yes')
             WHEN 1 THEN {arr}('', n, concat('r', CAST(k AS STRING), '@x.com'), '', 'Coach2', 'TRUE')
             ELSE {arr}('', '', n, concat('d', CAST(k AS STRING), '@x.com'), '12345678') END AS cells
  FROM d
  UNION ALL SELECT tab_ord, 0, CAST(2 AS BIGINT), {arr}('NAMES', 'EMAIL ID', 'PH NO.', 'COACH', 'STATUS', 'ACCESS - GOLD', 'SILVER', 'GOLD', 'AGRA EVENT') FROM tabs
  UNION ALL SELECT tab_ord, 1, CAST(1 AS BIGINT), {arr}('', 'REFUNDS', 'REFUNDS') FROM tabs
  UNION ALL SELECT tab_ord, 1, CAST(2 AS BIGINT), {arr}('REFUNDS', 'NAMES', 'EMAIL', 'PHONE', 'COACH') FROM tabs
  UNION ALL SELECT tab_ord, 2, CAST(1 AS BIGINT), {arr}('DEACTIVATED') FROM tabs
  UNION ALL SELECT tab_ord, 2, CAST(2 AS BIGINT), {arr}('', '', 'NAME', 'MAIL', 'MOBILE') FROM tabs
)
SELECT 'Tracker' AS source_workbook, 'trk' AS source_spreadsheet,
  concat('Tab', CAST(tab_ord AS STRING)) AS source_sheet, 0 AS workbook_ord, tab_ord,
  blk * (SELECT max(c_custkey) + 10 FROM customer) + pos AS source_row, cells
FROM r
"""

TEXTS = {"leads_raw": LEADS_RAW, "buyers_raw": BUYERS_RAW, "tracker_raw": TRACKER_RAW}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spark_sql(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    """Run a SQL text over test tables; the first one is the largest.

    With the setting ``sheetloom.workload.spread`` (of the bench) that one is spread over all cores first, so that
    one small file does not bind all later row work to one task. Real inputs have more splits than cores.
    """
    spread = spark.conf.get("sheetloom.workload.spread", "false") == "true"
    for name in tables:
        rows = table(spark, sf_dir, name)
        if spread and name == tables[0]:
            rows = rows.repartition(spark.sparkContext.defaultParallelism, rows.columns[0])
        rows.createOrReplaceTempView(name)
    return spark.sql(text)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``leads_raw``, ``buyers_raw`` or ``tracker_raw``."""
    tables = ("customer",) if name == "tracker_raw" else ("orders", "customer", "nation")
    return spark_sql(spark, sf_dir, TEXTS[name].format(**SPARK), *tables)


def land_rows(rows: DataFrame, path: str, rows_per_range: int = 5000) -> None:
    """Write raw rows as values answers, one bounded range of consecutive rows per line."""
    chunk = F.floor((F.col("source_row") - 1) / rows_per_range).alias("__chunk")
    ordered = F.array_sort(F.collect_list(F.struct("source_row", "cells")))
    lines = rows.groupBy("source_spreadsheet", "source_sheet", chunk).agg(
        F.min("source_row").alias("first"), F.max("source_row").alias("last"), ordered.alias("numbered")
    )
    by_row = F.map_from_entries("numbered")
    with_gaps = F.transform(
        F.sequence("first", "last"),
        lambda r: F.coalesce(F.element_at(by_row, r), F.array().cast("array<string>")),
    )
    complete = F.size("numbered") == F.col("last") - F.col("first") + 1
    filled = F.when(complete, F.col("numbered.cells")).otherwise(with_gaps)
    quoted = F.concat(F.lit("'"), F.replace("source_sheet", F.lit("'"), F.lit("''")), F.lit("'"))
    range_ = F.concat(quoted, F.lit("!A"), F.col("first").cast("string"), F.lit(":"), F.col("last").cast("string"))
    answer = F.struct(range_.alias("range"), filled.alias("values"))
    lines.select(
        F.col("source_spreadsheet").alias("spreadsheetId"), F.array(answer).alias("valueRanges")
    ).write.json(path)


def duckdb_cte(name: str) -> str:
    """``name AS (...)`` for a DuckDB ``WITH`` clause."""
    return f"{name} AS ({TEXTS[name].format(**DUCKDB)})"

"""The same results in DuckDB SQL, written independently of the Spark expressions."""

from __future__ import annotations

from sheetloom.spec import BUYERS, LEADS, DatasetSpec
from workload import queries as q
from workload.raw_tables import DUCKDB, duckdb_cte

ROW = "source_spreadsheet, source_sheet, source_row"
TEXT = "array_to_string(cells, '|') AS cells_text"
TICKS = "'true','yes','y','1','✓','✔','☑','false','no','n','0','☐'"
TRUES = "'true','yes','y','1','✓','✔','☑'"
LEADS_TABS = "lower(source_sheet) LIKE '%leads%'"
BUYERS_TABS = "lower(source_sheet) LIKE '%buyers%'"


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ", ".join(ctes) + " " + select


LEADS_CTE, BUYERS_CTE, TRACKER_CTE = (duckdb_cte(n) for n in ("leads_raw", "buyers_raw", "tracker_raw"))
RAW_CTE = {"leads": LEADS_CTE, "buyers": BUYERS_CTE}


def number(x: str) -> str:
    """DOUBLE of a plain number text, NULL otherwise."""
    pattern = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
    return f"CASE WHEN regexp_matches({x}, '{pattern}') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


def stamp(x: str) -> str:
    """Timestamp of a number text by magnitude."""
    v = f"TRY_CAST(trim({x}) AS DOUBLE)"
    return (
        f"CASE WHEN abs({v}) >= 1e17 THEN make_timestamp(TRY_CAST(TRY_CAST({x} AS HUGEINT) // 1000 AS BIGINT))"
        f" WHEN abs({v}) >= 1e14 THEN make_timestamp(TRY_CAST({v} AS BIGINT))"
        f" WHEN abs({v}) >= 1e11 THEN make_timestamp(TRY_CAST({v} * 1000 AS BIGINT))"
        f" WHEN abs({v}) >= 1e8 THEN make_timestamp(TRY_CAST({v} * 1000000 AS BIGINT))"
        f" WHEN {v} IS NOT NULL THEN make_timestamp(TRY_CAST(round_even(({v} - 25569) * 86400, 0) AS BIGINT) * 1000000) END"
    )


def text_of(t: str) -> str:
    return f"strftime({t}, '%Y-%m-%d %H:%M:%S.%f')"


POSITIONS = {
    "leads": dict(name=1, email_address=2, mobile=3, city=4, age=5, registration_date=6, amount=7, utm_source=8),
    "buyers": dict(name=1, email_address=2, mobile=3, city=4, date=5),
}


def clean_ctes(spec: DatasetSpec, source: str, out: str, run: str) -> list[str]:
    """CTEs that turn raw rows ``source`` into clean rows ``out`` (dates as timestamps)."""
    at = POSITIONS[spec.name]
    columns = []
    for c, kind in spec.business:
        if c not in at:
            columns.append(f"CAST(NULL AS VARCHAR) AS {c}")
        elif kind == "datetime":
            columns.append(f"{stamp(f'cells[{at[c]}]')} AS {c}")
        elif kind == "integer":
            v = number(f"cells[{at[c]}]")
            columns.append(f"CASE WHEN ({v}) % 1 = 0 THEN TRY_CAST({v} AS BIGINT) END AS {c}")
        elif kind == "double":
            columns.append(f"{number(f'cells[{at[c]}]')} AS {c}")
        else:
            columns.append(f"nullif(trim(cells[{at[c]}]), '') AS {c}")
    typed = (
        f"{out}_typed AS (SELECT {', '.join(columns)}, source_workbook, {ROW}, workbook_ord, tab_ord FROM {source}"
        f" WHERE source_row > 1 AND lower(source_sheet) LIKE '%{spec.tab_token}%')"
    )
    second = lambda c: f"coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S'), '')"
    hashed = sorted((*spec.business_columns, "source_workbook", "source_spreadsheet", "source_sheet", "source_row"))
    pairs = [
        f"'{c}=' || " + (second(c) if c == spec.date_column else f"coalesce(CAST({c} AS VARCHAR), '')") for c in hashed
    ]
    cleaned = (
        f"{out} AS (SELECT *, sha256(coalesce(lower(email_address), '<na>') || '|' || coalesce(mobile, '<NA>') || '|' ||"
        f" {second(spec.date_column)}) AS record_id, sha256({' || chr(124) || '.join(pairs)}) AS row_hash,"
        f" TIMESTAMP '{run}' AS ingested_at_utc FROM {out}_typed)"
    )
    return [typed, cleaned]


def stored(spec: DatasetSpec, source: str) -> str:
    """Columns of the stored schema."""
    dates = (spec.date_column, "ingested_at_utc")
    return "SELECT " + ", ".join(f"{text_of(c)} AS {c}" if c in dates else c for c in spec.columns) + f" FROM {source}"


def newest(source: str, out: str, order: str = "workbook_ord DESC, tab_ord DESC, source_row DESC") -> str:
    return (
        f"{out} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY {order})"
        f" AS rn FROM {source}) WHERE rn = 1)"
    )


def prepared_ctes(spec: DatasetSpec, run: str = q.FIRST_RUN) -> list[str]:
    return [RAW_CTE[spec.name], *clean_ctes(spec, f"{spec.name}_raw", "cleaned", run), newest("cleaned", "prepared")]


def two_load_ctes(spec: DatasetSpec, second: str = "source_row > most / 2") -> list[str]:
    """``merged``: the rows of ``second`` come with the second load."""
    raw = f"(SELECT *, (SELECT max(source_row) FROM {spec.name}_raw) AS most FROM {spec.name}_raw)"
    return [
        RAW_CTE[spec.name],
        f"raw1 AS (SELECT * EXCLUDE (most) FROM {raw} WHERE NOT ({second}))",
        f"raw2 AS (SELECT * EXCLUDE (most) FROM {raw} WHERE {second})",
        *clean_ctes(spec, "raw1", "clean1", q.FIRST_RUN),
        *clean_ctes(spec, "raw2", "clean2", q.SECOND_RUN),
        "both_loads AS (SELECT *, 0 AS load_seq FROM clean1 UNION ALL BY NAME SELECT *, 1 AS load_seq FROM clean2)",
        newest("both_loads", "merged", "load_seq DESC, workbook_ord DESC, tab_ord DESC, source_row DESC"),
    ]


O: dict[str, str] = {}

# ---- sources, sinks, tabs ------------------------------------------------------------------

O["scan_tabs"] = with_(
    LEADS_CTE,
    select="SELECT CASE WHEN source_spreadsheet = 'wb2' THEN 'wb2' ELSE source_workbook END AS source_workbook,"
    f" {ROW}, workbook_ord, CAST(12 AS INTEGER) AS n_cells,"
    " array_to_string(list_concat(cells, ['x10', 'x11', 'x12', 'x13', 'x14'])[1:12], '|') AS cells_text"
    f" FROM leads_raw WHERE {LEADS_TABS}",
)
O["scan_tab_formatted"] = with_(
    TRACKER_CTE,
    select=f"SELECT {ROW}, CAST(len(cells) + 5 AS INTEGER) AS n_cells,"
    " array_to_string(list_concat(cells, ['x10', 'x11', 'x12', 'x13', 'x14']), '|') AS cells_text FROM tracker_raw",
)
O["filter_tabs_leads"] = with_(LEADS_CTE, select=f"SELECT {ROW}, {TEXT} FROM leads_raw WHERE {LEADS_TABS}")
O["filter_tabs_buyers"] = with_(BUYERS_CTE, select=f"SELECT {ROW}, {TEXT} FROM buyers_raw WHERE {BUYERS_TABS}")
O["select_tabs_named"] = with_(
    LEADS_CTE, select=f"SELECT {ROW}, {TEXT} FROM leads_raw WHERE source_sheet IN ('Leads Jan', 'paid leads')"
)
O["list_tabs"] = with_(LEADS_CTE, select="SELECT DISTINCT source_spreadsheet, source_sheet, tab_ord FROM leads_raw")
O["select_tabs_all"] = with_(LEADS_CTE, select=f"SELECT {ROW}, {TEXT} FROM leads_raw")
O["workbook_title"] = with_(
    LEADS_CTE,
    select=f"SELECT CASE WHEN source_spreadsheet = 'wb2' THEN 'wb2' ELSE source_workbook END AS source_workbook, {ROW}"
    " FROM leads_raw",
)
O["spreadsheet_id"] = (
    "SELECT k, CASE WHEN v LIKE '%/spreadsheets/d/%' THEN regexp_extract(v, '/spreadsheets/d/([^/?#]+)', 1)"
    f" ELSE trim(v) END AS spreadsheet_id FROM ({q.ADDRESSES}) AS a"
)
BLANK_BELOW = (
    "blanked AS (SELECT * REPLACE (CASE WHEN tab_ord = 0 AND source_row > (SELECT max(source_row) - 20 FROM leads_raw)"
    " THEN list_concat([''], cells[2:]) ELSE cells END AS cells) FROM leads_raw)"
)
ROW_COUNTS = (
    "SELECT source_spreadsheet, source_sheet,"
    " CAST(coalesce(max(CASE WHEN cells[1] <> '' THEN source_row END), 0) AS BIGINT) AS n_rows"
)
O["tab_row_count"] = with_(
    LEADS_CTE, BLANK_BELOW, select=f"{ROW_COUNTS} FROM blanked GROUP BY source_spreadsheet, source_sheet"
)
O["tab_headers"] = with_(
    LEADS_CTE,
    select="SELECT source_spreadsheet, source_sheet, array_to_string(list_transform(cells,"
    " lambda x: replace(lower(x), ' ', '_')), '|') AS headers FROM leads_raw WHERE source_row = 1",
)
O["target_exists"] = with_(
    *prepared_ctes(BUYERS), select="SELECT false AS before, true AS after, count(*) AS n_rows FROM prepared"
)
O["scan_target"] = with_(*prepared_ctes(BUYERS), select=stored(BUYERS, "prepared"))
O["write_target"] = with_(*prepared_ctes(LEADS), select=stored(LEADS, "prepared"))

# ---- shape ---------------------------------------------------------------------------------

O["normalize_headers"] = f"""
WITH h AS (SELECT k, unnest(headers) AS h, generate_subscripts(headers, 1) AS i FROM ({q.PART_HEADERS.format(arr='list_value')}) AS p),
n AS (SELECT k, i, coalesce(nullif(trim(regexp_replace(lower(trim(h)), '[^a-z0-9]+', '_', 'g'), '_'), ''),
  'column_' || i) AS name FROM h),
s AS (SELECT *, row_number() OVER (PARTITION BY k, name ORDER BY i) AS times FROM n)
SELECT k, string_agg(CASE WHEN times = 1 THEN name ELSE name || '_' || times END, '|' ORDER BY i) AS headers FROM s GROUP BY k"""
O["rectangularize"] = with_(
    LEADS_CTE,
    "cut AS (SELECT *, list_concat(cells, ['more', 'cells'])[1:CAST(source_row % 11 + 1 AS INTEGER)] AS part FROM leads_raw"
    " WHERE source_row > 1)",
    select=f"SELECT {ROW}, array_to_string(list_transform(range(1, 10), lambda i: coalesce(part[i], '')), '|') AS cells_text,"
    " coalesce(part[8], '') AS utm_source FROM cut",
)
O["source_row_number"] = with_(BUYERS_CTE, select=f"SELECT {ROW}, {TEXT} FROM buyers_raw")
O["project_declared"] = with_(
    BUYERS_CTE,
    select="SELECT cells[1] AS name, cells[2] AS email_address, cells[3] AS mobile, cells[4] AS city, cells[5] AS date,"
    f" {ROW} FROM buyers_raw WHERE source_row > 1 AND {BUYERS_TABS}",
)
BY_HEADER = (
    "cells[1] AS name, cells[2] AS email_address, cells[3] AS mobile, cells[4] AS city, cells[5] AS age,"
    " cells[6] AS registration_date, cells[7] AS amount, cells[8] AS utm_source"
)
LEADS_DATA = f"leads_data AS (SELECT * FROM leads_raw WHERE source_row > 1 AND {LEADS_TABS})"
ALL_DATA = "leads_data AS (SELECT * FROM leads_raw WHERE source_row > 1)"


def each_header(expression: str) -> str:
    """An expression of each of the nine columns; {0} is its cell."""
    return ", ".join(f"{expression.format(f'cells[{i + 1}]')} AS {name}" for i, name in enumerate(q.HEADER_NAMES))


O["drop_columns"] = with_(LEADS_CTE, ALL_DATA, select=f"SELECT {BY_HEADER}, {ROW} FROM leads_data")
O["blank_to_null"] = with_(
    LEADS_CTE, ALL_DATA,
    select=f"SELECT {each_header("CASE WHEN trim({0}) <> '' THEN {0} END")}, {ROW} FROM leads_data",
)
O["drop_blank_rows"] = with_(
    LEADS_CTE, LEADS_DATA,
    select=f"SELECT cells[1] AS name, cells[6] AS registration_date, {ROW} FROM leads_data WHERE source_row % 23 <> 0",
)
O["add_missing_columns"] = with_(
    LEADS_CTE, ALL_DATA,
    select="SELECT cells[1] AS name, cells[2] AS email_address, CAST(NULL AS BIGINT) AS age, CAST(NULL AS DOUBLE) AS amount,"
    " CAST(NULL AS VARCHAR) AS workshop_date, CAST(NULL AS VARCHAR) AS utm_medium, CAST(NULL AS VARCHAR) AS record_id,"
    f" {ROW} FROM leads_data",
)
O["conform_schema"] = with_(*prepared_ctes(LEADS), select=stored(LEADS, "cleaned"))
O["trim_strings"] = with_(LEADS_CTE, ALL_DATA, select=f"SELECT {each_header('trim({0})')}, {ROW} FROM leads_data")

# ---- scalar functions ----------------------------------------------------------------------

_V = number("v")
O["safe_integer"] = (
    f"SELECT k, CASE WHEN ({_V}) % 1 = 0 THEN TRY_CAST({_V} AS BIGINT) END AS n FROM ({q.NUMBER_TEXTS}) AS t"
)
O["safe_double"] = f"SELECT k, {_V} AS x FROM ({q.NUMBER_TEXTS}) AS t"
# The dates are known, so the expected value is computed from the day, not parsed from the text.
_DAY = "make_timestamp(day * 86400000000)"
_MONTH = f"date_trunc('month', {_DAY})"
O["normalize_datetime"] = f"""
SELECT k, strftime(CASE k % 20 WHEN 3 THEN {_DAY} + INTERVAL 37815250 MILLISECOND WHEN 6 THEN {_DAY} + INTERVAL 1265 MINUTE
  WHEN 7 THEN {_DAY} + INTERVAL 15 MINUTE WHEN 8 THEN {_DAY} + INTERVAL 86399 SECOND
  WHEN 9 THEN CAST({_MONTH} AS TIMESTAMP) WHEN 10 THEN CAST({_MONTH} AS TIMESTAMP) WHEN 11 THEN NULL WHEN 12 THEN NULL
  WHEN 13 THEN {_DAY} + INTERVAL 19 HOUR WHEN 15 THEN {_DAY} + INTERVAL 18 HOUR
  WHEN 16 THEN {_DAY} + INTERVAL 59 SECOND WHEN 17 THEN {_DAY} + INTERVAL 1250 MILLISECOND
  WHEN 18 THEN {_DAY} + INTERVAL 7 MICROSECOND WHEN 19 THEN {_DAY} + INTERVAL 1 MICROSECOND
  ELSE {_DAY} END, '%Y-%m-%d %H:%M:%S.%f') AS t
FROM ({q.DATE_TEXTS.format(days=DUCKDB['days'], arr='list_value', first='0')}) AS d"""
O["datetime_to_string"] = (
    "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS t FROM events"
)
for _spec, _suffix in ((LEADS, ""), (BUYERS, "_buyers")):
    for _c in ("record_id", "row_hash"):
        O[_c + _suffix] = with_(*prepared_ctes(_spec), select=f"SELECT {ROW}, {_c} FROM cleaned")
O["ingested_at"] = with_(
    *prepared_ctes(LEADS), select=f"SELECT {ROW}, {text_of('ingested_at_utc')} AS ingested_at_utc FROM cleaned"
)
O["clean_text"] = r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents"
_KEY = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
O["header_key"] = f"SELECT doc_id, {_KEY.format('text')} AS t FROM documents"
O["snake_case"] = f"SELECT doc_id, replace({_KEY.format('text')}, ' ', '_') AS t FROM documents"
CELLS = (
    f"cells_of AS (SELECT {ROW}, CAST(generate_subscripts(cells, 1) - 1 AS INTEGER) AS pos, unnest(cells) AS cell"
    " FROM tracker_raw)"
)
O["to_bool"] = with_(
    TRACKER_CTE, CELLS, select=f"SELECT {ROW}, pos, lower(trim(cell)) IN ({TRUES}) AS is_true FROM cells_of"
)
O["is_bool_text"] = with_(TRACKER_CTE, CELLS, select=f"SELECT {ROW}, pos, lower(cell) IN ({TICKS}) AS is_tick FROM cells_of")
O["title_case_name"] = f"""
SELECT k, array_to_string(list_transform(range(1, len(v) + 1), lambda i: CASE WHEN i > 1 AND regexp_matches(v[i - 1], '[a-zA-Z]')
  THEN lower(v[i]) ELSE upper(v[i]) END), '') AS t FROM ({q.NAMES}) AS n"""
O["clean_email"] = f"SELECT k, replace(lower(email), ' ', '') AS t FROM ({q.CONTACTS}) AS c"
O["clean_mobile"] = f"SELECT k, regexp_replace(mobile, '[^0-9+]', '', 'g') AS t FROM ({q.CONTACTS}) AS c"
_STATUS = (
    "CASE WHEN contains(upper(status || ' ' || section), 'DEACTIVAT') THEN 'Deactivated'"
    " WHEN contains(upper(status || ' ' || section), 'REFUND') THEN 'Refund' ELSE 'Active' END"
)
O["client_status"] = f"SELECT k, {_STATUS} AS client_status FROM ({q.STATUSES}) AS s"
O["is_active"] = f"SELECT k, {_STATUS} = 'Active' AS is_active FROM ({q.STATUSES}) AS s"


def canonical(x: str) -> str:
    key = _KEY.format(x)
    word = lambda *ws: " OR ".join(f"list_contains(string_split({key}, ' '), '{w}')" for w in ws)
    has = lambda *ts: " OR ".join(f"contains({key}, '{t}')" for t in ts)
    return (
        f"CASE WHEN ({word('status')}) AND ({word('data')}) THEN 'status_data' WHEN {word('status')} THEN 'status'"
        f" WHEN {has('email')} OR {word('mail')} THEN 'email'"
        f" WHEN starts_with({key}, 'ph') OR {has('phone', 'mobile', 'whatsapp')} OR {word('contact')} THEN 'mobile'"
        f" WHEN {has('coach')} THEN 'coach' WHEN {word('tech')} THEN 'tech_member'"
        f" WHEN {has('comment', 'remark')} THEN 'comment' WHEN {word('silver')} THEN 'access_silver_lifetime'"
        f" WHEN ({word('gold')}) AND ({has('lifetime', 'life time')}) THEN 'access_gold_pro_lifetime'"
        f" WHEN {word('gold')} THEN 'access_gold_pro' WHEN {word('name', 'names')} THEN 'name' END"
    )


O["canonical_header"] = f"SELECT k, {canonical('v')} AS canonical FROM ({q.HEADER_TEXTS}) AS h"

# ---- tracker rows --------------------------------------------------------------------------

O["drop_empty_rows"] = with_(
    LEADS_CTE,
    select=f"SELECT {ROW}, array_to_string(list_transform(cells, lambda x: trim(x)), '|') AS cells_text FROM leads_raw"
    " WHERE source_row = 1 OR source_row % 23 <> 0",
)
NAMED = (
    f"named AS (SELECT {ROW}, list_transform(cells, lambda x: {canonical('x')}) AS names, cells FROM tracker_raw)"
)
HEADER = "list_contains(names, 'name') AND list_contains(names, 'email')"
_TEXTS = f"list_filter(cells, lambda x: x <> '' AND lower(x) NOT IN ({TICKS}))"
TITLED = (
    f"titled AS (SELECT {ROW}, cells, names, coalesce({HEADER}, false) AS is_header, {_TEXTS} AS texts FROM named),"
    " marked AS (SELECT *, CASE WHEN len(list_distinct(list_transform(texts, lambda x: upper(x)))) = 1"
    " AND texts[1] = upper(texts[1]) AND regexp_matches(texts[1], '[A-Z]') THEN texts[1] END AS title FROM titled),"
    " sectioned AS (SELECT *, coalesce(last_value(title IGNORE NULLS) OVER (PARTITION BY source_sheet ORDER BY source_row),"
    " 'MAIN') AS section FROM marked)"
)
O["is_header_row"] = with_(TRACKER_CTE, NAMED, TITLED, select=f"SELECT {ROW}, is_header FROM marked")
O["section_title"] = with_(TRACKER_CTE, NAMED, TITLED, select=f"SELECT {ROW}, title FROM marked")
O["section_fill"] = with_(TRACKER_CTE, NAMED, TITLED, select=f"SELECT {ROW}, section FROM sectioned")
# Each tab has three headers, so the merge is written out as two steps.
LAYOUTS = f"""
heads AS (SELECT {ROW}, section, row_number() OVER (PARTITION BY source_sheet ORDER BY source_row) AS nth,
  unnest(cells) AS cell, unnest(names) AS canonical, generate_subscripts(cells, 1) - 1 AS pos FROM sectioned WHERE is_header),
base AS (SELECT *, coalesce(canonical, replace({_KEY.format('cell')}, ' ', '_')) AS name FROM heads
  WHERE cell <> '' AND upper(cell) <> upper(section)),
golds AS (SELECT * REPLACE (CASE WHEN name = 'access_gold_pro' AND row_number() OVER
  (PARTITION BY source_sheet, nth, name ORDER BY pos) > 1 THEN 'access_gold_pro_lifetime' ELSE name END AS name) FROM base),
own AS (SELECT {ROW}, section, nth, pos, CASE WHEN times = 1 THEN name ELSE name || '_' || times END AS name FROM
  (SELECT *, row_number() OVER (PARTITION BY source_sheet, nth, name ORDER BY pos) AS times FROM golds)),
m1 AS (SELECT source_sheet, pos, name FROM own WHERE nth = 1),
m2 AS (SELECT source_sheet, pos, name FROM own WHERE nth = 2 UNION ALL SELECT source_sheet, pos, name FROM m1 WHERE
  (source_sheet, pos) NOT IN (SELECT source_sheet, pos FROM own WHERE nth = 2) AND
  (source_sheet, name) NOT IN (SELECT source_sheet, name FROM own WHERE nth = 2)),
m3 AS (SELECT source_sheet, pos, name FROM own WHERE nth = 3 UNION ALL SELECT source_sheet, pos, name FROM m2 WHERE
  (source_sheet, pos) NOT IN (SELECT source_sheet, pos FROM own WHERE nth = 3) AND
  (source_sheet, name) NOT IN (SELECT source_sheet, name FROM own WHERE nth = 3)),
spots AS (SELECT DISTINCT {ROW}, section, nth FROM own),
merged AS (SELECT s.*, m.pos, m.name FROM spots AS s JOIN
  (SELECT 1 AS nth, * FROM m1 UNION ALL SELECT 2, * FROM m2 UNION ALL SELECT 3, * FROM m3) AS m
  ON s.nth = m.nth AND s.source_sheet = m.source_sheet),
layouts AS (SELECT {ROW}, section, string_agg(pos || ':' || name, ',' ORDER BY pos) AS layout FROM merged GROUP BY ALL)"""
O["header_layout"] = with_(
    TRACKER_CTE, NAMED, TITLED, LAYOUTS,
    select=f"SELECT {ROW}, section, string_agg(pos || ':' || name, ',' ORDER BY pos) AS layout FROM own GROUP BY {ROW}, section",
)
O["merge_layout"] = with_(TRACKER_CTE, NAMED, TITLED, LAYOUTS, select=f"SELECT {ROW}, section, layout FROM layouts")
ASOF = (
    "placed AS (SELECT r.source_spreadsheet, r.source_sheet, r.source_row, r.cells, l.source_row AS header_row, l.layout"
    " FROM sectioned AS r ASOF LEFT JOIN layouts AS l ON r.source_sheet = l.source_sheet AND r.source_row >= l.source_row)"
)
O["asof_layout"] = with_(
    TRACKER_CTE, NAMED, TITLED, LAYOUTS, ASOF, select=f"SELECT {ROW}, header_row, layout FROM placed"
)
_CELL = "coalesce(max(CASE WHEN m.name = '{0}' THEN p.cells[m.pos + 1] END), '') AS {0}"
O["is_client_row"] = with_(
    TRACKER_CTE, NAMED, TITLED, LAYOUTS, ASOF,
    "fields AS (SELECT p.source_spreadsheet, p.source_sheet, p.source_row, p.cells,"
    f" {_CELL.format('name')}, {_CELL.format('email')}, {_CELL.format('mobile')} FROM placed AS p JOIN merged AS m"
    " ON p.source_sheet = m.source_sheet AND p.header_row = m.source_row WHERE p.source_row > p.header_row GROUP BY ALL)",
    select=f"SELECT {ROW}, contains(email, '@') OR len(regexp_replace(mobile, '[^0-9]', '', 'g')) >= 7 OR"
    f" (name <> '' AND len(list_distinct(list_transform({_TEXTS}, lambda x: upper(x)))) >= 2) AS is_client FROM fields",
)
# The client rows are the customers: expected values come from the customer table itself.
CLIENTS = f"""
people AS (SELECT c_custkey AS k, c_name AS n, CASE WHEN c_custkey % 10 < 7 THEN 0 WHEN c_custkey % 10 < 9 THEN 1 ELSE 2 END
  AS blk FROM customer),
parsed AS (SELECT CASE blk WHEN 0 THEN lower(n) ELSE n END AS name,
  CASE blk WHEN 0 THEN 'A ' || k || '@X.com' WHEN 1 THEN 'r' || k || '@x.com' ELSE 'd' || k || '@x.com' END AS email,
  CASE blk WHEN 0 THEN '+91-' || lpad(CAST(k AS VARCHAR), 8, '0') WHEN 1 THEN '' ELSE '12345678' END AS mobile,
  CASE blk WHEN 0 THEN 'Coach1' WHEN 1 THEN 'Coach2' ELSE '' END AS coach, '' AS tech_member, '' AS status, '' AS status_data,
  CASE blk WHEN 0 THEN CASE WHEN k % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END WHEN 1 THEN 'TRUE' ELSE '' END AS access_gold_pro,
  CASE blk WHEN 0 THEN 'FALSE' ELSE '' END AS access_silver_lifetime,
  CASE blk WHEN 0 THEN '✓' ELSE '' END AS access_gold_pro_lifetime, '' AS comment,
  CASE blk WHEN 0 THEN 'yes' ELSE '' END AS agra_event,
  CASE blk WHEN 0 THEN 'MAIN' WHEN 1 THEN 'REFUNDS' ELSE 'DEACTIVATED' END AS section,
  'Tab' || (k % 3) AS source_sheet, CAST(blk * (SELECT max(c_custkey) + 10 FROM customer) + 3 + k AS BIGINT) AS source_row
  FROM people)"""
CLIENT_TABLE = """
clients AS (SELECT upper(name[1]) || lower(name[2:]) AS name, replace(lower(email), ' ', '') AS email,
  replace(mobile, '-', '') AS mobile, coach, tech_member, status, status_data,
  CASE section WHEN 'DEACTIVATED' THEN 'Deactivated' WHEN 'REFUNDS' THEN 'Refund' ELSE 'Active' END AS client_status,
  section = 'MAIN' AS is_active, access_gold_pro = 'TRUE' AS access_gold_pro, access_silver_lifetime = 'TRUE' AS
  access_silver_lifetime, access_gold_pro_lifetime = '✓' AS access_gold_pro_lifetime, comment, agra_event = 'yes' AS agra_event,
  section, source_sheet, source_row FROM parsed)"""
O["parse_tracker"] = with_(CLIENTS, select="SELECT * FROM parsed")
O["infer_bool_columns"] = with_(
    CLIENTS,
    select="SELECT name, name = 'agra_event' AND (SELECT bool_and(agra_event IN ('', 'yes')) FROM parsed) AS is_bool FROM"
    " (SELECT unnest(['name', 'email', 'mobile', 'coach', 'tech_member', 'status', 'status_data', 'client_status', 'comment',"
    " 'agra_event']) AS name) AS c",
)
O["build_clients"] = with_(CLIENTS, CLIENT_TABLE, select="SELECT * FROM clients")
O["tracker_clients"] = O["build_clients"]
O["status_counts"] = with_(
    CLIENTS, CLIENT_TABLE, select="SELECT client_status, count(*) AS n FROM clients GROUP BY client_status"
)

# ---- aggregates, dedup, incremental --------------------------------------------------------

_LAST = "SELECT source_spreadsheet, source_sheet, CAST(max(source_row) AS BIGINT) AS last_row"
_TAB = "GROUP BY source_spreadsheet, source_sheet"
O["checkpoint"] = with_(*prepared_ctes(LEADS), select=f"{_LAST} FROM prepared {_TAB}")
O["incremental_filter"] = with_(
    LEADS_CTE,
    BLANK_BELOW,
    f"wanted AS (SELECT * FROM blanked WHERE {LEADS_TABS})",
    f"seen AS ({_LAST} FROM wanted WHERE tab_ord <> 2 AND source_row <= (SELECT max(source_row) / 2 FROM wanted) {_TAB})",
    f"counts AS ({ROW_COUNTS} FROM wanted {_TAB})",
    select=f"SELECT {ROW}, {TEXT} FROM wanted JOIN counts USING (source_spreadsheet, source_sheet) LEFT JOIN seen"
    " USING (source_spreadsheet, source_sheet) WHERE source_row > coalesce(last_row, 1) AND source_row <= n_rows",
)
O["shrunk_tabs"] = with_(
    LEADS_CTE,
    "now_rows AS (SELECT * FROM leads_raw WHERE tab_ord = 1 OR source_row <= (SELECT max(source_row) / 2 FROM leads_raw))",
    f"counts AS ({ROW_COUNTS} FROM now_rows {_TAB})",
    f"seen AS ({_LAST} FROM leads_raw {_TAB})",
    select="SELECT source_spreadsheet, source_sheet, last_row, n_rows FROM counts JOIN seen"
    " USING (source_spreadsheet, source_sheet) WHERE n_rows < last_row",
)
O["headerless_tabs"] = with_(
    LEADS_CTE,
    "kept_rows AS (SELECT * FROM leads_raw WHERE NOT (workbook_ord = 0 AND tab_ord = 1 AND source_row = 1)"
    " AND NOT (workbook_ord = 1 AND tab_ord = 2 AND source_row > 1))",
    "tabs AS (SELECT source_spreadsheet, source_sheet, CAST(max(source_row) AS BIGINT) AS n_rows, min(source_row) AS top"
    f" FROM kept_rows {_TAB})",
    select="SELECT source_spreadsheet, source_sheet, n_rows, CASE WHEN top > 1 THEN 'no header' ELSE 'no data rows' END"
    " AS reason FROM tabs WHERE top > 1 OR n_rows <= 1",
)
O["union_all"] = with_(
    LEADS_CTE,
    *clean_ctes(LEADS, "leads_raw", "l", q.FIRST_RUN),
    BUYERS_CTE,
    *clean_ctes(BUYERS, "buyers_raw", "b", q.FIRST_RUN),
    select="SELECT name, city, age, record_id, CAST(0 AS INTEGER) AS load_seq FROM l UNION ALL"
    " SELECT name, city, CAST(NULL AS BIGINT), record_id, 1 FROM b",
)
O["dedup_keep_last"] = with_(*prepared_ctes(LEADS), select=f"SELECT record_id, row_hash, {ROW} FROM prepared")
O["dedup_relanded_rows"] = with_(
    BUYERS_CTE,
    "edited AS (SELECT * REPLACE (CASE WHEN source_row > 1 AND source_row % 5 = 0 THEN list_concat(cells[1:3], ['Relanded'],"
    " cells[5:]) ELSE cells END AS cells) FROM buyers_raw)",
    *clean_ctes(BUYERS, "edited", "cleaned", q.FIRST_RUN),
    newest("cleaned", "prepared"),
    select=stored(BUYERS, "prepared"),
)
O["incremental_late_header"] = with_(*two_load_ctes(BUYERS, "tab_ord = 1"), select=stored(BUYERS, "merged"))
O["incremental_late_range"] = with_(*two_load_ctes(BUYERS, q.LATE_RANGE), select=stored(BUYERS, "merged"))
O["rows_read"] = with_(
    BUYERS_CTE,
    f"b AS (SELECT source_spreadsheet, source_sheet, source_row AS r FROM buyers_raw WHERE source_row > 1 AND {BUYERS_TABS})",
    "i AS (SELECT *, r - row_number() OVER (PARTITION BY source_spreadsheet, source_sheet ORDER BY r) AS island FROM b)",
    select='SELECT source_spreadsheet, source_sheet, min(r) AS "first", max(r) AS "last" FROM i GROUP BY source_spreadsheet, source_sheet, island',
)
O["typed_cells"] = with_(
    LEADS_CTE,
    select=f"SELECT {ROW}, nullif(trim(cells[1]), '') AS name,"
    " CASE source_row % 5 WHEN 0 THEN 'False' WHEN 1 THEN 'false' ELSE nullif(trim(cells[4]), '') END AS city,"
    f" CASE source_row % 7 WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE CASE WHEN ({number('cells[5]')}) % 1 = 0 THEN TRY_CAST({number('cells[5]')} AS BIGINT) END END AS age,"
    f" {number('cells[7]')} AS amount, {text_of(stamp('cells[6]'))} AS registered FROM leads_raw WHERE source_row > 1 AND {LEADS_TABS}",
)
O["load_report"] = with_(
    BUYERS_CTE,
    select="SELECT source_spreadsheet, source_sheet, CAST(max(source_row) AS BIGINT) AS n_rows, CAST(NULL AS BIGINT) AS last_row,"
    " CASE WHEN min(tab_ord) = 1 THEN 0 ELSE count(*) FILTER (source_row > 1) END AS new_rows,"
    f" CASE WHEN min(tab_ord) = 1 THEN 'no header' END AS note FROM buyers_raw WHERE {BUYERS_TABS} {_TAB}",
)
O["merge_upsert"] = with_(*two_load_ctes(BUYERS), select=stored(BUYERS, "merged"))
O["row_counts"] = with_(
    LEADS_CTE, LEADS_DATA, select=f"SELECT source_spreadsheet, source_sheet, count(*) AS n FROM leads_data {_TAB}"
)
O["validate"] = with_(
    *prepared_ctes(LEADS), select="SELECT count(*) AS n_rows, count(*) - count(record_id) AS n_null_ids FROM prepared"
)

# ---- whole flows ---------------------------------------------------------------------------

for _spec in (BUYERS, LEADS):
    O[f"prepare_{_spec.name}"] = with_(*prepared_ctes(_spec), select=stored(_spec, "prepared"))
    O[f"full_load_{_spec.name}"] = O[f"prepare_{_spec.name}"]
    O[f"incremental_{_spec.name}"] = with_(*two_load_ctes(_spec), select=stored(_spec, "merged"))
    O[f"incremental_stream_{_spec.name}"] = O[f"incremental_landing_{_spec.name}"] = O[f"incremental_{_spec.name}"]

ORACLES = O

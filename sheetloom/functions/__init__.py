"""Column expressions."""

from sheetloom.functions.datetimes import datetime_text, normalize_datetime, second_text, with_datetime
from sheetloom.functions.headers import canonical_header, normalize_headers
from sheetloom.functions.identity import record_id, row_hash
from sheetloom.functions.numbers import double_text, safe_double, safe_integer
from sheetloom.functions.text import (
    blank_to_null,
    clean_email,
    clean_mobile,
    clean_text,
    client_status,
    header_key,
    is_tick_text,
    snake_case,
    spreadsheet_id,
    strip,
    strip_to_null,
    title_case,
    to_bool,
)

__all__ = [name for name in dir() if not name.startswith("_")]

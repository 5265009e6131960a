"""Spreadsheet intake on Spark: ragged tabs in, clean deduplicated tables out."""

from sheetloom.operators.lookup import LookupLimits
from sheetloom.plans.loads import adopt_target, full_load, incremental_load, load, load_landing, prepare
from sheetloom.plans.tracker import build_clients, parse_tracker, tracker_clients, write_clients
from sheetloom.session import get_spark
from sheetloom.sources.landed import read_raw, read_workbooks, scan_dataset, scan_tab_formatted, scan_tabs, tab_listing
from sheetloom.sources.target import scan_target, target_exists, write_target
from sheetloom.spec import BUYERS, LEADS, DatasetSpec
from sheetloom.streaming.available_now import load_available

__all__ = [
    "BUYERS",
    "LEADS",
    "DatasetSpec",
    "LookupLimits",
    "adopt_target",
    "build_clients",
    "full_load",
    "get_spark",
    "incremental_load",
    "load",
    "load_available",
    "load_landing",
    "parse_tracker",
    "prepare",
    "read_raw",
    "read_workbooks",
    "scan_dataset",
    "scan_tab_formatted",
    "scan_tabs",
    "scan_target",
    "tab_listing",
    "target_exists",
    "tracker_clients",
    "write_clients",
    "write_target",
]

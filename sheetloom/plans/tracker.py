"""The tracker: irregular multi-block tabs -> one uniform client table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sheetloom.functions.text import (
    TICK_WORDS,
    clean_email,
    clean_mobile,
    client_status,
    let,
    title_case,
    to_bool,
)
from sheetloom.operators.layout import clean_rows, is_client_row, layout_position, mark_rows
from sheetloom.operators.lookup import DEFAULT_LIMITS, LookupLimits, asof_lookup
from sheetloom.operators.tabs import KEYS
from sheetloom.session import stage

# The columns of the client table.
ACCESS_COLUMNS = ("access_gold_pro", "access_silver_lifetime", "access_gold_pro_lifetime")
CORE_COLUMNS = (
    "name",
    "email",
    "mobile",
    "coach",
    "tech_member",
    "status",
    "status_data",
    "client_status",
    "is_active",
    *ACCESS_COLUMNS,
    "comment",
)
HEADER_COLUMNS = tuple(c for c in CORE_COLUMNS if c not in ("client_status", "is_active"))
META_COLUMNS = ("section", "source_sheet", "source_row")


def parse_tracker(rows: DataFrame, limits: LookupLimits = DEFAULT_LIMITS) -> DataFrame:
    """Client rows of all tabs: the fixed header columns as text, other headers in ``extras``.

    Two passes over ``rows``: one finds the marks, one places the data rows. Data rows stay in
    JVM expressions and, as long as the marks may be broadcast, are not shuffled.
    """
    taken = F.array(*(F.lit(c) for c in CORE_COLUMNS + META_COLUMNS))
    layout = F.col("layout")
    untaken = F.filter(layout, lambda e: ~F.array_contains(taken, e["name"]))
    # of equal names the last one counts; settled once per mark
    repeated = lambda all_, e, i: F.exists(F.slice(all_, i + 2, F.size(all_)), lambda x: x["name"] == e["name"])
    others = let(untaken, lambda all_: F.filter(all_, lambda e, i: ~repeated(all_, e, i)))
    marks = mark_rows(rows, limits).select(
        *KEYS,
        "source_row",
        "header_row",
        "section",
        *(layout_position(layout, c).alias(f"at_{c}") for c in HEADER_COLUMNS),
        F.when(layout.isNotNull(), others).alias("others"),
    )
    placed = asof_lookup(clean_rows(rows), marks, KEYS, "source_row", limits)
    # Written so that NULLs pass through: the lookup stays an outer join, and the client rules run
    # once per row above it instead of once per row and mark inside the join condition.
    data_row = (F.col("source_row") > F.col("header_row")) & (F.col("source_row") != F.col("mark_position"))
    below_header = placed.where(F.coalesce(data_row, F.lit(False)))
    cell = lambda at: F.coalesce(F.get("cells", at), F.lit(""))
    extras = F.map_from_arrays(F.col("others.name"), F.transform("others", lambda e: cell(e["at"])))
    records = below_header.select(
        "source_spreadsheet",
        "tab_ord",
        "header_row",
        "cells",
        *(cell(F.col(f"at_{c}")).alias(c) for c in HEADER_COLUMNS),
        F.when(F.size("others") > 0, extras).otherwise(F.create_map().cast("map<string,string>")).alias("extras"),
        *META_COLUMNS,
    )
    client = is_client_row(F.col("name"), F.col("email"), F.col("mobile"), F.col("cells"))
    return records.where(client).drop("cells")


def extra_columns(parsed: DataFrame, most: int = 10_000) -> list[str]:
    """Names of the other headers, in the order in which client rows first show them.

    Each becomes a column, so their number is bounded: more than ``most`` are an error, and :func:`build_clients` then
    takes a list of those wanted. Rows are first reduced to one per block, with
    partial aggregation, so nothing row-sized is exploded or moved.
    """
    blocks = parsed.groupBy("tab_ord", *KEYS, "header_row").agg(
        F.min("source_row").alias("first_row"), F.first(F.map_keys("extras")).alias("names")
    )
    seen = blocks.select("tab_ord", "first_row", F.posexplode("names").alias("at", "name"))
    first = seen.groupBy("name").agg(F.min(F.struct("tab_ord", "first_row", "at")).alias("first"))
    names = [r["name"] for r in first.orderBy("first").select("name").limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"the trackers have {first.count()} other headers, more than {most}: name the ones wanted")
    return names


def bool_column_report(clients: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column: does it hold tick words only, and at least one?

    ``clients`` are as :func:`clean_clients` returns them: other headers are entries of the map ``extras``, not columns. Every
    row gives its filled entries by name, and a name's entries are aggregated, combined before the shuffle, so the plan
    is the same for any number of headers.
    """
    held = set(clients.columns) - {"extras"}
    own = [c for c in columns if c in held]
    fixed = F.map_from_arrays(F.array(*map(F.lit, own)), F.array(*(F.col(c) for c in own)))
    entries = F.map_entries(F.map_concat(F.map_filter("extras", lambda k, v: ~k.isin(own)), fixed))
    filled = F.filter(entries, lambda e: F.trim(e["value"]) != "")
    ticks = F.transform(filled, lambda e: F.struct(e["key"].alias("name"), F.lower(F.trim(e["value"])).isin(*TICK_WORDS).alias("tick")))
    found = clients.select(F.inline(ticks)).groupBy("name").agg(F.bool_and("tick").alias("is_bool"))
    asked = clients.sparkSession.createDataFrame([(c,) for c in columns], "name string")
    return asked.join(found, "name", "left").select("name", F.coalesce("is_bool", F.lit(False)).alias("is_bool"))


def infer_bool_columns(clients: DataFrame, columns: Sequence[str]) -> list[str]:
    """The text columns of :func:`bool_column_report` that are booleans."""
    if not columns:
        return []
    found = {r["name"] for r in bool_column_report(clients, columns).where("is_bool").collect()}
    return [c for c in columns if c in found]


def clean_clients(parsed: DataFrame) -> DataFrame:
    """Clean names, emails and mobiles; derive the status; tick columns become booleans."""
    status = client_status(F.col("status"), F.col("section"))
    return parsed.withColumns(
        {
            "name": title_case(F.col("name")),
            "email": clean_email(F.col("email")),
            "mobile": clean_mobile(F.col("mobile")),
            "client_status": status,
            "is_active": status == "Active",
        }
        | {c: to_bool(F.col(c)) for c in ACCESS_COLUMNS}
    )


def text_columns(extras: Sequence[str]) -> list[str]:
    """The columns that may turn out to be tick columns."""
    return [c for c in CORE_COLUMNS if c not in ACCESS_COLUMNS and c != "is_active"] + list(extras)


def build_clients(parsed: DataFrame, extras: Sequence[str] | None = None) -> DataFrame:
    """The client table: core columns, other columns (``extras``, by default all of them), lineage.

    Its schema depends on the data, so two small results reach the driver: the other columns' names and
    which columns hold tick words only. ``parsed`` should be staged, or cheap to run again.
    """
    extras = extra_columns(parsed) if extras is None else list(extras)
    clients = clean_clients(parsed)
    ticks, held = set(infer_bool_columns(clients, text_columns(extras))), set(clients.columns)
    value = lambda c: F.col(c) if c in held else F.coalesce(F.element_at("extras", F.lit(c)), F.lit(""))
    typed = lambda c: (to_bool(value(c)) if c in ticks else value(c)).alias(c)
    return clients.select(*(typed(c) for c in (*CORE_COLUMNS, *extras)), *META_COLUMNS)


def tracker_clients(rows: DataFrame, limits: LookupLimits = DEFAULT_LIMITS) -> DataFrame:
    """Raw tracker rows -> client table.

    The parsed rows are staged: finding the schema and writing the table read them three times.
    """
    return build_clients(stage(parse_tracker(rows, limits), "parsed"))


def output_name(tabs: Sequence[str], stamp: str) -> str:
    """Folder name of a client table: the one tab's name, or ``combined``."""
    label = "_".join("".join(ch if ch.isascii() and ch.isalnum() else " " for ch in tabs[0].lower()).split())
    return f"clients_{label if len(tabs) == 1 else 'combined'}_{stamp}"


def write_clients(clients: DataFrame, folder: str, tabs: Sequence[str], stamp: str, format: str = "parquet") -> str:
    """Write the client table as Parquet or CSV and return its path."""
    path = f"{folder}/{output_name(tabs, stamp)}"
    writer = clients.write.option("header", "true") if format == "csv" else clients.write
    writer.format(format).save(path)
    return path

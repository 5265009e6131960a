"""The intake of declared datasets: prepare, full load, incremental load."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetloom.functions.cells import has_typed_cells
from sheetloom.functions.headers import normalize_headers
from sheetloom.functions.identity import record_id, row_hash
from sheetloom.functions.text import strip, strip_to_null
from sheetloom.operators import row_sets
from sheetloom.operators.dedup import dedup_keep_last
from sheetloom.operators.incremental import checkpoint, newest_headers, present_rows, rows_in, tab_facts, tab_report
from sheetloom.operators.lookup import DEFAULT_LIMITS, LookupLimits, lookup_join
from sheetloom.operators.shape import (
    blanks_to_null,
    conform_schema,
    decode_dates,
    drop_blank_rows,
    number_columns,
    project_declared,
)
from sheetloom.operators.tabs import KEYS, filter_tabs, header_positions, tab_headers
from sheetloom.session import scratch_scope, stage, staged_size
from sheetloom.sources.landed import landing_blocks, read_blocks, read_raw
from sheetloom.sources.target import (
    PublishConflict,
    expire_versions,
    merge_target,
    publish_tables,
    scan_table,
    scan_target,
    target_exists,
    target_info,
    write_target,
)
from sheetloom.spec import LINEAGE_COLUMNS, ORDER_COLUMNS, DatasetSpec


def _run_time(at: datetime.datetime | str | None) -> Column:
    """One zone-less UTC timestamp for the whole run, fixed when the plan is built."""
    if at is None:
        at = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
    return F.lit(str(at)).cast("timestamp_ntz")


def declared_rows(
    rows: DataFrame, spec: DatasetSpec, headers: DataFrame | None = None, limits: LookupLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Data rows of the dataset's tabs with their declared columns as text.

    The header of each tab is turned into column positions once; data rows only pick cells by
    position. Tabs without a header are skipped. ``headers`` defaults to row 1 of ``rows``.
    """
    wanted = filter_tabs(rows, spec)
    found = tab_headers(wanted, spec.read_width) if headers is None else headers
    positions = stage(header_positions(found, spec.business_columns), "headers", measured=True)
    data = wanted.where("source_row > 1")
    if spec.read_width is not None:
        data = data.withColumn("cells", F.slice("cells", 1, spec.read_width))
    return project_declared(lookup_join(data, positions, KEYS, limits=limits), spec)


def identify(df: DataFrame, spec: DatasetSpec, ingested_at: datetime.datetime | str | None = None) -> DataFrame:
    """Add ``record_id``, ``row_hash`` and ``ingested_at_utc``."""
    return df.withColumns(
        {
            "record_id": record_id(F.col("email_address"), F.col("mobile"), F.col(spec.date_column)),
            "row_hash": row_hash(spec),
            "ingested_at_utc": _run_time(ingested_at),
        }
    )


def prepare(
    rows: DataFrame,
    spec: DatasetSpec,
    ingested_at: datetime.datetime | str | None = None,
    headers: DataFrame | None = None,
    limits: LookupLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Raw rows -> clean, typed, identified rows, one per ``record_id``, in the typed schema."""
    declared = declared_rows(rows, spec, headers, limits)
    return dedup_keep_last(clean(declared, spec, ingested_at)).select(*spec.columns)


def clean(
    declared: DataFrame, spec: DatasetSpec, ingested_at: datetime.datetime | str | None = None
) -> DataFrame:
    """:func:`prepare` without its first and last step: no shuffle. Order columns are kept."""
    df = decode_dates(drop_blank_rows(declared, spec), spec)
    df = df.withColumns(
        number_columns(spec)
        | {c: strip_to_null(F.col(c)) for c in spec.of_kind("text")}
        | {c: strip(F.col(c)) for c in LINEAGE_COLUMNS if c != "source_row"}
    )
    df = identify(df, spec, ingested_at)
    return df.select(*spec.columns, *(c for c in ORDER_COLUMNS if c in df.columns and c not in spec.columns))


def reprepare(target: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Clean rows of an existing target again; their ids, hashes and ingestion times are kept."""
    df = target.select(*(c for c in spec.columns if c in target.columns))
    df = blanks_to_null(df, [f.name for f in df.schema if f.dataType.typeName() == "string"])
    return conform_schema(drop_blank_rows(df, spec), spec)


def _normal_headers(header_rows: DataFrame) -> DataFrame:
    """Header rows as landed -> normalised headers."""
    return header_rows.select(*KEYS, normalize_headers(F.col("cells")).alias("headers"))


def _blocks_of(chunks: DataFrame) -> DataFrame:
    return chunks.select(*KEYS, F.shiftright("chunk", row_sets.BLOCK_BITS - row_sets.CHUNK_BITS).alias("block")).distinct()


def _block_table(listing: DataFrame | None, examined: DataFrame, waiting: DataFrame, before: DataFrame | None) -> DataFrame:
    """What a version remembers of the landing: the tab, block, ``files`` (what lay in it) and ``waiting``, whether rows wait there.

    ``listing`` is the landing as it was listed before it was read (None: not listed), ``examined`` the blocks
    that were read, ``waiting`` those with rows that have to be looked at again, ``before`` the table of the last version.
    """
    key = [*KEYS, "block"]
    none = F.lit(None).cast("string").alias("files")
    here = examined.select(*key).join(waiting.select(*key, F.lit(True).alias("waiting")), key, "left")
    here = here.select(*key, F.coalesce("waiting", F.lit(False)).alias("waiting"))
    here = here.join(listing, key, "left") if listing is not None else here.withColumn("files", none)
    here = here.select(*key, "files", "waiting")
    return here if before is None else here.unionByName(before.join(here.select(*key), key, "left_anti").select(*key, "files", "waiting"))


def full_load(
    rows: DataFrame,
    spec: DatasetSpec,
    path: str,
    ingested_at: datetime.datetime | str | None = None,
    limits: LookupLimits = DEFAULT_LIMITS,
    listing: DataFrame | None = None,
) -> int:
    """Publish all rows of all workbooks; no rows is an error. Returns the row count.

    ``rows`` is read twice: once for everything that is asked of its tabs, once for its rows. ``listing`` tells what was in
    the landing that ``rows`` comes from.
    """
    facts = stage(tab_facts(filter_tabs(rows, spec), spec.read_width), "facts")
    headers = stage(newest_headers(facts), "header-rows", measured=True)
    # tabs without a header are not taken as read and wait for one
    headed = facts.join(headers.select(*KEYS), KEYS, "left_semi")
    headless = facts.where("mask <> 0").join(headers.select(*KEYS), KEYS, "left_anti")
    read = present_rows(headed)
    none = headers.select(*KEYS, F.lit(None).cast("long").alias("last_row")).where("false")
    tables = {
        "marks": row_sets.to_runs(read),
        "headers": headers,
        "report": tab_report(facts, headers, none, read),
        "blocks": _block_table(listing, _blocks_of(facts), _blocks_of(headless), None),
    }
    prepared = prepare(rows, spec, ingested_at, _normal_headers(headers), limits)
    return write_target(prepared, path, spec, f"{spec.name} full load", tables, stripped=True)


def _increment(
    rows: DataFrame,
    spec: DatasetSpec,
    path: str,
    info: dict,
    ingested_at: datetime.datetime | str | None,
    limits: LookupLimits,
    high_water_marks: bool = True,
    listing: DataFrame | None = None,
    keep_waiting: bool = False,
) -> int | None:
    """Merge what ``rows`` has beyond the version ``info``; ``rows`` may be part of the landing.

    With ``keep_waiting`` a version without new rows is published if it has to remember a header, or that rows wait.
    """
    spark = rows.sparkSession
    facts = stage(tab_facts(filter_tabs(rows, spec), spec.read_width), "facts")
    known_headers = scan_table(spark, path, "headers", info)
    headers = stage(newest_headers(facts, known_headers), "header-rows", measured=True)
    read = scan_table(spark, path, "marks", info) if high_water_marks else None
    if read is None:
        upto = checkpoint(scan_target(spark, path, spec))
        read = stage(upto.where("last_row > 1").select(*KEYS, F.lit(2).cast("long").alias("first"), F.col("last_row").alias("last")), "read")
    here, present, last_rows = _blocks_of(facts), present_rows(facts), row_sets.last_rows(read)
    used = facts.groupBy(*KEYS).agg(F.coalesce(F.max("used"), F.lit(0)).cast("long").alias("used")).join(last_rows, KEYS, "left")
    used = used.join(headers.select(*KEYS, F.lit(True).alias("headed")), KEYS, "left")
    # up to which row a tab is read: nothing without a header, nor below the last row with a value in column A
    n_rows = F.when(F.col("headed"), F.greatest("used", F.coalesce("last_row", F.lit(0)))).otherwise(0)
    unread = row_sets.difference(present, row_sets.to_chunks(read, here)).join(used.select(*KEYS, n_rows.alias("n_rows")), KEYS)
    within = row_sets.up_to(F.col("mask"), F.col("chunk"), F.col("n_rows"))
    unread = stage(unread.select(*KEYS, "chunk", "mask", within.alias("within")), "unread")
    added = unread.where("within <> 0").select(*KEYS, "chunk", F.col("within").alias("mask"))
    waits = _blocks_of(unread.where("within <> mask"))
    before = scan_table(spark, path, "blocks", info)
    new = None
    if staged_size(unread).rows and not added.isEmpty():
        prepared = prepare(rows_in(filter_tabs(rows, spec), added, present, limits), spec, ingested_at, _normal_headers(headers), limits)
        new = stage(conform_schema(prepared, spec, stripped=True), "new_rows", measured=True)
    if new is None or not staged_size(new).rows:
        if keep_waiting:
            waits = stage(waits, "waits")
            more = waits if before is None else waits.join(before.where("waiting"), [*KEYS, "block"], "left_anti")
            other = headers if known_headers is None else headers.join(known_headers, [*KEYS, "cells"], "left_anti")
            if not (more.isEmpty() and other.isEmpty()):
                publish_tables(spark, path, info, {"headers": headers, "blocks": _block_table(None, here, waits, before)})
        return None
    tables = {
        "marks": row_sets.merge_runs(read, row_sets.to_runs(added)),
        "headers": headers,
        "report": tab_report(facts, headers, last_rows, added),
        "blocks": _block_table(listing, here, waits, before),
    }
    return merge_target(new, path, spec, info, f"{spec.name} incremental load", tables, limits)


def incremental_load(
    rows: DataFrame,
    spec: DatasetSpec,
    path: str,
    ingested_at: datetime.datetime | str | None = None,
    high_water_marks: bool = True,
    limits: LookupLimits = DEFAULT_LIMITS,
) -> int | None:
    """Add the rows landed since the last run and publish a new version.

    Returns the row count, or None when there is nothing new; the target is untouched then.

    The row numbers read are kept beside the target, as runs. So a range that lands after later ones is
    still read, and so are the rows of a tab whose header comes late. A target without them (an adopted one), or
    ``high_water_marks=False``, falls back on the last row per tab in the target: rows up to it count as read.
    """
    return _increment(rows, spec, path, target_info(rows.sparkSession, path), ingested_at, limits, high_water_marks)


def _until_published(spark: SparkSession, path: str, run: Callable[[], int | None], keep_versions: int, attempts: int = 8) -> int | None:
    """Run a load; if another one publishes first, run it again on top of that. Tables staged on the way are deleted."""
    for attempt in range(attempts):
        with scratch_scope(spark):
            try:
                loaded = run()
                break
            except PublishConflict:
                if attempt == attempts - 1:
                    raise
    expire_versions(spark, path, keep_versions)
    return loaded


def load(
    rows: DataFrame,
    spec: DatasetSpec,
    path: str,
    ingested_at: datetime.datetime | str | None = None,
    limits: LookupLimits = DEFAULT_LIMITS,
    keep_versions: int = 3,
) -> int | None:
    """Full load if nothing was published yet, otherwise incremental load.

    What was staged on the way is deleted, and so are all but the newest ``keep_versions`` versions of the target: a
    reader of a version has until the third load after it. If another load publishes first, this one
    starts again and merges onto its version; one that is overtaken by ``keep_versions`` others while it writes may lose its
    files and fails, with the target as the others left it.
    """
    spark = rows.sparkSession

    def run() -> int | None:
        if target_exists(spark, path):
            return incremental_load(rows, spec, path, ingested_at, limits=limits)
        return full_load(rows, spec, path, ingested_at, limits)

    return _until_published(spark, path, run, keep_versions)


def load_landing(
    spark: SparkSession,
    landing: str,
    spec: DatasetSpec,
    path: str,
    ingested_at: datetime.datetime | str | None = None,
    limits: LookupLimits = DEFAULT_LIMITS,
    keep_versions: int = 3,
    typed: bool = False,
) -> int | None:
    """:func:`load` from a Parquet landing (:func:`~sheetloom.sources.landed.write_raw`), of which an increment reads only what changed.

    The landing is listed, not read, and compared with what the last version remembers of it. Blocks with other files are
    read, and of their tabs also blocks where rows wait. Without any the target is untouched and no file is opened.
    ``typed``: the landing's cells are variants.
    """

    def run() -> int | None:
        listing = stage(filter_tabs(landing_blocks(spark, landing), spec), "listing", measured=True)
        if not target_exists(spark, path):
            return full_load(read_raw(spark, landing, typed), spec, path, ingested_at, limits, listing)
        info = target_info(spark, path)
        known = scan_table(spark, path, "blocks", info)
        if known is None:
            return _increment(read_raw(spark, landing, typed), spec, path, info, ingested_at, limits, listing=listing)
        key = [*KEYS, "block"]
        joined = listing.join(known.select(*key, F.col("files").alias("had")), key, "left")
        changed = stage(joined.where(~F.col("files").eqNullSafe(F.col("had"))).select(*key), "changed", measured=True)
        if not staged_size(changed).rows:
            return None
        blocks = stage(changed.union(_waiting(known, changed)).distinct(), "examined", measured=True)
        return _increment(read_blocks(spark, landing, blocks, limits, typed=typed), spec, path, info, ingested_at, limits, listing=listing)

    return _until_published(spark, path, run, keep_versions)


def _waiting(known: DataFrame, changed: DataFrame) -> DataFrame:
    """Blocks where rows wait, of the tabs of ``changed``."""
    return known.where("waiting").join(changed.select(*KEYS).distinct(), KEYS, "left_semi").select(*KEYS, "block")


def load_batch(
    batch: DataFrame,
    landing: str,
    spec: DatasetSpec,
    path: str,
    ingested_at: datetime.datetime | str | None = None,
    limits: LookupLimits = DEFAULT_LIMITS,
    keep_versions: int = 3,
) -> int | None:
    """:func:`load` of newly landed rows alone. What the last version remembers (headers, rows read, blocks where rows wait)
    stands for the history; of the landing only blocks of the batch's tabs are opened where rows wait.

    A batch that was loaded before changes nothing.
    """
    spark = batch.sparkSession

    def run() -> int | None:
        if not target_exists(spark, path):
            return full_load(batch, spec, path, ingested_at, limits)
        info = target_info(spark, path)
        known = scan_table(spark, path, "blocks", info)
        rows = batch
        if known is not None and not known.where("waiting").isEmpty():
            blocks = stage(_waiting(known, batch), "waiting", measured=True)
            if staged_size(blocks).rows:
                rows = batch.unionByName(read_blocks(spark, landing, blocks, limits, typed=has_typed_cells(batch)))
        return _increment(rows, spec, path, info, ingested_at, limits, keep_waiting=True)

    return _until_published(spark, path, run, keep_versions)


def adopt_target(spark, parquet: str, path: str, spec: DatasetSpec) -> int:
    """Publish an existing plain Parquet dataset as the first version of a target.

    Of rows with one id the last of the last tab stays; tabs follow each other by their ids and names, as the
    dataset does not know their order.
    """
    order = ("source_spreadsheet", "source_sheet", "source_row")
    existing = dedup_keep_last(reprepare(spark.read.parquet(parquet), spec), order=order)
    return write_target(existing, path, spec, f"{spec.name} adopted table")

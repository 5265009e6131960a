"""Checkpoints and the rows beyond them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sheetloom.functions.cells import cell_text, cell_texts, has_typed_cells
from sheetloom.operators import row_sets
from sheetloom.operators.lookup import DEFAULT_LIMITS, LookupLimits, lookup_join
from sheetloom.operators.tabs import KEYS, tab_row_count
from sheetloom.session import stage, staged_size


def checkpoint(target: DataFrame) -> DataFrame:
    """Last processed row per tab. Rows without a tab or row number are ignored."""
    needed = KEYS + ["source_row"]
    missing = [c for c in needed if c not in target.columns]
    if missing:
        raise ValueError(f"target lacks the source columns needed for an incremental load: {missing}")
    return (
        target.select(*needed)
        .dropna()
        .groupBy(*KEYS)
        .agg(F.max("source_row").cast("long").alias("last_row"))
    )


def combine_checkpoints(*checkpoints: DataFrame) -> DataFrame:
    """The larger value of several checkpoints."""
    merged = checkpoints[0]
    for other in checkpoints[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy(*KEYS).agg(F.max("last_row").alias("last_row"))


def rows_beyond(
    rows: DataFrame, last_rows: DataFrame, limits: LookupLimits = DEFAULT_LIMITS
) -> DataFrame:
    """Rows after the checkpoint; after row 1, the header, in a tab that has none."""
    marked = lookup_join(rows, last_rows, KEYS, "left", limits=limits)
    return marked.where(F.col("source_row") > F.coalesce("last_row", F.lit(1))).drop("last_row")


def incremental_filter(
    rows: DataFrame,
    last_rows: DataFrame,
    row_counts: DataFrame | None = None,
    limits: LookupLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Rows after the checkpoint up to the used rows of their tab.

    A tab that shrank or did not grow yields nothing. ``row_counts`` defaults to the used rows of
    the rows beyond the checkpoint, which suffice: a count at or below the checkpoint lets
    nothing through either way. Both lookups should be staged.
    """
    beyond = rows_beyond(rows, last_rows, limits)
    if row_counts is None:
        row_counts = stage(tab_row_count(beyond), "row_counts", measured=True)
    counted = lookup_join(beyond, row_counts, KEYS, "inner", limits=limits)
    return counted.where("source_row <= n_rows").drop("n_rows")


def tab_facts(rows: DataFrame, width: int | None = None) -> DataFrame:
    """Everything a load asks of its input, in one aggregate: one row per tab, chunk of rows and header row.

    ``header`` (landed_seq, cells up to ``width``) is set for a first row that has cells, else NULL; ``mask`` holds the rows below
    the first (:mod:`sheetloom.operators.row_sets`), ``used`` the last one with a value in column A, ``n`` their number.
    The header is a grouping key, so that all aggregates are numbers and rows are combined by hash before the shuffle.
    """
    typed = has_typed_cells(rows)
    cells = cell_texts(F.col("cells") if width is None else F.slice("cells", 1, width), typed)
    seq = F.col("landed_seq") if "landed_seq" in rows.columns else F.lit(None).cast("long")
    row = F.col("source_row")
    header = F.when((row == 1) & (F.size("cells") > 0), F.struct(seq.alias("landed_seq"), cells.alias("cells")))
    keyed = rows.select(*KEYS, "source_row", row_sets.chunk_of(row).alias("chunk"), header.alias("header"), cell_text(F.get("cells", F.lit(0)), typed).alias("first_cell"))
    return keyed.groupBy(*KEYS, "chunk", "header").agg(
        F.coalesce(F.bit_or(F.when(row > 1, row_sets.bit_of(row))), F.lit(0).cast("long")).alias("mask"),
        F.max(F.when(F.col("first_cell") != "", row)).alias("used"),
        F.count_if(row > 1).alias("n"),
    )


def present_rows(facts: DataFrame) -> DataFrame:
    """The rows below the header, in chunks."""
    return row_sets.union(facts.where("mask <> 0"))


def newest_headers(facts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The header row of each tab, as landed: the tab, landed_seq and cells. The one landed last counts, by its content if that is
    not known. ``known`` are the headers of earlier loads; of equal times the one here counts."""
    here = facts.where("header IS NOT NULL").select(*KEYS, "header.*", F.lit(1).alias("turn"))
    if known is not None:
        here = here.unionByName(known.select(*KEYS, "landed_seq", "cells", F.lit(0).alias("turn")))
    timed = F.struct(F.coalesce("landed_seq", F.lit(1 << 62)).alias("at"), "turn", "cells")
    newest = here.groupBy(*KEYS).agg(F.max(F.struct(timed.alias("timed"), "landed_seq")).alias("newest"))
    return newest.select(*KEYS, "newest.landed_seq", "newest.timed.cells")


def rows_in(rows: DataFrame, wanted: DataFrame, present: DataFrame, limits: LookupLimits = DEFAULT_LIMITS) -> DataFrame:
    """The rows of the set ``wanted``, a part of the set ``present`` of rows below the header; both in chunks.

    Blocks of which all rows are wanted are named as a whole; only in the others the mask is looked up.
    """
    block = F.shiftright("chunk", row_sets.BLOCK_BITS - row_sets.CHUNK_BITS).alias("block")
    size = F.sum(F.bit_count("mask")).alias("size")
    of = lambda chunks: chunks.groupBy(*KEYS, block).agg(size)
    sizes = of(wanted).withColumnRenamed("size", "wanted").join(of(present), [*KEYS, "block"])
    blocks = stage(sizes.select(*KEYS, "block", (F.col("wanted") == F.col("size")).alias("whole")), "wanted-blocks", measured=True)
    row = F.col("source_row")
    placed = rows.withColumns({"block": row_sets.block_of(row), "chunk": row_sets.chunk_of(row)})
    named = lookup_join(placed, blocks, [*KEYS, "block"], limits=limits)
    if blocks.where("NOT whole").isEmpty():
        return named.where("source_row > 1").select(*rows.columns)
    parts = wanted.withColumn("block", block).join(blocks.where("NOT whole"), [*KEYS, "block"], "left_semi")
    masks = stage(parts.select(*KEYS, "chunk", "mask"), "wanted-chunks", measured=True)
    named = lookup_join(named, masks, [*KEYS, "chunk"], "left", limits=limits)
    return named.where((row > 1) & (F.col("whole") | row_sets.holds(F.col("mask"), row))).select(*rows.columns)


def tab_report(facts: DataFrame, headers: DataFrame, last_rows: DataFrame, added: DataFrame) -> DataFrame:
    """What a load did with each tab: the tab, n_rows (used rows), last_row (read before), new_rows, and note.

    ``added`` are the rows it read, in chunks. ``note`` is ``no header``, ``no data rows``, ``shrunk`` (fewer used rows than were
    read before), else NULL.
    """
    used = facts.groupBy(*KEYS).agg(F.coalesce(F.max("used"), F.lit(0)).cast("long").alias("n_rows"))
    brought = added.groupBy(*KEYS).agg(F.sum(F.bit_count("mask")).alias("new_rows"))
    joined = used.join(headers.select(*KEYS, F.lit(True).alias("has_header")), KEYS, "left")
    joined = joined.join(last_rows, KEYS, "left").join(brought, KEYS, "left")
    note = (
        F.when(F.col("has_header").isNull(), "no header")
        .when(F.col("n_rows") <= 1, "no data rows")
        .when(F.col("n_rows") < F.col("last_row"), "shrunk")
    )
    return joined.select(*KEYS, "n_rows", "last_row", F.coalesce("new_rows", F.lit(0)).alias("new_rows"), note.alias("note"))


def shrunk_tabs(row_counts: DataFrame, last_rows: DataFrame) -> DataFrame:
    """Tabs that now hold fewer rows than were already processed."""
    return row_counts.join(last_rows, KEYS).where("n_rows < last_row").select(*KEYS, "last_row", "n_rows")


def headerless_tabs(row_counts: DataFrame, headers: DataFrame) -> DataFrame:
    """Tabs that are skipped: no header row, or no row below it."""
    joined = row_counts.join(headers.select(*KEYS, F.lit(True).alias("has_header")), KEYS, "left")
    reason = F.when(F.col("has_header").isNull(), "no header").when(F.col("n_rows") <= 1, "no data rows")
    return joined.withColumn("reason", reason).where("reason is not null").select(*KEYS, "n_rows", "reason")

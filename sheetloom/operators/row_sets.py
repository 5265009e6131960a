"""Sets of row numbers per tab: which rows are there, which were read.

A set has two forms. *Runs* (tab, ``first``, ``last``) are what is stored: a tab without gaps is one row, whatever its
length. *Chunks* (tab, ``chunk``, ``mask``) hold 64 row numbers in the bits of one number, so that union and
difference are bitwise and building a set from rows is a hash aggregate that is combined before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from sheetloom.spec import TAB_KEYS

KEYS = list(TAB_KEYS)
CHUNK_BITS = 6
# Runs are first put together inside blocks of this many rows, then across them, so no window sees all runs of a tab.
BLOCK_BITS = 16
_FULL = -1  # all 64 bits


def chunk_of(row: Column) -> Column:
    """The chunk that holds a row number."""
    return F.shiftright(row.cast("long"), CHUNK_BITS)


def block_of(row: Column) -> Column:
    """The block of :data:`BLOCK_BITS` that holds a row number."""
    return F.shiftright(row.cast("long"), BLOCK_BITS)


def _left(value: Column, by: Column) -> Column:
    return F.call_function("shiftleft", value, by.cast("int"))


def _right(value: Column, by: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, by.cast("int"))


def bit_of(row: Column) -> Column:
    """The bit of a row number in the mask of its chunk."""
    return _left(F.lit(1).cast("long"), row.cast("long").bitwiseAND(F.lit(63)))


def holds(mask: Column, row: Column) -> Column:
    """Is the row number in the mask of its chunk? NULL counts as an empty mask."""
    return F.coalesce(mask.bitwiseAND(bit_of(row)) != 0, F.lit(False))


def _ones(low: Column, high: Column) -> Column:
    """The bits from ``low`` to ``high`` (0 to 63)."""
    return _left(_right(F.lit(_FULL).cast("long"), 63 - (high - low)), low)


def up_to(mask: Column, chunk: Column, row: Column) -> Column:
    """The part of a mask with row numbers up to ``row``."""
    here = F.when(chunk == chunk_of(row), mask.bitwiseAND(_ones(F.lit(0), row.cast("long").bitwiseAND(F.lit(63)))))
    return F.when(chunk < chunk_of(row), mask).otherwise(F.coalesce(here, F.lit(0).cast("long")))


def union(*sets: DataFrame) -> DataFrame:
    """The union of sets in chunks."""
    every = reduce(DataFrame.unionByName, (s.select(*KEYS, "chunk", "mask") for s in sets))
    return every.groupBy(*KEYS, "chunk").agg(F.bit_or("mask").alias("mask"))


def difference(one: DataFrame, other: DataFrame) -> DataFrame:
    """What ``one`` has and ``other`` lacks; both in chunks, one row per chunk. Empty chunks go."""
    joined = one.select(*KEYS, "chunk", "mask").join(other.select(*KEYS, "chunk", F.col("mask").alias("known")), [*KEYS, "chunk"], "left")
    rest = F.col("mask").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("long"))))
    return joined.select(*KEYS, "chunk", rest.alias("mask")).where("mask <> 0")


def to_chunks(runs: DataFrame, blocks: DataFrame | None = None) -> DataFrame:
    """Runs as chunks; with ``blocks`` (tab, ``block``) only of those blocks, so that a long history is not unfolded."""
    each = F.explode(F.sequence(block_of(F.col("first")), block_of(F.col("last")))).alias("block")
    parts = runs.select(*KEYS, "first", "last", each)
    if blocks is not None:
        parts = parts.join(blocks.select(*KEYS, "block"), [*KEYS, "block"], "left_semi")
    start = _left(F.col("block"), F.lit(BLOCK_BITS))
    parts = parts.select(*KEYS, F.greatest("first", start).alias("first"), F.least("last", start + (1 << BLOCK_BITS) - 1).alias("last"))
    chunk = F.explode(F.sequence(chunk_of(F.col("first")), chunk_of(F.col("last")))).alias("chunk")
    cut = parts.select(*KEYS, "first", "last", chunk)
    begin = _left(F.col("chunk"), F.lit(CHUNK_BITS))
    low, high = F.greatest(F.col("first") - begin, F.lit(0)), F.least(F.col("last") - begin, F.lit(63))
    return cut.select(*KEYS, "chunk", _ones(low, high).alias("mask")).groupBy(*KEYS, "chunk").agg(F.bit_or("mask").alias("mask"))


def to_runs(chunks: DataFrame) -> DataFrame:
    """Chunks as runs, none of which touch."""
    begin = _left(F.col("chunk"), F.lit(CHUNK_BITS))
    at = F.sequence(F.lit(0), F.lit(63))
    places = lambda bits: F.filter(at, lambda i: _right(bits, i).bitwiseAND(F.lit(1)) != 0)
    mask = F.col("mask")
    firsts = places(mask.bitwiseAND(F.bitwise_not(_left(mask, F.lit(1)))))
    lasts = places(mask.bitwiseAND(F.bitwise_not(_right(mask, F.lit(1)))))
    run = lambda a, b: F.struct((begin + a).alias("first"), (begin + b).alias("last"))
    whole = F.array(run(F.lit(0), F.lit(63)))
    found = F.when(mask == _FULL, whole).otherwise(F.zip_with(firsts, lasts, run))
    return merge_runs(chunks.select(*KEYS, F.inline(found)))


def _islands(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Runs that overlap or touch become one, within each group."""
    in_order = W.partitionBy(*keys).orderBy("first", "last")
    reached = F.max("last").over(in_order.rowsBetween(W.unboundedPreceding, -1))
    starts = runs.withColumn("reached", reached)
    begins = F.when(F.col("first") <= F.col("reached") + 1, 0).otherwise(1)
    numbered = starts.withColumn("island", F.sum(begins).over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return numbered.groupBy(*keys, "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island")


def merge_runs(*sets: DataFrame) -> DataFrame:
    """The union of sets in runs, as runs none of which touch. The sets must not overlap.

    Only the outermost runs of those that begin in a block can touch runs of other blocks, so only they meet in one window.
    """
    every = reduce(DataFrame.unionByName, (s.select(*KEYS, "first", "last") for s in sets))
    near = _islands(every.withColumn("block", block_of(F.col("first"))), [*KEYS, "block"])
    in_block = W.partitionBy(*KEYS, "block")
    ends = [(F.col("first") == F.min("first").over(in_block)), (F.col("last") == F.max("last").over(in_block))]
    marked = near.withColumn("outer", ends[0] | ends[1])
    outer = _islands(marked.where("outer").select(*KEYS, "first", "last"), KEYS)
    return outer.unionByName(marked.where("NOT outer").select(*KEYS, "first", "last"))


def last_rows(runs: DataFrame) -> DataFrame:
    """The last row of each tab: the tab and ``last_row``."""
    return runs.groupBy(*KEYS).agg(F.max("last").alias("last_row"))


def row_numbers(runs: DataFrame) -> DataFrame:
    """Every row number of a set: the tab and ``source_row``."""
    return runs.select(*KEYS, F.explode(F.sequence("first", "last")).alias("source_row"))

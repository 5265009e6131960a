"""Joins against small and not-so-small lookup tables, and the as-of lookup.

Both come in two exact forms. Which one runs is decided by the measured size of the lookup side,
never assumed: below the bound it is broadcast and the large side is not moved; above it the
large side is spread so that one hot key does not end up in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, Window as W

from sheetloom.session import row_width, staged_size


@dataclass(frozen=True)
class LookupLimits:
    """When a lookup side may be broadcast, and how the other forms spread a hot key."""

    rows: int = 500_000
    bytes: int = 64 * 1024 * 1024
    marks_per_group: int = 256
    salts: int = 64
    block_rows: int = 1 << 16


DEFAULT_LIMITS = LookupLimits()


def fits_broadcast(df: DataFrame, limits: LookupLimits = DEFAULT_LIMITS) -> bool:
    """Is ``df`` within the broadcast bound? Its size was taken when staged, or is measured now.

    The size is that of the values as text. A broadcast table takes a few times as much in memory, so ``limits.bytes`` is a
    fraction of what a task may hold.
    """
    size = staged_size(df)
    if size is None or size.bytes is None:
        size = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_width(df)).alias("bytes")).first()
    return size.rows <= limits.rows and (size.bytes or 0) <= limits.bytes


def require_unique(lookup: DataFrame, keys: list[str]) -> DataFrame:
    """``lookup`` itself; an error if it holds a key twice, because a lookup would then multiply rows."""
    twice = lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(3).collect()
    if twice:
        raise ValueError(f"a lookup holds {keys} more than once, such as {[tuple(r)[:-1] for r in twice]}")
    return lookup


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "inner",
    spread_by: str = "source_row",
    limits: LookupLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which holds at most one row per key.

    ``lookup`` should be staged, best measured. Beyond the bound every key is split over
    ``limits.salts`` tasks by ``spread_by``.
    """
    if fits_broadcast(lookup, limits):
        return rows.join(F.broadcast(lookup), keys, how)
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(limits.salts)).cast("int"))
    copies = lookup.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(limits.salts - 1))))
    return salted.join(copies, keys + ["__salt"], how).drop("__salt")


def asof_lookup(
    rows: DataFrame,
    marks: DataFrame,
    keys: list[str],
    position: str,
    limits: LookupLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """Attach to each row the latest mark of its group at or above its position.

    Rows and marks with a NULL key match nothing. ``marks`` has ``keys``, ``position`` and value columns, at most one mark per position; it is
    read twice and should be staged. The
    result has every column of ``rows``, the value columns (NULL above the first mark) and
    ``mark_position``.

    Few marks: broadcast as intervals, ``rows`` is not moved. Many marks: ``rows`` is spread over
    fixed blocks of positions; a window fills forward inside a block, and a per-block table of
    last marks, smaller by the block size, carries values across blocks.
    """
    marks = marks.dropna(subset=keys)
    values = [c for c in marks.columns if c not in keys and c != position]
    per_group = marks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(row_width(marks)).alias("w"))
    size = per_group.agg(F.sum("n").alias("rows"), F.sum("w").alias("bytes"), F.max("n").alias("densest")).first()
    if (
        (size["rows"] or 0) <= limits.rows
        and (size["bytes"] or 0) <= limits.bytes
        and (size["densest"] or 0) <= limits.marks_per_group
    ):
        following = F.lead(position).over(W.partitionBy(*keys).orderBy(position))
        spans = marks.select(
            *(F.col(k).alias(f"__{k}") for k in keys),
            F.col(position).alias("mark_position"),
            following.alias("__until"),
            *values,
        )
        inside = (F.col(position) >= F.col("mark_position")) & (
            F.col("__until").isNull() | (F.col(position) < F.col("__until"))
        )
        same_group = [F.col(k) == F.col(f"__{k}") for k in keys]
        on = inside
        for condition in same_group:
            on = condition & on
        return rows.join(F.broadcast(spans), on, "left").drop("__until", *(f"__{k}" for k in keys))
    return _asof_by_blocks(rows, marks, keys, position, values, limits)


def _asof_by_blocks(
    rows: DataFrame,
    marks: DataFrame,
    keys: list[str],
    position: str,
    values: list[str],
    limits: LookupLimits,
) -> DataFrame:
    block = F.floor(F.col(position) / limits.block_rows).alias("__block")
    packed = F.struct(F.col(position).alias("mark_position"), *values)
    marked = marks.select(*keys, block, F.col(position), packed.alias("__mark"))
    plain = rows.select("*", block, F.lit(None).cast(marked.schema["__mark"].dataType).alias("__mark"))
    plain = plain.withColumn("__is_row", F.lit(True))

    in_block = W.partitionBy(*keys, "__block").orderBy(F.col(position), F.col("__is_row").asc_nulls_first())
    in_block = in_block.rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = plain.unionByName(marked, allowMissingColumns=True).withColumn(
        "__near", F.last("__mark", ignorenulls=True).over(in_block)
    )
    filled = filled.where("__is_row")

    last_in_block = marked.groupBy(*keys, "__block").agg(
        F.max_by("__mark", F.col(position)).alias("__last")
    )
    blocks = rows.select(*keys, block).distinct()
    across = W.partitionBy(*keys).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        blocks.join(last_in_block, keys + ["__block"], "full")
        .withColumn("__far", F.last("__last", ignorenulls=True).over(across))
        .drop("__last")
    )
    joined = filled.join(carried, keys + ["__block"], "left")
    mark = F.coalesce(F.col("__near"), F.col("__far"))
    return joined.select(
        *(F.col(c) for c in rows.columns),
        mark["mark_position"].alias("mark_position"),
        *(mark[v].alias(v) for v in values),
    )

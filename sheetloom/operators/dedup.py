"""Union, keep-last and merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sheetloom.operators.lookup import DEFAULT_LIMITS, LookupLimits, fits_broadcast
from sheetloom.session import staged_size
from sheetloom.spec import ORDER_COLUMNS


def union_all(*parts: DataFrame) -> DataFrame:
    """Concatenate by column name; a column one part lacks is NULL there.

    Each part is numbered in ``load_seq``, which therefore leads the keep-last order.
    """
    numbered = [p.withColumn("load_seq", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def dedup_keep_last(
    df: DataFrame, key: str = "record_id", order: Sequence[str] = ("load_seq",) + ORDER_COLUMNS
) -> DataFrame:
    """One row per key: the last in ``order`` (order columns ``df`` lacks are skipped). Rows of equal place are
    ordered by ``row_hash`` if there is one, so the result does not depend on the partitioning.

    An aggregate, so rows are combined before the shuffle: a key shared by a large part of the
    data sends one row per input task.
    """
    position = F.struct(*(c for c in (*order, "row_hash") if c in df.columns))
    rest = F.struct(*(c for c in df.columns if c != key))
    newest = df.groupBy(key).agg(F.max_by(rest, position).alias("__row"))
    return newest.select(*(F.col(key) if c == key else F.col("__row")[c].alias(c) for c in df.columns))


def merge_upsert(
    existing: DataFrame,
    new: DataFrame,
    key: str = "record_id",
    existing_unique: bool = False,
    new_unique: bool = False,
    limits: LookupLimits = DEFAULT_LIMITS,
    by_key: bool = False,
) -> DataFrame:
    """``existing`` plus ``new``; where both hold a key the new row wins.

    Unless ``new_unique``, ``new`` may repeat keys (last in source order wins). With ``existing_unique`` the existing
    rows are known to hold each key once, as every table written by this package does; then they
    only lose the keys in ``new``, and when those are few enough to broadcast (measured) the
    existing table is not shuffled. Otherwise all rows go through keep-last.

    With ``by_key`` the result is dealt to tasks by the key. Existing rows that were for losing keys are not dealt again.
    """
    columns = existing.columns
    if not existing_unique:
        return dedup_keep_last(union_all(existing, new), key).select(*columns)
    latest = new if new_unique else dedup_keep_last(new, key)
    ids = latest.select(key)
    size = staged_size(latest)
    few = fits_broadcast(ids if size is None or size.bytes is None else latest, limits)
    ids = F.broadcast(ids) if few else ids.hint("merge")
    kept, latest = existing.join(ids, key, "left_anti").select(*columns), latest.select(*columns)
    if not by_key:
        return kept.unionByName(latest)
    return kept.unionByName(latest).repartition(key) if few else kept.unionByName(latest.repartition(key))

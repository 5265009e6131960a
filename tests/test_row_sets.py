"""Sets of row numbers as runs and as chunks."""

import random

import pytest
from pyspark.sql import functions as F

from sheetloom.operators import row_sets

RUNS = "source_spreadsheet string, source_sheet string, first long, last long"
ROWS = "source_spreadsheet string, source_sheet string, source_row long"


def runs_of(numbers):
    found = []
    for n in sorted(numbers):
        if found and found[-1][1] == n - 1:
            found[-1][1] = n
        else:
            found.append([n, n])
    return [tuple(r) for r in found]


def frame(spark, sets):
    return spark.createDataFrame([("wb", tab, *r) for tab, numbers in sets.items() for r in runs_of(numbers)], RUNS).repartition(3)


def tabs_of(runs):
    found = {}
    for r in runs.collect():
        found.setdefault(r.source_sheet, []).append((r.first, r.last))
    return {tab: sorted(rs) for tab, rs in found.items()}


def made_sets(seed):
    pick = random.Random(seed)
    edges = [62, 63, 64, 65, 127, 128, (1 << 16) - 1, 1 << 16, (1 << 16) + 63, (1 << 16) + 64, (1 << 17) - 1, 1 << 17]
    sparse = {pick.randrange(2, 1 << 17) for _ in range(200)}
    dense = set(range(pick.randrange(2, 300), pick.randrange(70_000, 140_000)))
    return {"edges": {e for e in edges if pick.random() < 0.7}, "sparse": sparse, "dense": dense, "holes": dense - sparse, "one": {2}}


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_and_chunks_are_the_same_sets(spark, seed):
    sets = made_sets(seed)
    chunks = row_sets.to_chunks(frame(spark, sets))
    assert tabs_of(row_sets.to_runs(chunks)) == {tab: runs_of(numbers) for tab, numbers in sets.items() if numbers}


def test_difference_and_union(spark):
    one, other = made_sets(3), made_sets(4)
    a, b = (row_sets.to_chunks(frame(spark, s)) for s in (one, other))
    assert tabs_of(row_sets.to_runs(row_sets.difference(a, b))) == {t: runs_of(one[t] - other[t]) for t in one if one[t] - other[t]}
    assert tabs_of(row_sets.to_runs(row_sets.union(a, b))) == {t: runs_of(one[t] | other[t]) for t in one if one[t] | other[t]}
    assert row_sets.difference(a, a).count() == 0


def test_merged_runs_do_not_touch(spark):
    sets = made_sets(5)
    part = {tab: {n for n in numbers if n % 7 < 3 or 60_000 < n < 80_000} for tab, numbers in sets.items()}
    rest = {tab: numbers - part[tab] for tab, numbers in sets.items()}
    merged = row_sets.merge_runs(frame(spark, part), frame(spark, rest))
    assert tabs_of(merged) == {tab: runs_of(numbers) for tab, numbers in sets.items() if numbers}


def test_a_tab_without_gaps_is_one_run(spark):
    rows = spark.range(2, 300_002).select(F.lit("wb").alias("source_spreadsheet"), F.lit("t").alias("source_sheet"), F.col("id").alias("source_row"))
    chunks = rows.groupBy(*row_sets.KEYS, row_sets.chunk_of(F.col("source_row")).alias("chunk")).agg(F.bit_or(row_sets.bit_of(F.col("source_row"))).alias("mask"))
    assert [(r.first, r.last) for r in row_sets.to_runs(chunks).collect()] == [(2, 300_001)]


def test_building_a_set_is_a_hash_aggregate_combined_before_the_shuffle(spark):
    rows = spark.createDataFrame([("wb", "t", 5)], ROWS)
    chunks = rows.groupBy(*row_sets.KEYS, row_sets.chunk_of(F.col("source_row")).alias("chunk")).agg(F.bit_or(row_sets.bit_of(F.col("source_row"))).alias("mask"))
    plan = chunks._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "SortAggregate" not in plan and "ObjectHash" not in plan


def test_only_the_asked_blocks_are_unfolded(spark):
    runs = spark.createDataFrame([("wb", "t", 2, 10_000_000)], RUNS)
    blocks = spark.createDataFrame([("wb", "t", 1), ("wb", "other", 0)], "source_spreadsheet string, source_sheet string, block long")
    chunks = row_sets.to_chunks(runs, blocks)
    assert tabs_of(row_sets.to_runs(chunks)) == {"t": [(1 << 16, (1 << 17) - 1)]}


def test_members(spark):
    numbers = {2, 63, 64, 100, 70_000}
    chunks = row_sets.to_chunks(frame(spark, {"t": numbers}))
    rows = spark.range(0, 70_100).withColumn("chunk", row_sets.chunk_of(F.col("id")))
    inside = rows.join(chunks, "chunk", "left").where(row_sets.holds(F.col("mask"), F.col("id")))
    assert {r.id for r in inside.collect()} == numbers
    cut = chunks.select(*row_sets.KEYS, "chunk", row_sets.up_to(F.col("mask"), F.col("chunk"), F.lit(64)).alias("mask"))
    assert tabs_of(row_sets.to_runs(cut.where("mask <> 0"))) == {"t": [(2, 2), (63, 64)]}


def test_last_rows(spark):
    assert {(r.source_sheet, r.last_row) for r in row_sets.last_rows(frame(spark, {"a": {3, 9}, "b": {2}})).collect()} == {("a", 9), ("b", 2)}

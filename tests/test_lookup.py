"""Both forms of each lookup give the same, and the right, result."""

import random
from bisect import bisect_right

import pytest

from sheetloom.operators.lookup import LookupLimits, asof_lookup, lookup_join

SPREAD = LookupLimits(rows=0, salts=5, block_rows=16)
DENSE = LookupLimits(marks_per_group=1, block_rows=7)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_forms_agree(spark, how):
    rows = spark.createDataFrame([("a" if i % 3 else f"k{i % 7}", i) for i in range(200)], "k string, source_row long")
    lookup = spark.createDataFrame([("a", 1), ("k0", 2), ("k3", 3), ("z", 4)], "k string, v int")
    small = lookup_join(rows, lookup, ["k"], how)
    spread = lookup_join(rows, lookup, ["k"], how, limits=SPREAD)
    assert "BroadcastHashJoin" in plan(small)
    want = {("a", 1), ("k0", 2), ("k3", 3)}
    for df in (small, spread):
        got = {(r.k, r.source_row, r.v) for r in df.collect()}
        assert {(k, v) for k, _, v in got if v} == want
        assert len(got) == df.count() == (200 if how == "left" else sum(1 for i in range(200) if i % 3 or i % 7 in (0, 3)))
    assert sorted(map(repr, small.collect())) == sorted(map(repr, spread.collect()))


@pytest.mark.parametrize("limits", [LookupLimits(), SPREAD, DENSE])
def test_asof_lookup(spark, limits):
    pick = random.Random(1)
    rows = [(t, r) for t in ("hot", "cold") for r in range(1, 300 if t == "hot" else 20)]
    marks = {t: sorted(pick.sample(range(1, 400), 40 if t == "hot" else 3)) for t in ("hot", "cold")}
    left = spark.createDataFrame(rows, "t string, r long").repartition(6)
    right = spark.createDataFrame([(t, m, [f"{t}{m}"]) for t in marks for m in marks[t]], "t string, r long, v array<string>")
    got = {(x.t, x.r): (x.mark_position, x.v) for x in asof_lookup(left, right, ["t"], "r", limits).collect()}
    want = {}
    for t, r in rows:
        i = bisect_right(marks[t], r)
        want[t, r] = (marks[t][i - 1], [f"{t}{marks[t][i - 1]}"]) if i else (None, None)
    assert got == want


@pytest.mark.parametrize("limits", [LookupLimits(), SPREAD, DENSE])
def test_asof_null_keys_match_nothing(spark, limits):
    left = spark.createDataFrame([(None, 5), ("a", 5)], "t string, r long")
    right = spark.createDataFrame([(None, 1, "vn"), ("a", 1, "va")], "t string, r long, v string")
    got = {(x.t, x.r): (x.mark_position, x.v) for x in asof_lookup(left, right, ["t"], "r", limits).collect()}
    assert got == {(None, 5): (None, None), ("a", 5): (1, "va")}


def test_asof_without_marks(spark):
    left = spark.createDataFrame([("a", 1)], "t string, r long")
    right = spark.createDataFrame([], "t string, r long, v string")
    for limits in (LookupLimits(), SPREAD):
        assert [tuple(x) for x in asof_lookup(left, right, ["t"], "r", limits).select("t", "r", "v").collect()] == [("a", 1, None)]

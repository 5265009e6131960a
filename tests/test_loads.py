"""Full and incremental loads, publishing, streaming."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sheetloom.operators.dedup import dedup_keep_last, merge_upsert
from sheetloom.operators.incremental import checkpoint, incremental_filter, shrunk_tabs
from sheetloom.operators.lookup import LookupLimits
from sheetloom.operators.quality import ValidationError, validate
from sheetloom.operators.shape import conform_schema
from sheetloom.operators.tabs import select_tabs_named, tab_headers, with_workbook_title
from sheetloom.plans import loads
from sheetloom.session import row_width, scratch_path, stage, staged_size
from sheetloom.sources import landed, target
from sheetloom.spec import BUYERS, LEADS, RAW_SCHEMA
from sheetloom.streaming.available_now import load_available

HEAD = ["Name", "Email Address", "Mobile", "City", "Date", "Order Id"]
RUNS = [f"2024-0{i}-01 00:00:00" for i in range(1, 9)]


def tab(workbook, sheet, tab_ord, rows, head=HEAD, start=1):
    lines = ([head] if start == 1 else []) + rows
    return [(f"Book {workbook}", f"wb{workbook}", sheet, workbook, tab_ord, start + i, c) for i, c in enumerate(lines)]


def frame(spark, *tabs):
    return spark.createDataFrame([r for t in tabs for r in t], RAW_SCHEMA).repartition(4)


def made_rows(seed, n):
    pick = random.Random(seed)
    people = [(f" P{i} ", f"p{i}@X.com ", str(9000 + i)) for i in range(12)]
    return [[*pick.choice(people), "Pune", pick.choice(["45321", "05/03/2024", "", "junk"]), str(i)] for i in range(n)]


def stored_rows(spark, path, spec=BUYERS):
    return {tuple(r) for r in target.scan_target(spark, path, spec).collect()}


def ids(rows):
    return {r[BUYERS.columns.index("record_id")] for r in rows}


def test_prepare_buyers(spark):
    rows = frame(
        spark,
        tab(0, "Buyers A", 0, [[" Ann ", " A@x.com ", "1", "", "45321.5", "o1"], ["", " ", "", "", "", "only an order"], []]),
        tab(0, "Notes", 1, [["not", "read"]]),
        tab(1, "old BUYERS", 0, [["Ann", "a@X.com", "1", "Pune", "2024-01-30 12:00:00"], ["Zed"]], head=["Name", "Email Address", "Mobile", "City", "Date"]),
        tab(1, "empty buyers", 1, [], head=[]),
    )
    got = {r.name: r for r in conform_schema(loads.prepare(rows, BUYERS, RUNS[0]), BUYERS).collect()}
    assert set(got) == {"Ann", "Zed"}
    assert (got["Ann"].source_spreadsheet, got["Ann"].city, got["Ann"].date) == ("wb1", "Pune", "2024-01-30 12:00:00.000000")
    assert got["Zed"].email_address is None and got["Zed"].source_row == 3


def test_prepare_spread_lookup_gives_the_same(spark):
    rows = frame(spark, tab(0, "buyers", 0, made_rows(1, 80)), tab(1, "buyers", 0, made_rows(2, 5)))
    plain = loads.prepare(rows, BUYERS, RUNS[0])
    spread = loads.prepare(rows, BUYERS, RUNS[0], limits=LookupLimits(rows=0, salts=7))
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, spread.collect()))
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, loads.prepare(rows.repartition(1), BUYERS, RUNS[0]).collect()))


def test_leads_types_and_dropped_columns(spark):
    head = ["Name", "Age", "Amount", "Registration Date", "Tag", "Amount", "Surprise"]
    rows = frame(spark, tab(0, "Leads", 0, [["A", "41.0", " 499 ", "1706616000", "t", "7", "s"], ["", "", "", "", "", "", "s"]], head=head))
    prepared = loads.prepare(rows, LEADS, RUNS[0])
    assert prepared.schema == LEADS.typed_schema or [f.dataType for f in prepared.schema] == [f.dataType for f in LEADS.typed_schema]
    assert prepared.columns == list(LEADS.columns)
    (row,) = prepared.collect()
    assert (row.age, row.amount, str(row.registration_date)) == (41, 499.0, "2024-01-30 12:00:00")


def test_loads_in_parts_hold_the_same_ids(spark, tmp_path):
    whole = [tab(w, f"buyers {w}", 0, made_rows(w, 40)) for w in (0, 1)]
    loads.load(frame(spark, *whole), BUYERS, str(tmp_path / "once"), RUNS[0])
    for i, upto in enumerate((10, 11, 30, 60)):
        part = [[r for r in t if r[5] <= upto] for t in whole]
        loads.load(frame(spark, *part), BUYERS, str(tmp_path / "parts"), RUNS[i])
    once, parts = (stored_rows(spark, str(tmp_path / p)) for p in ("once", "parts"))
    assert ids(once) == ids(parts) and len(parts) == len(ids(parts))


def test_nothing_new_leaves_the_target(spark, tmp_path):
    path, rows = str(tmp_path / "t"), frame(spark, tab(0, "buyers", 0, made_rows(3, 30)))
    assert loads.load(rows, BUYERS, path, RUNS[0]) == len(stored_rows(spark, path))
    before = target.target_info(spark, path), stored_rows(spark, path)
    assert loads.load(rows, BUYERS, path, RUNS[1]) is None
    assert (target.target_info(spark, path), stored_rows(spark, path)) == before


def test_new_rows_win_and_old_metadata_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    first = tab(0, "buyers", 0, [["Ann", "a@x", "1", "Pune", "45321"], ["Bob", "b@x", "2", "Pune", "45321"]])
    more = tab(0, "buyers", 0, [["Ann", "A@x", "1", "Goa", "45321"], ["Cy", "c@x", "3", "", ""]], start=4)
    loads.load(frame(spark, first), BUYERS, path, RUNS[0])
    loads.load(frame(spark, first, more), BUYERS, path, RUNS[1])
    got = {r.name: (r.city, r.source_row, r.ingested_at_utc[:10]) for r in target.scan_target(spark, path, BUYERS).collect()}
    assert got == {"Ann": ("Goa", 4, "2024-02-01"), "Bob": ("Pune", 3, "2024-01-01"), "Cy": (None, 5, "2024-02-01")}


def test_high_water_marks_stop_rereading(spark, tmp_path):
    same = [["Ann", "a@x", "1", "Pune", "45321"]]
    rows = frame(spark, tab(0, "buyers 0", 0, same), tab(0, "buyers 1", 1, same))
    for name, marks in (("with", True), ("without", False)):
        path = str(tmp_path / name)
        loads.full_load(rows, BUYERS, path, RUNS[0])
        again = loads.incremental_load(rows, BUYERS, path, RUNS[1], high_water_marks=marks)
        assert again is None if marks else again == 1


def test_incremental_filter_cases(spark):
    rows = frame(spark, *(tab(0, f"t{n}", n, [["x"]] * (n - 1)) for n in (8, 5, 3, 4)))
    last = spark.createDataFrame([("wb0", t, 5) for t in ("t8", "t5", "t3")], "source_spreadsheet string, source_sheet string, last_row long")
    got = sorted((r.source_sheet, r.source_row) for r in incremental_filter(rows, last).collect())
    assert got == [("t4", 2), ("t4", 3), ("t4", 4), ("t8", 6), ("t8", 7), ("t8", 8)]
    counts = rows.groupBy("source_spreadsheet", "source_sheet").agg(F.max("source_row").alias("n_rows"))
    assert [tuple(r) for r in shrunk_tabs(counts, last).collect()] == [("wb0", "t3", 5, 3)]


def test_trailing_rows_without_first_cell_wait(spark):
    rows = frame(spark, tab(0, "t", 0, [["x"], ["", "b"], ["y"], ["", "c"]]))
    none = spark.createDataFrame([], "source_spreadsheet string, source_sheet string, last_row long")
    assert sorted(r.source_row for r in incremental_filter(rows, none).collect()) == [2, 3, 4]


def test_checkpoint_needs_its_columns(spark):
    with pytest.raises(ValueError, match="source_row"):
        checkpoint(spark.createDataFrame([("a", "b")], "source_spreadsheet string, source_sheet string"))


def test_dedup_keeps_the_last_in_source_order(spark):
    rows = spark.createDataFrame([("k", 0, 0, 9), ("k", 1, 0, 2), ("j", 0, 1, 1)], "record_id string, workbook_ord int, tab_ord int, source_row long")
    assert {tuple(r) for r in dedup_keep_last(rows.repartition(3)).collect()} == {("k", 1, 0, 2), ("j", 0, 1, 1)}


def test_hot_key_is_combined_before_the_shuffle(spark):
    rows = spark.range(1000).select(F.lit("hot").alias("record_id"), F.col("id").alias("source_row"))
    kept = dedup_keep_last(rows)
    assert kept.collect()[0].source_row == 999
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_merge_forms_agree(spark):
    columns = "record_id string, v int, workbook_ord int, tab_ord int, source_row long"
    old = spark.createDataFrame([(f"k{i}", 0, 0, 0, i) for i in range(30)], columns)
    new = spark.createDataFrame([(f"k{i % 40}", i, 0, 0, i) for i in range(20, 70)], columns)
    forms = [
        merge_upsert(old, new),
        merge_upsert(old, new, existing_unique=True),
        merge_upsert(old, new, existing_unique=True, limits=LookupLimits(rows=0)),
    ]
    results = [sorted(map(tuple, f.collect())) for f in forms]
    assert results[0] == results[1] == results[2] and len(results[0]) == 40


def test_validate(spark):
    good = loads.prepare(frame(spark, tab(0, "buyers", 0, made_rows(5, 5))), BUYERS, RUNS[0])
    assert validate(good, BUYERS) == good.count()
    for bad, message in (
        (good.where("false"), "empty"),
        (good.drop("city"), "lacks columns"),
        (good.withColumn("date", F.col("date").cast("string")), "date must be"),
        (good.withColumn("record_id", F.lit(None).cast("string")), "without record_id"),
    ):
        with pytest.raises(ValidationError, match=message):
            validate(bad, BUYERS)


def test_failed_write_is_not_published(spark, tmp_path):
    path, good = str(tmp_path / "t"), loads.prepare(frame(spark, tab(0, "buyers", 0, made_rows(6, 9))), BUYERS, RUNS[0])
    with pytest.raises(FileNotFoundError):
        target.scan_target(spark, path, BUYERS)
    with pytest.raises(ValidationError):
        target.write_target(good.where("false"), path, BUYERS)
    assert not target.target_exists(spark, path)
    for _ in range(3):
        target.write_target(good, path, BUYERS)
    assert target.target_info(spark, path)["version"] == 3
    with pytest.raises(target.PublishConflict, match="another run"):
        target._publish(spark, path, 3, {})
    assert target.target_info(spark, path)["rows"] == good.count()
    assert target.expire_versions(spark, path, keep=2) == [1]
    assert target.scan_target(spark, path, BUYERS).count() == good.count()


def test_full_load_without_rows_is_an_error(spark, tmp_path):
    with pytest.raises(ValidationError):
        loads.full_load(frame(spark, tab(0, "buyers", 0, [])), BUYERS, str(tmp_path / "t"))


def test_preparing_a_target_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.load(frame(spark, tab(0, "buyers", 0, made_rows(8, 40))), BUYERS, path, RUNS[0])
    stored = target.scan_target(spark, path, BUYERS)
    assert sorted(map(repr, loads.reprepare(stored, BUYERS).collect())) == sorted(map(repr, stored.collect()))
    plain = str(tmp_path / "plain")
    stored.coalesce(1).write.parquet(plain)
    loads.adopt_target(spark, plain, str(tmp_path / "adopted"), BUYERS)
    assert stored_rows(spark, str(tmp_path / "adopted")) == stored_rows(spark, path)


def test_stream_loads_only_what_landed(spark, tmp_path):
    landing, path, done = (str(tmp_path / p) for p in ("landing", "target", "done"))
    first, more = tab(0, "buyers", 0, made_rows(1, 20)), tab(0, "buyers", 0, made_rows(2, 20), start=22)
    landed.write_raw(frame(spark, first), landing)
    load_available(spark, landing, path, BUYERS, done, RUNS[0])
    one = target.target_info(spark, path)
    load_available(spark, landing, path, BUYERS, done, RUNS[1])
    assert target.target_info(spark, path) == one
    landed.write_raw(frame(spark, more), landing)
    landed.write_raw(frame(spark, tab(1, "Buyers", 0, made_rows(3, 20))), landing)
    load_available(spark, landing, path, BUYERS, done, RUNS[2])
    loads.load(frame(spark, first, more, tab(1, "Buyers", 0, made_rows(3, 20))), BUYERS, str(tmp_path / "once"), RUNS[0])
    assert ids(stored_rows(spark, path)) == ids(stored_rows(spark, str(tmp_path / "once")))


def test_relanded_header_does_not_double_rows(spark):
    rows = frame(spark, tab(0, "buyers", 0, [["Ann", "a@x"]]), tab(0, "buyers", 0, []))
    assert loads.declared_rows(rows, BUYERS).count() == 1


def test_what_a_merge_costs(spark, monkeypatch, tmp_path):
    """Sizes of flat rows are not taken from JSON, and rows that lost ids are not dealt again."""
    flat = spark.createDataFrame([(1, "abc", None), (2, None, 2.5)], "id long, t string, x double")
    assert "to_json" not in str(row_width(flat)) and flat.agg(F.sum(row_width(flat))).first()[0] == 2 * (4 + 18 + 8 + 8) + 3
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    ids = lambda low, high: spark.range(low, high).selectExpr("string(id) AS record_id", f"'{low}' AS name")
    for limits, dealt in ((LookupLimits(rows=0), False), (LookupLimits(), True)):
        merged = merge_upsert(ids(0, 60), ids(40, 90), existing_unique=True, new_unique=True, limits=limits, by_key=True)
        found = plan(merged)
        assert (0 < found.find("Exchange hashpartitioning") < found.find("Union")) == dealt
        assert sorted((int(r.record_id), r.name) for r in merged.collect()) == [(i, "0" if i < 40 else "40") for i in range(90)]


def test_staged_sizes(spark):
    sizes = [staged_size(stage(d, "s", measured=True)) for d in (spark.range(5), spark.range(5).where("id < 0"))]
    assert [s.rows for s in sizes] == [5, 0] and sizes[0].bytes > 0 and sizes[1].bytes == 0
    assert staged_size(spark.range(5)) is None


def test_landed_answers(spark, tmp_path):
    values, books = str(tmp_path / "values"), str(tmp_path / "books")
    answer = (
        '{"spreadsheetId": "id1", "valueRanges": [{"range": "\'Bob\'\'s leads\'!A1:L3", "majorDimension": "ROWS", "values": '
        '[["Name", "Mobile"], [], ["x", 9876543210, true, 45321.5]]}, {"range": "Leads2!A5:L6", "values": [["y"]]}, {"range": "Leads3!A:L"}]}'
    )
    spark.createDataFrame([(answer,)], "value string").write.text(values)
    book = '{"spreadsheetId": "id1", "sheets": [{"properties": {"title": "Leads2"}}, {"properties": {"title": "Bob\'s leads"}}]}'
    spark.createDataFrame([(book,)], "value string").write.text(books)
    tabs = landed.tab_listing(landed.read_workbooks(spark, books), ["id0", "id1"])
    for lines in (True, False):
        rows = landed.scan_tabs(spark, values, tabs, width=3, lines=lines).collect()
        got = {(r.source_workbook, r.workbook_ord, r.tab_ord, r.source_sheet, r.source_row): r.cells for r in rows}
        assert got == {
            ("id1", 1, 1, "Bob's leads", 1): ["Name", "Mobile"],
            ("id1", 1, 1, "Bob's leads", 2): [],
            ("id1", 1, 1, "Bob's leads", 3): ["x", "9876543210", "true"],
            ("id1", 1, 0, "Leads2", 5): ["y"],
        }


@pytest.mark.parametrize("stream", [False, True])
def test_late_headers_and_late_ranges_are_read(spark, tmp_path, stream):
    """Rows below a header that comes late, and rows that land after later ones of their tab."""
    landing, path, done = (str(tmp_path / p) for p in ("landing", "target", "done"))
    whole = [tab(0, "buyers", 0, made_rows(1, 30)), tab(0, "buyers late", 1, made_rows(2, 9))]
    rows = [r for t in whole for r in t]
    parts = [
        [r for r in rows if r[5] not in (1, 3, 4) or (r[4] == 0 and r[5] == 1)],
        [r for r in rows if r[5] == 3],
        [r for r in rows if r[5] == 4 or (r[4] == 1 and r[5] == 1)],
    ]
    landed_rows = []
    for part, run in zip(parts, RUNS):
        if stream:
            landed.write_raw(frame(spark, part), landing)
            load_available(spark, landing, path, BUYERS, done, run)
        else:
            landed_rows += part
            loads.load(frame(spark, landed_rows), BUYERS, path, run)
    loads.load(frame(spark, rows), BUYERS, str(tmp_path / "once"), RUNS[0])
    assert ids(stored_rows(spark, path)) == ids(stored_rows(spark, str(tmp_path / "once")))
    assert loads.load(frame(spark, rows), BUYERS, path, RUNS[5]) is None


def test_report_of_a_load(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [tab(0, "buyers", 0, made_rows(1, 9)), tab(0, "buyers 1", 1, made_rows(2, 2), start=2), tab(0, "buyers 2", 2, [])]
    report = lambda: {r.source_sheet: (r.n_rows, r.last_row, r.new_rows, r.note) for r in target.scan_report(spark, path).collect()}
    loads.load(frame(spark, *first), BUYERS, path, RUNS[0])
    assert report() == {"buyers": (10, None, 9, None), "buyers 1": (3, None, 0, "no header"), "buyers 2": (1, None, 0, "no data rows")}
    loads.load(frame(spark, [r for r in first[0] if r[5] < 5], tab(0, "buyers 3", 3, made_rows(3, 4))), BUYERS, path, RUNS[1])
    assert report() == {"buyers": (4, 10, 0, "shrunk"), "buyers 3": (5, None, 4, None)}


def test_the_last_landing_of_a_row_and_of_a_header_counts(spark):
    shape = RAW_SCHEMA.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ") + ", landed_seq long"
    old, new = [["Ann", "a@x", "1", "Old", "45321"]], [["Ann", "a@x", "1", "New", "45321"]]
    turned = ["Email Address", "Name", "Mobile", "City", "Date"]
    rows = [(*r, 1) for r in tab(0, "buyers", 0, old, head=turned)] + [(*r, 2) for r in tab(0, "buyers", 0, new)]
    for n in range(1, 11):
        random.Random(n).shuffle(rows)
        (row,) = loads.prepare(spark.createDataFrame(rows, shape).repartition(n), BUYERS, RUNS[0]).collect()
        assert (row.name, row.email_address, row.city) == ("Ann", "a@x", "New")


def test_keep_last_does_not_depend_on_the_partitioning(spark):
    """Two rows of one place and no landing time."""
    rows = [r for t in (tab(0, "buyers", 0, [["Ann", "a@x", "1", c, "45321"]]) for c in ("Old", "New")) for r in t]
    found = {loads.prepare(frame(spark, rows[::d]).repartition(n), BUYERS, RUNS[0]).first().city for n in range(1, 6) for d in (1, -1)}
    assert len(found) == 1


def test_blanks_around_tab_names(spark):
    rows = frame(spark, tab(0, "Buyers A\u00a0", 0, [["x"]]))
    assert select_tabs_named(rows, ["buyers a"]).count() == 2


def test_a_load_leaves_no_scratch_and_few_versions(spark, tmp_path):
    path, whole = str(tmp_path / "t"), tab(0, "buyers", 0, made_rows(1, 30))
    here = Path(scratch_path(spark, "x")).parent
    before = set(here.iterdir())
    for n, run in zip((5, 10, 15, 20, 30), RUNS):
        loads.load(frame(spark, whole[:n]), BUYERS, path, run)
    assert set(here.iterdir()) == before
    assert sorted(p.name for p in Path(path, "_published").iterdir()) == ["3.json", "4.json", "5.json"]
    kept = [json.loads(p.read_text()) for p in Path(path, "_published").iterdir()]
    listed = {part["folder"] for info in kept for part in info["parts"] if part["rows"]}
    assert {str(p.relative_to(path)) for p in Path(path).glob("v=*/data/bucket=*")} == listed
    assert ids(stored_rows(spark, path)) and target.target_info(spark, path)["version"] == 5


def test_unknown_tab_is_an_error(spark):
    rows = frame(spark, tab(0, " Buyers A", 0, [["x"]]))
    assert select_tabs_named(rows, ["buyers a "]).count() == 2
    with pytest.raises(ValueError, match="nope"):
        select_tabs_named(rows, ["buyers a", "nope"])


def test_tabs_follow_in_the_order_asked_for(spark):
    rows = frame(spark, tab(0, "A", 0, [["x"]]), tab(0, "B", 1, [["x"]]), tab(0, "C", 2, [["x"]]))
    asked = select_tabs_named(rows, ["c", " a", "C"])
    assert {(r.source_sheet, r.tab_ord) for r in asked.collect()} == {("C", 0), ("A", 1)}


def test_two_titles_of_a_workbook_are_an_error(spark):
    rows = frame(spark, tab(0, "A", 0, [["x"]]))
    titles = spark.createDataFrame([("wb0", "One"), ("wb0", "Two")], "source_spreadsheet string, title string")
    with pytest.raises(ValueError, match="wb0"):
        with_workbook_title(rows, titles)
    assert {r.source_workbook for r in with_workbook_title(rows, titles.limit(1)).collect()} == {"One"}


def test_the_last_answer_about_a_workbook_counts(spark, tmp_path):
    path = str(tmp_path / "books")
    for k, sheets in enumerate((["Old"], ["New", "Leads"])):
        titles = ", ".join(f'{{"properties": {{"title": "{t}"}}}}' for t in sheets)
        spark.createDataFrame([(f'{{"spreadsheetId": "id1", "properties": {{"title": "T{k}"}}, "sheets": [{titles}]}}',)], "value string").write.mode("append").text(path)
    assert [(r.title, r.tabs) for r in landed.read_workbooks(spark, path).collect()] == [("T1", ["New", "Leads"])]


def test_headers_are_cut_to_the_read_width(spark):
    rows = frame(spark, tab(0, "t", 0, [], head=[f"h{i}" for i in range(20)]))
    assert len(tab_headers(rows, BUYERS.read_width).first().headers) == 12
    assert len(tab_headers(rows).first().headers) == 20


def test_typed_cells(spark, tmp_path):
    """A check box, the same word as text, and numbers, from the answer to the target."""
    values, books = str(tmp_path / "values"), str(tmp_path / "books")
    lines = [
        '["Name", "City", "Age", "Amount", "Mobile", true, 7]',
        '["Ann", true, true, 41.0, 9876543210, 1, 2]',
        '["Bob", "true", "true", "499", "0091"]',
        '["Cy", 12.50, false, null, 41.0]',
        "[]",
    ]
    answer = '{"spreadsheetId": "id1", "valueRanges": [{"range": "Leads!A1:L5", "values": [' + ", ".join(lines) + "]}]}"
    spark.createDataFrame([(answer,)], "value string").write.text(values)
    spark.createDataFrame([('{"spreadsheetId": "id1", "sheets": [{"properties": {"title": "Leads"}}]}',)], "value string").write.text(books)
    spec = LEADS.with_workbooks("id1")
    rows = landed.scan_dataset(spark, values, books, spec, typed=True)
    assert tab_headers(rows).first().headers == ["name", "city", "age", "amount", "mobile", "true", "7"]
    want = {("Ann", "True", 1, 41.0, "9876543210"), ("Bob", "true", None, 499.0, "0091"), ("Cy", "12.5", 0, None, "41")}
    fields = lambda df: {(r.name, r.city, r.age, r.amount, r.mobile) for r in df.collect()}
    assert fields(loads.prepare(rows, spec, RUNS[0])) == want
    landing, path = str(tmp_path / "landing"), str(tmp_path / "target")
    landed.write_raw(rows, landing)
    assert loads.load_landing(spark, landing, spec, path, RUNS[0], typed=True) == 3
    assert fields(target.scan_target(spark, path, spec)) == want
    as_text = loads.prepare(landed.scan_dataset(spark, values, books, spec), spec, RUNS[0])
    assert ("Bob", "true", 1, 499.0, "0091") in fields(as_text) and ("Ann", "true", 1, 41.0, "9876543210") in fields(as_text)

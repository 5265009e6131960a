"""What an increment reads and writes, and loads that run side by side."""

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_loads import RUNS, frame, ids, made_rows, stored_rows, tab

from sheetloom.operators import row_sets
from sheetloom.operators.lookup import LookupLimits
from sheetloom.plans import loads
from sheetloom.sources import landed, target
from sheetloom.spec import BUYERS, RAW_SCHEMA
from sheetloom.streaming.available_now import load_available

BLOCK = 1 << row_sets.BLOCK_BITS


def counted(rows):
    """``rows`` and a counter of how many of them Spark reads."""
    seen = rows.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(count, rows.schema), seen


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def opened_by(spark, monkeypatch, run):
    """The landing files that ``run`` reads, by what its plans hand to the rows."""
    found, plain = set(), landed._landing

    def listed(spark_, path, typed=False):
        return plain(spark_, path, typed).withColumn("source_workbook", F.concat("source_workbook", F.lit("\0"), F.input_file_name()))

    def took(rows, *rest, **named):
        found.update(r[0].split("\0")[1] for r in rows.select("source_workbook").distinct().collect())
        return increment(rows.withColumn("source_workbook", F.substring_index("source_workbook", "\0", 1)), *rest, **named)

    increment = loads._increment
    monkeypatch.setattr(landed, "_landing", listed)
    monkeypatch.setattr(loads, "_increment", took)
    try:
        return run(), found
    finally:
        monkeypatch.undo()


def test_a_full_load_reads_its_input_twice(spark, tmp_path):
    rows, seen = counted(frame(spark, tab(0, "buyers", 0, made_rows(1, 300)), tab(1, "buyers", 0, made_rows(2, 99))))
    loads.full_load(rows, BUYERS, str(tmp_path / "t"), RUNS[0])
    assert seen.value <= 2 * 401


def test_an_incremental_load_reads_its_input_twice_and_once_if_nothing_is_new(spark, tmp_path):
    path, whole = str(tmp_path / "t"), tab(0, "buyers", 0, made_rows(1, 300))
    loads.load(frame(spark, whole[:200]), BUYERS, path, RUNS[0])
    for times, run in ((2, RUNS[1]), (1, RUNS[2])):
        rows, seen = counted(frame(spark, whole))
        loads.incremental_load(rows, BUYERS, path, run)
        assert seen.value <= times * 301


def test_marks_of_a_tab_without_gaps_are_one_run(spark, tmp_path):
    path, whole = str(tmp_path / "t"), tab(0, "buyers", 0, made_rows(1, 500))
    for upto, run in ((100, RUNS[0]), (350, RUNS[1]), (501, RUNS[2])):
        loads.load(frame(spark, whole[:upto]), BUYERS, path, run)
        assert [(r.first, r.last) for r in target.scan_marks(spark, path).collect()] == [(2, upto)]


def test_the_landing_is_listed_without_opening_files(spark, tmp_path):
    path = str(tmp_path / "landing")
    odd = "a+b 50% =x/y é"
    landed.write_raw(frame(spark, tab(0, odd, 0, made_rows(1, 3)), tab(12, "12", 0, made_rows(1, 3), start=BLOCK)), path)
    first = {tuple(r)[:3]: r.files for r in landed.landing_blocks(spark, path).collect()}
    assert set(first) == {("wb0", odd, 0), ("wb12", "12", 1)}
    for file in Path(path).rglob("*.parquet"):
        file.write_bytes(b"not parquet")  # never opened
    assert {tuple(r)[:3]: r.files for r in landed.landing_blocks(spark, path).collect()} == first


def test_folders_filter_the_landing(spark, tmp_path):
    path = str(tmp_path / "landing")
    landed.write_raw(frame(spark, *(tab(w, f"buyers {t}", t, made_rows(w, 4), start=s) for w in (0, 1) for t in (0, 1) for s in (1, BLOCK, 2 * BLOCK))), path)
    blocks = spark.createDataFrame([("wb0", "buyers 1", 1), ("wb1", "buyers 0", 0), ("wb1", "buyers 0", 1)], "source_spreadsheet string, source_sheet string, block long")
    few = landed.read_blocks(spark, path, blocks)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in plan and "PartitionFilters: []" not in plan  # folders are filtered, not rows
    many = landed.read_blocks(spark, path, blocks, most_ranges=0)
    assert "dynamicpruning" in many._jdf.queryExecution().executedPlan().toString()
    rows = lambda df: sorted((r.source_spreadsheet, r.source_sheet, r.source_row) for r in df.collect())
    assert rows(few) == rows(many) == rows(landed.read_raw(spark, path).where(
        f"(source_spreadsheet = 'wb0' AND source_sheet = 'buyers 1' AND source_row DIV {BLOCK} = 1)"
        f" OR (source_spreadsheet = 'wb1' AND source_sheet = 'buyers 0' AND source_row DIV {BLOCK} < 2)"
    ))


def test_an_increment_opens_only_the_blocks_that_changed(spark, tmp_path, monkeypatch):
    """The number of files opened for one more range does not grow with the history."""
    opened = []
    for history in (1, 4):
        landing, path = (str(tmp_path / f"{n}{history}") for n in ("landing", "target"))
        for k in range(history):
            landed.write_raw(frame(spark, *(tab(w, "buyers", 0, made_rows(k, 5), start=1 + k * BLOCK) for w in (0, 1))), landing)
        loads.load_landing(spark, landing, BUYERS, path, RUNS[0])
        before = set(files_of(landing))
        landed.write_raw(frame(spark, tab(1, "buyers", 0, made_rows(9, 5), start=1 + history * BLOCK)), landing)
        added, files = opened_by(spark, monkeypatch, lambda: loads.load_landing(spark, landing, BUYERS, path, RUNS[1]))
        assert added and len(files) == len(set(files_of(landing)) - before)
        opened.append(len(files))
    once = loads.prepare(landed.read_raw(spark, landing), BUYERS, RUNS[0])
    assert ids(stored_rows(spark, path)) == {r.record_id for r in once.collect()}
    assert opened[0] == opened[1]


def test_a_landing_without_changes_is_not_opened(spark, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "target")
    landed.write_raw(frame(spark, tab(0, "buyers", 0, made_rows(1, 20))), landing)
    loads.load_landing(spark, landing, BUYERS, path, RUNS[0])
    for file in Path(landing).rglob("*.parquet"):
        file.write_bytes(b"not parquet")
    assert loads.load_landing(spark, landing, BUYERS, path, RUNS[1]) is None


@pytest.mark.parametrize("way, ranges", [("landing", 0), ("stream", 1000)])
def test_rows_that_wait_are_read_when_their_header_or_successor_comes(spark, tmp_path, monkeypatch, way, ranges):
    plain = landed.read_blocks
    monkeypatch.setattr(loads, "read_blocks", lambda s, p, b, limits=LookupLimits(), typed=False: plain(s, p, b, limits, ranges, typed))
    landing, path, done = (str(tmp_path / n) for n in ("landing", "target", "done"))
    late = tab(0, "buyers late", 1, made_rows(2, 9))
    blank = [[" ", "no@first.cell", "5", "Goa", "45321"]]
    blank[0][0] = ""
    parts = [
        [tab(0, "buyers", 0, made_rows(1, 9))],
        [late[1:5], tab(0, "buyers", 0, blank, start=11)],  # no header; nothing in column A below
        [tab(0, "buyers new", 2, [])],  # a header alone
        [late[5:], tab(0, "buyers new", 2, made_rows(4, 3), start=2), tab(0, "buyers", 0, made_rows(5, 1), start=12)],
        [late[:1]],
    ]
    every = []
    for part, run in zip(parts, RUNS):
        every += part
        landed.write_raw(frame(spark, *part), landing)
        if way == "stream":
            load_available(spark, landing, path, BUYERS, done, run)
        else:
            loads.load_landing(spark, landing, BUYERS, path, run)
        assert "no@first.cell" not in {r[1] for r in stored_rows(spark, path)} or part is parts[3] or part is parts[4]
    loads.load(frame(spark, *every), BUYERS, str(tmp_path / "once"), RUNS[0])
    assert ids(stored_rows(spark, path)) == ids(stored_rows(spark, str(tmp_path / "once")))
    assert "no@first.cell" in {r[1] for r in stored_rows(spark, path)}


def test_a_stream_does_not_open_the_history(spark, tmp_path):
    landing, path, done = (str(tmp_path / n) for n in ("landing", "target", "done"))
    landed.write_raw(frame(spark, tab(0, "buyers", 0, made_rows(1, 20))), landing)
    load_available(spark, landing, path, BUYERS, done, RUNS[0])
    for file in Path(landing).rglob("*.parquet"):
        file.write_bytes(b"not parquet")
    landed.write_raw(frame(spark, tab(0, "buyers", 0, made_rows(2, 20), start=22)), landing)
    load_available(spark, landing, path, BUYERS, done, RUNS[1])
    loads.load(frame(spark, tab(0, "buyers", 0, made_rows(1, 20)), tab(0, "buyers", 0, made_rows(2, 20), start=22)), BUYERS, str(tmp_path / "once"), RUNS[0])
    assert ids(stored_rows(spark, path)) == ids(stored_rows(spark, str(tmp_path / "once")))


def test_a_batch_that_is_repeated_changes_nothing(spark, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "target")
    shape = RAW_SCHEMA.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ") + ", landed_seq long"
    batches = [spark.createDataFrame([(*r, k) for r in t], shape) for k, t in enumerate((tab(0, "buyers", 0, made_rows(1, 9)), tab(0, "buyers", 0, made_rows(2, 9), start=11)))]
    for batch, run in zip(batches, RUNS):
        assert loads.load_batch(batch, landing, BUYERS, path, run)
    info, rows = target.target_info(spark, path), stored_rows(spark, path)
    for batch in batches:
        assert loads.load_batch(batch, landing, BUYERS, path, RUNS[5]) is None
    assert (target.target_info(spark, path), stored_rows(spark, path)) == (info, rows)


def test_a_failed_batch_is_repeated_by_the_next_call(spark, tmp_path, monkeypatch):
    landing, path, done = (str(tmp_path / n) for n in ("landing", "target", "done"))
    first, more = tab(0, "buyers", 0, made_rows(1, 20)), tab(0, "buyers", 0, made_rows(2, 20), start=22)
    landed.write_raw(frame(spark, first), landing)
    load_available(spark, landing, path, BUYERS, done, RUNS[0])
    landed.write_raw(frame(spark, more), landing)

    def fail(*_):
        raise OSError("the store is away")

    with monkeypatch.context() as broken:
        broken.setattr(target, "_publish", fail)
        with pytest.raises(Exception, match="the store is away"):
            load_available(spark, landing, path, BUYERS, done, RUNS[1])
    load_available(spark, landing, path, BUYERS, done, RUNS[1])
    loads.load(frame(spark, first, more), BUYERS, str(tmp_path / "once"), RUNS[0])
    assert ids(stored_rows(spark, path)) == ids(stored_rows(spark, str(tmp_path / "once")))


def test_a_merge_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    path, whole = str(tmp_path / "t"), tab(0, "buyers", 0, [[f"P{i}", f"p{i}@x", str(i), "Pune", "45321"] for i in range(200)])
    loads.load(frame(spark, whole), BUYERS, path, RUNS[0], keep_versions=9)
    data = lambda: {f: t for f, t in files_of(path).items() if "/data/" in f}
    before = data()
    assert len({f.split("/")[2] for f in before}) == 8
    one = tab(0, "buyers", 0, [["P7", "p7@x", "7", "Goa", "45321"]], start=202)
    loads.load(frame(spark, whole, one), BUYERS, path, RUNS[1], keep_versions=9)
    after = data()
    assert {f: after[f] for f in before} == before  # nothing is rewritten in place
    assert len({f.split("/")[2] for f in set(after) - set(before)}) == 1
    got = {r.name: r.city for r in target.scan_target(spark, path, BUYERS).collect()}
    assert len(got) == 200 and got["P7"] == "Goa" and set(got.values()) == {"Goa", "Pune"}
    parts = target.target_info(spark, path)["parts"]
    assert sum(p["rows"] for p in parts) == 200 and {p["folder"].split("/")[0] for p in parts} == {"v=1", "v=2"}


def test_expired_versions_leave_the_buckets_that_are_in_use(spark, tmp_path):
    path, rows = str(tmp_path / "t"), [[f"P{i}", f"p{i}@x", str(i), "Pune", "45321"] for i in range(60)]
    whole = tab(0, "buyers", 0, rows + [["P7", "p7@x", "7", f"city {k}", "45321"] for k in range(6)])
    for upto, run in zip((61, 62, 64, 67), RUNS):
        loads.load(frame(spark, whole[:upto]), BUYERS, path, run, keep_versions=2)
        assert len(stored_rows(spark, path)) == 60
    folders = {f.split("/bucket=")[1].split("/")[0] + "@" + f.split("/")[0] for f in files_of(path) if "/data/" in f}
    assert len(folders) == 8 + 1  # all buckets, and the touched one of the version before


def test_rows_are_written_without_another_shuffle(spark, tmp_path):
    prepared = loads.prepare(frame(spark, tab(0, "buyers", 0, made_rows(1, 300))), BUYERS, RUNS[0])
    target.write_target(prepared, str(tmp_path / "t"), BUYERS)
    files = [f for f in files_of(tmp_path / "t") if "/data/" in f]
    assert len(files) == len({f.split("/")[2] for f in files})  # one file in each bucket


def test_two_loads_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    loads.load(frame(spark, tab(0, "buyers", 0, made_rows(0, 10))), BUYERS, path, RUNS[0])
    parts = {w: frame(spark, tab(w, f"buyers {w}", 0, [[f"W{w} {i}", f"w{w}.{i}@x", str(i), "Pune", "45321"] for i in range(20)])) for w in (1, 2, 3)}
    ready, publish = threading.Barrier(3, timeout=120), target._publish
    first = threading.local()

    def together(*args):
        if not getattr(first, "done", False):
            first.done = True
            ready.wait()  # all have built their version on the same one
        publish(*args)

    monkeypatch.setattr(target, "_publish", together)
    errors = []

    def run(w):
        try:
            loads.load(parts[w], BUYERS, path, RUNS[w], keep_versions=9)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=run, args=(w,)) for w in parts]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    names = {r.name for r in target.scan_target(spark, path, BUYERS).collect()}
    assert {f"W{w} {i}" for w in parts for i in range(20)} <= names
    assert target.target_info(spark, path)["version"] == 4


def test_two_first_loads_at_once_lose_nothing(spark, tmp_path, monkeypatch):
    path, ready, publish = str(tmp_path / "t"), threading.Barrier(2, timeout=120), target._publish
    first = threading.local()

    def together(*args):
        if not getattr(first, "done", False):
            first.done = True
            ready.wait()
        publish(*args)

    monkeypatch.setattr(target, "_publish", together)
    parts = [frame(spark, tab(w, "buyers", 0, [[f"W{w} {i}", f"w{w}.{i}@x", str(i), "", ""] for i in range(9)])) for w in (1, 2)]
    threads = [threading.Thread(target=loads.load, args=(p, BUYERS, path, RUNS[0])) for p in parts]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(stored_rows(spark, path)) == 18


def test_a_file_is_created_by_one_of_many(spark, tmp_path):
    wins, file = [], str(tmp_path / "folder" / "1.json")
    threads = [threading.Thread(target=lambda k=k: wins.append(k) if target._create(spark, file, f"{k}") else None) for k in range(16)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(wins) == 1 and Path(file).read_text() == str(wins[0])
    assert [p.name for p in Path(file).parent.iterdir()] == ["1.json"]


def test_a_version_that_died_while_publishing_is_passed_over(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    loads.load(frame(spark, tab(0, "buyers", 0, made_rows(0, 10))), BUYERS, path, RUNS[0])
    (tmp_path / "t" / "_published" / "2.json").write_text("")
    monkeypatch.setattr(target._content, "__defaults__", (0.0,))
    assert loads.load(frame(spark, tab(0, "buyers", 0, made_rows(0, 14))), BUYERS, path, RUNS[1])
    assert target.target_info(spark, path)["version"] == 3

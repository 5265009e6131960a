"""The tracker on tabs with written-out results, and its properties on random tabs."""

import random

import pytest
from pyspark.sql import functions as F

from sheetloom.operators import layout as lay
from sheetloom.operators.lookup import LookupLimits
from sheetloom.plans import tracker
from sheetloom.session import stage

SCHEMA = "source_workbook string, source_spreadsheet string, source_sheet string, workbook_ord int, tab_ord int, source_row long, cells array<string>"
HEADERS = ["NAME", "Full Name", "E MAIL", "email", "Mail", "PH NO.", "Mobile", "COACH", "Status", "GOLD", "Gold", "Silver"]
HEADERS += ["Agra", "Agra", "REFUNDS", "gold lifetime", "", "", "₹", "comment"]
VALUES = ["", "", "TRUE", "no", "✓", "ann", "BOB", "A@X.COM", "a@x.com", "12345678", "PH 9876543210", "REFUNDS", "refunds"]
VALUES += ["DEACTIVATED", "JAN 2024", "call  later", "X@Y 1234567"]


def random_tab(pick, sheet, rows):
    made = []
    for r in range(1, rows + 1):
        kind = pick.random()
        if kind < 0.1:
            cells = ["NAME", "EMAIL"] + [pick.choice(HEADERS) for _ in range(pick.randint(0, 5))]
            pick.shuffle(cells)
        elif kind < 0.35:
            text = pick.choice(VALUES[3:])
            cells = [pick.choice(["", text, "TRUE", text]) for _ in range(pick.randint(1, 7))]
        else:
            cells = [pick.choice(VALUES) for _ in range(pick.randint(0, 8))]
        if pick.random() < 0.95:
            made.append((sheet, r, cells))
    return made


def as_rows(spark, rows):
    data = [("T", "trk", s, 0, int(s[3:]), r, c) for s, r, c in rows]
    pick = random.Random(9)
    pick.shuffle(data)
    return spark.createDataFrame(data, SCHEMA).repartition(5)


# One tab: its rows, and what each client row becomes (section, and its filled columns).
TAB = [
    (1, ["ann", "a@x.com", "not below a header yet"], None),
    (2, ["NAME", "E MAIL", "Mobile", "Agra", "Gold", "GOLD", "Gold"], None),
    (3, ["Ann", "a@x.com", "", "yes", "TRUE", "no", "x"], ("MAIN", "name=Ann email=a@x.com agra=yes access_gold_pro=TRUE access_gold_pro_lifetime=no access_gold_pro_lifetime_2=x")),
    (4, ["Bob", "", "98765-43", "", "", "", ""], ("MAIN", "name=Bob mobile=98765-43")),
    (5, ["Cy", "", "12345", "", "", "", ""], ("MAIN", "name=Cy mobile=12345")),
    (6, ["Dee", "", "", "TRUE", "", "", ""], None),  # one text besides the tick
    (7, ["", "REFUNDS", "", "REFUNDS"], None),  # a title
    (8, ["Eve", "", "", "Coach Z"], ("REFUNDS", "name=Eve agra=Coach Z")),
    (9, ["", "A@B 1234567", "", ""], ("REFUNDS", "email=A@B 1234567")),  # capitals, but an address in the email column
    (10, ["A@B 1234567", "", "", ""], None),  # the same text elsewhere is a title
    (11, ["Flo", "f@x", "", ""], ("A@B 1234567", "name=Flo email=f@x")),
    (12, ["", "", "JAN 9876543210", ""], ("A@B 1234567", "mobile=JAN 9876543210")),  # digits in the mobile column
    (13, ["", "", "JAN 98", ""], None),
    (14, ["Email", "JAN 98", "Names", "", "Email"], None),  # a header; the section's title names nothing
    (15, ["g@x", "no column", "Gil", "by position", "two", "lifetime", "7"], ("JAN 98", "email=g@x name=Gil agra=by position email_2=two access_gold_pro_lifetime=lifetime access_gold_pro_lifetime_2=7")),
    (16, ["", "", "", ""], None),
    (17, ["₹", "name", "mail", "Coach"], None),
    (18, ["5", "Hal", "h@x", "Zoe", "one", "old"], ("JAN 98", "column_1=5 name=Hal email=h@x coach=Zoe email_2=one access_gold_pro_lifetime=old")),
]


def found_in(parsed):
    found = {}
    for r in parsed.collect():
        record = {c: r[c] for c in tracker.HEADER_COLUMNS} | r["extras"]
        found[r.source_sheet, r.source_row] = (r.section, {c: v for c, v in record.items() if v})
    return found


@pytest.mark.parametrize("limits", [LookupLimits(), LookupLimits(rows=0, block_rows=8, salts=3)])
def test_a_tab_row_by_row(spark, limits):
    parsed = tracker.parse_tracker(as_rows(spark, [("Tab0", n, cells) for n, cells, _ in TAB]), limits)
    found = {n: (section, record) for (_, n), (section, record) in found_in(parsed).items()}
    want = {}
    for n, _, result in TAB:
        if result:
            words = result[1].replace("=", " = ").split()
            starts = [k - 1 for k, w in enumerate(words) if w == "="] + [len(words)]
            want[n] = (result[0], {words[a]: " ".join(words[a + 2 : b]) for a, b in zip(starts, starts[1:])})
    assert found == want


@pytest.mark.parametrize("seed", [1, 2])
def test_order_of_rows_and_form_of_lookups_do_not_matter(spark, seed):
    pick = random.Random(seed)
    rows = [r for i in range(6) for r in random_tab(pick, f"Tab{i}", 150)]
    found = found_in(tracker.parse_tracker(as_rows(spark, rows)))
    assert len(found) > 100
    pick.shuffle(rows)
    spread = LookupLimits(rows=0, block_rows=8, salts=3)
    assert found_in(tracker.parse_tracker(as_rows(spark, rows).repartition(3), spread)) == found


def test_no_client_above_the_first_header(spark):
    pick = random.Random(4)
    rows = [(s, n, c) for s, n, c in random_tab(pick, "Tab0", 150) if n < 40 or n > 60]
    rows = [(s, n, [t for t in c if "mail" not in t.lower()]) if n < 60 else (s, n, c) for s, n, c in rows]
    assert all(n > 60 for _, n in found_in(tracker.parse_tracker(as_rows(spark, rows))))


def test_many_titles_in_one_block(spark):
    """A tab full of title candidates under one header: addresses in the email column are clients."""
    rows = [("Tab0", 1, ["NAME", "EMAIL"])]
    rows += [("Tab0", i + 2, ["", f"MONTH {i}"] if i % 3 else ["", f"A@{i}"]) for i in range(500)]
    rows += [("Tab0", 600, ["x", "EMAIL", "MAIL", "NAME"]), ("Tab0", 601, ["", "A@1"]), ("Tab0", 602, ["n", "m"])]
    found = {n: section for (_, n), (section, _) in found_in(tracker.parse_tracker(as_rows(spark, rows))).items()}
    want = {i + 2: f"MONTH {i - 1}" if i else "MAIN" for i in range(0, 500, 3)}
    assert found == want | {601: "MONTH 499"}


@pytest.mark.parametrize(
    "cells, title",
    [(["REFUNDS", "", "REFUNDS"], "REFUNDS"), (["Refunds"], None), (["TRUE"], None), (["A", "B"], None), (["123"], None)],
)
def test_section_title(evaluate, cells, title):
    assert evaluate(lay.section_title, [cells], "array<string>") == [title]


def test_is_client_row(spark):
    cases = [
        ("", "a@b", "", ["a@b"], True),
        ("", "", "12-345-67", ["12-345-67"], True),
        ("", "", "123456", ["123456"], False),
        ("ann", "", "", ["ann"], False),
        ("ann", "", "", ["ann", "coach x"], True),
        ("ann", "", "", ["ann", "ANN", "TRUE"], False),
    ]
    rows = spark.createDataFrame(cases, "n string, e string, m string, cells array<string>, want boolean")
    got = rows.select(lay.is_client_row(F.col("n"), F.col("e"), F.col("m"), F.col("cells")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def layouts(spark, expression, *arrays):
    """An expression over arrays of (position, name)."""
    shape = ", ".join(f"l{k} {lay.LAYOUT_TYPE}" for k in range(len(arrays)))
    frame = spark.createDataFrame([arrays], shape)
    return [tuple(e) for e in frame.select(expression(*(F.col(f"l{k}") for k in range(len(arrays)))).alias("r")).first().r]


def test_own_layout(spark):
    cells = ["Name", "", "Email", "Gold", "Gold", "refunds", "Email", "Agra", "Agra", "₹", "Gold"]
    canonical = ["name", "", "email", "access_gold_pro", "access_gold_pro", None, "email", None, None, None, "access_gold_pro"]
    snake = ["name", "", "email", "gold", "gold", "refunds", "email", "agra", "agra", "", "gold"]
    frame = spark.createDataFrame([(cells, canonical, snake, "REFUNDS")], "c array<string>, k array<string>, s array<string>, t string")
    found = frame.select(lay.own_layout(*(F.col(x) for x in "ckst")).alias("r")).first().r
    assert [tuple(e) for e in found] == [
        (0, "name"), (2, "email"), (3, "access_gold_pro"), (4, "access_gold_pro_lifetime"), (6, "email_2"), (7, "agra"),
        (8, "agra_2"), (9, "column_10"), (10, "access_gold_pro_lifetime_2"),
    ]


def test_a_layout_inherits_free_positions_and_names(spark):
    above = [(0, "name"), (1, "email"), (2, "coach"), (5, "agra"), (6, "agra")]
    assert layouts(spark, lay.inherit, [(1, "name"), (2, "email")], above) == [(1, "name"), (2, "email"), (5, "agra")]
    assert layouts(spark, lay.inherit, [(1, "name")], []) == [(1, "name")]


def test_clients_and_inferred_columns(spark):
    head = ["NAME", "EMAIL", "Zeta", "Agra", "Both"]
    rows = [("Tab1", 1, head), ("Tab1", 2, ["mary-jane o'neil", "A B@X.com", "z", "yes", "yes"])]
    rows += [("Tab1", 3, ["bob", "b@x", "", "", "maybe"]), ("Tab0", 1, ["NAME", "EMAIL", "Late"]), ("Tab0", 2, ["ann", "a@x", ""])]
    clients = tracker.tracker_clients(as_rows(spark, rows))
    assert clients.columns == [*tracker.CORE_COLUMNS, "late", "zeta", "agra", "both", *tracker.META_COLUMNS]
    types = dict(clients.dtypes)
    assert (types["agra"], types["both"], types["late"]) == ("boolean", "string", "string")
    first = clients.where("source_sheet = 'Tab1' and source_row = 2").first()
    assert (first["name"], first["email"], first["agra"], first["is_active"]) == ("Mary-Jane O'Neil", "ab@x.com", True, True)


def test_the_width_of_the_client_table_is_bounded(spark):
    head = ["NAME", "EMAIL", *(f"Head {k}" for k in range(1200))]
    parsed = tracker.parse_tracker(as_rows(spark, [("Tab0", 1, head), ("Tab0", 2, ["ann", "a@x", "0", "1"])]))
    with pytest.raises(ValueError, match="1200"):
        tracker.extra_columns(parsed, most=1000)
    clients = tracker.build_clients(parsed, ["head_1"])
    assert clients.columns == [*tracker.CORE_COLUMNS, "head_1", *tracker.META_COLUMNS]
    assert clients.first().head_1 is True


def test_five_thousand_headers(spark):
    """In many blocks of a few headers each; the names and their types are found without a column for each."""
    rows = []
    for k in range(0, 5000, 10):
        rows.append(("Tab0", 3 * k + 1, ["NAME", "EMAIL", *(f"Head {i}" for i in range(k, k + 10))]))
        rows.append(("Tab0", 3 * k + 2, [f"n{k}", f"{k}@x", *("yes" if i % 2 else "text" for i in range(k, k + 10))]))
    parsed = stage(tracker.parse_tracker(as_rows(spark, rows)), "parsed")
    names = tracker.extra_columns(parsed)
    assert names == [f"head_{i}" for i in range(5000)]
    report = tracker.bool_column_report(tracker.clean_clients(parsed), tracker.text_columns(names))
    assert {r.name for r in report.where("is_bool").collect()} == {f"head_{i}" for i in range(1, 5000, 2)}
    clients = tracker.build_clients(parsed, names[:40])
    row = clients.where("name = 'N20'").select("head_20", "head_21", "head_30").first()
    assert tuple(row) == ("text", True, "")


def test_a_hundred_thousand_headers_in_one_tab(spark):
    """Every header moves one column; each layout inherits from all above it, across all blocks."""
    n = 100_000
    cells = F.array(F.lit("NAME"), F.lit("EMAIL"), *(F.when(F.col("id") % 6 == k, F.concat(F.lit("Head "), F.col("id").cast("string"))).otherwise("") for k in range(6)))
    rows = spark.range(n).select(
        F.lit("T").alias("source_workbook"), F.lit("trk").alias("source_spreadsheet"), F.lit("Tab0").alias("source_sheet"), F.lit(0).alias("workbook_ord"),
        F.lit(0).alias("tab_ord"), (F.col("id") * 2 + 1).alias("source_row"), cells.alias("cells"),
    )
    control = stage(lay.control_rows(rows), "control")
    layouts = lay.tab_layouts(control)
    assert layouts.count() == n
    at = lambda h: {e["at"]: e["name"] for e in layouts.where(F.col("source_row") == 2 * h + 1).first().layout}
    for h in (0, 3, 6, 5_001, 99_999):
        last = {k: max((i for i in range(max(0, h - 5), h + 1) if i % 6 == k), default=None) for k in range(6)}
        assert at(h) == {0: "name", 1: "email"} | {k + 2: f"head_{i}" for k, i in last.items() if i is not None}
    plan = layouts._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_chained_layouts_are_those_of_one_walk(spark):
    """Random headers in many blocks, with repeated names and moved columns, against a walk in row order."""
    pick = random.Random(9)
    heads = {r: [(p, pick.choice("abcdefgh")) for p in sorted(pick.sample(range(8), pick.randrange(1, 5)))] for r in pick.sample(range(1, 9_000), 400)}
    shape = f"source_spreadsheet string, source_sheet string, source_row long, own {lay.LAYOUT_TYPE}, section string"
    placed = spark.createDataFrame([("wb", "t", r, own, "S") for r, own in heads.items()], shape)
    got = {r.source_row: [tuple(e) for e in r.layout] for r in lay.chain_layouts(placed).collect()}
    want, above = {}, []
    for r in sorted(heads):
        own = heads[r]
        kept, names = list(own), {n for _, n in own}
        for p, name in above:
            if p not in {q for q, _ in own} and name not in names:
                kept.append((p, name))
                names.add(name)
        want[r] = above = kept
    assert got == want


def test_titles_that_depend_on_titles(spark):
    """Each address above a header is a title or a client by the layout that the one before it leaves."""
    rows, section, email = [], "MAIN", None
    want = {}
    for k in range(40):
        r = 3 * k + 1
        text, at = f"T{k}@X", k % 3
        rows.append(("Tab0", r, ["", "", "", ""][:at] + [text]))
        section = section if email == at else text.upper()
        head = ["NAME", "EMAIL", "MAIL ID", section if k % 2 else "x"]
        rows.append(("Tab0", r + 1, head))
        email = 1
        want[r + 1] = section
    control = stage(lay.control_rows(as_rows(spark, rows)), "control")
    assert {r.source_row: r.section for r in lay.tab_layouts(control).collect()} == want


def test_no_clients(spark):
    clients = tracker.tracker_clients(as_rows(spark, [("Tab0", 1, ["JUST A TITLE"])]))
    assert clients.count() == 0 and clients.columns == [*tracker.CORE_COLUMNS, *tracker.META_COLUMNS]


def test_write_clients(spark, tmp_path):
    clients = tracker.tracker_clients(as_rows(spark, [("Tab0", 1, ["NAME", "EMAIL"]), ("Tab0", 2, ["ann", "a@x"])]))
    assert tracker.output_name(["MASTER List!"], "s") == "clients_master_list_s"
    assert tracker.output_name(["a", "b"], "s") == "clients_combined_s"
    for kind in ("parquet", "csv"):
        path = tracker.write_clients(clients, str(tmp_path / kind), ["Tab 0"], "20240101_000000", kind)
        read = spark.read.option("header", "true").format(kind).load(path)
        assert read.count() == 1 and read.columns == clients.columns

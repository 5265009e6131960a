"""Embedding near-dedup, HTML extraction, WARC archives and chat formatting."""

import base64
import hashlib
import html
import math
import random
import re
import uuid

import brute
import duckdb
import numpy as np
import pytest

from sheetloom.llm.chat import END_OF_TURN, rotate
from sheetloom.llm.html_text import Weights, extract_text, fit_weights, main_text, read_page
from sheetloom.llm.queries import ORACLES, QUERIES
from sheetloom.llm.vectors import near_duplicate_vectors
from sheetloom.llm.warc import assemble, captures, read_records, write_archives
from sheetloom.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"


def vector_links(vectors, threshold=0.95):
    usable = {i: np.array(v, float) for i, v in vectors.items() if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in usable.items()}
    ids = sorted(unit)
    return [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]


def check_vectors(frame, vectors):
    links = vector_links(vectors)
    component = brute.component_of(vectors, links)
    degree = dict.fromkeys(vectors, 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in frame.collect()}
    assert found == {i: (degree[i], component[i], component[i] == i) for i in vectors}


def near_copies(rng, n, size=32):
    """Groups around centres, near the threshold too."""
    centres = rng.standard_normal((9, size))
    noise = rng.uniform(0.02, 0.3, n)[:, None] * rng.standard_normal((n, size))
    return (centres[rng.integers(0, 9, n)] + noise).tolist()


@pytest.mark.parametrize("part_rows", [20, 8192])
def test_vectors_against_brute_force(spark, part_rows):
    rng = np.random.default_rng(4)
    vectors = dict(enumerate(near_copies(rng, 300)))
    vectors |= {k: rng.standard_normal(32).tolist() for k in range(300, 400)} | {400: vectors[3], 401: (3e200 * np.array(vectors[3])).tolist()}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    check_vectors(near_duplicate_vectors(frame, part_rows=part_rows), vectors)


def test_vectors_edges(spark):
    x = [1.0, 2.0, 3.0]
    vectors = {1: x, 2: None, 3: [], 4: [0.0, 0.0, 0.0], 5: [1.0, None, 3.0], 6: [1.0, float("nan"), 3.0], 7: [float("inf"), 1.0, 1.0], 8: x, 9: [1.0, 2.0, 3.0, 0.0]}
    shape = "vec_id long, embedding array<double>, node string, cell int, class int"
    frame = spark.createDataFrame([(*r, "n", 1, 2) for r in vectors.items()], shape)
    check_vectors(near_duplicate_vectors(frame), vectors)
    unnamed = near_duplicate_vectors(spark.createDataFrame([(None, x), (1, x), (1, x)], "vec_id long, embedding array<float>")).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in unnamed) == [(-1, 0, None, True), (1, 1, 1, True), (1, 1, 1, True)]
    assert near_duplicate_vectors(frame.where("false")).count() == 0


def test_vectors_whole_sample(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()}
    check_vectors(QUERIES["op8_embedding_dedup"](spark, SF_DIR), vectors)


WEIGHTS = Weights()
ARTICLE = "<article><h1>A  head</h1><p>First\n <b>bold</b> words &amp; more &lt;x&gt;.<p>Second<br>line</p></article>"
TEXT = "A head\n\nFirst bold words & more <x>.\n\nSecond line"


def article_text(source):
    inner = re.search(r"<article>(.*?)</article>", source, re.DOTALL)[1].replace("<br>", " ")
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(filter(None, blocks))


def test_pages_whole_sample(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    found = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op3_html_extraction"](spark, SF_DIR).collect()}
    assert found == {i: (article_text(h), len(article_text(h))) for i, h in pages.items()}


def test_pages_without_article_tags(spark):
    """The weights are learned on labelled pages; the extraction doesn't need the label."""
    table = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    weights = fit_weights(table)
    for row in table.collect():
        for tag in ("", "div"):
            bare = re.sub(r"<(/?)article>", lambda m: f"<{m[1]}{tag}>" if tag else "", row.html)
            assert main_text(bare, weights) == article_text(row.html)


@pytest.mark.parametrize(
    "around",
    [
        "<nav><a href=a>Home</a> <a href=b>News</a></nav>{}<footer>Imprint and so on</footer>",
        "<header><h1>The site name</h1></header><main>{}</main><aside><p>Words in a sidebar, many of them</p></aside>",
        "<div class='cookie-notice'>We use cookies on this site</div>{}<div id=comments><p>first comment with words</p></div>",
        "<script>var a = '<p>no</p>'</script><style>p {{}}</style>{}<form><label>Name</label><button>Send it now</button></form>",
        "<div class='ad-box'>buy now</div><!-- <p>not shown</p> -->{}<section class='related'><h2>Read on</h2></section>",
        "<div hidden>not seen</div>{}<div style='display: none'>nor this</div>",
    ],
)
def test_what_is_around_or_inside_an_article(around):
    assert main_text(f"<html><head><title>T</title></head><body>{around.format(ARTICLE)}</body></html>", WEIGHTS) == TEXT
    # a header inside an article is part of it
    beside = re.sub("<header>.*</header>|<main>|</main>", "", around).format("")
    inside = ARTICLE.replace("<p>Second", beside + "<p>Second")
    assert main_text(f"<body>{inside}</body>", WEIGHTS) == TEXT


@pytest.mark.parametrize(
    "source, text",
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("only words", "only words"), ("a < b", "a < b"), ("<p", ""), ("<p>x &am</p>", "x &am"),
        ("<p>one<p>two", "one\n\ntwo"), ("</div></p>x", "x"), ("<p title='a > b'>x</p>", "x"), ("<a href=\"x>y</a><p>z w", "y\n\nz w"),
        ("<script>x < y", ""), ("<p>caf&eacute; &#233;</p>", "café é"), ("<p>a<b>b</b>c</p>", "abc"),
    ],
)
def test_page_edges(source, text):
    assert main_text(source, WEIGHTS) == text


def test_long_and_deep_pages():
    words = " ".join(f"w{k}" for k in range(50_000))
    assert main_text(f"<body><article><p>{words}</p></article></body>", WEIGHTS) == words
    deep = read_page("<div>" * 2000 + "x" + "</div>" * 2000)
    assert len(deep.items) == 4001 and not read_page("").items


def test_pages_frame(spark):
    rows = [(1, "u", ARTICLE, 9, "old"), (1, "u", ARTICLE, 9, "old"), (None, None, None, 9, "old"), (2, "u", "", 9, "old")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, extra int, text string")
    found = extract_text(pages, WEIGHTS)
    assert found.columns == ["page_id", "url", "extra", "text", "n_chars"]
    assert sorted((r.page_id or -1, r.text, r.n_chars) for r in found.collect()) == [(-1, "", 0), (1, TEXT, len(TEXT)), (1, TEXT, len(TEXT)), (2, "", 0)]
    assert extract_text(pages.where("false")).count() == 0


PAYLOADS = [
    "", "plain", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "WARC/1.1\r\n", "x\r\n\r\nWARC/1.1\r\n\r\n",
    "a\nb\r\nc\r\n\r\n", "é漢\U0001f600", "\r\n", "﻿", "y" * 100_000, "plain", "plain", "",
]


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def round_trip(spark, rows, shape="page_id long, url string, html string", **options):
    path = scratch_path(spark, "warc")
    write_archives(spark.createDataFrame(rows, shape).repartition(3), path, **options)
    return path, captures(spark, path).collect()


def test_archives_round_trip(spark):
    rows = [(k, f"http://h.example/{k}\r\nX: y", p) for k, p in enumerate(PAYLOADS)] + [(90, None, None)]
    path, found = round_trip(spark, rows)
    first = {}
    for k, _, p in rows:
        first.setdefault(p or "", k)
    assert len(found) == len(rows)
    for r in found:
        k, url, payload = next(x for x in rows if x[0] == r.page_id)
        payload = payload or ""
        revisit = first[payload] != k
        assert (r.url, r.response.type, r.refers_to) == (url, "revisit" if revisit else "response", first[payload] if revisit else None)
        assert (r.response.payload_digest, r.response.payload_bytes) == (digest(payload), len(payload.encode()))
        assert r.response.payload is None if revisit else bytes(r.response.payload) == payload.encode()
        assert len(r.requests) == len(r.metadata) == 1 and r.requests[0].content.startswith("GET /")
    records = read_records(spark, path).collect()
    ids = [r.record_id for r in records]
    assert len(set(ids)) == len(ids) == 3 * len(rows) and all(uuid.UUID(i[10:-1]) for i in ids)


def test_small_payloads_repeated_rows_and_null_ids(spark):
    rows = [(3, "u", "abc"), (2, "u", "abc"), (2, "u", "abc"), (None, "u", "abc"), (5, "u", "a"), (6, "u", "a")]
    _, found = round_trip(spark, rows, min_bytes=2)
    assert sorted((r.page_id or -1, r.response.type, r.refers_to) for r in found if r.page_id in (5, 6)) == [(5, "response", None), (6, "response", None)]
    same = sorted((r.page_id or -1, r.response.type, r.refers_to or 0) for r in found if r.page_id not in (5, 6))
    assert same == [(-1, "revisit", 2), (2, "response", 0), (2, "revisit", 2), (3, "revisit", 2)]
    assert round_trip(spark, [])[1] == []


def test_assembly_of_incomplete_captures(spark):
    rows = [("r1", "response", None, "a"), ("q2", "request", "r9", "b"), ("m1", "metadata", "r1", "c"), ("q1", "request", "r1", "d"), ("x", "request", None, "e")]
    shape = "record_id string, type string, concurrent_to string, content string, uri string, date string, http_head string, payload binary, payload_bytes long, payload_digest string, refers_to string"
    found = {r.capture_id: r for r in assemble(spark.createDataFrame([(*r, *[None] * 7) for r in rows], shape)).collect()}
    assert set(found) == {"r1", "r9"} and found["r9"].response.type is None and found["r9"].metadata == []
    assert [x.content for x in found["r1"].requests] == ["d"] and [x.content for x in found["r1"].metadata] == ["c"]


def test_perspectives(spark):
    turns = [(1, 0, "system", "Be kind."), (1, 1, "Ann", "Hi <|end|>"), (1, 2, "Bob", None), (1, 3, None, "?"), (2, 0, "system", "alone"), (None, 0, "Ann", "x"), (1, 300, "Ann", "late")]
    frame = spark.createDataFrame([(*t, "n", 5) for t in turns], "conv_id long, turn long, role string, text string, speaker string, part int")
    found = {(r.conv_id, r.speaker, r.part): r for r in rotate(frame).collect()}
    assert set(found) == {(1, s, p) for s in ("Ann", "Bob", "unknown") for p in (0, 1)} | {(None, "Ann", 0)}
    ann = found[1, "Ann", 0]
    assert ann.text == (
        "<|system|>\nBe kind.<|end|>\n<|assistant|>\nHi < |end|><|end|>\n<|user name=Bob|>\n<|end|>\n<|user name=unknown|>\n?<|end|>\n"
    )
    assert [ann.text[s.start : s.end] for s in ann.spans] == ["Hi < |end|>" + END_OF_TURN]
    assert ann.n_trained == len("Hi < |end|>" + END_OF_TURN) and found[1, "Bob", 1].spans == []
    assert rotate(frame.where("false")).count() == 0


def test_ties_and_repeated_turns(spark):
    turns = [(1, 5, "b", "x"), (1, 5, "a", "z"), (1, 5, "a", "y"), (1, 5, "a", "y"), (1, None, "a", "first")]
    found = {(r.speaker, r.part): r for r in rotate(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    assert [found["b", 0].text[s.start : s.end] for s in found["b", 0].spans] == ["x" + END_OF_TURN]
    assert re.findall(r"\n([a-z]+)<", found["a", 0].text) == ["y", "y", "z", "x"] and found["a", -1].n_turns == 1


def test_masks_cover_what_the_speaker_says(spark):
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    said = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        said.setdefault((r.conv_id, r.role), []).append((r.text or "") + END_OF_TURN)
    for r in rotate(turns).collect():
        assert [r.text[s.start : s.end] for s in r.spans] == said[r.conv_id, r.speaker]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = sorted((dict(zip(columns, row)) for row in cursor.fetchall()), key=str)
    result = QUERIES[name](spark, SF_DIR)
    found = [r.asDict() for r in result.select(*columns).collect()]
    assert sorted(result.columns) == sorted(columns) and sorted(found, key=str) == want


def test_random_pages_never_fail():
    rng = random.Random(8)
    pieces = ["<p>", "</p>", "<div class='ad'>", "</div>", "<b>", "</i>", "word ", "&lt;", "<", ">", "'", '"', "<a href='", "<!--", "-->", "<script>", "</script>", "\n"]
    for _ in range(500):
        source = "".join(rng.choice(pieces) for _ in range(40))
        assert main_text(source, WEIGHTS) == "\n\n".join(" ".join(b.split()) for b in main_text(source, WEIGHTS).split("\n\n"))

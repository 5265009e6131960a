"""Personal data, source divergence and lexical search against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetloom.llm import divergence, lexical
from sheetloom.llm.divergence import WordPointers, audit_sources
from sheetloom.llm.lexical import search
from sheetloom.llm.private_data import KINDS, SpanModel, _lower_bound, fit_model, find_spans, personal_data, redacted, span_text
from sheetloom.llm.queries import QUERIES

SAMPLE = "/root/testdata/sf0.001"

# ---- personal data -------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def stays(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text):
    found = [(m.start(), k, m.end()) for k, kind in enumerate(KINDS) for m in re.finditer(PLAIN[kind], text or "") if stays(kind, m[0])]
    return [f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found)]


def spans_of(frame):
    rows = frame.select("doc_id", span_text(F.filter("spans", lambda s: s["base"])).alias("base"), span_text(F.col("spans")).alias("all")).collect()
    return [(r.doc_id, r.base.split(",") if r.base else [], r.all.split(",") if r.all else []) for r in rows]


TRICKY = [
    None, "", " ", "a@b.c", "é a.b+c@x-y.co.uk, z@q", "a@b.c_x@y.z", "a@b.c@d.e", "..@..a@b.c.", "x@y", "@a.b", "a@b.c.d@e.f", "ü@b.de x",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.001.00.9", "1.2.3", "..1.2.3.4..", "999999999999999999999.1.1.1", "1.1.1.99999",
    "4111 1111 1111 1111", "4111-1111-1111-1111 7", "41111111 11111111", "4111111111111112", "1 2", "0000 0000 0000", "12", "5",
    "4041894974608795 70.123.182.155", "+1 (269) 555-3296 4524132264652876", "+49 30 1234567.", "+12345", "+1234567890123456", "+1 ((((((((", "++1 234 567 890",
    "𝔘 +1 (988) 555-2485 é 1.1.1.1 𝔘 a@b.io", "mail\na@b.c\n4111 1111\n1111 1111", "9" * 3000, "1 " * 3000, "a" * 3000 + "@b.c", "a@" + "b." * 3000 + "c",
    "1.1.1.1 " * 700, "a.b@c.de," * 600,
]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    rng = random.Random(5)
    pieces = ["a", "B7", "@", ".", "-", "+", " ", "1", "23", "4111111111111111", "255", "(", ")", "é", "_", "%", "\n", "+1 555 123 4567", "x@y.z"]
    texts = TRICKY + ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, "old", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, kind int").repartition(4)
    found = spans_of(personal_data(docs, SpanModel()))
    assert sorted(i for i, _, _ in found) == list(range(len(texts)))
    for i, base, every in found:
        assert base == base_spans(texts[i]), texts[i][:80]
        assert set(base) <= set(every)


def test_added_spans_overlap_nothing(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for i, base, every in spans_of(personal_data(docs)):
        assert base == base_spans(texts[i])
        places = [tuple(map(int, s.split(":")[1:])) for s in every]
        added = [tuple(map(int, s.split(":")[1:])) for s in every if s not in base]
        assert all(b <= c or d <= a for a, b in added for c, d in places if (a, b) != (c, d))


def test_adjacent_numbers_are_told_apart(spark):
    """The base patterns run through both numbers and drop them; the trees find each."""
    rng = random.Random(1)

    def card():
        digits = [4] + [rng.randrange(10) for _ in range(14)]
        return next(n for n in ("".join(map(str, digits)) + str(k) for k in range(10)) if luhn(n))

    rows, hard = [], {}
    for i in range(600):
        phone, number = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", card()
        rows.append((i, f"call {phone} now, then pay with {number} or write to u{i}@mail.example.com today"))
    for i in range(600, 620):
        phone, number = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", card()
        text = f"call {phone} {number} now"
        rows.append((i, text))
        hard[i] = {f"phone:5:{5 + len(phone)}", f"card:{6 + len(phone)}:{6 + len(phone) + 16}"}
    rows += [(700 + i, f"version {i}.{i}. of the release 4.0. with key AKIA{i}ABCDEF and 0641917ea4e9feb9cda83477b57ac2654884f{i}") for i in range(40)]
    found = {i: set(every) for i, _, every in spans_of(personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))}
    assert all(hard[i] <= found[i] for i in hard)
    assert not any(found[700 + i] for i in range(40))


def test_the_same_rows_in_other_order_give_the_same_spans(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text")
    once, again = (sorted(spans_of(personal_data(docs.repartition(n)))) for n in (1, 7))
    assert once == again


def test_redaction(spark):
    text = "é a@b.co and 4111 1111 1111 1111 é"
    docs = spark.createDataFrame([(1, text), (2, "none"), (3, None)], "doc_id long, text string")
    found = personal_data(docs, SpanModel()).select("doc_id", redacted(F.col("text"), F.col("spans")).alias("t"))
    assert {r.doc_id: r.t for r in found.collect()} == {1: "é [EMAIL] and [CARD] é", 2: "none", 3: None}


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "a@b.c"), (1, "a@b.c"), (1, "x"), (None, "q@r.s"), (None, None)]
    found = spans_of(personal_data(spark.createDataFrame(rows, "doc_id long, text string"), SpanModel()))
    assert sorted((i is None, i or 0, base) for i, base, _ in found) == [
        (False, 1, []), (False, 1, ["email:0:5"]), (False, 1, ["email:0:5"]), (True, 0, []), (True, 0, ["email:0:5"]),
    ]
    assert personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_kind_without_evidence_adds_nothing(spark):
    docs = spark.createDataFrame([(i, f"call 020 7946 0{i:03d} now") for i in range(50)], "doc_id long, text string")
    model = fit_model(find_spans(docs))
    assert "phone" in model.trees and not model.thresholds
    assert not any(every for _, _, every in spans_of(personal_data(docs, model)))


def test_the_trees_are_trained_and_calibrated_on_all_candidates(spark):
    many = spark.range(50_000).select(
        F.col("id").alias("doc_id"), F.lit(1).cast("long").alias("text_hash"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("start"),
        F.lit(5).cast("long").alias("stop"), F.lit(False).alias("base"), F.array_repeat(F.expr("id % 2 = 0"), 24).alias("features"),
        F.expr("id % 3 = 0 OR id % 2 = 0").alias("passed"),
    )
    training = F.pmod(F.xxhash64(F.xxhash64("doc_id", "text_hash", "start", "stop")), F.lit(2)) == 0
    halves = {r.half: r for r in many.groupBy(training.alias("half")).agg(F.count("*").alias("n"), F.count_if("passed").alias("hits")).collect()}
    (n, hits), (n2, hits2) = ((halves[half].n, halves[half].hits) for half in (True, False))
    assert n + n2 == 50_000
    share, bound = (hits + 1) / (n + 2), _lower_bound(hits2, n2)
    for precision, found in ((bound - 1e-9, {True, False}), (bound + 1e-9, {True})):  # one band of the whole other half
        model = fit_model(many, rounds=2, band_rows=n2, precision=precision)
        assert model.priors == {"email": pytest.approx(math.log(share / (1 - share)), abs=1e-12)}
        assert set(model.thresholds) == {("email", passing) for passing in found}


def test_op11_uses_no_python_worker(spark):
    frame = QUERIES["op11_pii"](spark, SAMPLE)
    plan = frame._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    digest = {r.doc_id: r.base_sha256 for r in frame.collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SAMPLE}/documents.parquet").collect()}
    assert digest == {i: hashlib.sha256(",".join(base_spans(t)).encode()).hexdigest() for i, t in texts.items()}


# ---- source divergence ---------------------------------------------------------------------


def words(text):
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def audit(rows, min_docs, top):
    docs = [(lang or "", source or "", words(text)) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(w for _, _, ws in mine for w in set(ws))
        kept = sorted(w for w, n in df.items() if n >= min_docs)
        counts = {s: Counter(w for _, s2, ws in mine if s2 == s for w in ws if w in df and df[w] >= min_docs) for s in {d[1] for d in mine}}
        whole = sum(counts.values(), Counter())

        def shares(c):
            total = sum(c.values())
            return {w: 1 + 1_000_000_000 * (c[w] + 5) // (total + 5 * len(kept)) for w in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in p:
            pairs = [(o, sum(abs(p[s][w] - p[o][w]) for w in kept)) for o in p if o != s]
            terms = [(w, p[s][w] - q[w]) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda f: (-f[1], f[0].encode()))
                out += [(lang, s, part, item, v, r) for r, (item, v) in enumerate(ranked, 1) if part == "pair" or r <= top]
    return sorted(out)


def audited(frame):
    return sorted(tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect())


def made_documents(seed, n):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "été", "Été", "abcdefgh", "abcdefghi", "abcdefgx", "𝔘x", "日本", "z", "abcdefghijklmnopqr", "abcdefghijklmnopqs"]
    make = lambda: rng.choice([" ", "1", "\n", "--"]).join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 12)))
    rows = [(make(), rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "é", "", None])) for _ in range(n)]
    return rows + [(None, "en", "s3"), ("", "xx", "only"), ("12 ?", "yy", "a"), ("", "yy", "b"), ("the " * 30_000 + "été" * 40_000, "en", "long")] + rows[:3]


@pytest.mark.parametrize("shard", [1 << 23, 64])
def test_audit_is_that_of_plain_counting(spark, shard):
    rows = made_documents(2, 150)
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "text string, lang string, source string, n int, term string, tile int").repartition(5)
    for min_docs in (2, 30):
        got = audited(audit_sources(frame, min_docs=min_docs, top=3, shard_bytes=shard, block_terms=3, tile_sources=2))
        assert got == audit(rows, min_docs, 3)


def test_audit_of_nothing(spark):
    assert audited(audit_sources(spark.createDataFrame([], "text string, lang string, source string"))) == []


def test_words_are_sorted_by_bytes(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "b", "é", " ", "abcdefgh"]) for _ in range(rng.randrange(0, 40))) for _ in range(300)]
    data = "".join(texts).encode()
    starts = np.cumsum([0] + [len(t.encode()) for t in texts[:-1]])
    pointers = WordPointers(np.frombuffer(data.translate(divergence.term_table(False)), np.uint8), starts)
    want = sorted((w.encode(), int(s)) for t, s in zip(texts, starts) for w in words(t))
    for cutoff in (1 << 16, 64):
        order, first = pointers.sort(cutoff)
        got = [bytes(data[pointers.starts[k] : pointers.starts[k] + pointers.lengths[k]]) for k in order]
        assert got == [w for w, _ in want]
        assert first.tolist() == [k == 0 or got[k] != got[k - 1] for k in range(len(got))]
        assert all(pointers.starts[order[k]] < pointers.starts[order[k + 1]] for k in range(len(got) - 1) if not first[k + 1])


# ---- lexical search ------------------------------------------------------------------------


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranking(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c in counted:
            m = 10 + 90 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t]
            )
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 20, 4])
def test_search_ranks_as_plain_scoring(spark, block):
    rng = random.Random(4)
    vocabulary = ["the", "The", "7", "a7", "été", "日本", "word", "rare", "x"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs = [(i, make(rng.randrange(0, 9))) for i in range(120)] + [(7, "rare"), (7, "rare"), (None, "rare"), (200, None), (201, "--"), (202, "rare " * 50_000)]
    items = [(1, "the rare"), (2, "nowhere"), (3, None), (4, ""), (5, "word 7 7 x"), (5, "word 7 7 x"), (6, make(9)), (None, "été")]
    frame = spark.createDataFrame([(*d, 1, 2, "t") for d in docs], "doc_id long, text string, item int, score int, term string").repartition(5)
    asked = spark.createDataFrame([(*i, 3, "r") for i in items], "item_id long, text string, doc_id int, rank string")
    got = sorted((tuple(r) for r in search(frame, asked, k=4, block_postings=block).collect()), key=repr)
    assert got == ranking(docs, items, 4)


def test_search_in_nothing_and_for_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    item = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(none, item).count() == 0 and search(one, item.where("false")).count() == 0


def test_scores_in_whole_numbers_are_those_in_doubles():
    rng = np.random.default_rng(1)
    index = lexical.ItemIndex.of([(int(i), b"t%d" % t) for i in range(5) for t in rng.integers(0, 40, 12)])
    n = len(index.terms)
    docs, terms_ = np.repeat(np.arange(30), n), np.tile(np.arange(n), 30)
    tf, sizes = rng.integers(1, 9, len(docs)), rng.integers(50, 99, 30)
    small = lexical.Collection(30, int(sizes.sum()), rng.integers(1, 5000, n))
    large = lexical.Collection(30, int(sizes.sum()), small.weights * 10_000_000)
    plain = lexical.block_scores(index, small, sizes, docs, terms_, tf)
    assert (lexical.block_scores(index, large, sizes, docs, terms_, tf) == plain * 10_000_000).all()


def test_crc32_is_that_of_python(spark):
    assert spark.range(3).select(F.crc32(F.col("id").cast("string")).alias("c")).collect()[2].c == zlib.crc32(b"2")

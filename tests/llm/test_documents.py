"""Line dedup, MinHash, language ID, decontamination, packing and LM scoring on small documents."""

import math
import random
import re
import time
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetloom.llm import decontaminate as decontaminate_module, packing
from sheetloom.llm.common import WordHashes, components, word_chunks, words
from sheetloom.llm.decontaminate import canonical, decontaminate, find_contamination
from sheetloom.llm.language import fit_languages, gram_counts, identify
from sheetloom.llm.language_model import LogBilinear, build_vocabulary, contexts, count_words, score_texts, token_hash, train
from sheetloom.llm.line_dedup import LineRuns, dedup_lines, document_lines
from sheetloom.llm.minhash import near_duplicates
from sheetloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
LINE = "This line is long enough to count"


def docs_frame(spark, rows, extra=True):
    """(doc_id, text) with clashing extra columns."""
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    shape = "doc_id long, text string, node long, class string, score int, n_lines string, component_id string, bucket int, row int"
    return spark.createDataFrame([(*r, 1, "c", 2, "x", "y", 3, 4) for r in rows], shape)


def sample(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_words():
    assert words("A b  C\x0bdÉ\n") == ["a b".encode(), b"c", "dÉ".encode()]
    assert words(None) == words(" \t\n") == []
    text = "ab cd " * 1000
    assert [t for part in word_chunks(text, size=7) for t in part] == words(text)
    assert WordHashes(room=1).of_text(text).tolist() == WordHashes()(words(text)).tolist()


def test_components(spark):
    edges = [(5, 9), (9, 2), (7, 7), (2, 5), (20, 21), (None, 3), (30, 31), (31, 32), (32, 33), (33, 34), (34, 35), (35, 29)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {
        2: 2, 5: 2, 9: 2, 20: 20, 21: 20, 29: 29, 30: 29, 31: 29, 32: 29, 33: 29, 34: 29, 35: 29,
    }
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    rng = random.Random(3)
    names = list(range(200))
    rng.shuffle(names)
    edges = [(names[k], names[k + 1]) for k in range(149)] + [(names[199], names[k]) for k in range(150, 199)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == brute.component_of(names, edges)


def line_result(frame):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in frame.collect()}


def test_line_dedup_rules(spark):
    rows = [
        (1, f"{LINE}\nshort\n{LINE}"),
        (2, f"  {LINE.upper()}\t\nshort"),
        (3, f"{LINE}\n{LINE}\nshort\n\n"),
        (4, None),
        (5, ""),
        (6, "É" + LINE),
        (7, "é" + LINE),
        (8, "É" + LINE),
    ]
    found = line_result(dedup_lines(docs_frame(spark, rows)))
    assert found == brute.dedup_lines(dict(rows))
    assert found[1] == (3, 2, "short") and found[3][1] == 0 and found[6][1] == 0


def test_line_dedup_keeps_columns_nulls_and_repeated_rows(spark):
    rows = [(1, LINE), (1, LINE), (2, LINE), (3, LINE), (None, f"{LINE}\nx"), (None, None)]
    result = dedup_lines(docs_frame(spark, rows))
    assert set(result.columns) == {"doc_id", "text", "node", "class", "score", "component_id", "bucket", "row", "n_lines", "n_dropped"}
    found = sorted((r.doc_id or -1, r.text, r.n_dropped) for r in result.collect() if r.text is not None)
    assert found == [(-1, "x", 1), (1, "", 1), (1, "", 1), (2, "", 1), (3, LINE, 0)]
    assert dedup_lines(docs_frame(spark, [])).count() == 0


def test_line_dedup_whole_sample(spark):
    rows = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in QUERIES["op7_line_dedup"](spark, SF_DIR).collect()}
    assert rows == {i: (n, d, brute.sha256(t)) for i, (n, d, t) in brute.dedup_lines(sample(spark)).items()}


def test_line_runs_are_compacted_and_batches_do_not_matter(spark):
    rows = [(k, "\n".join(f"line number {j} that is long" for j in range(k % 5, 5))) for k in range(24)]
    lines = document_lines(docs_frame(spark, rows))
    runs = LineRuns(fanout=2)
    for k in range(6):
        runs.add(lines.where(F.col("doc_id") % 6 == k))
    assert [len(level) for level in runs.levels] == [0, 1, 1]
    one = LineRuns()
    one.add(lines)
    assert sorted(runs.repeated(3).collect()) == sorted(one.repeated(3).collect())


def near_result(frame):
    return {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in frame.collect()}


def edited(text, rng, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def test_near_duplicates_against_brute_force(spark):
    """Groups of near copies of a base that differ more from each other than from it, also over several parts."""
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(300)}" for _ in range(120)) for _ in range(4)]
    docs = {k: edited(base[k % 4], rng, rng.randrange(8)) for k in range(160)}
    docs |= {200: docs[7], 201: docs[7].upper(), 202: " ".join(f"u{k}" for k in range(50)), 203: "one two", 204: "one two", 205: "One"}
    want, sizes = brute.near_duplicate_components(docs, 3, 85)
    rows = list(docs.items())
    rng.shuffle(rows)
    found = near_result(near_duplicates(docs_frame(spark, rows), width=3, percent=85, part_rows=9))
    assert found == {i: (want[i], sizes[i], want[i] == i) for i in docs}


def test_near_duplicates_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f")]
    result = near_duplicates(docs_frame(spark, rows))
    found = sorted(((r.doc_id or -1), r.component_id, r.n_shingles, r.kept) for r in result.collect())
    assert found == [(-1, None, 2, True), (1, 1, 0, True), (2, 2, 0, True), (3, 3, 0, True), (4, 4, 2, True), (5, 4, 2, False), (5, 4, 2, False)]
    assert near_duplicates(docs_frame(spark, [])).count() == 0


def test_near_duplicates_whole_sample(spark):
    docs = sample(spark)
    want, sizes = brute.near_duplicate_components(docs, 3, 85)
    found = near_result(QUERIES["op10_minhash_dedup"](spark, SF_DIR))
    assert found == {i: (want[i], sizes[i], want[i] == i) for i in docs}


def test_language_accuracy_on_held_out_documents(spark):
    rows = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held_out = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held_out) >= 0.98 * len(held_out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    docs = spark.createDataFrame([(k, t, "en" if k % 2 else "fr", "s", 1) for k, t in enumerate(["le la des " * 9, "the of and " * 9] * 8)], SHAPE)
    model = fit_languages(docs, sample_per_language=100)
    texts = [(1, None), (2, ""), (3, "123 ² --"), (4, "THE and OF"), (None, "des la le"), (4, "THE and OF"), (5, "漢字" * 50)]
    found = identify(docs_frame(spark, texts), model).select("doc_id", "lang_pred", "score", "rejected", "n_lines").collect()
    assert [r.lang_pred for r in found][:6] == ["und", "und", "und", "en", "fr", "en"]
    assert [r.score for r in found][:3] == [0, 0, 0] and [r.rejected for r in found] == [True] * 3 + [False] * 3 + [True]
    assert identify(docs_frame(spark, []), model).count() == 0
    nothing = fit_languages(docs.where("false"))
    assert [r.lang_pred for r in identify(docs, nothing).collect()] == ["und"] * 16


def test_gram_counts_of_long_texts_do_not_depend_on_the_piece():
    text = "Ein langer Text, with Élèves 12 and more. " * 50
    assert (gram_counts(text, piece=17) == gram_counts(text)).all()


@pytest.mark.parametrize(
    "token, kind, value",
    [("Tom's", 2, "tom's"), ("(12,5)", 1, "12,5"), ("5kg", 3, "5kg"), ("km.", 4, "km"), ("NASA", 0, "nasa"), ("***", 0, ""), ("the", 0, "the")],
)
def test_canonical_words(token, kind, value):
    assert canonical(token) == (kind, value)


ITEM = "Tom has 12 apples and gives 5 apples to Anna. How many of the 12 apples does Tom still have after he eats 3 more?"
PROSE = "some other words stand here that no one asks about and they go on and on for a while"


def contaminated(spark, texts, items):
    docs = docs_frame(spark, list(enumerate(texts)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in find_contamination(docs, benchmark).collect()}


def test_contamination(spark):
    other = ITEM.replace("Tom", "Rosa").replace("Anna", "Max").replace("12", "40").replace("5", "9").replace(" 3 ", " 7 ")
    inconsistent = other.replace("40 apples does Rosa", "41 apples does Rosa", 1).replace("Rosa still", "Pete still").replace("Max", "Rosa")
    texts = [f"{PROSE} {ITEM} {PROSE}", f"{PROSE}. {other}", inconsistent, PROSE, None, "", ITEM.replace("apples", "pears"), ITEM, "7 of 9"]
    found = contaminated(spark, texts, [(7, ITEM), (8, None), (9, "12 34"), (None, ITEM), (10, "")])
    assert set(found) == {(0, 7), (1, 7), (7, 7)}
    assert found[0, 7].n_changed == 0 and (found[1, 7].n_changed, found[1, 7].n_slots) == (7, 8)  # all but "How"
    assert found[0, 7].first_word == len(PROSE.split()) and found[0, 7].n_matched == found[0, 7].n_windows


def test_contamination_after_an_inconsistent_text_of_the_same_template(spark):
    other = ITEM.replace("Tom", "Rosa").replace("Anna", "Max").replace("12", "40").replace("5", "9").replace(" 3 ", " 7 ")
    inconsistent = other.replace("40 apples does Rosa", "41 apples does Rosa", 1).replace("Rosa still", "Pete still").replace("Max", "Rosa")
    found = contaminated(spark, [f"{inconsistent} {PROSE} {other}", f"{inconsistent} {PROSE} {inconsistent}"], [(7, ITEM)])
    assert set(found) == {(0, 7)} and found[0, 7].first_word == len(f"{inconsistent} {PROSE}".split())


def test_contamination_with_a_word_put_in(spark):
    assert set(contaminated(spark, [ITEM.replace("apples to", "apples back to")], [(7, ITEM)])) == {(0, 7)}


def test_decontaminate_keeps_the_other_rows_as_they_are(spark):
    docs = docs_frame(spark, [(1, ITEM), (2, PROSE), (2, PROSE), (None, None), (3, "")])
    benchmark = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    kept = decontaminate(docs, benchmark)
    assert kept.columns == docs.columns and sorted(kept.collect(), key=str) == sorted(docs.where("doc_id IS NULL OR doc_id > 1").collect(), key=str)
    assert decontaminate(docs.where("false"), benchmark).count() == 0
    assert decontaminate(docs, benchmark.where("false")).count() == 5


def test_contamination_finds_every_copied_item_of_the_sample(spark):
    docs = sample(spark)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    copied = {(i, k) for i, t in docs.items() for k, item in items.items() if " ".join(item.split()) in " ".join((t or "").split())}
    found = {(r.doc_id, r.item_id) for r in QUERIES["op4_decontamination"](spark, SF_DIR).collect()}
    assert copied <= found
    for doc, item in found - copied:  # copies with changes
        assert len(brute.shingles(items[item], 2) & brute.shingles(docs[doc], 2)) >= 0.7 * len(brute.shingles(items[item], 2))


def test_contamination_in_any_letter_case(spark):
    texts = [f"{PROSE} {ITEM.upper()}", f"{PROSE} {ITEM.lower()} {PROSE}", ITEM.title(), ITEM.upper().replace("APPLES", "PEARS")]
    found = contaminated(spark, texts, [(7, ITEM)])
    assert set(found) == {(0, 7), (1, 7), (2, 7)} and all(r.n_changed == 0 for r in found.values())
    assert set(contaminated(spark, ["WIE LANG IST DIE STRASSE NACH BERLIN"], [(1, "Wie lang ist die Straße nach Berlin?")])) == {(0, 1)}


def test_contamination_by_short_items_and_items_of_numbers_and_names(spark):
    items = ["12 + 7 = 19", "Paris", "What is gravity?", "Anna Bob 12 34 Carl Dora 56 78"]
    texts = [*(f"{PROSE} {item} {PROSE}" for item in items), f"{PROSE} WHAT IS GRAVITY", "what was gravity", f"{PROSE} 12 + 7 = 20"]
    found = contaminated(spark, texts, list(enumerate(items)))
    assert set(found) == {(0, 0), (1, 1), (2, 2), (3, 3), (4, 2)}
    assert {r.first_word for r in found.values()} == {len(PROSE.split())} and all(r.n_matched == r.n_windows for r in found.values())
    assert contaminated(spark, texts, [(9, "!!"), (10, "...")]) == {}


def bare(text):
    """The words in folded case without punctuation at their ends, between blanks."""
    return f" {' '.join(w for w in (re.sub(r'^[\W_]+|[\W_]+$', '', t).casefold() for t in (text or '').split()) if w)} "


def test_contamination_in_any_letter_case_of_the_large_sample(spark):
    table = {n: spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "benchmark")}
    items = [(r.item_id, bare(r.text)) for r in table["benchmark"].collect()]
    copied = {(r.doc_id, k) for r in table["documents"].collect() for text in [bare(r.text)] for k, item in items if item in text}
    found = {(r.doc_id, r.item_id) for r in find_contamination(table["documents"], table["benchmark"]).collect()}
    assert {(1699, 130), (6420, 37), (8376, 101)} <= copied <= found


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(30):
        histogram = {rng.randrange(1, 40): rng.randrange(1, 9) for _ in range(rng.randrange(1, 9))}
        for buckets in (1, 2, 3, 5):
            bounds = packing.best_boundaries(histogram, buckets)
            assert len(bounds) <= buckets and bounds == sorted(set(bounds)) and bounds[-1] == max(histogram)
            assert packing.padding(histogram, bounds) == brute.least_padding(histogram, buckets)
    assert packing.best_boundaries({}, 3) == []


def check_packing(docs, rows, max_tokens, batch_tokens):
    spans = sorted((r.doc_id if r.doc_id is not None else -1, r.start_token, r.n_tokens) for r in rows)
    want = []
    for doc, text in docs:
        n = len(brute.words(text)) + 1
        want += [(doc if doc is not None else -1, at, min(max_tokens, n - at)) for at in range(0, n, max_tokens)]
    assert spans == sorted(want)
    batches = {}
    for r in rows:
        batches.setdefault((r.bucket, r.shard, r.batch), []).append(r)
    for (bucket, _, _), held in batches.items():
        assert sorted(r.slot for r in held) == list(range(len(held))) and len(held) * bucket <= batch_tokens
        assert all(r.n_tokens <= bucket for r in held)
    partial = Counter((b, s) for (b, s, _), held in batches.items() if len(held) < batch_tokens // b)
    assert all(n == 1 for n in partial.values())
    histogram = Counter(r.n_tokens for r in rows)
    bounds = packing.best_boundaries(histogram, 8)
    assert all(r.bucket == min(b for b in bounds if b >= r.n_tokens) for r in rows)


def test_packing(spark):
    rng = random.Random(2)
    docs = [(k % 200, " ".join("w" for _ in range(rng.randrange(70)))) for k in range(300)] + [(None, "a b"), (None, None), (7, "")]
    rows = packing.pack(docs_frame(spark, docs), max_tokens=32, batch_tokens=128, shard_rows=16).collect()
    check_packing(docs, rows, 32, 128)
    assert packing.pack(docs_frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs_frame(spark, docs), max_tokens=64, batch_tokens=32)


def test_packing_whole_sample(spark):
    check_packing(list(sample(spark).items()), QUERIES["op2_packing"](spark, SF_DIR).collect(), 2048, 16_384)


def test_scores_whole_sample(spark):
    docs = sample(spark)
    held_out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = Counter()
    for i, t in docs.items():
        if not held_out[i]:
            counts.update([*brute.words(t), None])
    total = sum(counts.values())
    rows = QUERIES["op1_lm_scoring"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        tokens = [*brute.words(docs[r.doc_id]), None]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held_out[r.doc_id], len(tokens), total)
        assert r.n_known == sum(counts[t] > 0 for t in tokens)
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in tokens), rel_tol=1e-9)
    gains = [(r.score - r.base_score, r.n_tokens) for r in rows if r.held_out]
    assert sum(g for g, _ in gains) > 0.005 * sum(n for _, n in gains)  # 200 documents teach little


def test_every_training_text_takes_steps(spark):
    docs = spark.createDataFrame([(k, f"w{k:02} " * 20) for k in range(40)], "doc_id long, text string")
    vocabulary = build_vocabulary(count_words(docs), 40)
    start = LogBilinear.start((vocabulary.class_tokens + 1) / (vocabulary.n_tokens + vocabulary.n_classes))
    moved = (train(docs, vocabulary).r != start.r).any(axis=1)
    own = [vocabulary.class_of[vocabulary.words[f"w{k:02}".encode()]] for k in range(40)]
    assert len(set(own)) == 40 and moved[own].all()  # the word of each text is a class of its own, seen in that text only


def test_words_beyond_the_known_ones_count_the_same(spark):
    rows = [(k, t) for k, t in sample(spark).items() if k < 60]
    docs = docs_frame(spark, rows, extra=False)
    many = score_texts(docs, F.col("doc_id") % 3 != 0, singles=20, shared=8)
    few = score_texts(docs, F.col("doc_id") % 3 != 0, singles=20, shared=8, known_words=25)
    for a, b in zip(sorted(many.collect()), sorted(few.collect())):
        assert a[:5] == b[:5] and math.isclose(a.base_score, b.base_score) and math.isclose(a.score, b.score, rel_tol=1e-6)


def plain_softmax(model, before, targets):
    """log10 probabilities by a softmax over the scores of 4,096 tokens at a time."""
    out = []
    for at in range(0, len(targets), 4096):
        scores = (model.r[before[at : at + 4096]] * model.w).sum(axis=1) @ model.q.T + model.b
        scores -= scores.max(axis=1, keepdims=True)
        out.append((scores[np.arange(len(scores)), targets[at : at + 4096]] - np.log(np.exp(scores).sum(axis=1))) / math.log(10))
    return np.concatenate(out)


@pytest.mark.parametrize(("size", "classes"), [(1, 256), (8, 256), (200, 256), (1, 1100)])
def test_the_softmax_of_tables_is_that_of_the_scores(size, classes):
    rng = np.random.default_rng(3)
    model = LogBilinear.start(rng.dirichlet(np.ones(classes)))
    model = LogBilinear(model.r * size, model.q * size, model.w, model.b)
    before, targets = rng.integers(0, classes, (3000, 3)), rng.integers(0, classes, 3000)
    assert (model.tables() is None) == (size == 200 or classes > 1024)
    found = model.log10(before, targets)
    assert np.allclose(found, plain_softmax(model, before, targets), rtol=1e-5, atol=1e-5) and np.isfinite(found).all()
    assert np.array_equal(found, model.log10(before, targets, model.tables())) and len(model.log10(before[:0], targets[:0])) == 0


def test_the_softmax_costs_less_than_half_of_the_plain_one():
    rng = np.random.default_rng(4)
    model = LogBilinear.start(rng.dirichlet(np.ones(256)))
    before, targets = rng.integers(0, 256, (100_000, 3)), rng.integers(0, 256, 100_000)

    def seconds(run):
        start = time.process_time()
        run(before, targets)
        return time.process_time() - start

    fast = min(seconds(model.log10) for _ in range(3))
    assert fast < 0.5 * min(seconds(lambda *x: plain_softmax(model, *x)) for _ in range(3))


def test_probabilities_add_up_to_one(spark):
    docs = docs_frame(spark, [(k, t) for k, t in sample(spark).items() if k < 40])
    counts = count_words(docs)
    vocabulary = build_vocabulary(counts, 40, singles=10, shared=5)
    tokens = {bytes(r.token): r.n for r in counts.collect()}
    assert vocabulary.n_tokens == sum(tokens.values()) + 40 and vocabulary.n_words == len(tokens) + 1
    model = LogBilinear.start(np.ones(vocabulary.n_classes) / vocabulary.n_classes)
    before = np.zeros((vocabulary.n_classes, 3), np.int64)
    by_class = 10 ** model.log10(before, np.arange(vocabulary.n_classes))
    assert math.isclose(by_class.sum(), 1, rel_tol=1e-5)
    inside = Counter()
    for token, n in tokens.items():
        place = vocabulary.classes([token], vocabulary.places([token]))[0]
        if place >= vocabulary.n_single:
            inside[place] += (n + 1) / (vocabulary.class_tokens[place] + vocabulary.class_words[place] + 1)
    for place, p in inside.items():  # the rest is for all words never seen
        assert math.isclose(p + 1 / (vocabulary.class_tokens[place] + vocabulary.class_words[place] + 1), 1)


def test_scores_edges(spark):
    docs = docs_frame(spark, [(1, "a b a"), (2, None), (3, ""), (None, "a"), (1, "a b a")])
    rows = score_texts(docs, F.col("doc_id") != 3).collect()
    found = sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known) for r in rows)
    assert found == [(-1, True, 2, 2), (1, False, 4, 4), (1, False, 4, 4), (2, False, 1, 1), (3, True, 1, 1)]
    assert {r.train_tokens for r in rows} == {9}
    untrained = score_texts(docs, F.lit(False)).collect()
    assert all(r.n_known == r.train_tokens == 0 and r.base_score == 0 and math.isfinite(r.score) for r in untrained)
    assert score_texts(docs_frame(spark, []), F.lit(True)).count() == 0


def test_token_hash_is_that_of_spark(spark):
    tokens = ["the", "élève", "x" * 100, ""]
    found = spark.createDataFrame([(t,) for t in tokens], "t string").select(F.xxhash64(F.col("t").cast("binary")).alias("h"))
    assert [r.h for r in found.collect()] == [token_hash(t.encode()) for t in tokens]


def test_contexts():
    assert contexts(np.array([4, 5, 6, 0])).tolist() == [[0, 0, 0], [4, 0, 0], [5, 4, 0], [6, 5, 4]]


def test_texts_read_together_hold_what_they_hold_alone():
    """Groups of texts, with windows that would only exist across two of them, short and empty ones."""
    rng = random.Random(8)
    words_ = "alpha beta 12 Paris km gamma delta 7 x".split()
    make = lambda n: " ".join(rng.choice(words_) for _ in range(n))
    items = [(k, make(rng.randrange(1, 14))) for k in range(30)]
    texts = [make(rng.randrange(0, 20)) for _ in range(300)] + [None, "", "--", items[3][1], items[4][1].upper()]
    index = decontaminate_module.build_index(items, 5)
    alone = [decontaminate_module.find_items(index, decontaminate_module.Templates(), t, 5, 80) for t in texts]
    together = list(decontaminate_module.find_in_texts(index, decontaminate_module.Templates(), texts, 5, 80))
    assert together == alone and any(alone)
    assert [g for g in decontaminate_module.text_groups(["ab", None, "abc", "d"], most=3)] == [slice(0, 3), slice(3, 4)]

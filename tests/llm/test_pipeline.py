"""The corpus pipeline, stage by stage, against plain Python."""

import random

import brute
import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from sheetloom.llm.queries import QUERIES
from sheetloom.session import stage

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, rejected string, kept string"
SF_DIR = "/root/testdata/sf0.001"


def english(rng, n):
    return " ".join(rng.choice("the of and that with from this have were which there their".split()) + str(rng.randrange(500)) for _ in range(n))


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Documents with copies, repeated lines, benchmark items, junk and nulls, and a benchmark."""
    rng = random.Random(11)
    folder = str(tmp_path_factory.mktemp("corpus"))
    item = "How many days pass before the old mill of the village grinds all 40 sacks of wheat that the farmers brought there"
    long_line = "this licence line stands in several documents of the corpus"
    rows = [(k, english(rng, 60)) for k in range(40)]
    rows += [(k, rows[k - 40][1]) for k in range(40, 44)]
    rows += [(k, rows[k - 40][1] + " and one more") for k in range(44, 48)]
    rows += [(k, f"{english(rng, 50)}\n{long_line}\nshort") for k in range(50, 56)]
    rows += [(60, f"{english(rng, 20)} {item} {english(rng, 20)}"), (61, item.replace("40", "75")), (70, "12 34 --"), (71, None), (72, "")]
    docs = [(i, t, "en", "s", len(t or ""), "x", "y") for i, t in rows]
    spark.createDataFrame(docs, SHAPE).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, dict(rows), long_line


def test_stages(spark, small):
    folder, texts, long_line = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    results = {}
    for name, function in cp.STAGES:
        result = stage(function(spark, docs, folder), name)
        if name != "packing":
            assert result.columns == docs.columns
        results[name] = result
        docs = result
    ids = {name: {r.doc_id for r in result.select("doc_id").collect()} for name, result in results.items()}
    assert ids["language_id"] == set(texts) - {70, 71, 72}

    kept = {i: texts[i] for i in ids["language_id"]}
    lines = {i: t for i, (_, _, t) in brute.dedup_lines(kept).items()}
    assert {r.doc_id: r.text for r in results["line_dedup"].collect()} == {i: t for i, t in lines.items() if t.strip()}
    assert sum(long_line in t for t in lines.values()) == 1
    assert all(r.n_chars == len(r.text) for r in results["line_dedup"].collect())

    lines = {i: t for i, t in lines.items() if t.strip()}
    component, _ = brute.near_duplicate_components(lines, 5, 80)
    assert ids["near_dedup"] == {i for i in lines if component[i] == i} and len(ids["near_dedup"]) < len(lines)
    assert ids["benchmark_decontamination"] == ids["near_dedup"] - {60, 61}
    assert ids["packing"] == ids["benchmark_decontamination"]

    key = ["doc_id", "piece", "start_token", "n_tokens"]
    assert sorted(cp.run(spark, folder).select(key).collect()) == sorted(results["packing"].select(key).collect())


def test_empty_and_null_documents(spark, small):
    folder = small[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    empty = docs.where("false")
    for name, function in cp.STAGES:
        assert function(spark, empty, folder).count() == 0, name
    odd = docs.withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(None).cast("string")).limit(3)
    for name, function in cp.STAGES[1:]:
        assert function(spark, odd, folder).count() == 3, name


def test_repeated_rows_go_or_stay_together(spark, small):
    folder = small[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id in (0, 40, 1)")
    twice = cp.near_dedup(spark, docs.union(docs), folder)
    assert sorted(r.doc_id for r in twice.collect()) == [0, 0, 1, 1]


def test_stages_name_their_operators():
    assert [name for name, _ in cp.STAGES] == ["language_id", "line_dedup", "near_dedup", "benchmark_decontamination", "packing"]
    assert cp.ORACLE_SQL is None
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_pipeline_on_the_sample(spark):
    rows = cp.run(spark, SF_DIR).collect()
    known = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = {r.doc_id for r in rows}
    assert found < known and len(found) > 0.5 * len(known)

"""The corpus pipeline: language ID, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. A
stage's result is written as Parquet and read again as the next one's ``docs``. Rows with a null id are kept by every
filter that needs an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetloom.llm.decontaminate import decontaminate
from sheetloom.llm.language import fit_languages, identify
from sheetloom.llm.line_dedup import dedup_lines
from sheetloom.llm.minhash import near_duplicates
from sheetloom.llm.packing import pack
from sheetloom.session import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go: no letter, or far from the texts of every language."""
    return identify(docs, fit_languages(docs)).where("NOT rejected").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; n_chars follows. Documents of which nothing remains go."""
    kept = dedup_lines(docs).where("n_dropped = 0 OR trim(text) <> ''")
    length = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars")).alias("n_chars")
    return kept.select(*(length if c == "n_chars" else c for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5 words, 0.8) stays; of repeated rows of it, all do."""
    gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(stage(gone, "gone"), "doc_id", "left_anti").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents in token-budget batches."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: The stages' hashes, models and shards have no SQL form; tests/llm/test_pipeline.py holds the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

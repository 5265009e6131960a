"""Line dedup: levelled sorted runs of line hashes, merge-anti-joined batch by batch (built-in functions only).

The index is a list of *runs*. A run is a staged table sorted by line hash with one row per line: how many
documents hold it and the largest of their ids. A batch of documents becomes a run of level 0; when a level
has ``fanout`` runs they are merged into one of the next level, so a line is rewritten only a logarithmic
number of times. Then the lines of the documents are merge-joined against the runs: lines that a later document
repeats go, all others (the anti-join side) stay.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.llm.common import WHITE, lower_ascii, pick
from sheetloom.session import stage


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE))


def document_lines(docs: DataFrame, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line long enough to count: doc_id, text_hash, pos (from 0), line.

    ``line`` is the MD5 of the line without white space at its ends and with A-Z in lower case.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    keyed = F.transform(
        _lines(lower_ascii(F.col("text"))),
        lambda line, pos: F.when(
            F.char_length(_stripped(line)) >= min_chars,
            F.struct(pos.alias("pos"), F.md5(_stripped(line).cast("binary")).alias("line")),
        ),
    )
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.inline(F.filter(keyed, F.isnotnull)))
    return rows.select("doc_id", "text_hash", "pos", "line")


@dataclass
class LineRuns:
    """The index: ``levels[k]`` holds the runs of level k, each (line, n_docs, last_doc)."""

    fanout: int = 3
    levels: list[list[DataFrame]] = field(default_factory=list)

    def add(self, lines: DataFrame) -> None:
        """Add a batch (as from :func:`document_lines`); a document must not be split between batches."""
        once = lines.select("line", "doc_id").distinct()
        found = once.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
        self._put(0, stage(found.sortWithinPartitions("line"), "line-run"))

    def _put(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = stage(self._merge(self.levels[level]).sortWithinPartitions("line"), "line-run")
            self.levels[level] = []
            self._put(level + 1, merged)

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        every = reduce(DataFrame.union, runs)
        return every.groupBy("line").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def repeated(self, min_docs: int) -> DataFrame:
        """Lines of at least ``min_docs`` documents over all runs, staged and sorted."""
        every = self._merge([run for level in self.levels for run in level])
        return stage(every.where(F.col("n_docs") >= min_docs).sortWithinPartitions("line"), "line-run")


def dedup_lines(
    docs: DataFrame,
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with repeated lines removed from its text, and the columns n_lines and n_dropped.

    A line of ``min_chars`` or more whose key is in ``min_docs`` or more documents stays only in the largest id
    that holds it (there with all its repetitions). Rows with one id are one document; rows with a null
    id are one document before all others. A null text is one empty line and stays null. Other columns
    are kept; existing columns n_lines and n_dropped are replaced. A text that loses all lines becomes empty.
    """
    numbered = document_lines(docs, min_chars, id_col, text_col)
    numbered = numbered.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    lines = stage(numbered, "lines")
    runs = LineRuns()
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch))
    repeated = runs.repeated(min_docs).withColumnRenamed("line", "held")
    earlier = (F.col("line") == F.col("held")) & (
        F.col("doc_id").isNull() & F.col("last_doc").isNotNull() | (F.col("doc_id") < F.col("last_doc"))
    )
    dropped = lines.join(repeated, earlier, "left_semi")
    dropped = dropped.groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).agg(
        F.collect_set("pos").alias("__drop")
    )
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    same = ident.eqNullSafe(F.col("__doc")) & (F.xxhash64(text) == F.col("__hash"))
    joined = docs.drop("n_lines", "n_dropped").join(dropped, same, "left")
    split = _lines(text)
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__drop"))
    rebuilt = F.array_join(F.transform(kept, lambda pos: F.get(split, pos)), "\n")
    new_text = F.when(F.col("__drop").isNull(), text).otherwise(rebuilt)
    columns = [new_text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(
        *columns,
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )

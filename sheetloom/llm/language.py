"""Language identification by the nearest centroid of TF-IDF n-gram vectors.

A text's vector counts its byte n-grams of 1 to 3 (lower case, everything but letters as one blank) in hashed
dimensions, with logarithmic counts, weighted by inverse document frequency and scaled to length one. The
texts of each language are clustered by spherical k-means into several centroids; a text gets the language of
the centroid with the largest cosine. It is rejected if it lies farther from that centroid than any text
of the fit by a documented factor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheetloom.llm.common import pick, rows_of
from sheetloom.llm.vectors import spherical_kmeans
from sheetloom.operators.lookup import lookup_join
from sheetloom.session import stage, staged_size

DIM_BITS = 13
ORDERS = (1, 2, 3)
UNDETERMINED = "und"

_LETTER = np.full(256, 32, dtype=np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def gram_counts(text: str, piece: int = 1 << 20) -> np.ndarray:
    """Counts of the n-grams of a text by hashed dimension; long texts go in pieces."""
    letters = _LETTER[np.frombuffer(text.lower().encode(), dtype=np.uint8)]
    blank = letters == 32
    letters = letters[~(blank & np.concatenate([[False], blank[:-1]]))] if len(letters) else letters
    letters = np.concatenate([[32], letters, [32]]).astype(np.uint8)
    counts = np.zeros(1 << DIM_BITS, dtype=np.int64)
    for start in range(0, len(letters), piece):
        part = letters[start : start + piece + max(ORDERS) - 1].astype(np.uint32)
        code = np.zeros(len(part), dtype=np.uint32)
        for order in range(1, max(ORDERS) + 1):
            starts = min(piece, len(part) - order + 1)
            if starts <= 0:
                break
            code = code[:starts] * np.uint32(256) + part[order - 1 : order - 1 + starts]
            if order in ORDERS:
                hashed = (code + np.uint32(order * 0x51ED270B & 0xFFFFFFFF)) * np.uint32(2654435761)
                counts += np.bincount(hashed >> np.uint32(32 - DIM_BITS), minlength=len(counts))
    return counts


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows of rows of counts."""
    rows = np.log1p(counts.astype(np.float32)) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class LanguageModel:
    """Centroids as rows, with the language and the smallest accepted cosine of each."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    cutoffs: np.ndarray

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine from 0 to 1, rejected) for each text."""
        result = [(UNDETERMINED, 0.0, True)] * len(texts)
        usable = [k for k, text in enumerate(texts) if has_letter(text)] if self.languages else []
        if usable:
            rows = weigh(np.array([gram_counts(texts[k]) for k in usable]), self.idf)
            near = np.clip(rows @ self.centroids.T, 0.0, 1.0)
            for k, best, cosines in zip(usable, near.argmax(axis=1), near):
                result[k] = (self.languages[best], float(cosines[best]), bool(cosines[best] < self.cutoffs[best]))
        return result


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in rows_of(batches):
        dims, counts = [], []
        for text in part["text"]:
            found = gram_counts(text) if has_letter(text) else np.zeros(1, np.int64)
            dims.append(np.flatnonzero(found))
            counts.append(found[dims[-1]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(part["lang"], pa.string()), pa.array(dims, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))],
            ["lang", "dims", "counts"],
        )


def _centroids_of(idf: np.ndarray, per_language: int, slack: float):
    def run(table: pa.Table) -> pa.Table:
        counts = np.zeros((len(table), len(idf)), dtype=np.int32)
        order = sorted(range(len(table)), key=lambda k: table["dims"][k].as_py())  # the same whatever the row order
        for row, k in enumerate(order):
            counts[row, table["dims"][k].values.to_numpy()] = table["counts"][k].values.to_numpy()
        rows = weigh(counts, idf)
        centroids = spherical_kmeans(rows, min(per_language, len(rows)))
        near = rows @ centroids.T
        home = near.argmax(axis=1)
        cutoffs = [float(slack * near[home == c, c].min(initial=1.0)) for c in range(len(centroids))]
        language = [table["lang"][0].as_py()] * len(centroids)
        return pa.table({"lang": language, "centroid": pa.array(list(centroids.astype(np.float64)), pa.list_(pa.float64())), "cutoff": cutoffs})

    return run


def fit_languages(
    docs: DataFrame,
    sample_per_language: int = 1000,
    per_language: int = 4,
    slack: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel:
    """Fit on about ``sample_per_language`` texts of every language, chosen by a hash of the id and taken whole.

    Rows without a language or without a letter are left out; if none remain the model rejects everything. ``slack``
    is the part of the smallest cosine of the fit that is still accepted.
    """
    plain = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = plain.groupBy("lang").count()  # one row per language
    share = F.least(F.lit(1.0), sample_per_language / F.col("count"))
    shares = stage(sizes.select("lang", share.alias("share")), "languages", measured=True)
    chosen = lookup_join(plain, shares, ["lang"], spread_by="doc_id")
    chosen = chosen.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) < F.col("share") * 1_000_003)
    sample = chosen.select("lang", "text").mapInArrow(_sample_counts, "lang string, dims array<long>, counts array<long>")
    sample = stage(sample.where(F.size("dims") > 0), "language-sample")
    n = staged_size(sample).rows
    idf = np.zeros(1 << DIM_BITS, dtype=np.float32)
    for r in sample.select(F.explode("dims").alias("dim")).groupBy("dim").count().collect():  # one row per dimension
        idf[r.dim] = np.log((n + 1) / (r["count"] + 1)) + 1
    fitted = sample.groupBy("lang").applyInArrow(
        _centroids_of(idf, per_language, slack), "lang string, centroid array<double>, cutoff double"
    )
    rows = sorted(map(tuple, fitted.collect()))  # per_language rows for each language
    centroids = np.array([r[1] for r in rows], dtype=np.float32).reshape(len(rows), len(idf))
    return LanguageModel(idf, centroids, [r[0] for r in rows], np.array([r[2] for r in rows]))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns lang_pred, score (cosine, 0 to 1) and rejected; existing ones are replaced.

    Only the text is read. A null text or one without a letter is ``und`` with score 0 and rejected. Equal cosines go
    to the first language by name. Rows stay in place, so repeated rows and other columns are kept as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                found = shared.value.predict(part.column(0).to_pylist())
                names, scores, rejected = zip(*found)
                added = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *added], [*part.schema.names[1:], *_ADDED])

    others = [c for c in docs.columns if c not in _ADDED]
    shape = docs.select(*(F.col(f"`{c}`") for c in others)).schema
    shape = shape.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.select(F.col(f"`{text_col}`"), *(F.col(f"`{c}`") for c in others)).mapInArrow(run, shape)


_ADDED = ("lang_pred", "score", "rejected")

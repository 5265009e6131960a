"""Ranked lexical search, reversed: the items' terms are the index, the documents stream through it.

The usual search looks queries up in an index of all documents. Here the few queries (items) are indexed and the
many documents are the stream: a document's term counts are looked up in the inverted index of the items, the
scores of all items it touches are added up, and each item keeps a bounded heap of its best documents. A task
hands on one heap per item; heaps are merged in two steps, so no task sees more than the heaps of a few.

The index is broadcast in blocks of bounded size. For each block the documents' counts of its terms are staged
once: they give the document frequencies, and then the scores.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W

from sheetloom.llm.common import pick, rows_of, term_chunks, term_table
from sheetloom.session import stage, staged_size

_TERMS = term_table(digits=True)


def term_counts(text: str | None) -> tuple[int, Counter]:
    """Number of terms, and the occurrences of each."""
    n, counts = 0, Counter()
    for terms in term_chunks(text, _TERMS):
        n += len(terms)
        counts.update(terms)
    return n, counts


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, text) -> one row per item and distinct term."""
    for part in rows_of(batches):
        items, terms = [], []
        for item, text in zip(part["item"], part["text"]):
            found = {t for chunk in term_chunks(text, _TERMS) for t in chunk}
            items += [item] * len(found)
            terms += sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(terms, pa.binary())], ["item", "term"])


@dataclass
class ItemIndex:
    """Inverted index of one block: term number t is in ``postings[starts[t]:starts[t + 1]]`` (item numbers)."""

    items: list[int]
    terms: dict[bytes, int]
    starts: np.ndarray
    postings: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]]) -> "ItemIndex":
        items = sorted({item for item, _ in rows})
        place = {item: k for k, item in enumerate(items)}
        ordered = sorted((term, place[item]) for item, term in rows)
        names = list(dict.fromkeys(term for term, _ in ordered))
        sizes = Counter(term for term, _ in ordered)
        starts = np.concatenate([[0], np.cumsum([sizes[t] for t in names], dtype=np.int64)])
        return cls(items, {t: k for k, t in enumerate(names)}, starts, np.array([k for _, k in ordered], np.int64))


def _document_counts(shared):
    """(doc_id, text) -> doc_id, n (all terms), terms (numbers in the index) and tf; documents without a term go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.terms
        for part in rows_of(batches):
            ids, sizes, terms, tfs = [], [], [], []
            for doc_id, text in zip(part["doc_id"], part["text"]):
                n, counts = term_counts(text)
                if n:
                    found = counts.keys() & known.keys()
                    ids.append(doc_id)
                    sizes.append(n)
                    terms.append([known[t] for t in found])
                    tfs.append([counts[t] for t in found])
            arrays = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "tf"])

    return run


@dataclass
class Collection:
    """What scoring knows of all documents: how many, how long, and the weight of each term of the index."""

    n_docs: int
    n_terms: int
    weights: np.ndarray

    @staticmethod
    def weight(n_docs: int, df: int) -> int:
        return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def block_scores(index: ItemIndex, of: Collection, sizes: np.ndarray, docs: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """Scores of documents (rows) and items (columns) from the entries (document number, term, tf)."""
    lengths = np.array([10 + 90 * int(n) * of.n_docs // of.n_terms for n in sizes], np.int64)
    each = of.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * lengths[docs]))
    fan = index.starts[terms + 1] - index.starts[terms]
    ends = np.cumsum(fan)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - fan, fan) + np.repeat(index.starts[terms], fan)
    cells = np.repeat(docs, fan) * len(index.items) + index.postings[at]
    shape, room = (len(sizes), len(index.items)), len(sizes) * len(index.items)
    if int(of.weights.max(initial=0)) * 1_000_000 * len(index.terms) < 1 << 53:  # sums of doubles are exact
        return np.bincount(cells, weights=np.repeat(each, fan).astype(np.float64), minlength=room).astype(np.int64).reshape(shape)
    scores = np.zeros(room, np.int64)
    np.add.at(scores, cells, np.repeat(each, fan))
    return scores.reshape(shape)


class Heaps:
    """The best ``k`` (score, document) of every item; of equal scores the smallest ids, a null id after all others."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k, self.heaps = k, [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)  # what a document needs to be looked at

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        enough = self.least
        if len(scores) > self.k:
            enough = np.maximum(enough, np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k])
        for doc, item in zip(*(a.tolist() for a in np.nonzero(scores >= enough))):
            entry = (int(scores[doc, item]), -math.inf if ids[doc] is None else -ids[doc])
            heap = self.heaps[item]
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.least[item] = heap[0][0]


def _best(shared, of: Collection, k: int, cells: int = 1 << 21):
    """Staged counts -> one heap per item and task: item, doc_id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        heaps = Heaps(len(index.items), k)
        step = max(1, cells // max(1, len(index.items)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                lists = part.column("terms")
                per_doc = np.diff(lists.offsets.to_numpy())
                docs = np.repeat(np.arange(part.num_rows), per_doc)
                terms, tf = (part.column(c).flatten().to_numpy() for c in ("terms", "tf"))
                sizes = part.column("n").to_numpy()
                # slices of documents whose lookups stay bounded
                fan = np.bincount(docs, weights=(index.starts[terms + 1] - index.starts[terms]), minlength=part.num_rows)
                cut = np.searchsorted(np.cumsum(fan), np.arange(cells, fan.sum() + cells, cells))
                bounds = np.unique(np.concatenate([[0], np.minimum(cut + 1, part.num_rows), [part.num_rows]]))
                ids = part.column("doc_id").to_pylist()
                for low, high in zip(bounds[:-1], bounds[1:]):
                    a, b = np.searchsorted(docs, [low, high])
                    scores = block_scores(index, of, sizes[low:high], docs[a:b] - low, terms[a:b], tf[a:b])
                    heaps.add(scores, ids[low:high])
        found = [(index.items[i], None if neg == -math.inf else -neg, score) for i, heap in enumerate(heaps.heaps) for score, neg in heap]
        columns = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    return run


def _merge_heaps(heaps: DataFrame, k: int, salts: int = 64) -> DataFrame:
    """The best ``k`` of every item, by rank: first among the tasks of one salt, then among the salts."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    near = heaps.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    first = near.withColumn("rank", F.row_number().over(W.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("salt")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    block_postings: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank (from 1), doc_id, score.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. The score is BM25-like
    in whole numbers: per term of the item, once each, ``weight * (10^9 tf div (1000 tf + 8 m))`` with m = 10 + 90 n N div L.
    Every row of ``docs`` is a document (a repeated row is a document of its own); ids must be whole numbers.
    A document without a term (a null or empty text) counts nowhere. Equal scores are ranked by id, a null id last.
    Items without a term, or whose terms no document holds, have no rows. Rows of ``items`` with one id and one text are one
    item; with other texts they are items of their own under the same id. Other columns are ignored.

    An index block holds about ``block_postings`` (item, term) pairs; only one block is broadcast at a time, and more
    items only mean more passes over the documents.
    """
    plain = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    asked = pick(items, item_id=item_col, text=item_text_col).where("text IS NOT NULL").distinct()
    asked = stage(asked.withColumn("item", F.xxhash64("item_id", "text")), "items")
    postings = stage(asked.select("item", "text").mapInArrow(_item_terms, "item long, term binary"), "postings")
    blocks = max(1, -(-staged_size(postings).rows // block_postings))
    spark, ranked = docs.sparkSession, []
    for block in range(blocks):
        mine = postings.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        index = ItemIndex.of([(r.item, bytes(r.term)) for r in mine.collect()])  # bounded by block_postings
        shared = spark.sparkContext.broadcast(index)
        counted = plain.mapInArrow(_document_counts(shared), "doc_id long, n long, terms array<int>, tf array<long>")
        counts = stage(counted, "term-counts")
        size = counts.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        holders = counts.select(F.explode("terms").alias("term")).groupBy("term").count()
        df = {r.term: r["count"] for r in holders.collect()}  # one row per term of the block
        weights = np.array([Collection.weight(size.docs, df.get(t, 0)) for t in range(len(index.terms))], np.int64)
        of = Collection(size.docs, size.terms or 1, weights)
        heaps = counts.mapInArrow(_best(shared, of, k), "item long, doc_id long, score long")
        ranked.append(stage(_merge_heaps(heaps, k), "ranked"))
        shared.destroy()
    every = ranked[0]
    for more in ranked[1:]:
        every = every.unionByName(more)
    return every.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

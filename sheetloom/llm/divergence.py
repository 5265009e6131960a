"""Source divergence audit: how the sources of a language differ in their words.

Words are counted by sorting pointers. A shard is a few megabytes of the Arrow text buffer of a task; its pointers are
the starts of all words, and multikey quicksort orders them by the words they point to, eight bytes at a time,
without making a string of any of them. Runs of equal words then give, per language and source, the occurrences and
the documents of a word. Shards are added up by Spark.

The audit compares the smoothed shares of the kept words: every source with every other of its language (in tiles of
sources and blocks of words, so that no task holds more than one tile and one block), and with the language as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from sheetloom.llm.common import pick, term_table
from sheetloom.session import stage

SHARD_BYTES = 1 << 23
_LOWER = np.frombuffer(term_table(digits=False), np.uint8)
_BLANK = 32
_KEEP = np.array([0] + [(1 << 64) - (1 << (64 - 8 * k)) for k in range(1, 9)], np.uint64)


class WordPointers:
    """The words of a buffer of lower-case letters and blanks, as pointers.

    ``doc_starts`` are the places where documents begin; a word never crosses one.
    """

    def __init__(self, letters: np.ndarray, doc_starts: np.ndarray) -> None:
        inside = letters != _BLANK
        edge = np.zeros(len(letters) + 1, bool)
        edge[doc_starts] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:-1]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(start)
        self.lengths = np.flatnonzero(stop) + 1 - self.starts
        padded = np.concatenate([letters, np.zeros(8, np.uint8)])
        self._eights = np.ndarray(len(letters) + 1, dtype=">u8", buffer=padded, strides=(1,))

    def keys(self, words: np.ndarray, depth: int) -> np.ndarray:
        """Bytes ``depth`` to ``depth + 8`` of words as numbers that compare as the bytes do; 0 beyond the end."""
        left = np.clip(self.lengths[words] - depth, 0, 8)
        at = np.minimum(self.starts[words] + depth, len(self._eights) - 1)
        return self._eights[at].astype(np.uint64) & _KEEP[left]

    def sort(self, cutoff: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
        """The words in byte order, equal ones in buffer order, and where runs of equal words begin.

        Multikey quicksort: a slice is split by a pivot into smaller, equal and larger keys; the equal part goes on eight
        bytes further, if any of its words is that long. Slices of up to ``cutoff`` words are finished by columns.
        """
        order = np.arange(len(self.starts))
        first = np.zeros(len(order), bool)
        slices = [(0, len(order), 0)] if len(order) else []
        while slices:
            low, high, depth = slices.pop()
            part = order[low:high]
            if len(part) <= cutoff:
                self._finish(order, first, low, high, depth)
                continue
            keys = self.keys(part, depth)
            pivot = np.sort(keys[:: len(keys) // 63])[31]
            less, same = keys < pivot, keys == pivot
            more = ~(less | same)
            a = low + int(less.sum())
            b = a + int(same.sum())
            order[low:high] = np.concatenate([part[less], part[same], part[more]])
            slices += [s for s in ((low, a, depth), (b, high, depth)) if s[0] < s[1]]
            if (self.lengths[order[a:b]] > depth + 8).any():
                slices.append((a, b, depth + 8))
            else:
                first[a] = True
        return order, first

    def _finish(self, order: np.ndarray, first: np.ndarray, low: int, high: int, depth: int) -> None:
        """All runs of a slice together, eight bytes at a time, until no run can split."""
        at, run = np.arange(low, high), np.zeros(high - low, np.int64)
        while len(at):
            keys = self.keys(order[at], depth)
            sorted_ = np.lexsort((keys, run))
            order[at], keys = order[at][sorted_], keys[sorted_]
            begins = np.concatenate([[True], (keys[1:] != keys[:-1]) | (run[1:] != run[:-1])])
            first[at[begins]] = True
            run = np.cumsum(begins) - 1
            depth += 8
            longer = np.bincount(run, weights=self.lengths[order[at]] > depth) > 0
            open_ = (longer & (np.bincount(run) > 1))[run]
            at, run = at[open_], run[open_]

    def words(self, picked: np.ndarray, letters: np.ndarray) -> pa.Array:
        """The words themselves, as an Arrow array."""
        lengths = self.lengths[picked]
        ends = np.cumsum(lengths)
        data = letters[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[picked] - ends + lengths, lengths)]
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(picked), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


def count_shard(letters: np.ndarray, doc_starts: np.ndarray, groups: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Words, their group, occurrences and documents, for documents that begin at ``doc_starts`` and are of ``groups``."""
    pointers = WordPointers(letters, doc_starts)
    order, first = pointers.sort()
    doc = np.searchsorted(doc_starts, pointers.starts, "right") - 1  # of empty documents at one place, the last
    doc = doc[order]
    run = np.cumsum(first) - 1
    entry = run * (int(groups.max(initial=0)) + 1) + groups[doc]
    new_doc = first | np.concatenate([[True], doc[1:] != doc[:-1]])[: len(doc)]
    by_entry = np.argsort(entry, kind="stable")
    entry = entry[by_entry]
    begins = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]])[: len(entry)])
    n = np.diff(np.concatenate([begins, [len(entry)]]))
    n_docs = np.add.reduceat(new_doc[by_entry].astype(np.int64), begins) if len(begins) else n
    runs = run[by_entry][begins]
    words = pointers.words(order[np.flatnonzero(first)], letters)
    return words.take(pa.array(runs)), groups[doc[by_entry][begins]], n, n_docs


_COUNTS = "lang string, source string, term string, n long, n_docs long"


def _batch(lang: pa.Array, source: pa.Array, term: pa.Array, n, n_docs) -> pa.RecordBatch:
    arrays = [lang, source, term, pa.array(n, pa.int64()), pa.array(n_docs, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "n_docs"])


def _count_long(letters: np.ndarray, size: int) -> tuple[pa.Array, pa.Array]:
    """Words and occurrences of one document of any length, in pieces that end between words."""
    start, tables = 0, []
    while start < len(letters):
        stop = min(start + size, len(letters))
        if stop < len(letters):
            blank = np.flatnonzero(letters[stop : stop + size] == _BLANK)
            while not len(blank) and stop < len(letters):  # a word longer than a piece
                stop = min(stop + size, len(letters))
                blank = np.flatnonzero(letters[stop : stop + size] == _BLANK)
            stop += int(blank[0]) if len(blank) else 0
        words, _, n, _ = count_shard(letters[start:stop], np.array([0]), np.array([0]))
        tables.append(pa.table({"term": words, "n": n}))
        start = stop
    merged = pa.concat_tables(tables).group_by("term").aggregate([("n", "sum")])
    return merged["term"].combine_chunks(), merged["n_sum"].combine_chunks()


def _count_words(shard_bytes: int):
    """(lang, source, text) -> one row per shard, language, source and word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text = batch.column(2).cast(pa.large_string())
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            bytes_ = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            pairs = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["lang", "source"]).to_pylist()
            known = {}
            groups = np.array([known.setdefault((p["lang"], p["source"]), len(known)) for p in pairs])
            langs, sources = (pa.array([k[i] for k in known], pa.string()) for i in (0, 1))
            start = 0
            while start < len(groups):
                stop = int(np.searchsorted(offsets, offsets[start] + shard_bytes, "right")) - 1
                stop = min(max(stop, start + 1), len(groups))
                letters = _LOWER[bytes_[offsets[start] : offsets[stop]]]
                if len(letters) > shard_bytes:
                    words, n = _count_long(letters, shard_bytes)
                    one = pa.array(np.full(len(words), groups[start]))
                    yield _batch(langs.take(one), sources.take(one), words, n, np.ones(len(words), np.int64))
                else:
                    words, of, n, n_docs = count_shard(letters, offsets[start:stop] - offsets[start], groups[start:stop])
                    of = pa.array(of)
                    yield _batch(langs.take(of), sources.take(of), words, n, n_docs)
                start = stop

    return run


def _share(n: Column, total: Column, kept: Column, scale: int, smoothing: int) -> Column:
    """1 + floor(scale * (n + smoothing) / (total + smoothing * kept)), in whole numbers of up to 38 digits."""
    top = (n + smoothing).cast("decimal(19,0)") * F.lit(scale).cast("decimal(10,0)")
    bottom = (total + smoothing * kept).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", top, bottom)


_PAIRS = "lang string, source string, item string, value long"


def _distances(key: tuple, words: pa.Table, sources: pa.Table) -> pa.Table:
    """Partial distances between the sources of two tiles over one block of words.

    ``words``: source, term, p of the words a source has; ``sources``: source, tile, p0 (of a word it lacks) and
    ``block_terms``, the number of kept words of the block, of which those that no source here has all give ``|p0 - q0|``.
    """
    lang, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
    names = sources["source"].to_pylist()
    tile, p0 = (sources[c].to_numpy() for c in ("tile", "p0"))
    place = {name: k for k, name in enumerate(names)}
    coded = words["term"].combine_chunks().dictionary_encode() if len(words) else None
    width = len(coded.dictionary) if coded is not None else 0
    shares = np.repeat(p0[:, None], width, axis=1)
    if width:
        shares[[place[s] for s in words["source"].to_pylist()], coded.indices.to_numpy()] = words["p"].to_numpy()
    absent = sources["block_terms"][0].as_py() - width if names else 0
    left, right = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
    out = {"lang": [], "source": [], "item": [], "value": []}
    for i in left:
        values = np.abs(shares[right] - shares[i]).sum(axis=1) + np.abs(p0[right] - p0[i]) * absent
        for j, value in zip(right.tolist(), values.tolist()):
            both = ((i, j),) if low == high else ((i, j), (j, i))
            for a, b in both:
                if a != b:
                    out["source"].append(names[a])
                    out["item"].append(names[b])
                    out["value"].append(value)
    out["lang"] = [lang] * len(out["source"])
    return pa.table(out, schema=pa.schema({"lang": pa.string(), "source": pa.string(), "item": pa.string(), "value": pa.int64()}))


def word_counts(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` (lang, source, text; none null) -> lang, source, term, n (occurrences), n_docs."""
    shards = docs.select("lang", "source", "text").mapInArrow(_count_words(shard_bytes), _COUNTS)
    return shards.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def audit_sources(
    docs: DataFrame,
    min_docs: int = 30,
    top: int = 50,
    smoothing: int = 5,
    scale: int = 1_000_000_000,
    block_terms: int = 512,
    tile_sources: int = 256,
    shard_bytes: int = SHARD_BYTES,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """How far the sources of each language lie apart: lang, source, part, item, value, rank.

    Words are runs of letters and of all characters beyond ASCII, A-Z in lower case. A language keeps the words of
    ``min_docs`` or more of its documents. Every source of a language, and the language as a whole, gives each kept word the
    share ``p = 1 + floor(scale * (n + smoothing) / (all + smoothing * kept))``.

    * part ``pair``: ``item`` is each other source of the language, ``value`` the sum of ``|p - q|`` over all kept words
      (0 if there are none);
    * part ``term``: ``item`` is each kept word that the source has and gives more than the language does, ``value`` the
      difference; only the ``top`` ones.

    Ranks count from 1 for each source and part, the largest value first, equal values by ``item`` in UTF-8 order. Null
    text, language and source are read as empty; every row is a document, so repeated rows count again. A source without
    words is compared all the same; a language with one source has no pairs. Other columns are ignored; an empty table
    gives none.
    """
    rows = pick(docs, lang=lang_col, source=source_col, text=text_col).fillna("", ["lang", "source", "text"])
    counts = stage(word_counts(rows, shard_bytes), "word-counts")
    by_word = counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("lang_n"))
    block = F.xxhash64("term")
    kept = stage(by_word.where(F.col("n_docs") >= min_docs).select("lang", "term", "lang_n", block.alias("hash")), "kept-words")
    found = stage(counts.drop("n_docs").join(kept, ["lang", "term"]), "kept-counts")

    # sizes: one row per language, one per source
    langs = rows.select("lang").distinct()
    per_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    per_lang = stage(langs.join(per_lang, "lang", "left").select("lang", zero("kept"), zero("lang_total")), "languages")
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
    sources = stage(sources.join(per_lang, "lang").select("lang", "source", zero("total"), "kept", "lang_total"), "sources")

    def share(n: Column, total: str = "total") -> Column:
        return _share(n, F.col(total), F.col("kept"), scale, smoothing)

    placed = stage(found.join(sources, ["lang", "source"]).withColumn("p", share(F.col("n"))), "shares")

    # part pair: tiles of sources, blocks of words
    grid = sources.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / tile_sources).alias("tiles"), F.greatest(F.lit(1), F.ceil(F.max("kept") / block_terms)).alias("blocks")
    )
    grid = stage(grid, "grid")
    tile = F.pmod(F.xxhash64("source"), F.col("tiles"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    tiles = [F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")]
    sized = kept.join(grid, "lang").groupBy("lang", F.pmod("hash", "blocks").alias("block")).agg(F.count(F.lit(1)).alias("block_terms"))
    each_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    p0 = F.when(F.col("kept") > 0, share(F.lit(0))).otherwise(0)
    cells = sources.join(grid, "lang").select("lang", "source", tile.alias("tile"), "tiles", p0.alias("p0"), each_block.alias("block"))
    cells = cells.withColumn("other", other).join(sized, ["lang", "block"], "left")
    cells = cells.select("lang", "block", *tiles, "source", "tile", "p0", zero("block_terms"))
    shares = placed.join(grid, "lang").select("lang", F.pmod("hash", "blocks").alias("block"), tile.alias("tile"), "tiles", "source", "term", "p")
    shares = shares.withColumn("other", other).select("lang", "block", *tiles, "source", "term", "p")
    keys = ["lang", "block", "low", "high"]
    partial = shares.groupBy(*keys).cogroup(cells.groupBy(*keys)).applyInArrow(_distances, _PAIRS)
    pairs = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    # part term
    over = F.col("p") - share(F.col("lang_n"), "lang_total")
    terms = placed.select("lang", "source", F.col("term").alias("item"), over.alias("value")).where("value > 0")

    ranking = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    parts = [
        part.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.row_number().over(ranking).alias("rank"))
        for name, part in (("pair", pairs), ("term", terms))
    ]
    return parts[0].unionByName(parts[1].where(F.col("rank") <= top))

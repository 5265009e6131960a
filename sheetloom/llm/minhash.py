"""MinHash near-dedup with tensored banding.

A document's set are the hashes of its word shingles. Two small collections of ``bands`` bands with ``rows``
minhashes each are computed; the key of table (i, j) combines band i of the first with band j of the second. So
``bands**2`` tables of ``2 * rows`` minhashes cost ``2 * bands * rows`` minhashes instead of ``2 * bands**2 * rows``.
A pair of similarity s meets with probability ``(1 - (1 - s**rows)**bands)**2``: with 8 bands of 3, 0.999 at 0.85.

Copies (equal word sequences) are one class with the smallest id as its node. Not all pairs of a bucket are made.
First every member is compared with one hub, the member that meets others most often; that connects most of a
group of near copies. What is then still unconnected within a bucket is compared in blocks of bounded size: documents
that share a band of the first collection meet in one task per pair of parts, where a product of their membership
matrices gives all intersections at once, and the task returns one row per document, never pairs. So no candidate is left
out. Links count only after comparing the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheetloom.llm.common import WordHashes, components, mix, pick, rows_of, window_hashes, words
from sheetloom.session import stage


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; a text of fewer words is one shingle, none are none."""
    return np.unique(window_hashes(hashes(words(text)), width))


def sketch_schema() -> str:
    return "doc_id long, class binary, n_shingles long, left array<long>, right array<long>"


def sketches(width: int, bands: int, rows: int):
    """A function for ``mapInArrow``: (doc_id, text) -> :func:`sketch_schema`."""

    def band_keys(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        least = np.full(len(seeds), np.iinfo(np.uint64).max)
        factors = (seeds | np.uint64(1))[:, None]
        for start in range(0, len(shingles), 4096):  # long texts in pieces of bounded size
            ranks = shingles[None, start : start + 4096] * factors + mix(seeds)[:, None]
            least = np.minimum(least, ranks.min(axis=1))
        bits = mix(least).reshape(2 * bands, rows)
        for k in range(1, rows):
            bits[:, 0] = mix(bits[:, 0] * np.uint64(0x9E3779B97F4A7C15) + bits[:, k])
        return bits[:, 0].view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        seeds = mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for part in rows_of(batches):
            out = {"doc_id": part["doc_id"], "class": [], "n_shingles": [], "left": [], "right": []}
            for text in part["text"]:
                tokens = words(text)
                shingles = np.unique(window_hashes(hashes(tokens), width))
                keys = band_keys(shingles, seeds) if tokens else None
                out["class"].append(hashlib.blake2b(b" ".join(tokens), digest_size=16).digest() if tokens else None)
                out["n_shingles"].append(len(shingles))
                out["left"].append(keys[:bands] if tokens else None)
                out["right"].append(keys[bands:] if tokens else None)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema({
                "doc_id": pa.int64(), "class": pa.binary(), "n_shingles": pa.int64(),
                "left": pa.list_(pa.int64()), "right": pa.list_(pa.int64()),
            }))

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part in rows_of(batches):
            sets = [shingle_set(text, width, hashes).view(np.int64) for text in part["text"]]
            arrays = [pa.array(part["node"], pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "shingles"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b), those with 100 * intersection >= percent * union."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", shared.alias("shared"), (F.size("of_a") + F.size("of_b")).alias("sizes"))
    return both.where(F.col("shared") * 100 >= (F.col("sizes") - F.col("shared")) * percent).select("a", "b")


def _overlaps(rows: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, through 0/1 matrices over slices of the elements they share."""
    one, other = np.concatenate(rows), np.concatenate(others)
    shared = np.intersect1d(one, other)
    of_one = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    of_other = np.repeat(np.arange(len(others)), [len(r) for r in others])
    result = np.zeros((len(rows), len(others)), np.float32)  # exact up to 2 ** 24

    def matrix(owner: np.ndarray, place: np.ndarray, count: int, low: int, width: int) -> np.ndarray:
        inside = (place >= low) & (place < low + width)
        out = np.zeros((count, width), np.float32)
        out[owner[inside], place[inside] - low] = 1
        return out

    kept_one, kept_other = np.isin(one, shared), np.isin(other, shared)
    place_one, place_other = np.searchsorted(shared, one[kept_one]), np.searchsorted(shared, other[kept_other])
    for low in range(0, len(shared), 4096):
        width = min(4096, len(shared) - low)
        left = matrix(of_one[kept_one], place_one, len(rows), low, width)
        result += left @ matrix(of_other[kept_other], place_other, len(others), low, width).T
    return result


def _compare_blocks(percent: int):
    """Links between unconnected documents of two parts (or inside one) that share band ``i`` of the first collection
    as their first one and any band of the second: (node, hub), the smallest linked node by local components."""

    def run(table: pa.Table) -> pa.Table:
        node, component, part, n = (table[c].to_numpy() for c in ("node", "component", "part", "n"))
        left, right = (np.array(table[c].to_pylist()) for c in ("left", "right"))
        i, lo, hi = (table[c][0].as_py() for c in ("i", "lo", "hi"))
        one, other = np.flatnonzero(part == lo), np.flatnonzero(part == hi)
        wanted = component[one][:, None] != component[other][None]
        wanted &= np.minimum(n[one][:, None], n[other][None]) * 100 >= np.maximum(n[one][:, None], n[other][None]) * percent
        for earlier in range(i):
            wanted &= left[one, earlier][:, None] != left[other, earlier][None]
        meet = np.zeros_like(wanted)
        for j in range(right.shape[1]):
            meet |= right[one, j][:, None] == right[other, j][None]
        wanted &= meet
        one, other, wanted = one[wanted.any(axis=1)], other[wanted.any(axis=0)], wanted[wanted.any(axis=1)][:, wanted.any(axis=0)]
        if not len(one):
            return pa.table({"a": node[:0], "b": node[:0]})
        sets = table["shingles"]
        common = _overlaps([sets[int(k)].values.to_numpy() for k in one], [sets[int(k)].values.to_numpy() for k in other])
        linked = wanted & (common * 100 >= (n[one][:, None] + n[other][None] - common) * percent)
        a, b = np.nonzero(linked)
        a, b = one[a], other[b]
        hub, before = node.copy(), None
        while before is None or (hub != before).any():
            before = hub.copy()
            np.minimum.at(hub, a, hub[b])
            np.minimum.at(hub, b, hub[a])
        return pa.table({"a": node[hub != node], "b": hub[hub != node]})

    return run


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    bands: int = 8,
    rows: int = 3,
    part_rows: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable by links), kept.

    Documents link when 100 * shared shingles >= ``percent`` * all shingles of both. Rows with one id are one
    document. A null or empty text, or one of white space only, links with nothing. A row with a null id links
    with nothing, has a null component and is kept. An empty table gives an empty result.
    """
    plain = pick(docs, doc_id=id_col, text=text_col)
    sketched = stage(plain.mapInArrow(sketches(width, bands, rows), sketch_schema()), "sketches")
    known = sketched.where("doc_id IS NOT NULL AND class IS NOT NULL")
    nodes = known.groupBy("class").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("left").alias("left"), F.first("right").alias("right")
    )
    nodes = stage(nodes, "nodes")
    members = _members(nodes)
    candidates = stage(members.select("node").distinct(), "candidates")
    texts = plain.join(candidates, F.col("doc_id") == F.col("node"), "left_semi").withColumnRenamed("doc_id", "node")
    sets = texts.mapInArrow(_sets(width), "node long, shingles array<long>")
    sets = stage(sets.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_set("shingles"))).alias("shingles")), "sets")

    central = members.join(members.groupBy("node").agg(F.sum("size").alias("weight")), "node")
    hubs = stage(central.groupBy("bucket").agg(F.max_by("node", F.struct("weight", "node")).alias("hub")), "hubs")
    members = stage(members.join(hubs, "bucket").select("bucket", "node", "hub"), "members")
    sizes = nodes.select("node", "n")
    met = members.where("node <> hub").select("node", "hub").distinct().join(sizes, "node")
    met = met.join(sizes.select(F.col("node").alias("hub"), F.col("n").alias("hub_n")), "hub")
    similar = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent
    pairs = met.where(similar).select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    links = stage(_verified(pairs, sets, percent), "links")
    labels = components(links)

    blocks = _blocks(nodes, _unconnected(members, labels), part_rows).join(sets, "node")
    compared = blocks.groupBy("i", "key", "lo", "hi").applyInArrow(_compare_blocks(percent), "a long, b long")
    labels = components(links.union(stage(compared, "links")))

    named = nodes.join(labels, "node", "left").select("class", F.coalesce("component", "node").alias("component_id"))
    result = sketched.join(stage(named, "classes"), "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def _members(nodes: DataFrame) -> DataFrame:
    """(bucket, node, size) of all tables, without buckets of one member."""
    keys = F.flatten(F.transform("left", lambda x, i: F.transform(F.col("right"), lambda y, j: F.xxhash64(x, y, i, j))))
    entries = nodes.select("node", F.explode(keys).alias("bucket"))
    shared = stage(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    return stage(entries.join(shared, "bucket").select("bucket", "node", "size"), "members")


def _unconnected(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, component) of the members, but for the hub, of buckets that still hold several components."""
    labelled = members.where("node <> hub").join(labels, "node", "left")
    labelled = stage(labelled.select("bucket", "node", F.coalesce("component", "node").alias("component")), "labelled")
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = stage(mixed.where("low <> high").select("bucket"), "mixed")
    return stage(labelled.join(mixed, "bucket", "left_semi").select("node", "component").distinct(), "unconnected")


def _blocks(nodes: DataFrame, unconnected: DataFrame, part_rows: int) -> DataFrame:
    """The unconnected documents by band of the first collection and pair of parts: (i, key, lo, hi) and their sketches."""
    banded = nodes.join(unconnected, "node").select("node", "n", "component", "left", "right", F.posexplode("left").alias("i", "key"))
    sizes = banded.groupBy("i", "key").agg(
        F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("parts"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    sizes = stage(sizes.where("low <> high").select("i", "key", "parts"), "bands")
    parted = banded.join(sizes, ["i", "key"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    parted = parted.withColumn("other", other).withColumns({"lo": F.least("part", "other"), "hi": F.greatest("part", "other")})
    return parted.drop("other", "parts")

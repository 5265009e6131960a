"""Embedding near-dedup: spherical k-means cells, blocked cosine products inside them, one row kept per group.

Equal vectors are one class. Centroids are fitted in numpy on a bounded sample; every class is then indexed in the
cell of its nearest centroid (*native*) and also sent as a *visitor* to later cells whose boundary is near.
Two unit vectors of cosine t differ by sqrt(1 - t^2) across the first; along one normal of a boundary
that has a standard deviation of sqrt((1 - t^2) / (d - 1)). Cells within ``reach`` (4) such deviations are visited, so
a pair is missed only if its difference is far from evenly spread; with reach infinite every pair is compared.

A cell is split into parts of at most about ``part_rows`` members, and one task compares two parts: memory does
not grow with the cell. A task returns one row per member (its number of links and the smallest member of
its local component), never pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheetloom.llm.common import components, pick
from sheetloom.session import stage, staged_size

# vectors travel as the bytes of their double numbers
_CLASSED = "vec_id long, class binary, vector binary"
_MEMBER = "node long, copies long, cell int, native boolean, vector binary"


def _doubles(vectors: pa.ListArray) -> list[np.ndarray]:
    """The vectors in double precision; null vectors are empty, null numbers NaN."""
    numbers = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.array(vectors.value_lengths().fill_null(0), dtype=np.int64)
    return np.split(numbers, np.cumsum(sizes)[:-1]) if len(sizes) else []


def _classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, digest of the vector, vector; digest and vector are null where nothing may link."""
    for batch in batches:
        vectors, digests = [], []
        for vector in _doubles(batch.column(1)):
            usable = bool(np.isfinite(vector).all() and vector.any())
            vectors.append((vector + 0.0).tobytes() if usable else None)
            digests.append(hashlib.blake2b(vectors[-1], digest_size=16).digest() if usable else None)
        arrays = [batch.column(0).cast(pa.int64()), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "class", "vector"])


def unit_rows(vectors: list[bytes], width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors as rows, padded with zeros (or cut) to one width, and their own lengths."""
    sizes = np.array([len(v) // 8 for v in vectors], dtype=np.int64)
    width = width or int(sizes.max(initial=1))
    if (sizes == width).all():
        rows = np.frombuffer(b"".join(vectors)).reshape(len(vectors), width).copy()
    else:
        rows = np.zeros((len(vectors), width))
        for k, v in enumerate(vectors):
            rows[k, : min(len(v) // 8, width)] = np.frombuffer(v)[:width]
    rows /= np.maximum(np.abs(rows).max(axis=1, keepdims=True), np.finfo(float).tiny)  # squares can't overflow
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), np.finfo(float).tiny)
    return rows, sizes


def spherical_kmeans(rows: np.ndarray, cells: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit ``rows``; empty cells keep their last centroid."""
    rng = np.random.default_rng(seed)
    centroids = rows[rng.permutation(len(rows))[:cells]].copy()
    for _ in range(rounds):
        nearest = (rows @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centroids)
    return centroids


def _to_cells(centroids: np.ndarray, margin: float):
    gaps = np.linalg.norm(centroids[:, None] - centroids[None], axis=2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                near = unit_rows(part.column(2).to_pylist(), centroids.shape[1])[0] @ centroids.T
                home = near.argmax(axis=1)
                best = near[np.arange(len(home)), home][:, None]
                reached = (best - near) <= margin * gaps[home]
                reached &= np.arange(len(centroids))[None] >= home[:, None]
                reached[np.arange(len(home)), home] = True
                row, cell = np.nonzero(reached)
                native = pa.array(cell == home[row])
                taken = part.take(pa.array(row))
                arrays = [taken.column(0), taken.column(1), pa.array(cell.astype(np.int32)), native, taken.column(2)]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "copies", "cell", "native", "vector"])

    return run


def _compare(threshold: float):
    """Links between the two parts of a group (or inside the one)."""

    def run(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        copies, native, part = (table[c].to_numpy(zero_copy_only=False) for c in ("copies", "native", "part"))
        rows, sizes = unit_rows(table["vector"].to_pylist())
        low, high = np.flatnonzero(part == table["i"][0].as_py()), np.flatnonzero(part == table["j"][0].as_py())
        inside = len(low) == len(node)  # one part with itself: natives against all of it see every link
        jobs = [(low[native[low]], high)]
        if not inside:
            jobs.append((high[native[high]], low[~native[low]]))
        found_a, found_b = [], []
        for ours, theirs in jobs:
            for at in range(0, len(ours), 256):
                some = ours[at : at + 256]
                linked = rows[some] @ rows[theirs].T >= threshold
                linked &= (sizes[some][:, None] == sizes[theirs][None]) & (some[:, None] != theirs[None])
                a, b = np.nonzero(linked)
                found_a.append(some[a])
                found_b.append(theirs[b])
        a, b = (np.concatenate([np.empty(0, np.int64), *x]) for x in (found_a, found_b))
        back = ~native[b] if inside else np.ones(len(b), bool)  # links seen from one side only
        a, b = np.concatenate([a, b[back]]), np.concatenate([b, a[back]])
        links = np.bincount(a, weights=copies[b], minlength=len(node)).astype(np.int64)
        hub, before = node.copy(), None
        while before is None or (hub != before).any():
            before = hub.copy()
            np.minimum.at(hub, a, hub[b])
        found = links > 0
        return pa.table({"node": node[found], "links": links[found], "hub": hub[found]})

    return run


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = 0.95,
    sample_rows: int = 16_384,
    max_cells: int = 1024,
    part_rows: int = 8192,
    reach: float = 4.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links (other rows linked directly), component_id (smallest id reachable), kept.

    Rows link at a cosine of ``threshold`` or more in double precision. Vectors that are null, empty, zero or
    hold null or non-finite numbers link with nothing, nor do vectors of different lengths, nor rows with a null id
    (component null, kept). Equal rows link with each other. An empty table gives an empty result.

    About ``sample_rows`` classes, chosen by hash, fit at most ``max_cells`` centroids (a quarter of the root of the
    number of classes); all classes are indexed and compared.
    """
    plain = pick(vectors, vec_id=id_col, vector=vector_col)
    classed = stage(plain.mapInArrow(_classed, _CLASSED), "vectors")
    known = classed.where("class IS NOT NULL AND vec_id IS NOT NULL")
    classes = known.groupBy("class").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    classes = stage(classes, "vector-classes")
    n = staged_size(classes).rows
    if n:
        share = min(1.0, sample_rows / n)
        chosen = classes.where(F.pmod(F.xxhash64("class"), F.lit(1_000_003)) < F.lit(share * 1_000_003))
        sample = [r.vector for r in chosen.select("vector").orderBy("class").limit(2 * sample_rows).collect()]
        rows, _ = unit_rows(sample or [np.ones(1).tobytes()])
        cells = max(1, min(max_cells, math.ceil(math.sqrt(n) / 4), len(rows)))
        centroids = spherical_kmeans(rows, cells)
        margin = reach * math.sqrt((1 - threshold**2) / max(1, rows.shape[1] - 1))
    else:
        centroids, margin = np.ones((1, 1)), 0.0
    members = stage(classes.select("node", "copies", "vector").mapInArrow(_to_cells(centroids, margin), _MEMBER), "cells")
    # one row per cell, at most max_cells
    parts = members.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("parts"))
    members = members.join(F.broadcast(parts), "cell")
    members = members.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    members = members.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
    compared = members.groupBy("cell", "i", "j").applyInArrow(_compare(threshold), "node long, links long, hub long")
    compared = stage(compared, "vector-links")
    labels = components(compared.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("class", "node", "copies").join(links, "node", "left").join(labels, "node", "left")
    named = stage(named.select(
        "class", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")
    ), "vector-classes")
    result = classed.select("vec_id", "class").join(named, "class", "left")
    identified = F.col("vec_id").isNotNull()
    component = F.when(identified, F.coalesce("component_id", "vec_id"))
    return result.select(
        "vec_id",
        F.when(identified, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )

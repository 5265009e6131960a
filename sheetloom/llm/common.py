"""What several operators share: words, ASCII lower case, hashes, staged tables, components."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.session import stage, staged_size

#: The white space of all word and line rules.
WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is. Pure ASCII takes the fast built-in way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; on bytes both rules are ASCII only."""
    return text.encode().lower().split() if text else []


_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_chunks(text: str | None, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """:func:`words` in lists of bounded size, for texts of any length."""
    data = text.encode().lower() if text else b""
    start = 0
    while start < len(data):
        cut = _BLANK.search(data, start + size)
        stop = cut.start() if cut else len(data)
        yield data[start:stop].split()
        start = stop


class WordHashes:
    """64-bit hashes of words, with a cache that is emptied when full (it changes no result)."""

    def __init__(self, room: int = 1 << 18) -> None:
        self.room, self.known = room, {}

    def __call__(self, tokens: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.room:
            known.clear()
        for t in set(tokens).difference(known):
            known[t] = xxhash.xxh3_64_intdigest(t)
        return np.fromiter((known[t] for t in tokens), np.uint64, len(tokens))

    def of_text(self, text: str | None) -> np.ndarray:
        """Hashes of all words of a text, in order."""
        parts = [self(tokens) for tokens in word_chunks(text)]
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (splitmix64 finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for every run of ``width`` words, in order; shorter sequences give one for the whole."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    out = np.full(len(hashes) - width + 1, np.uint64(width))
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - width + 1 + k])
    return out


def rows_of(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[dict[str, list]]:
    """Small column dictionaries of Arrow batches, so that few long texts are decoded at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size).to_pydict()


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names, so that extra columns never clash."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as (node, component: the smallest node).

    Every round each root hooks onto its smallest smaller neighbour, chains are shortened, and edges
    are rewritten between roots; edges and roots shrink with every round. All state is in staged
    tables, so nothing is collected and a lost executor costs one step. Null ends and loops are ignored;
    no edges give an empty table.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    live = stage(pairs, "edges")
    labels = stage(live.select(F.explode(F.array("hi", "lo")).alias("node")).distinct()
                   .withColumn("component", F.col("node")), "labels")
    while staged_size(live).rows:
        hooks = stage(live.groupBy("hi").agg(F.min("lo").alias("lo")), "hooks")
        up = hooks.select(F.col("hi").alias("lo"), F.col("lo").alias("lo_up"))
        roots = hooks.join(up, "lo", "left").select("hi", F.coalesce("lo_up", "lo").alias("lo"))
        up = roots.select(F.col("hi").alias("lo"), F.col("lo").alias("lo_up"))
        roots = stage(roots.join(up, "lo", "left").select("hi", F.coalesce("lo_up", "lo").alias("lo")), "roots")
        by_hi = roots.select("hi", F.col("lo").alias("hi_root"))
        by_lo = roots.select(F.col("hi").alias("lo"), F.col("lo").alias("lo_root"))
        ends = live.union(hooks).join(by_hi, "hi", "left").join(by_lo, "lo", "left")
        ends = ends.select(F.coalesce("hi_root", "hi").alias("x"), F.coalesce("lo_root", "lo").alias("y"))
        rewritten = ends.where("x <> y").select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo"))
        live = stage(rewritten.distinct(), "edges")
        moved = roots.select(F.col("hi").alias("component"), F.col("lo").alias("root"))
        labels = labels.join(moved, "component", "left")
        labels = stage(labels.select("node", F.coalesce("root", "component").alias("component")), "labels")
    return labels


def term_table(digits: bool) -> bytes:
    """For ``bytes.translate``: letters (ASCII in lower case, and every byte beyond ASCII), with ``digits`` 0-9 too;
    all other bytes become a blank."""
    kept = bytearray(b" " * 128 + bytes(range(128, 256)))
    for lower in range(97, 123):
        kept[lower] = kept[lower - 32] = lower
    if digits:
        kept[48:58] = range(48, 58)
    return bytes(kept)


def term_chunks(text: str | None, table: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text under a :func:`term_table`, in lists of bounded size, for texts of any length."""
    data = text.encode().translate(table) if text else b""
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + size)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop

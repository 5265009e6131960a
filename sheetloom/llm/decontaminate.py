"""Benchmark decontamination by templates.

Words lose punctuation at their ends. Numbers, names (words written Xxxx, so also the first word of a sentence) and units after
a number become typed placeholders, all others are literal in lower case. The template windows of five words of a
benchmark item are looked up by hash in each document. An item is found in a document where at least 0.8 of its
windows lie near one alignment and the placeholders are consistent: one value in the item stands for one value in the
document and the other way round. So a copy is found, and so is a question with other numbers and names. Beside the
template windows the plain windows (all words in folded case) are looked up, and an item is also found where 0.8 of these lie near
one alignment: a copy in other letter case, whose names are not written Xxxx, or of numbers and names only. The plain words of
an item of fewer than five are one window of their own length, which is looked up anywhere in a document.

The benchmark is the query set: it is cut by a hash of the item into blocks of a measured size, each sent to all
tasks, and every block is held against all documents in one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from sheetloom.llm.common import pick, window_hashes

LITERAL, NUMBER, NAME, MEASURE, UNIT = range(5)

# Units of measure that count as such after a number.
UNITS = set(
    "mm cm dm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes "
    "ml cl l litre litres liter liters gallon gallons cup cups ms s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years percent degrees degree c f k w kw v a hz khz mhz ghz kb mb gb tb usd eur gbp "
    "dollar dollars euro euros cent cents pence".split()
)

_COUNTS = ("n_windows", "n_matched", "first_word", "n_slots", "n_consistent", "n_changed")

_NUMBER = re.compile(r"[+-]?\d[\d.,:/-]*")
_MEASURED = re.compile(r"[+-]?\d[\d.,]*[^\W\d_]{1,4}")
_INNER = re.compile(r"[^\W_]")


def canonical(token: str) -> tuple[int, str]:
    """The kind of a word and its value in folded case; an empty value is punctuation only."""
    first = _INNER.search(token)
    if not first:
        return LITERAL, ""
    after = _INNER.search(token[::-1]).start()
    core = token[first.start() : len(token) - after]
    value = core.casefold()
    if core[0].isdigit():
        if _NUMBER.fullmatch(core):
            return NUMBER, value
        if _MEASURED.fullmatch(core):
            return MEASURE, value
    if len(core) > 1 and core[0].isupper() and core[1:].islower():
        return NAME, value
    return (UNIT, value) if value in UNITS else (LITERAL, value)


class Templates:
    """Turns texts into template words; known words are cached (the cache is emptied when full)."""

    def __init__(self, room: int = 1 << 18) -> None:
        self.room = room
        self._reset()

    def _reset(self) -> None:
        self.place: dict[str, int] = {}
        self.values: list[str] = []
        self.kinds, self.hashes = np.empty(1 << 12, np.int8), np.empty(1 << 12, np.uint64)

    def _learn(self, token: str) -> None:
        kind, value = canonical(token)
        if not value:
            self.place[token] = -1
            return
        at = self.place[token] = len(self.values)
        if at == len(self.kinds):
            self.kinds, self.hashes = np.resize(self.kinds, 2 * at), np.resize(self.hashes, 2 * at)
        self.kinds[at], self.hashes[at] = kind, xxhash.xxh3_64_intdigest(value.encode())
        self.values.append(value)

    def read_many(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of the words of all texts, one after the other: kinds, template hashes and plain hashes, the values known, each word's
        place among them, and the number of its text."""
        if len(self.place) > self.room:
            self._reset()
        split = [text.split() if text else [] for text in texts]
        tokens = list(chain.from_iterable(split))
        for token in set(tokens).difference(self.place):
            self._learn(token)
        at = np.fromiter(map(self.place.__getitem__, tokens), np.int64, len(tokens))
        owner = np.repeat(np.arange(len(texts)), [len(words) for words in split])
        known = at >= 0
        at, owner = at[known], owner[known]
        kinds, plain = self.kinds[at], self.hashes[at]
        after_number = np.zeros(len(kinds), bool)
        after_number[1:] = (kinds[:-1] == NUMBER) & (owner[1:] == owner[:-1])
        kinds[(kinds == UNIT) & ~after_number] = LITERAL
        hashes = np.where(kinds == LITERAL, plain, kinds.astype(np.uint64))
        return kinds, hashes, plain, self.values, at, owner

    def read(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]:
        """:meth:`read_many` of one text."""
        return self.read_many([text])[:5]


@dataclass(frozen=True)
class Lookup:
    """Windows of one sort of a block of items: sorted hashes with (item, position) beside."""

    hashes: np.ndarray
    items: np.ndarray
    positions: np.ndarray
    seen: np.ndarray  # by the top bits of a hash: is there any such window
    sizes: np.ndarray  # windows by item

    def hits(self, windows: np.ndarray) -> np.ndarray:
        """Places of the windows that are here."""
        if not len(self.hashes):
            return np.empty(0, np.int64)
        at = np.flatnonzero(self.seen[(windows >> np.uint64(44)).astype(np.int64)])
        low = np.searchsorted(self.hashes, windows[at], "left")
        hit = low < len(self.hashes)
        hit[hit] = self.hashes[low[hit]] == windows[at[hit]]
        return at[hit]


@dataclass(frozen=True)
class Index:
    """The items of a block with their words, and their template and plain windows."""

    template: Lookup
    plain: dict[int, Lookup]  # by the words of a window: the width, or all words of shorter items
    ids: list
    kinds: list[np.ndarray]
    values: list[list[str]]


def _windows(kinds: np.ndarray, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of windows in which at least half of the words are literal."""
    windows = window_hashes(hashes, width)
    width = min(width, len(hashes))
    literal = np.concatenate([[0], np.cumsum(kinds == LITERAL)])
    at = np.flatnonzero(2 * (literal[width:] - literal[: len(literal) - width]) >= width) if len(hashes) else np.empty(0, np.int64)
    return at, windows[at]


def _lookup(found: list[tuple[np.ndarray, np.ndarray]]) -> Lookup:
    """Of the (positions, hashes) of every item."""
    sizes = np.array([len(hashes) for _, hashes in found], np.int64)
    flat = np.concatenate([np.empty(0, np.uint64), *(hashes for _, hashes in found)])
    positions = np.concatenate([np.empty(0, np.int64), *(where for where, _ in found)])
    order = np.argsort(flat, kind="stable")
    seen = np.zeros(1 << 20, bool)
    seen[(flat >> np.uint64(44)).astype(np.int64)] = True
    return Lookup(flat[order], np.repeat(np.arange(len(sizes)), sizes)[order], positions[order], seen, sizes)


def build_index(items: list[tuple[object, str | None]], width: int) -> Index:
    templates = Templates(room=1 << 62)
    template, plain, ids, all_kinds, all_values = [], [], [], [], []
    none = np.empty(0, np.int64), np.empty(0, np.uint64)
    for item, text in items:
        kinds, hashes, words, values, at = templates.read(text)
        if not len(words):
            continue  # nothing to look for
        template.append(_windows(kinds, hashes, width))
        windows = window_hashes(words, width)
        plain.append((np.arange(len(windows)), windows))
        ids.append(item)
        all_kinds.append(kinds)
        all_values.append([values[k] for k in at])
    lengths = [min(width, len(kinds)) for kinds in all_kinds]
    by_length = {n: _lookup([w if n == mine else none for w, mine in zip(plain, lengths)]) for n in sorted(set(lengths))}
    return Index(_lookup(template), by_length, ids, all_kinds, all_values)


def may_hold_items(index: Index, templates: Templates, texts: list[str | None], width: int) -> np.ndarray:
    """Which of the texts have any window of the index, or are shorter than a window; all texts at once."""
    _, hashes, words, _, _, owner = templates.read_many(texts)
    sizes = np.bincount(owner, minlength=len(texts))
    found = (sizes > 0) & (sizes < width)
    for lookup, sequence, n in [(index.template, hashes, width), *((lookup, words, n) for n, lookup in index.plain.items())]:
        if len(sequence) >= n:
            whole = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])  # not across texts
            found[owner[whole[lookup.hits(window_hashes(sequence, n)[whole])]]] = True
    return found


def text_groups(texts: list[str | None], most: int = 1 << 20) -> Iterator[slice]:
    """Slices of texts of about ``most`` characters or one text."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield slice(start, k + 1)
            start, size = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def find_in_texts(index: Index, templates: Templates, texts: list[str | None], width: int, percent: int) -> Iterator[list[dict]]:
    """:func:`find_items` of every text. Texts without any window of the index are told apart together."""
    for part in text_groups(texts):
        for text, possible in zip(texts[part], may_hold_items(index, templates, texts[part], width)):
            yield find_items(index, templates, text, width, percent) if possible else []


def find_items(index: Index, templates: Templates, text: str | None, width: int, percent: int) -> list[dict]:
    """The items of ``index`` found in a text, by template windows or else by plain ones."""
    kinds, hashes, words, values, place = templates.read(text)
    found: dict[int, dict] = {}
    if len(words):
        wanted = [(index.template, hashes, width)]
        wanted += [(lookup, words, n) for n, lookup in index.plain.items() if n <= len(words)]
        for lookup, sequence, n in wanted:
            for item, match in _matches(index, lookup, window_hashes(sequence, n), values, place, width, percent):
                found.setdefault(item, match)
    return [found[item] for item in sorted(found)]


def _matches(index: Index, lookup: Lookup, windows: np.ndarray, values: list[str], place: np.ndarray, width: int, percent: int) -> Iterator[tuple[int, dict]]:
    at = lookup.hits(windows)
    if not len(at):
        return
    # which windows of which items occur at all; repeated windows of the text count once
    present = np.unique(windows[at])
    low, high = np.searchsorted(lookup.hashes, present, "left"), np.searchsorted(lookup.hashes, present, "right")
    entries = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
    covered = np.bincount(lookup.items[entries], minlength=len(index.ids))
    for item in np.flatnonzero((covered > 0) & (100 * covered >= percent * lookup.sizes)):
        mine = entries[lookup.items[entries] == item]
        for match in _aligned(index, lookup, int(item), mine, windows, at, values, place, width, percent):
            if match["n_consistent"] * 100 >= percent * match["n_slots"]:
                yield int(item), match
                break


def _aligned(index: Index, lookup: Lookup, item: int, entries: np.ndarray, windows: np.ndarray, at: np.ndarray, values: list[str], place: np.ndarray, width: int, percent: int) -> Iterator[dict]:
    """The alignments of an item in a text that have enough windows, most windows first: these and the consistency of the placeholders."""
    by_hash: dict[int, list[int]] = {}
    for entry in entries:
        by_hash.setdefault(int(lookup.hashes[entry]), []).append(int(lookup.positions[entry]))
    wanted = np.fromiter(by_hash, np.uint64, len(by_hash))
    pairs = [(mine, int(k)) for k in at[np.isin(windows[at], wanted)] for mine in by_hash[int(windows[k])]]
    shifts = Counter(theirs - mine for mine, theirs in pairs)
    offsets = np.array([theirs - mine for mine, theirs in pairs], np.int64)
    by_offset = np.argsort(offsets, kind="stable")
    offsets = offsets[by_offset]
    n_words = len(index.values[item])
    room = max(2, n_words // 5)  # words put in or left out move the rest of the passage
    for shift in sorted(shifts, key=lambda s: (-shifts[s], s)):
        low, high = np.searchsorted(offsets, shift - room, "left"), np.searchsorted(offsets, shift + room, "right")
        if 100 * (high - low) < percent * lookup.sizes[item]:
            continue
        nearest: dict[int, int] = {}
        for k in np.sort(by_offset[low:high]):
            mine, theirs = pairs[k]
            if mine not in nearest or abs(theirs - mine - shift) < abs(nearest[mine] - mine - shift):
                nearest[mine] = theirs
        if 100 * len(nearest) < percent * lookup.sizes[item]:
            continue
        slots = {}
        for mine, theirs in nearest.items():
            for k in range(min(width, n_words - mine)):
                if index.kinds[item][mine + k] != LITERAL:
                    slots[mine + k] = theirs + k
        said = [(index.kinds[item][a], index.values[item][a], values[place[b]]) for a, b in sorted(slots.items())]
        forth, back = {}, {}
        for (kind, mine, theirs), _ in Counter(said).most_common():
            forth.setdefault((kind, mine), theirs)
            back.setdefault((kind, theirs), mine)
        consistent = sum(forth[kind, mine] == theirs and back[kind, theirs] == mine for kind, mine, theirs in said)
        yield {
            "item_id": index.ids[item], "n_windows": int(lookup.sizes[item]), "n_matched": len(nearest),
            "first_word": min(nearest.values(), default=0), "n_slots": len(said), "n_consistent": consistent,
            "n_changed": sum(mine != theirs for _, mine, theirs in said),
        }


def index_blocks(benchmark: DataFrame, width: int = 5, block_bytes: int = 16 << 20, id_col: str = "item_id", text_col: str = "text") -> list[Broadcast]:
    """Indexes of the benchmark in blocks of about ``block_bytes`` bytes of text, made one after the other."""
    plain = pick(benchmark, item_id=id_col, text=text_col).where("item_id IS NOT NULL")
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    result = []
    for block in range(blocks):
        rows = plain.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = sorted(((r.item_id, r.text) for r in rows.collect()), key=lambda x: (x[0], x[1] or ""))
        result.append(benchmark.sparkSession.sparkContext.broadcast(build_index(items, width)))
    return result


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row per document and benchmark item found in it.

    Columns: doc_id, item_id, n_windows (of the item: template windows, or plain ones if only these suffice), n_matched, first_word (place in the document, without punctuation
    words), n_slots, n_consistent, n_changed (placeholders with another value). Null and empty texts hold
    nothing; items without a template window that is at least half literal are found by their plain windows; items of fewer than
    ``width`` words are one plain window of that many words, found anywhere in a text, and one template window, found only in a text
    of as many words; items with a null id are left out. Repeated documents or items are reported as often as they are there.
    """
    item_kind = benchmark.schema[settings.get("item_col", "item_id")].dataType.simpleString()
    plain = pick(docs, doc_id=id_col, text=text_col)
    doc_kind = plain.schema["doc_id"].dataType.simpleString()
    shape = ", ".join([f"doc_id {doc_kind}, item_id {item_kind}", *(f"{name} long" for name in _COUNTS)])
    result = None
    for block in index_blocks(benchmark, width, id_col=settings.get("item_col", "item_id")):

        def run(batches: Iterator[pa.RecordBatch], block: Broadcast = block) -> Iterator[pa.RecordBatch]:
            templates = Templates()
            for batch in batches:
                found = []
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256).to_pydict()
                    for doc, matches in zip(part["doc_id"], find_in_texts(block.value, templates, part["text"], width, percent)):
                        found += [{"doc_id": doc} | m for m in matches]
                if found:
                    kinds = {"doc_id": batch.schema.field("doc_id").type, "item_id": pa.array(block.value.ids).type}
                    yield pa.RecordBatch.from_pylist(found, pa.schema(kinds | dict.fromkeys(_COUNTS, pa.int64())))

        matched = plain.mapInArrow(run, shape)
        result = matched if result is None else result.union(matched)
    return result


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found (see :func:`find_contamination`), unchanged."""
    result = docs
    for block in index_blocks(benchmark, width):

        def run(batches: Iterator[pa.RecordBatch], block: Broadcast = block) -> Iterator[pa.RecordBatch]:
            templates = Templates()
            for batch in batches:
                column = batch.column(batch.schema.get_field_index(text_col))
                clean = []
                for start in range(0, batch.num_rows, 256):
                    texts = column.slice(start, 256).to_pylist()
                    clean += [not found for found in find_in_texts(block.value, templates, texts, width, percent)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        result = result.mapInArrow(run, result.schema)
    return result

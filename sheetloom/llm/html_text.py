"""Main text of web pages by the maximum-scoring run of words and tags.

A page is read as a sequence of tags and words. A word scores ``word``; a tag scores at most zero, the more
below it the more typical the tag is of what lies outside articles. One linear scan finds the contiguous run of the
largest sum. The run grows to whole blocks and to the smallest element that holds it (unless that is the body); blocks
of that element outside the run count unless most of their words are links. Elements that are never article
text (menus, adverts, forms, comments, ...: the fixed lists below) are silent: their words count for nothing.

The tag weights are log-odds learned from labelled pages, those that mark their article with ``article`` or ``main``.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheetloom.llm.common import pick, rows_of

# Element names of HTML by their role here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template textarea title iframe noembed noframes xmp".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr img br ruby rt rp rb math".split()
)
BLOCK = set(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote "
    "pre figure figcaption address header footer nav aside form fieldset hr details summary center hgroup".split()
)
SILENT = set(
    "head nav footer aside form button select dialog menu script style template textarea title iframe noembed noframes xmp "
    "noscript object embed svg canvas video audio map datalist".split()
)
#: Words of class, id and role that mark an element which is not article text.
SILENT_WORDS = set(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored banner promo promotion cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing social related "
    "recommended recommendations teaser teasers comment comments disqus reply replies respond discussion sidebar side "
    "complementary menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer contentinfo masthead toolbar widget "
    "widgets copyright login search skip tags dialog form paywall".split()
)
#: A word after one of these says that the thing is absent or beside the element.
_BESIDE = {"no", "with", "has", "without"}
#: An open element that such a tag ends if the element is still open.
CLOSED_BY = {
    "p": BLOCK - {"html", "body"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option"},
}

#: Elements that article text is made of, for weights not learned.
_TEXT_TAGS = set("p h1 h2 h3 h4 h5 h6 blockquote pre article main figcaption".split()) | INLINE - {"a"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+|[^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_MARKS = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_UNSEEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)


def _is_silent(name: str, attributes: str, inside: Counter) -> bool:
    if name in SILENT:
        return True
    if name == "header":
        return not (inside["article"] or inside["main"])
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    if _UNSEEN.search(attributes):
        return True
    for mark in _MARKS.finditer(attributes):
        parts = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", mark[2] or mark[3] or mark[4] or "").lower())
        for before, part in zip(["", *parts], parts):
            if part in SILENT_WORDS and before not in _BESIDE:
                return True
            if part == "header" and not inside["article"] and not inside["main"] and before not in ("article", "post", "entry"):
                return True
    return False


@dataclass
class _Open:
    name: str
    number: int
    silent: bool


@dataclass
class Page:
    """A page as items in order: ("tag", name, element path) or ("text", text, element path)."""

    items: list[tuple[bool, str, tuple[int, ...], bool]] = field(default_factory=list)
    names: dict[int, str] = field(default_factory=dict)


def read_page(source: str) -> Page:
    """Tags and texts of a page: (is_tag, name or decoded text, numbers of the open elements, silent).

    Unclosed, crossed and unknown tags are accepted: an end tag closes up to its start tag, and without one it
    is only an item.
    """
    page, stack, inside, at, count = Page(), [], Counter(), 0, 0
    path: tuple[int, ...] = ()

    def leave(level: int) -> None:
        nonlocal path
        for gone in stack[level:]:
            inside[gone.name] -= 1
        del stack[level:]
        path = path[:level]

    def text(upto: int) -> None:
        if upto > at:
            raw = source[at:upto]
            page.items.append((False, html.unescape(raw) if "&" in raw else raw, path, bool(stack) and stack[-1].silent))

    while True:
        token = _TOKEN.search(source, at)
        if token is None:
            text(len(source))
            return page
        text(token.start())
        at = token.end()
        if token[2] is None:
            continue
        name = token[2].lower()
        if token[1]:
            level = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name), None) if inside[name] > 0 else None
            page.items.append((True, name, path, bool(stack) and stack[-1].silent))
            if level is not None:
                leave(level)
            continue
        while stack and name in CLOSED_BY.get(next((x.name for x in reversed(stack) if x.name not in INLINE), ""), ()):
            leave(max(k for k, x in enumerate(stack) if x.name not in INLINE))
        silent = bool(stack) and stack[-1].silent or _is_silent(name, token[3], inside)
        page.items.append((True, name, path, silent))
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(source, at)
            at = end.end() if end else len(source)
        elif name not in VOID and not token[3].endswith("/"):
            count += 1
            stack.append(_Open(name, count, silent))
            inside[name] += 1
            path += (count,)
            page.names[count] = name


@dataclass(frozen=True)
class Weights:
    """Scores of a word and of the tags (at most ``least``, inline ones at least ``inline_floor``, as a link or two
    does not end an article); unknown tags score ``other``."""

    word: float = 1.0
    tags: dict[str, float] = field(default_factory=dict)
    other: float = -0.5
    least: float = -0.02
    inline_floor: float = -3.0

    def tag(self, name: str) -> float:
        known = self.tags.get(name, self.least if name in _TEXT_TAGS else self.other)
        return max(known, self.inline_floor) if name in INLINE else known


def learn_weights(counts: dict[str, tuple[int, int]]) -> Weights:
    """Weights from (inside, outside) counts by tag name, words under the empty name."""
    counts = dict(counts)
    words_in, words_out = counts.pop("", (0, 0))
    total_in, total_out = (words_in + sum(n for n, _ in counts.values()), words_out + sum(n for _, n in counts.values()))
    if not total_in or not total_out:
        return Weights()
    odds = lambda n, m: math.log((n + 0.5) / (total_in + 1)) - math.log((m + 0.5) / (total_out + 1))
    word = max(0.25, odds(words_in, words_out))
    return Weights(word, {name: min(Weights.least, odds(*both)) for name, both in counts.items()})


def _tag_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = INLINE | BLOCK | SILENT | VOID
    counts: dict[str, list[int]] = {}
    for part in rows_of(batches, 64):
        for source in part["html"]:
            page = read_page(source or "")
            labelled = {n for n, name in page.names.items() if name in ("article", "main")}
            if not labelled:
                continue
            for is_tag, what, path, silent in page.items:
                within = not silent and not labelled.isdisjoint(path) and not (is_tag and what in ("article", "main"))
                if not is_tag:
                    counts.setdefault("", [0, 0])[not within] += len(what.split())
                elif what in known:
                    counts.setdefault(what, [0, 0])[not within] += 1
    yield pa.RecordBatch.from_pydict(
        {"tag": list(counts), "inside": [c[0] for c in counts.values()], "outside": [c[1] for c in counts.values()]},
        schema=pa.schema({"tag": pa.string(), "inside": pa.int64(), "outside": pa.int64()}),
    )


def fit_weights(pages: DataFrame, sample_pages: int = 5_000, id_col: str = "page_id", html_col: str = "html") -> Weights:
    """Weights from about ``sample_pages`` pages (chosen by a hash of the id) as far as they are labelled."""
    plain = pick(pages, page_id=id_col, html=html_col)
    share = min(1.0, sample_pages / max(1, plain.count()))
    chosen = plain.where(F.pmod(F.xxhash64("page_id"), F.lit(1_000_003)) < F.lit(share * 1_000_003))
    counts = chosen.select("html").mapInArrow(_tag_counts, "tag string, inside long, outside long")
    rows = counts.groupBy("tag").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return learn_weights({r.tag: (r.inside, r.outside) for r in rows})  # one row per known element name


def main_text(source: str | None, weights: Weights) -> str:
    """The article text of a page, one block per paragraph, joined by empty lines; empty if there is none."""
    page = read_page(source or "")
    scores = []
    for is_tag, what, _, silent in page.items:
        scores.append(weights.tag(what) if is_tag else 0.0 if silent else weights.word * len(what.split()))
    best, run, first, start, stop = 0.0, 0.0, 0, 0, 0
    for k, score in enumerate(scores):
        if run <= 0:
            run, first = 0.0, k
        run += score
        if run > best:
            best, start, stop = run, first, k + 1
    if not best:
        return ""
    while start and not _ends_block(page.items[start - 1]):
        start -= 1
    while stop < len(page.items) and not _ends_block(page.items[stop]):
        stop += 1
    shared = _common_element(page, start, stop)
    whole = not shared or page.names[shared[-1]] in ("html", "body")
    blocks, parts = [], []
    own, linked, counted = 0, 0, False

    def close() -> None:
        nonlocal own, linked, counted
        block = " ".join("".join(parts).split())
        if block and (counted or own > linked):
            blocks.append(block)
        parts.clear()
        own, linked, counted = 0, 0, False

    for k, item in enumerate(page.items):
        is_tag, what, path, silent = item
        in_run = start <= k < stop
        if is_tag:
            if _ends_block(item):
                close()
            elif what == "br":
                parts.append(" ")
        elif not silent and (in_run or not whole and path[: len(shared)] == shared):
            parts.append(what)
            counted |= in_run
            if any(page.names[n] == "a" for n in path):
                linked += len(what.split())
            else:
                own += len(what.split())
    close()
    return "\n\n".join(blocks)


def _ends_block(item: tuple[bool, str, tuple[int, ...], bool]) -> bool:
    return item[0] and item[1] not in INLINE


def _common_element(page: Page, start: int, stop: int) -> tuple[int, ...]:
    """The path of the smallest element that holds all words of the run and can hold several blocks."""
    shared = None
    for is_tag, what, path, silent in page.items[start:stop]:
        if not is_tag and not silent and what.strip():
            shared = path if shared is None else shared
            same = next((n for n, (x, y) in enumerate(zip(shared, path)) if x != y), min(len(shared), len(path)))
            shared = shared[:same]
    shared = shared or ()
    while shared and page.names[shared[-1]] in _TEXT_TAGS - {"article", "main", "blockquote"} | {"a", "li"}:
        shared = shared[:-1]  # a single block: its siblings belong to the same text
    return shared


def extract_text(pages: DataFrame, weights: Weights | None = None, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``pages`` with the columns text and n_chars (its code points) in place of the html; other columns are kept.

    Each page is read whole and by itself. A null or empty html, or one without words, gives an empty text. ``weights``
    are learned from the pages themselves if not given. Existing columns text and n_chars are replaced.
    """
    weights = weights or fit_weights(pages, id_col=id_col, html_col=html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = [main_text(source, weights) for source in part.column(0).to_pylist()]
                added = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *added], [*part.schema.names[1:], "text", "n_chars"])

    others = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    shape = pages.select(*(F.col(f"`{c}`") for c in others)).schema.add("text", "string").add("n_chars", "long")
    return pages.select(F.col(f"`{html_col}`"), *(F.col(f"`{c}`") for c in others)).mapInArrow(run, shape)

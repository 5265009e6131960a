"""Personal data: fixed base patterns, and spans that boosted trees choose among overlapping candidates.

Base spans come from four patterns and a check each, and always stay. Beside them *generators* propose many more spans,
which may overlap each other: another grouping of the same digits, a number that stands directly behind another one, a
number without its plus, an address spelt with ``(at)``.

Boosted trees score every candidate from two kinds of features, its format and its context. They are trained without
labelled spans, on two views of the candidates: what a check that no feature shows says of it (the checksum of a card,
the ranges of an IP address, the plus of a phone number, the at-sign of an address) is the label, and the trees learn which
formats and contexts go with a passed check. Half of the training candidates calibrate, in bands of like score. Let s be the
passed share of a band, at its lower confidence bound, and c the share that would pass by chance (one number in ten
has the checksum of a card). Then a candidate that passed is right with probability (s - c) / ((1 - c) s); one that did not is
right with probability s where the check is a matter of spelling (phone, email), and wrong where it is not (card, ip).
The threshold is the lowest score of the bands, from the highest on, in which this reaches the precision asked for.

Everything is built-in functions: positions come from the lengths of the pieces between matches, trees are column
expressions, and a boosting round is one aggregate.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from sheetloom.functions.text import let
from sheetloom.llm.common import pick
from sheetloom.session import stage, staged_size

KINDS = ("email", "ip", "card", "phone")

# The base patterns, in a form that neither backtracks nor starts inside a run: a match begins where the last one
# ended, or where the run of its first class begins. They match what the plain forms match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# Candidate generators; all quantifiers are bounded, and every match begins and ends at the edge of a word or number.
_WORD = r"[A-Za-z0-9-]{1,63}"
GENERATORS = (
    ("email", rf"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+-]{{1,64}}@{_WORD}(?:\.{_WORD}){{1,8}}+(?![A-Za-z0-9@-])"),
    ("email", rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}\x20?[(\[]at[)\]]\x20?{_WORD}"
              rf"(?:(?:\.|\x20?[(\[]dot[)\]]\x20?){_WORD}){{1,8}}+"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])"),
    ("ip", r"(?<![0-9])(?<![0-9]\.)[0-9]{1,3}(?:\x20\.\x20[0-9]{1,3}){3}(?![0-9])"),
    ("card", r"(?<![0-9A-Za-z+])[0-9]{12,19}+(?![0-9A-Za-z])"),
    ("card", r"(?<![0-9A-Za-z+])[0-9]{4}(?:[\x20./_-][0-9]{4}){2}[\x20./_-][0-9]{1,7}(?![0-9A-Za-z])"),
    ("card", r"(?<![0-9A-Za-z+])3[47][0-9]{2}[\x20./_-]?[0-9]{6}[\x20./_-]?[0-9]{5}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z+])(?:\+|00)?[0-9]{0,3}[\x20.-]?\([0-9]{2,5}\)\x20?[0-9]{2,4}(?:[\x20.-][0-9]{2,4}){1,2}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z+])(?:(?:\+|00)[0-9]{1,3}[\x20.-]?|0)[0-9]{2,5}(?:[\x20./-][0-9]{2,5}){1,4}+(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z+.-])\+?[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z+])\+[0-9]{9,15}+(?![0-9A-Za-z])"),
)

# How often the check of a kind is passed by chance, and the kinds whose members all pass it.
CHANCE = {"email": 0.0, "ip": 0.256**4, "card": 0.1, "phone": 0.0}
NECESSARY = ("ip", "card")

BEFORE, AFTER = 32, 16
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_FOUND = "array<struct<kind:int,base:boolean,start:bigint,value:string,before:string,after:string>>"


def _luhn(digits: Column) -> Column:
    """The checksum of a card number over ASCII digits; false unless there are 12 to 19."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * (1 + i % 2))
    total = F.aggregate(doubled, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v))
    return F.when(F.char_length(digits).between(12, 19), total % 10 == 0).otherwise(False)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def base_check(kind: str, value: Column) -> Column:
    """May a match of a base pattern stay?"""
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return _luhn(_digits(value))
    if kind == "phone":
        return F.char_length(_digits(value)).between(9, 15)
    return F.lit(True)


def passed(kind: str, value: Column) -> Column:
    """The check that labels a candidate; no feature shows it."""
    if kind == "email":
        return value.rlike(r"^[A-Za-z0-9][^@]*+@(?:[A-Za-z0-9][A-Za-z0-9-]*+\.)++[A-Za-z]{2,24}$") & ~value.contains("..")
    if kind == "phone":
        return value.startswith("+") & F.char_length(_digits(value)).between(9, 15)
    return base_check(kind, value)


# Format and context features of a candidate. Each is a name and a rule over its text, its digits, and the texts before
# (in lower case) and after it.
FEATURES: tuple[tuple[str, object], ...] = (
    ("blank before", lambda v, d, b, a: (b == "") | b.rlike(r"\s$")),
    ("blank after", lambda v, d, b, a: (a == "") | a.rlike(r"^\s")),
    ("assigned", lambda v, d, b, a: b.rlike(r"[:=#]\s?[\"']?$")),
    ("number before", lambda v, d, b, a: b.rlike(r"[0-9][\s.,()/+-]{0,2}$")),
    ("number after", lambda v, d, b, a: a.rlike(r"^[\s.,()/+-]{0,2}[0-9]")),
    ("sentence ends", lambda v, d, b, a: a.rlike(r"^[.,;!?)]")),
    ("mail words", lambda v, d, b, a: b.rlike("mail|contact|write|reach")),
    ("call words", lambda v, d, b, a: b.rlike("tel|phone|call|mobile|cell|fax|ring")),
    ("card words", lambda v, d, b, a: b.rlike("card|visa|credit|debit|amex|pay")),
    ("host words", lambda v, d, b, a: b.rlike(r"\bip\b|host|server|addr|login")),
    ("id words", lambda v, d, b, a: b.rlike(r"version|release|order|invoice|isbn|part|serial|\bv\s?$|\bid\b|\bno\.")),
    ("under 9 digits", lambda v, d, b, a: F.char_length(d) < 9),
    ("9 to 11 digits", lambda v, d, b, a: F.char_length(d).between(9, 11)),
    ("12 to 14 digits", lambda v, d, b, a: F.char_length(d).between(12, 14)),
    ("15 or 16 digits", lambda v, d, b, a: F.char_length(d).between(15, 16)),
    ("blanks", lambda v, d, b, a: v.contains(" ")),
    ("hyphens", lambda v, d, b, a: v.contains("-")),
    ("brackets", lambda v, d, b, a: v.contains("(")),
    ("groups of four", lambda v, d, b, a: v.rlike(r"^[0-9]{4}(?:[\x20./_-]?[0-9]{4}){3}$")),
    ("groups 3-3-4", lambda v, d, b, a: v.rlike(r"(?<![0-9])[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}$")),
    ("card network", lambda v, d, b, a: d.rlike("^(?:4|5[1-5]|3[47]|6|2[2-7])")),
    ("few different digits", lambda v, d, b, a: (d != "") & (F.size(F.array_distinct(F.split(d, ""))) <= 3)),
    ("letters at the end", lambda v, d, b, a: v.rlike("[A-Za-z]{2,}$")),
    ("longer part", lambda v, d, b, a: v.rlike("[A-Za-z]{4,}")),
)


def _running_starts(lengths: Column, part: int = 256) -> Column:
    """Sums of all earlier entries, part by part, so that the work stays close to linear."""

    def sums(values: Column) -> Column:
        following = lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x))
        return F.aggregate(values, F.array(F.lit(0).cast("long")), following)

    first = lambda p: F.slice(lengths, p * part + 1, F.lit(part))
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / part).cast("int")), lambda p: sums(first(p)))

    def placed(parts_: Column) -> Column:
        starts = sums(F.transform(parts_, lambda s: F.element_at(s, -1)))
        return F.flatten(F.transform(parts_, lambda s, p: F.transform(F.slice(s, F.lit(1), F.size(s) - 1), lambda x: x + F.get(starts, p))))

    return let(parts, placed)


def _matches(text: Column, pattern: str, of: object) -> Column:
    """``of(value, before, after, start)`` for every match; positions in code points from 0."""

    def located(both: Column) -> Column:
        values, pieces = both["values"], both["pieces"]
        steps = F.transform(values, lambda v, i: F.char_length(F.get(pieces, i)).cast("long") + F.char_length(v))
        starts = let(F.concat(steps, F.array(F.lit(0).cast("long"))), lambda lengths: _running_starts(lengths))

        def each(starts_: Column) -> Column:
            start = lambda i: F.get(starts_, i) + F.char_length(F.get(pieces, i))
            return F.transform(values, lambda v, i: of(v, F.get(pieces, i), F.get(pieces, i + 1), start(i)))

        return let(starts, each)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(F.struct(found.alias("values"), F.split(text, pattern, -1).alias("pieces")), located)


def _found(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """The matches of a pattern: kind, base, start, value, and the text near it."""

    def one(value: Column, before: Column, after: Column, start: Column) -> Column:
        near = [F.right(before, F.lit(BEFORE)).alias("before"), F.left(after, F.lit(AFTER)).alias("after")]
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), F.lit(base).alias("base"), start.alias("start"), value.alias("value"), *near)

    return _matches(text, pattern, one)


def _by_kind(rule: object) -> Column:
    """``rule(kind, value)`` of the kind of a row."""
    chosen = F.lit(None).cast("boolean")
    for k, kind in enumerate(KINDS):
        chosen = F.when(F.col("kind") == k, rule(kind, F.col("value"))).otherwise(chosen)
    return chosen


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans and candidates of every text, one row each: doc_id, text_hash, kind (number), start, stop, base,
    features and passed. One pass over the texts, without a shuffle; texts without an at-sign or digit have none."""
    rows = pick(docs, doc_id=id_col, text=text_col).where(F.col("text").rlike(r"[0-9@]|[(\[]at[)\]]"))
    text, none = F.col("text"), F.array().cast(_FOUND)
    sign, digit = text.rlike(r"@|[(\[]at[)\]]"), text.rlike("[0-9]")
    patterns = [(kind, BASE[kind], True) for kind in KINDS] + [(kind, pattern, False) for kind, pattern in GENERATORS]
    lists = [F.when(sign if kind == "email" else digit, _found(text, kind, pattern, base)).otherwise(none) for kind, pattern, base in patterns]
    found = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.inline(F.flatten(F.array(*lists))))
    found = found.where(~F.col("base") | _by_kind(base_check)).withColumns({"digits": _digits(F.col("value")), "before": F.lower("before")})
    known = F.array(*(rule(F.col("value"), F.col("digits"), F.col("before"), F.col("after")) for _, rule in FEATURES))
    return found.select(
        "doc_id", "text_hash", "kind", "start", (F.col("start") + F.char_length("value")).alias("stop"), "base",
        F.when(~F.col("base"), known).alias("features"), F.when(~F.col("base"), _by_kind(passed)).alias("passed"),
    )


# ---- boosted trees -------------------------------------------------------------------------


@dataclass
class SpanModel:
    """For each kind: a prior, trees (two features and the values of their four leaves), and the smallest accepted scores:
    of candidates that passed the check of their kind, and of others."""

    priors: dict[str, float] = field(default_factory=dict)
    trees: dict[str, list[tuple[int, int, list[float]]]] = field(default_factory=dict)
    thresholds: dict[tuple[str, bool], float] = field(default_factory=dict)

    def score(self, kind: Column, features: Column) -> Column:
        """Probability from 0 to 1; NULL for a kind that was never trained."""
        trees = [{"prior": self.priors.get(k), "trees": [{"i": i, "j": j, "v": v} for i, j, v in self.trees.get(k, [])]} for k in KINDS]
        model = F.get(F.from_json(F.lit(json.dumps(trees)), "array<struct<prior:double,trees:array<struct<i:int,j:int,v:array<double>>>>>"), kind)
        bit = lambda at: F.get(features, at).cast("int")
        odds = F.aggregate(model["trees"], model["prior"], lambda sum_, t: sum_ + F.get(t["v"], bit(t["i"]) + 2 * bit(t["j"])))
        return F.round(1 / (1 + F.exp(-odds)), 6)

    def accepted(self, kind: Column, ok: Column, score: Column) -> Column:
        """Does the score reach the threshold of the kind, for a candidate that passed the check of its kind or not?"""
        found = F.lit(False)
        for (name, passing), least in sorted(self.thresholds.items()):
            found = found | ((kind == KINDS.index(name)) & (ok == passing) & (score >= least))
        return F.coalesce(found, F.lit(False))


def _lower_bound(hits: int, n: int, z: float = 1.96) -> float:
    """Wilson's lower bound of a share."""
    if not n:
        return 0.0
    p = hits / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _bands(rows: list[tuple[int, int, int]], least: int) -> Iterator[tuple[int, int, int]]:
    """(level, n, hits) put together, from the highest level on, to bands of at least ``least``: the lowest level, n and hits."""
    n = hits = 0
    ordered = sorted(rows, reverse=True)
    for k, (level, more, more_hits) in enumerate(ordered, 1):
        n, hits = n + more, hits + more_hits
        if n >= least or k == len(ordered):
            yield level, n, hits
            n = hits = 0


def fit_model(
    candidates: DataFrame,
    rounds: int = 10,
    rate: float = 0.4,
    precision: float = 0.85,
    band_rows: int = 50,
    smooth: float = 1.0,
) -> SpanModel:
    """Train on one half of all candidates, by a hash of document and place, and calibrate on the other.

    Candidates of equal features are one row with counts, so a boosting round aggregates a small table. Trees have two
    levels, the same feature on both sides of the second; the best pair of features by gain is taken, of equal gains the
    first. A kind without candidates in both halves is not trained, and none of it is added.
    """
    of_kind = candidates.where("NOT base").withColumn("key", F.xxhash64("doc_id", "text_hash", "start", "stop"))
    model, n_features = SpanModel(), len(FEATURES)
    half = (F.pmod(F.xxhash64("key"), F.lit(2)) == 0).alias("training")
    cells = of_kind.groupBy("kind", half, "features").agg(F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("hits"))
    cells = stage(cells, "feature-cells")  # the features that occur together, usually few hundred rows
    if not staged_size(cells).rows:
        return model
    cells = cells.coalesce(1 + staged_size(cells).rows // 2000)
    training = cells.where("training")
    for r in training.groupBy("kind").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect():
        share = (r.hits + smooth) / (r.n + 2 * smooth)
        model.priors[KINDS[r.kind]], model.trees[KINDS[r.kind]] = math.log(share / (1 - share)), []
    for _ in range(rounds):
        p = model.score(F.col("kind"), F.col("features"))
        stats = training.select("kind", "features", (F.col("hits") - F.col("n") * p).alias("g"), (F.col("n") * p * (1 - p)).alias("h"))
        first = F.explode(F.sequence(F.lit(0), F.lit(n_features - 2))).alias("i")
        second = F.explode(F.sequence(F.col("i") + 1, F.lit(n_features - 1))).alias("j")
        split = stats.select("*", first).select("*", second)
        bit = lambda c: F.get("features", F.col(c)).cast("int")
        leaves = split.groupBy("kind", "i", "j", (bit("i") + 2 * bit("j")).alias("leaf")).agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        best = leaves.groupBy("kind", "i", "j").agg(
            F.sum(F.round(F.col("g") * F.col("g") / (F.col("h") + smooth), 6)).alias("gain"),
            F.map_from_entries(F.collect_list(F.struct("leaf", (rate * F.col("g") / (F.col("h") + smooth)).alias("value")))).alias("values"),
        )
        best = best.groupBy("kind").agg(F.max_by(F.struct("i", "j", "values"), F.struct("gain", -F.col("i"), -F.col("j"))).alias("tree"))
        for r in best.collect():  # at most four rows
            values = [round(r.tree["values"].get(leaf, 0.0), 9) for leaf in range(4)]
            model.trees[KINDS[r.kind]].append((r.tree.i, r.tree.j, values))
    scored = cells.where("NOT training").select("kind", model.score(F.col("kind"), F.col("features")).alias("score"), "n", "hits")
    levels = scored.where("score IS NOT NULL").groupBy("kind", F.floor(F.col("score") * 1000).alias("level"))
    by_kind: dict[int, list] = {}
    for r in levels.agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect():  # at most 4,000 rows
        by_kind.setdefault(r.kind, []).append((r.level, r.n, r.hits))
    for kind, rows in by_kind.items():
        n = hits = 0
        name = KINDS[kind]
        open_ = {True, False} - ({False} if name in NECESSARY else set())
        for level, n, hits in _bands(rows, band_rows):
            share, chance = _lower_bound(hits, n), CHANCE[name]
            right = {False: share, True: (share - chance) / ((1 - chance) * share) if share > chance else 0.0}
            open_ = {passing for passing in open_ if right[passing] >= precision}
            model.thresholds |= {(name, passing): level / 1000 for passing in open_}
    return model


# ---- choosing spans ------------------------------------------------------------------------


def choose_spans(spans: DataFrame, model: SpanModel) -> DataFrame:
    """One row per document and text: doc_id, text_hash and ``spans`` (kind, start, stop, base, score) in order.

    Base spans all stay. Of the accepted candidates the best go first: by score, then length, then kind, then place; one
    that overlaps a base span or a chosen one goes.
    """
    place = ["doc_id", "text_hash", "kind", "start", "stop", "base"]
    found = spans.select(*place, "passed", model.score(F.col("kind"), F.col("features")).alias("score"))
    found = found.where(F.col("base") | model.accepted(F.col("kind"), F.col("passed"), F.col("score")))
    found = found.select(*place, F.when(~F.col("base"), F.col("score")).alias("score"))
    found = found.distinct()  # repeated rows, and generators that propose the same
    in_order = W.partitionBy("doc_id", "text_hash").orderBy("start", "stop", "kind", "base")
    reached = F.max("stop").over(in_order.rowsBetween(W.unboundedPreceding, -1))
    cluster = F.sum(F.when(F.col("start") < F.col("reached"), 0).otherwise(1)).over(in_order.rowsBetween(W.unboundedPreceding, 0))
    clustered = found.withColumn("reached", reached).withColumn("cluster", cluster)
    ranked = F.struct(
        (~F.col("base")).alias("added"), (-F.col("score")).alias("worse"), (F.col("start") - F.col("stop")).alias("shorter"),
        "kind", "start", "stop", "base", "score",
    )
    grouped = clustered.groupBy("doc_id", "text_hash", "cluster").agg(F.sort_array(F.collect_list(ranked)).alias("ranked"))
    none = F.filter("ranked", lambda s: F.lit(False))
    overlaps = lambda a, b: (a["start"] < b["stop"]) & (b["start"] < a["stop"])
    taken = lambda done, s: F.when(s["base"] | ~F.exists(done, lambda d: overlaps(d, s)), F.concat(done, F.array(s))).otherwise(done)
    kept = grouped.select("doc_id", "text_hash", F.aggregate("ranked", none, taken).alias("kept"))
    flat = F.array_sort(F.flatten(F.collect_list(F.transform("kept", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"), s["base"].alias("base"), s["score"].alias("score"))))))
    return kept.groupBy("doc_id", "text_hash").agg(flat.alias("spans"))


def personal_data(
    docs: DataFrame,
    model: SpanModel | None = None,
    precision: float = 0.85,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the column ``spans``: array of (start, kind, stop, base, score) by start, then kind; kinds are numbers
    in :data:`KINDS`, positions code points, the end exclusive, and ``score`` is null for base spans.

    Without a ``model`` one is trained on all candidates of the documents themselves (:func:`fit_model`). A null or empty text has no
    spans. Rows with one id and one text get the same spans, as do rows with a null id; rows and all other columns stay as
    they are, except that an existing column ``spans`` is replaced. An empty table stays empty.
    """
    spans = stage(find_spans(docs, id_col, text_col), "spans")
    if model is None:
        model = fit_model(spans, precision=precision)
    chosen = stage(choose_spans(spans, model), "chosen").withColumnsRenamed({"doc_id": "__doc", "text_hash": "__hash", "spans": "__spans"})
    # the hash is taken before the join, so that the text only moves where it is asked for
    hashed = docs.drop("spans").withColumn("__text_hash", F.xxhash64(F.col(f"`{text_col}`")))
    joined = hashed.join(chosen, F.col(f"`{id_col}`").eqNullSafe(F.col("__doc")) & (F.col("__text_hash") == F.col("__hash")), "left")
    others = [F.col(f"`{c}`") for c in docs.columns if c != "spans"]
    return joined.select(*others, F.coalesce("__spans", F.array().cast(chosen.schema["__spans"].dataType)).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first names the place."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit("").alias("done"))

    def step(state: Column, s: Column) -> Column:
        between = F.substring(text, (state["upto"] + 1).cast("int"), (s["start"] - state["upto"]).cast("int"))
        new = F.concat(state["done"], between, F.get(names, s["kind"]))
        return F.struct(
            F.greatest(state["upto"], s["stop"]).alias("upto"), F.when(s["start"] >= state["upto"], new).otherwise(state["done"]).alias("done")
        )

    finish = lambda state: F.concat(state["done"], F.substring(text, (state["upto"] + 1).cast("int"), F.char_length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, finish))

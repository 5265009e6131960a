"""Log-bilinear language model, trained in numpy by noise-contrastive estimation.

Every frequent word is a class of its own; all other words share classes by their last two bytes; the end of a text is a
class. The model predicts the class of a token from the classes of the three tokens before it: the context vector is
``sum_j w[j] * r[c_j]``, the score of a class ``q . context + b``, and a softmax over all classes normalises
it (batched products of tables, one for each place). Within a shared class a word has its add-one share of the class, where
one more share stands for all words never seen. So the probabilities of all tokens add up to one.

Training is data parallel: every partition runs stochastic gradient steps from the same start on its own texts, and the
parameters are averaged by the number of tokens, round by round. Every training text takes steps in one of the rounds. Noise words come from the class distribution
and are shared by a minibatch. Counts cover all training texts.

The words are counted exactly. Up to ``known_words`` of the most frequent ones go to all tasks as a table of bounded size;
occurrences of the rest are joined to their counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.llm.common import pick, rows_of, word_chunks
from sheetloom.session import stage

CONTEXT = 3
END = 0  # the class of the end of a text; also stands before its first token


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shape = pa.schema({"token": pa.binary(), "n": pa.int64()})
    counts: Counter[bytes] = Counter()
    for part in rows_of(batches):
        for text in part["text"]:
            for tokens in word_chunks(text):
                counts.update(tokens)
        if len(counts) > 1 << 19:
            yield pa.RecordBatch.from_pydict({"token": list(counts), "n": list(counts.values())}, schema=shape)
            counts.clear()
    yield pa.RecordBatch.from_pydict({"token": list(counts), "n": list(counts.values())}, schema=shape)


def token_hash(token: bytes) -> int:
    """As Spark's ``xxhash64`` of the same bytes."""
    value = xxhash.xxh64_intdigest(token, seed=42)
    return value - (1 << 64) if value >> 63 else value


@dataclass(frozen=True)
class Vocabulary:
    """Counts and classes. ``words``: known word -> its place in ``class_of`` and ``count_of``."""

    words: dict[bytes, int]
    class_of: np.ndarray
    count_of: np.ndarray
    endings: dict[bytes, int]
    n_single: int  # classes below are END and single words, classes from here on are shared
    class_tokens: np.ndarray
    class_words: np.ndarray
    n_texts: int

    @property
    def n_tokens(self) -> int:
        return int(self.class_tokens.sum())

    @property
    def n_words(self) -> int:
        """Distinct tokens; the end is one."""
        return int(self.class_words.sum())

    @property
    def n_classes(self) -> int:
        return len(self.class_tokens)

    def shared_class(self, token: bytes) -> int:
        return self.endings.get(token[-2:], self.n_classes - 1)

    def places(self, tokens: list[bytes]) -> np.ndarray:
        """Places of the words, -1 for those not known."""
        return np.fromiter(map(self.words.get, tokens, repeat(-1)), np.int64, len(tokens))

    def classes(self, tokens: list[bytes], places: np.ndarray) -> np.ndarray:
        found = self.class_of[places] if len(self.class_of) else np.zeros(len(places), np.int64)
        for k in np.flatnonzero(places < 0):
            found[k] = self.shared_class(tokens[k])
        return found


def count_words(texts: DataFrame) -> DataFrame:
    """token (binary) and n over all rows of ``texts`` (column text), staged."""
    counted = texts.select("text").mapInArrow(_count_words, "token binary, n long")
    return stage(counted.groupBy("token").agg(F.sum("n").alias("n")), "word-counts")


def build_vocabulary(counts: DataFrame, n_texts: int, singles: int = 191, shared: int = 64, known_words: int = 1 << 18) -> Vocabulary:
    """The classes, and the most frequent words, at most ``known_words`` besides the single ones.

    Words are known down to a count that is found from a histogram of counts, so that no more than the known
    ones ever reach the driver. Ties among the single words go by their bytes.
    """
    first = [(bytes(r.token), r.n) for r in counts.orderBy(F.desc("n"), "token").limit(singles).collect()]
    level = F.floor(F.log2("n") * 16).cast("int")
    sizes = {r.level: r["count"] for r in counts.groupBy(level.alias("level")).count().collect()}  # 16 for each power of two
    taken, least = 0, 1 << 30
    for at in sorted(sizes, reverse=True):
        taken += sizes[at]
        if taken > known_words:
            break
        least = at
    frequent = counts.where(level >= least).toArrow()
    known = dict(zip(frequent["token"].to_pylist(), frequent["n"].to_pylist()))
    for token, _ in first:
        known.pop(token, None)
    known = first + sorted(known.items(), key=lambda x: (-x[1], x[0]))
    ending = F.substring("token", -2, 2)
    single = [token for token, _ in known[:singles]]
    # one row per pair of bytes at most
    every = counts.groupBy(ending.alias("ending")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    tokens, words = Counter(), Counter()
    for r in every:
        tokens[bytes(r.ending)], words[bytes(r.ending)] = r.n, r.words
    for token, n in known[:singles]:
        tokens[token[-2:]] -= n
        words[token[-2:]] -= 1
    frequent = sorted((e for e in tokens if words[e] > 0), key=lambda e: (-tokens[e], e))[: shared - 1]
    n_single = 1 + len(single)
    endings = {e: n_single + k for k, e in enumerate(frequent)}
    class_tokens, class_words = np.zeros(n_single + len(frequent) + 1, np.int64), np.zeros(n_single + len(frequent) + 1, np.int64)
    class_tokens[END], class_words[END] = n_texts, int(n_texts > 0)
    class_tokens[1:n_single], class_words[1:n_single] = [n for _, n in known[:singles]], 1
    for e in tokens:
        at = endings.get(e, len(class_tokens) - 1)
        class_tokens[at] += tokens[e]
        class_words[at] += words[e]
    class_of = [1 + k if k < len(single) else endings.get(t[-2:], len(class_tokens) - 1) for k, (t, _) in enumerate(known)]
    return Vocabulary(
        {t: k for k, (t, _) in enumerate(known)}, np.array(class_of, np.int64), np.array([n for _, n in known], np.int64),
        endings, n_single, class_tokens, class_words, n_texts,
    )


@dataclass
class LogBilinear:
    """Parameters: r and q (classes x size), w (context x size), b (classes)."""

    r: np.ndarray
    q: np.ndarray
    w: np.ndarray
    b: np.ndarray

    @classmethod
    def start(cls, probabilities: np.ndarray, size: int = 16, seed: int = 11) -> LogBilinear:
        """Small random vectors; the biases give the class distribution, so that training starts from it."""
        rng = np.random.default_rng(seed)
        n = len(probabilities)
        shape = [(n, size), (n, size), (CONTEXT, size)]
        r, q, w = ((rng.standard_normal(s) * 0.1).astype(np.float32) for s in shape)
        return cls(r, q, w + np.float32(1 / CONTEXT), np.log(probabilities).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.r, self.q, self.w, self.b)]).astype(np.float64)

    def unflat(self, values: np.ndarray) -> LogBilinear:
        parts, at = [], 0
        for x in (self.r, self.q, self.w, self.b):
            parts.append(values[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return LogBilinear(*parts)

    def tables(self, most_classes: int = 1024) -> tuple[list[np.ndarray], list[np.ndarray]] | None:
        """What each place of the context adds to the score of each class, and the exponentials of that; the biases belong to
        the last place. None with more than ``most_classes``, or where products of the exponentials might not fit."""
        if len(self.b) > most_classes:
            return None
        terms = [(self.r * w) @ self.q.T for w in self.w]
        terms[-1] += self.b
        return (terms, [np.exp(t) for t in terms]) if sum(np.abs(t).max() for t in terms) < 60 else None

    def log10(self, before: np.ndarray, targets: np.ndarray, tables: tuple | None = None, batch: int = 1024) -> np.ndarray:
        """Normalised log10 probabilities of ``targets`` after the classes ``before`` (n x 3).

        A score is the sum of a term for each place, so its exponential is a product out of :meth:`tables` (made here
        unless given). Without these, scores come from a matrix product, less the largest of a row.
        """
        out = np.empty(len(targets), np.float64)
        tables = tables or self.tables()
        weighted = [self.r * w for w in self.w]
        for at in range(0, len(targets), batch):
            places, chosen = before[at : at + batch].T, targets[at : at + batch]
            if tables:
                score = sum(t[c, chosen] for t, c in zip(tables[0], places))
                first, second, third = (t[c] for t, c in zip(tables[1], places))
                total = np.log(np.einsum("nc,nc->n", np.multiply(first, second, out=first), third))
            else:
                scores = sum(t[c] for t, c in zip(weighted, places)) @ self.q.T + self.b
                scores -= scores.max(axis=1, keepdims=True)
                score = scores[np.arange(len(chosen)), chosen]
                total = np.log(np.exp(scores).sum(axis=1))
            out[at : at + batch] = (score - total) / math.log(10)
        return out

    def nce_step(self, before: np.ndarray, targets: np.ndarray, noise: np.ndarray, log_noise: np.ndarray, past: LogBilinear, rate: float) -> None:
        """One minibatch: each target against all ``noise`` classes; ``log_noise``: log(k * noise probability) by
        class; ``past``: sums of squared gradients, changed in place (AdaGrad)."""
        from_r, from_q, vectors = self.r[before], self.q[targets], self.q[noise]
        h = np.einsum("ncs,cs->ns", from_r, self.w)
        true = _sigmoid(np.einsum("ns,ns->n", h, from_q) + self.b[targets] - log_noise[targets]) - 1
        false = _sigmoid(h @ vectors.T + (self.b[noise] - log_noise[noise]))
        to_h = true[:, None] * from_q + false @ vectors
        scale = np.float32(1 / len(targets))
        n, size = self.q.shape
        q = _summed(np.concatenate([targets, noise]), np.concatenate([true[:, None] * h, false.T @ h]), n)
        b = np.bincount(targets, true, n) + np.bincount(noise, false.sum(axis=0), n)
        r = _summed(before.ravel(), (to_h[:, None] * self.w).reshape(-1, size), n)
        w = np.einsum("ns,ncs->cs", to_h, from_r)
        for mine, sums, gradient in ((self.r, past.r, r), (self.q, past.q, q), (self.w, past.w, w), (self.b, past.b, b)):
            gradient = gradient.astype(np.float32) * scale
            sums += gradient * gradient
            mine -= rate * gradient / (np.sqrt(sums) + np.float32(1e-6))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.clip(x, -30, 30, out=x)
    np.exp(np.negative(x, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _summed(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    size = rows.shape[1]
    flat = (index[:, None] * size + np.arange(size)).ravel()
    return np.bincount(flat, rows.ravel(), n * size).reshape(n, size)


def contexts(classes: np.ndarray) -> np.ndarray:
    """The three classes before each token of a text (END before the first)."""
    padded = np.concatenate([np.full(CONTEXT, END, classes.dtype), classes])
    return np.stack([padded[CONTEXT - 1 - j : len(padded) - 1 - j] for j in range(CONTEXT)], axis=1)


def _class_sequence(vocabulary: Vocabulary, text: str | None) -> np.ndarray:
    parts = [vocabulary.classes(tokens, vocabulary.places(tokens)) for tokens in word_chunks(text)]
    return np.concatenate([*parts, [END]]).astype(np.int64)


def train(texts: DataFrame, vocabulary: Vocabulary, rounds: int = 4, noise: int = 64, batch: int = 2048, rate: float = 0.05) -> LogBilinear:
    """Train on ``texts`` (doc_id, text); they are dealt to the rounds by a hash of id and text, so each takes its steps in
    one round."""
    if not vocabulary.n_texts:
        return LogBilinear.start(np.ones(vocabulary.n_classes) / vocabulary.n_classes)
    probabilities = (vocabulary.class_tokens + 1) / (vocabulary.n_tokens + vocabulary.n_classes)
    model = LogBilinear.start(probabilities)
    context = texts.sparkSession.sparkContext
    words = context.broadcast(vocabulary)
    for number in range(rounds):
        start = context.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], number: int = number) -> Iterator[pa.RecordBatch]:
            vocabulary, mine = words.value, start.value.unflat(start.value.flat())
            past = mine.unflat(np.full(mine.flat().size, 1e-4))
            log_noise = (np.log(probabilities) + math.log(noise)).astype(np.float32)
            rng = np.random.default_rng(number)
            befores, targets, waiting, seen = [], [], 0, 0

            def step(least: int) -> None:
                nonlocal befores, targets, waiting, seen
                if waiting < least:
                    return
                before, target = np.concatenate(befores), np.concatenate(targets)
                order = rng.permutation(len(target))
                for at in range(0, len(order), batch):
                    chosen = order[at : at + batch]
                    drawn = rng.choice(len(probabilities), noise, p=probabilities)
                    mine.nce_step(before[chosen], target[chosen], drawn, log_noise, past, rate)
                seen += waiting
                befores, targets, waiting = [], [], 0

            for part in rows_of(batches):
                for text in part["text"]:
                    classes = _class_sequence(vocabulary, text)
                    befores.append(contexts(classes))
                    targets.append(classes)
                    waiting += len(classes)
                    step(1 << 16)
            step(1)
            if seen:
                yield pa.RecordBatch.from_pydict({"values": [mine.flat() * seen], "seen": [seen]}, schema=_TRAINED)

        taken = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == number).select("text")
        trained = stage(taken.mapInArrow(run, "values array<double>, seen long"), "trained")
        seen = trained.agg(F.sum("seen").alias("seen")).first().seen
        if seen:
            sums = trained.select(F.posexplode("values")).groupBy("pos").agg(F.sum("col").alias("total"))
            flat = np.zeros(model.flat().size)
            for r in sums.collect():  # one row per parameter
                flat[r.pos] = r.total / seen
            model = model.unflat(flat)
    return model


_TRAINED = pa.schema({"values": pa.list_(pa.float64()), "seen": pa.int64()})

_SCORED = pa.schema({
    "n_tokens": pa.int64(), "n_known": pa.int64(), "log_counts": pa.float64(), "log_model": pa.float64(),
    "rare": pa.list_(pa.int64()),
})


def _score(vocabulary: Vocabulary, model: LogBilinear, texts: list[str | None], tables: tuple | None = None) -> pa.RecordBatch:
    """Sums over known words for each text, and the hashes of the others. ``log_model`` lacks their log10(c + 1)."""
    out: dict[str, list] = {name: [] for name in _SCORED.names}
    log_count = np.log10(vocabulary.count_of + 1.0)
    # what log10(c + 1) of a word in a shared class is reduced by
    total = np.log10(vocabulary.class_tokens + vocabulary.class_words + 1.0)
    total[: vocabulary.n_single] = 0.0
    befores, targets, ends = [], [], []
    for text in texts:
        parts, rare, known, counts, own = [], [], 0, 0.0, 0.0
        for tokens in word_chunks(text):
            places = vocabulary.places(tokens)
            parts.append(vocabulary.classes(tokens, places))
            rare += [token_hash(tokens[k]) for k in np.flatnonzero(places < 0)]
            places = places[places >= 0]
            known += len(places)
            counts += log_count[places].sum() if len(places) else 0.0
            inside = places[vocabulary.class_of[places] >= vocabulary.n_single] if len(places) else places
            own += log_count[inside].sum() if len(inside) else 0.0
        classes = np.concatenate([*parts, [END]]).astype(np.int64)
        befores.append(contexts(classes))
        targets.append(classes)
        ends.append(len(classes))
        out["n_tokens"].append(len(classes))
        out["n_known"].append(known + (vocabulary.n_texts > 0))
        out["log_counts"].append(counts + math.log10(vocabulary.n_texts + 1))
        out["log_model"].append(own - total[classes].sum())
        out["rare"].append(rare)
    by_token = model.log10(np.concatenate(befores), np.concatenate(targets), tables)
    starts = np.concatenate([[0], np.cumsum(ends)[:-1]])
    out["log_model"] = (np.array(out["log_model"]) + np.add.reduceat(by_token, starts)).tolist()
    return pa.RecordBatch.from_pydict(out, schema=_SCORED)


def score_texts(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """Train on the rows where ``training`` holds and score all rows.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigram) and score (the model), both
    log10 probabilities of the whole text with its end. A null or empty text is the end alone. Rows are
    scored one by one, so repeated rows and ids are repeated in the result; a null ``training`` is held out. Without
    training rows all classes are equally likely. ``settings`` go to :func:`build_vocabulary`.
    """
    train_row = F.coalesce(training, F.lit(False))
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), (~train_row).alias("held_out"))
    texts = plain.where(~F.col("held_out"))
    counts = count_words(texts)
    vocabulary = build_vocabulary(counts, texts.count(), **settings)
    model = train(texts, vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value[1].tables()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                found = _score(*shared.value, part.column(2).to_pylist(), tables)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *found.columns], ["doc_id", "held_out", *_SCORED.names])

    kind = docs.schema[id_col].dataType.simpleString()
    shape = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, log_counts double, log_model double, rare array<long>"
    scored = plain.select("doc_id", "held_out", "text").mapInArrow(run, shape)
    scored = stage(scored.withColumn("row", F.monotonically_increasing_id()), "scored")

    occurrences = scored.select("row", F.explode("rare").alias("word"))
    by_hash = counts.select(F.xxhash64("token").alias("word"), "n")
    rare = occurrences.join(by_hash, "word").groupBy("row").agg(F.sum(F.log10(F.col("n") + 1)).alias("log_rare"), F.count(F.lit(1)).alias("seen"))
    every = scored.drop("rare").join(rare, "row", "left")
    log_rare = F.coalesce("log_rare", F.lit(0.0))
    base = F.log10(F.lit(float(vocabulary.n_tokens + vocabulary.n_words + 1))) if vocabulary.n_words else F.lit(0.0)
    return every.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.n_tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + log_rare - F.col("n_tokens") * base).alias("base_score"),
        (F.col("log_model") + log_rare).alias("score"),
    )

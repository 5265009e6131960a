"""Packing: optimal length buckets and token-budget batches.

Texts are cut into pieces of at most ``max_tokens`` tokens, so there are at most that many lengths and their histogram over all
pieces is of bounded size. Dynamic programming over it finds the bucket boundaries with the least total padding.
Within a bucket a batch holds as many pieces as fit the token budget at the bucket's length.

To number pieces without gathering a bucket in one task, every bucket is dealt by hash into shards of about
``shard_rows`` pieces and batches form inside a shard; each shard has at most one batch that is not full.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetloom.llm.common import pick
from sheetloom.session import stage


def token_count(text: Column) -> Column:
    """Words of a text and one end token; 1 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long") + 1


def best_boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` length buckets with the least total padding, ascending; the last is the largest length.

    Exact: ``best[k][j]`` is the least padding of the j smallest lengths in k buckets. Of equal choices the one with
    the smallest boundary is taken.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[x] for x in lengths.tolist()], dtype=np.float64)
    many = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    n, buckets = len(lengths), min(buckets, len(lengths))
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    came = np.zeros((buckets + 1, n + 1), dtype=np.int64)
    for k in range(1, buckets + 1):
        now = np.full(n + 1, np.inf)
        for j in range(k, n + 1):
            cost = best[:j] + lengths[j - 1] * (many[j] - many[:j]) - (tokens[j] - tokens[:j])
            came[k, j] = int(cost.argmin())
            now[j] = cost[came[k, j]]
        best = now
    ends, j = [], n
    for k in range(buckets, 0, -1):
        ends.append(int(lengths[j - 1]))
        j = int(came[k, j])
    return ends[::-1]


def pack(
    docs: DataFrame,
    max_tokens: int = 2048,
    buckets: int = 8,
    batch_tokens: int = 16_384,
    shard_rows: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start_token, n_tokens, bucket (padded length), shard, batch, slot.

    Tokens are the words of a text and its end, so a null or empty text is one piece of one token; every token is in
    exactly one piece. Rows with one id, and rows with a null id, are packed as separate texts. (bucket, shard, batch) names a batch: its
    pieces times ``bucket`` is at most ``batch_tokens``. An empty table gives an empty result.
    """
    if batch_tokens < max_tokens:
        raise ValueError("batch_tokens must hold a piece of max_tokens")
    counted = pick(docs, doc_id=id_col, text=text_col).select("doc_id", token_count(F.col("text")).alias("tokens"))
    piece = F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / max_tokens).cast("int")))
    pieces = counted.select("doc_id", "tokens", piece.alias("piece"), F.monotonically_increasing_id().alias("row"))
    start = F.col("piece").cast("long") * max_tokens
    pieces = pieces.select("doc_id", "piece", "row", start.alias("start_token"), F.least(F.lit(max_tokens), F.col("tokens") - start).alias("n_tokens"))
    pieces = stage(pieces, "pieces")
    histogram = {r.n_tokens: r["count"] for r in pieces.groupBy("n_tokens").count().collect()}  # at most max_tokens rows
    bounds = best_boundaries(histogram, buckets)
    bucket, shards, capacity = F.lit(None).cast("long"), F.lit(1), F.lit(1)
    for low, high in reversed(list(zip([0, *bounds], bounds))):
        held = sum(n for length, n in histogram.items() if low < length <= high)
        fit = batch_tokens // high
        per_shard = fit * math.ceil(shard_rows / fit)  # a whole number of batches
        inside = F.col("n_tokens") <= high
        bucket = F.when(inside, F.lit(high).cast("long")).otherwise(bucket)
        shards = F.when(inside, F.lit(math.ceil(held / per_shard))).otherwise(shards)
        capacity = F.when(inside, F.lit(fit)).otherwise(capacity)
    dealt = pieces.select("*", bucket.alias("bucket"), F.pmod(F.xxhash64("doc_id", "piece", "row"), shards).cast("int").alias("shard"), capacity.alias("capacity"))
    order = Window.partitionBy("bucket", "shard").orderBy("doc_id", "piece", "row")
    ranked = dealt.withColumn("rank", F.row_number().over(order) - 1)
    return ranked.select(
        "doc_id", "piece", "start_token", "n_tokens", "bucket", "shard",
        F.floor(F.col("rank") / F.col("capacity")).cast("long").alias("batch"),
        (F.col("rank") % F.col("capacity")).cast("int").alias("slot"),
    )


def padding(histogram: dict[int, int], bounds: list[int]) -> int:
    """Padding tokens when every length goes to the next boundary."""
    return sum(n * (min(b for b in bounds if b >= length) - length) for length, n in histogram.items())

"""Packing into optimal length buckets with batches under a token budget.

Documents are cut into pieces of at most ``max_len`` words. Dynamic programming over the histogram of all piece lengths
(at most ``max_len`` entries, whatever the input) chooses the bucket bounds that minimise padding. Each bucket's pieces
are numbered in a seeded order, and every ``batch_tokens // bound`` consecutive pieces form one batch, padded to the
bound.

Defined results: a null or empty text gives one piece of length 0 in bucket 0, without a batch; rows with equal ids are
packed each on its own; an empty table gives no rows. Pieces of one document keep their order in ``piece``. Of bounds that
pad equally the choice is the same on every run; pieces of equal seeded order go by id and piece.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smeltwork.llm.common import n_words, only, text_of


@dataclass(frozen=True)
class PackOptions:
    """``group_rows`` is the mean number of pieces that one numbering group holds."""

    max_len: int = 2048
    buckets: int = 12
    batch_tokens: int = 65_536
    group_rows: int = 8192
    seed: int = 23


def best_bounds(counts: dict[int, int], buckets: int) -> list[int]:
    """Bucket bounds of least total padding; each bound is a length that occurs, the last the longest."""
    lengths = np.array(sorted(counts), dtype=np.int64)
    if not len(lengths):
        return []
    number = np.array([counts[n] for n in lengths.tolist()], dtype=np.float64)
    n_before = np.r_[0.0, np.cumsum(number)]
    tokens_before = np.r_[0.0, np.cumsum(number * lengths)]
    # cost of a bucket over lengths[i:j] is bound * count - tokens, with bound lengths[j-1]
    best = np.full(len(lengths) + 1, np.inf)
    best[0] = 0.0
    choices = []
    for _ in range(min(buckets, len(lengths))):
        ahead, choice = np.full_like(best, np.inf), np.zeros(len(best), dtype=np.int64)
        for j in range(1, len(lengths) + 1):
            cost = best[:j] + lengths[j - 1] * (n_before[j] - n_before[:j]) - (tokens_before[j] - tokens_before[:j])
            choice[j] = int(np.argmin(cost))
            ahead[j] = cost[choice[j]]
        choices.append(choice)
        best = ahead
    bounds, j = [], len(lengths)
    for choice in reversed(choices):
        bounds.append(int(lengths[j - 1]))
        j = int(choice[j])
    return bounds[::-1]


def pieces_of(docs: DataFrame, options: PackOptions, id_column: str, text_column: str) -> DataFrame:
    sized = only(docs, doc_id=id_column, text=text_column).select(
        "doc_id", n_words(F.col("text")).alias("n"), F.xxhash64(text_of(F.col("text"))).alias("tie")
    )
    last = F.greatest(F.ceil(F.col("n") / options.max_len) - 1, F.lit(0)).cast("int")
    return sized.select("doc_id", "n", "tie", F.explode(F.sequence(F.lit(0), last)).alias("piece")).select(
        "doc_id", "piece", "tie",
        F.least(F.lit(options.max_len), F.col("n") - F.col("piece") * options.max_len).cast("int").alias("n_tokens"),
    )


def pack(docs: DataFrame, options: PackOptions = PackOptions(), id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, n_tokens, bucket_len, batch, slot``."""
    pieces = pieces_of(docs, options, id_column, text_column)
    counts = {row["n_tokens"]: row["n"] for row in pieces.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    bounds = best_bounds({n: c for n, c in counts.items() if n > 0}, options.buckets)
    bucket, groups = F.lit(0), F.lit(1)
    for bound in reversed(bounds):
        bucket = F.when(F.col("n_tokens") <= bound, bound).otherwise(bucket)
    lower = 0
    for bound in bounds:
        held = sum(c for n, c in counts.items() if lower < n <= bound)
        groups = F.when(F.col("bucket_len") == bound, max(1, -(-held // options.group_rows))).otherwise(groups)
        lower = bound
    bucket = F.when(F.col("n_tokens") == 0, 0).otherwise(bucket)
    placed = (
        pieces.withColumn("bucket_len", bucket.cast("int"))
        .withColumn("mixed", F.xxhash64(F.lit(options.seed), "doc_id", "piece"))
        .withColumn("part", F.pmod(F.col("mixed"), groups.cast("long")))
    )
    real = placed.where("n_tokens > 0")
    held = real.groupBy("bucket_len", "part").agg(F.count("*").alias("held"))
    before = Window.partitionBy("bucket_len").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("bucket_len", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("bucket_len", "part").orderBy("mixed", "doc_id", "piece", "n_tokens", "tie")
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(options.batch_tokens) / F.col("bucket_len")))
    numbered = (
        real.withColumn("rank", F.row_number().over(inside) - 1)
        .join(starts, ["bucket_len", "part"])
        .withColumn("at", F.col("start") + F.col("rank"))
        .select("doc_id", "piece", "n_tokens", "bucket_len",
                F.floor(F.col("at") / per_batch).cast("long").alias("batch"),
                (F.col("at") % per_batch).cast("int").alias("slot"))
    )
    blank = placed.where("n_tokens = 0").select(
        "doc_id", "piece", "n_tokens", "bucket_len", F.lit(None).cast("long").alias("batch"),
        F.lit(None).cast("int").alias("slot"))
    return numbered.unionByName(blank)

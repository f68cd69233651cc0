"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is cut into blocks of documents by a seeded hash. A source's target fixes how often each of its blocks is
taken; every take is one unit. The units of all sources are then dealt to output shards: a binary tree halves the shard
range, and each left half draws its share of every source's remaining units from the multivariate hypergeometric
distribution, so the quotas of the leaves add up exactly. A shard takes as many consecutive units of a source's
seeded permutation as its quota says, and orders its documents by a seeded hash.

Any number of sources will do. They are numbered in code point order and put into ``groups``; the driver splits the units
of the groups, and for each group a task splits its quotas among its sources, by the same tree. Drawing groups first and
then sources given the groups' draws has the same distribution as drawing sources at once.

Defined results: a null text has no words; null is a source of its own, last in order; rows with equal ids are separate
documents that share a block; an empty table gives an empty mix. A document without words is taken like its block and
adds nothing. A very long text counts with all its words, and is one document of its block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltwork.llm.common import n_words, whole_row
from smeltwork.operators.surrogate import number_rows
from smeltwork.session import Scratch

_UNITS = "_number long, _block long, _rank long, _group int"
_PLACES = "_number long, _block long, _copy int, _shard long"


@dataclass(frozen=True)
class MixOptions:
    """``weights`` repeat over the sources in code point order.

    ``blocks_per_source`` sets the grain: raise it with the number of output shards wanted, which is
    the words over ``shard_words``, and ``least_shards`` at least, so that readers can share the work.
    The driver holds one number for each shard and each of the ``groups`` of sources.
    """

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    most_repeats: int = 3
    blocks_per_source: int = 1024
    shard_words: int = 20_000_000
    least_shards: int = 8
    groups: int = 64
    seed: int = 17


def with_targets(sources: DataFrame, options: MixOptions) -> DataFrame:
    """``sources`` (``_number`` from 1, ``words``) with ``_target``.

    Shares by weight stop at a multiple of the source's size and the excess is shared again. The share of a unit of weight
    only grows, so each round asks which sources are full at the share of the round before; one row for each of the
    weights comes back from it.
    """
    turn = F.pmod(F.col("_number") - 1, F.lit(len(options.weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in options.weights]), turn + 1)
    most = options.most_repeats * F.col("words")
    unit, before = 0.0, -1
    while True:
        full = most < F.lit(unit) * weight
        rows = sources.groupBy(turn.alias("turn")).agg(
            F.sum("words").alias("words"), F.sum(F.when(full, most)).alias("kept"), F.count_if(full).alias("full"),
            F.count_if(~full).alias("free")).collect()
        stopped = sum(row["full"] for row in rows)
        free = sum(row["free"] * options.weights[row["turn"]] for row in sorted(rows, key=lambda row: row["turn"]))
        if stopped == before or not free:
            return sources.withColumn("_target", F.when(full, most).otherwise(F.lit(unit) * weight))
        unit = (sum(row["words"] for row in rows) - sum(row["kept"] or 0 for row in rows)) / free
        before = stopped


def block_copies(words: np.ndarray, order: np.ndarray, target: float, most: int) -> np.ndarray:
    """How often each block is taken: whole passes, then blocks in permuted order as long as they fit the rest."""
    total = int(words.sum())
    if total == 0:
        return np.zeros(len(words), dtype=np.int64)
    passes = min(most, math.floor(target / total + 1e-9))
    copies = np.full(len(words), passes, dtype=np.int64)
    left = target - passes * total
    if passes == most or left <= 0:
        return copies
    skipped = []
    for block in order:
        if words[block] <= left:
            copies[block] += 1
            left -= words[block]
        else:
            skipped.append(block)
    if skipped:
        best = min(skipped, key=lambda block: abs(left - words[block]))
        if abs(left - words[best]) < left:
            copies[best] += 1
    return copies


def split_quotas(units: np.ndarray, sizes: np.ndarray, seed: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, colours, their quotas above 0): ``units`` of each colour dealt to shards of ``sizes`` units in all.

    Recursive multivariate-hypergeometric halving; only colours that a half still holds are carried into it.
    """
    ends = np.r_[0, np.cumsum(sizes)].tolist()
    waiting = [(0, len(sizes), np.arange(len(units)), units.astype(np.int64))]
    while waiting:
        first, count, colours, rest = waiting.pop()
        colours, rest = colours[rest > 0], rest[rest > 0]
        if not len(colours):
            continue
        if count == 1:
            yield first, colours, rest
            continue
        left = count // 2
        rng = np.random.default_rng([*seed, first, count])
        # Draw colour by colour: each count is hypergeometric given what the earlier colours took.
        wanted, behind = ends[first + left] - ends[first], int(rest.sum())
        drawn = np.zeros(len(rest), dtype=np.int64)
        for i, have in enumerate(rest.tolist()):
            if not wanted:
                break
            behind -= have
            drawn[i] = _hypergeometric(rng, have, behind, wanted)
            wanted -= int(drawn[i])
        waiting += [(first, left, colours, drawn), (first + left, count - left, colours, rest - drawn)]


def _even(total: int, shards: int) -> np.ndarray:
    """Sizes of shards that differ by one at most."""
    return np.diff([total * i // shards for i in range(shards + 1)]).astype(np.int64)


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """``rng.hypergeometric`` takes populations below 1e9; beyond it the distribution is inverted.

    Chances follow from the ratio of each to the one before, over 12 standard deviations either way; what lies beyond has
    a chance below 1e-30.
    """
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, sample))
    total = good + bad
    mean = sample * good / total
    reach = 12 * math.sqrt(mean * (bad / total) * ((total - sample) / (total - 1))) + 12
    low = max(0, sample - bad, math.floor(mean - reach))
    high = min(good, sample, math.ceil(mean + reach))
    k = np.arange(low, high, dtype=np.float64)
    ratio = np.log(good - k) + np.log(sample - k) - np.log(k + 1) - np.log(bad - sample + k + 1)
    log_chance = np.r_[0.0, np.cumsum(ratio)]
    reached = np.cumsum(np.exp(log_chance - log_chance.max()))
    return low + int(np.searchsorted(reached, rng.random() * reached[-1], side="right"))


def _permuted(seed: int, blocks: np.ndarray) -> np.ndarray:
    """Positions of the blocks in a seeded random order that does not depend on how rows arrive."""
    with np.errstate(over="ignore"):
        mixed = (blocks.astype(np.uint64) + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.lexsort((blocks, mixed ^ (mixed >> np.uint64(32))))


def mix(docs: DataFrame, options: MixOptions = MixOptions(), id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source") -> DataFrame:
    """``_row`` (the row of ``docs``), ``_size, _source_size, _target, _places`` (array of copy number and shard)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, keep=True)
    marked = docs.select(
        whole_row(docs),
        n_words(F.col(f"`{text_column}`")).alias("_size"),
        F.col(f"`{source_column}`").cast("string").alias("_source"),
        F.pmod(F.xxhash64(F.lit(options.seed), F.col(f"`{id_column}`")), F.lit(options.blocks_per_source)).alias("_block"),
    )
    words = scratch.store(marked.groupBy("_source", "_block").agg(F.sum("_size").alias("words")), "mix-blocks")
    sizes = words.groupBy(F.col("_source").alias("_s")).agg(F.sum("words").alias("words"))
    numbered = number_rows(sizes.withColumn("_last", F.col("_s").isNull()), ["_last", "_s"], "_number", scratch=scratch).rows
    sources = scratch.store(
        with_targets(numbered, options).select("_s", "_number", F.col("words").alias("_source_size"), "_target"), "mix-sources")
    # A source has at most blocks_per_source rows here, so none is hot.
    blocks = scratch.store(words.join(sources, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s"), "mix-plan")
    seed, most, groups = options.seed, options.most_repeats, options.groups

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_block").reset_index(drop=True)
        numbers = group["_block"].to_numpy()
        order = _permuted(seed, numbers)
        copies = block_copies(group["words"].to_numpy(), order, float(group["_target"].iloc[0]), most)
        taken = np.repeat(numbers, copies)
        source = int(group["_number"].iloc[0])
        return pd.DataFrame({"_number": np.full(len(taken), source), "_block": taken,
                             "_rank": np.argsort(_permuted(seed + 1, taken * 8 + _number_in_run(taken))),
                             "_group": np.full(len(taken), source % groups, dtype=np.int32)})

    units = scratch.store(
        blocks.select("_number", "_block", "words", "_target").groupBy("_number").applyInPandas(choose, _UNITS), "mix-units")
    drawn = dict(units.groupBy("_group").agg(F.count("*").alias("n")).collect())  # one row for each group of sources
    total = sum(drawn.values())
    planned = blocks.agg(F.sum("words")).first()[0] or 0
    shards = max(1, min(total, max(options.least_shards, math.ceil(planned / options.shard_words))))
    names = sorted(drawn)
    quotas = np.zeros((len(names), shards), dtype=np.int64)
    for shard, found, quota in split_quotas(np.array([drawn[name] for name in names]), _even(total, shards), [seed]):
        quotas[found, shard] = quota
    shares = spark.createDataFrame(
        [(name, row.tolist()) for name, row in zip(names, quotas)], "_group int, _quotas array<bigint>")

    def place(group: pd.DataFrame, share: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_number", "_block", "_rank"]).reset_index(drop=True)
        numbers, of, counts = np.unique(group["_number"].to_numpy(), return_inverse=True, return_counts=True)
        of_group = [seed, int(share["_group"].iloc[0]) + 1]
        parts = list(split_quotas(counts, np.asarray(share["_quotas"].iloc[0], dtype=np.int64), of_group))
        shard = np.repeat([part[0] for part in parts], [len(part[1]) for part in parts])
        colour, quota = (np.concatenate([part[i] for part in parts]) for i in (1, 2))
        order = np.lexsort((shard, colour))
        dealt = np.repeat(shard[order], quota[order])  # the shard of every rank, source after source
        before = np.cumsum(counts) - counts
        block = group["_block"].to_numpy()
        return pd.DataFrame({"_number": group["_number"], "_block": block,
                             "_copy": _number_in_run(of * options.blocks_per_source + block),
                             "_shard": dealt[before[of] + group["_rank"].to_numpy()]})

    places = (
        units.groupBy("_group").cogroup(shares.groupBy("_group")).applyInPandas(place, _PLACES)
        .groupBy(F.col("_number").alias("_n"), F.col("_block").alias("_b"))
        .agg(F.array_sort(F.collect_list(F.struct("_copy", "_shard"))).alias("_places"))
    )
    empty = F.array().cast("array<struct<_copy:int,_shard:bigint>>")
    drawn_blocks = blocks.join(places, (F.col("_number") == F.col("_n")) & (F.col("_block") == F.col("_b")), "left").select(
        F.col("_source").alias("_s"), F.col("_block").alias("_b"), "_source_size", "_target",
        F.coalesce("_places", empty).alias("_places"))
    same = F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b"))
    return marked.join(drawn_blocks, same).drop("_s", "_b", "_block")


def _number_in_run(sorted_values: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... within each run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, dtype=np.int32)
    starts = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    return (np.arange(len(sorted_values)) - np.repeat(starts, np.diff(np.r_[starts, len(sorted_values)]))).astype(np.int32)


def order_of(place: Column, options: MixOptions = MixOptions(), id_column: str = "doc_id") -> Column:
    """Where a take stands in the local shuffle of its shard."""
    return F.xxhash64(F.lit(options.seed), F.col(f"_row.`{id_column}`"), place["_copy"], place["_shard"])


def mixed_rows(mixed: DataFrame, options: MixOptions = MixOptions(), id_column: str = "doc_id") -> DataFrame:
    """``_row, _shard, _order`` of every take; ``_order`` is its place in the shard's local shuffle."""
    taken = mixed.select("_row", F.explode("_places").alias("_place"))
    order = order_of(F.col("_place"), options, id_column)
    return taken.select("_row", F.col("_place._shard").alias("_shard"), order.alias("_order"))


def in_order(mixed: DataFrame, options: MixOptions = MixOptions(), id_column: str = "doc_id") -> DataFrame:
    """``_row`` of every take, laid out shard after shard, each in the order of its local shuffle."""
    rows = mixed_rows(mixed, options, id_column)
    return rows.repartitionByRange("_shard", "_order").sortWithinPartitions("_shard", "_order").select("_row")


def write_shards(mixed: DataFrame, path: str, options: MixOptions = MixOptions(), id_column: str = "doc_id") -> None:
    """Write one folder per shard, each locally shuffled."""
    rows = mixed_rows(mixed, options, id_column)
    (rows.repartition("_shard").sortWithinPartitions("_shard", "_order").select("_shard", "_row.*")
     .write.partitionBy("_shard").parquet(path))

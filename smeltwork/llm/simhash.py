"""SimHash near-duplicates found by pigeonring filtering.

A fingerprint is cut into ``max_bits + 1`` segments on a ring. If two fingerprints differ in at most ``max_bits`` bits,
some segment starts a chain in which the differences of the first l segments, summed, stay within l shares of the
budget, for every l. So a pair is a candidate only if it agrees on a whole segment, differs by at most one bit in the
next (hence agrees on one half of it), by at most two in the first three, and so on. Equal fingerprints meet first;
each distinct one is listed under (segment, half of the next segment), and the rest of the chain is checked before the
full Hamming distance. What a task finds leaves it as a spanning star per local component, never as all pairs; a bucket
over ``block_rows`` is dealt out as pairs of blocks.

Defined results: null and empty texts, and texts without words, have fingerprint zero and are linked like any other;
fewer words than a shingle make one shingle of all words; rows with equal ids are separate documents; a component's id
is its smallest doc_id that is not null (null if it has none); an empty table gives no rows. Very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltwork.llm.common import only, text_of, whole_row
from smeltwork.llm.components import components, local_stars
from smeltwork.session import Scratch


@dataclass(frozen=True)
class SimHashOptions:
    shingle: int = 4
    max_bits: int = 4
    block_rows: int = 4096


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The fingerprint as an unsigned number."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z, only ASCII space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], 42) for s, e in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist())]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_in = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        found = [fingerprint_of(t if isinstance(t, str) else None, shingle) for t in texts]
        return pd.Series(np.array(found, dtype=np.uint64).view(np.int64))

    return prints(text)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of each of the ring's segments."""
    count = max_bits + 1
    edges = [64 * i // count for i in range(count + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(count)]


def _bucket_keys(prints: Column, max_bits: int) -> Column:
    """Two keys for each segment: the segment and either half of the one after it, with their numbers in front."""
    ring = segments(max_bits)
    keys = []
    for i, (first, width) in enumerate(ring):
        after, after_width = ring[(i + 1) % len(ring)]
        low = after_width // 2
        for half, (start, size) in enumerate([(after, low), (after + low, after_width - low)]):
            whole = F.shiftrightunsigned(prints, first).bitwiseAND(F.lit((1 << width) - 1))
            part = F.shiftrightunsigned(prints, start).bitwiseAND(F.lit((1 << size) - 1))
            keys.append(F.xxhash64(F.lit(2 * i + half), whole, part))
    return F.array(*keys)


def _close(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs hold the chain condition from some segment on, and lie within ``max_bits``."""
    apart = a ^ b
    ring = segments(max_bits)
    parts = [np.bitwise_count((apart >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int16)
             for first, width in ring]
    chained = np.zeros(len(a), dtype=bool)
    for start in range(len(ring)):
        total, holds = np.zeros(len(a), dtype=np.int16), np.ones(len(a), dtype=bool)
        for length in range(1, len(ring)):
            total = total + parts[(start + length - 1) % len(ring)]
            holds &= total * len(ring) <= length * max_bits
        chained |= holds
    near = np.flatnonzero(chained)
    found = np.zeros(len(a), dtype=bool)
    found[near] = np.bitwise_count(apart[near]) <= max_bits
    return found


def _run_links(key: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars over the links within runs of equal keys."""
    left, right = [], []
    step = 1
    at = np.arange(len(key))
    while True:
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        if not len(at):
            break
        a, b = prints[at], prints[at + step]
        hit = _close(a.view(np.uint64), b.view(np.uint64), max_bits) & (a != b)
        left.append(a[hit])
        right.append(b[hit])
        step += 1
    if not left:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return local_stars(np.concatenate(left), np.concatenate(right))


def links(prints: DataFrame, options: SimHashOptions, scratch: Scratch) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints of ``prints (fp long)`` within ``max_bits``."""
    max_bits = options.max_bits
    listed = prints.select("fp", F.explode(_bucket_keys(F.col("fp"), max_bits)).alias("key"))
    # A bucket beyond one block is dealt out: every pair of its blocks meets once.
    large = (
        listed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > options.block_rows)
        .select(F.col("key").alias("_key"), F.ceil(F.col("n") / options.block_rows).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64(F.lit(1), "fp"), F.coalesce("blocks", F.lit(1))).cast("int")
    others = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    dealt = (
        listed.join(scratch.store(large, "large-buckets"), F.col("key") == F.col("_key"), "left")
        .withColumn("own", own).withColumn("other", F.explode(others))
        .select("fp", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"))
    )

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            key = np.concatenate([held_key, np.asarray(batch.column("key"))])
            fp = np.concatenate([held, np.asarray(batch.column("fp"))])
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last run may go on in the next batch
            held_key, held = key[cut:], fp[cut:]
            a, b = _run_links(key[:cut], fp[:cut], max_bits)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        a, b = _run_links(held_key, held, max_bits)
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(find, "a long, b long")


def near_duplicates(docs: DataFrame, options: SimHashOptions = SimHashOptions(), id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id, group, tie`` of every row.

    ``group`` names the component by one of its fingerprints, ``tie`` is a digest of the text.
    """
    scratch = Scratch(docs.sparkSession, keep=True)
    hashed = only(docs, doc_id=id_column, text=text_column).select(
        "doc_id", F.xxhash64(text_of(F.col("text"))).alias("tie"), fingerprint(F.col("text"), options.shingle).alias("fp"))
    hashed = scratch.store(hashed, "fingerprints")
    distinct = scratch.store(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = components(links(distinct.select("fp"), options, scratch), scratch)
    grouped = distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("group"))
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    named = scratch.store(grouped.join(least, "group").select(F.col("fp").alias("_fp"), "group", "component_id"), "groups")
    return hashed.join(named, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group", "tie")


def one_per_group(docs: DataFrame, options: SimHashOptions = SimHashOptions(), id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id (ties: by digest of the text)."""
    found = near_duplicates(docs, options, id_column, text_column)
    stays = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("least"))
    # Digests of id and text are never null: one shuffle serves the join and the window.
    stays = stays.select(F.xxhash64("least.doc_id").alias("own"), F.col("least.tie").alias("tie"))
    whole = docs.select(
        whole_row(docs), F.xxhash64(F.col(f"`{id_column}`")).alias("own"),
        F.xxhash64(text_of(F.col(f"`{text_column}`"))).alias("tie"))
    repeated = Window.partitionBy("own", "tie").orderBy(F.xxhash64("_row"))
    kept = whole.join(stays, ["own", "tie"], "left_semi").withColumn("n", F.row_number().over(repeated))
    return kept.where("n = 1").select("_row.*")

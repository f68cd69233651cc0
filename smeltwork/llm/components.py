"""Connected components of links, by alternating large and small stars, with every step a join or an aggregation.

Links between near copies are many, so each task first replaces the links it holds by a spanning star per local
component. Then large-star and small-star rounds run until nothing changes; each round is written to the shared folder.
A hub with many links is never gathered: its smallest neighbour comes from a partial aggregation and goes back by a
join, which Spark may split.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltwork.session import Scratch


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for every node that is not the smallest one itself."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], least)
        np.minimum.at(root, root[right], least)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        if np.array_equal(before, root):
            break
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _thin(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = local_stars(np.asarray(batch.column(0)), np.asarray(batch.column(1)))
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, root`` for every node in ``links (a long, b long)``; the root is the component's smallest node.

    Nodes without links are not listed; null ends must not occur.
    """
    thin = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInArrow(_thin, "a long, b long")
    stars = scratch.store(thin.distinct(), "links")
    state = _state(stars)
    while True:
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        large = (
            both.join(least, F.col("a") == F.col("u"))
            .where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .where("a <> b").distinct()
        )
        below = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        joined = large.join(below, F.col("a") == F.col("u"))
        small = joined.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        stars = scratch.store(small.select("e.*").where("a <> b").distinct(), "links")
        now = _state(stars)
        if now == state:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def _state(stars: DataFrame) -> tuple:
    """A digest of the set of links, the same whatever the order of rows."""
    digest = F.xxhash64("a", "b")
    return tuple(stars.agg(F.count("*"), F.sum(digest % (1 << 40)), F.bit_xor(digest)).first())

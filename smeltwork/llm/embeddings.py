"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

A bounded sample of vectors is projected on its principal axes; iterative quantisation then learns the rotation that
brings the projections closest to their signs. Bits follow the angle seen from the code's middle. That is the sample's
mean, which balances the bits, if the mean is so near the origin that no pair's angle grows much by it. Otherwise, as
with one dominant group or a common direction, it is the origin: seen from a mean inside a group, its near copies lie far
apart. With more bits wanted than dimensions, further rotations start from other seeds. Every vector gets a binary code,
each table lists the vectors by one substring of it, and vectors whose substrings differ by one bit at most are
candidates: each vector also goes to the neighbouring substrings above its own. Candidates are compared with the original
vectors by cosine in double precision, so no link below the limit is made. A pair that meets in several tables counts in
the first. Equal vectors are grouped before; a bucket over ``block_rows`` is dealt out as pairs of blocks. What leaves a
bucket is a count per vector and a spanning star per local component, never its pairs. Lengths beyond the
``max_lengths`` commonest get no code: all their vectors of one length are compared.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of
different lengths never link; rows with equal ids are separate vectors; a null id is ignored in a component's smallest
id unless all are null; an empty table gives no rows. Vectors are told apart by a 64-bit digest.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltwork.llm.common import only
from smeltwork.llm.components import components, local_stars
from smeltwork.session import Scratch


@dataclass(frozen=True)
class ItqOptions:
    """``sample`` bounds the vectors the rotation is learned from; every vector is indexed.

    ``tables`` substrings of ``table_bits`` bits: more bits make smaller buckets, more tables find more. With 12 tables
    of 10 bits and neighbours probed, a pair at cosine 0.9 (14 % of bits differ) is missed about once in 20,000 by the
    estimate for random planes. Raise both with the number of vectors. ``most_shift`` is the length up to which a mean of
    the unit vectors is the middle: at 0.1 at most 16 % of bits differ, and one such pair in 5,000 is missed.
    """

    cosine: float = 0.9
    tables: int = 12
    table_bits: int = 10
    sample: int = 20_000
    rounds: int = 40
    block_rows: int = 2048
    max_lengths: int = 16
    most_shift: float = 0.1
    seed: int = 3


@dataclass(frozen=True)
class ItqCode:
    middle: np.ndarray
    axes: np.ndarray

    def bits(self, unit: np.ndarray) -> np.ndarray:
        return (unit - self.middle) @ self.axes >= 0


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.maximum(np.abs(vectors).max(axis=1, keepdims=True), np.finfo(np.float64).tiny)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def learn_code(vectors: np.ndarray, options: ItqOptions, most_shift: float = np.inf) -> ItqCode:
    """Projections and rotations for ``tables * table_bits`` bits; a mean over ``most_shift`` long is not the middle."""
    unit = unit_rows(vectors)
    middle = unit.mean(axis=0)
    if np.linalg.norm(middle) > most_shift:
        middle = np.zeros_like(middle)
    _, _, axes = np.linalg.svd(unit - middle, full_matrices=False) if len(unit) >= unit.shape[1] else (
        None, None, np.eye(unit.shape[1]))
    wanted, found = options.tables * options.table_bits, []
    while sum(part.shape[1] for part in found) < wanted:
        rng = np.random.default_rng([options.seed, len(found)])
        projection = axes.T
        values = (unit - middle) @ projection
        rotation, _ = np.linalg.qr(rng.normal(size=(values.shape[1], values.shape[1])))
        for _ in range(options.rounds):
            signs = np.where(values @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(signs.T @ values)
            rotation = (left @ right).T
        found.append(projection @ rotation)
    return ItqCode(middle, np.hstack(found)[:, :wanted])


def substrings(bits: np.ndarray, options: ItqOptions) -> np.ndarray:
    """The value of each table's substring, one column per table."""
    weights = 1 << np.arange(options.table_bits)
    return bits.reshape(len(bits), options.tables, options.table_bits) @ weights


def _run_links(table: int, across: bool, own: np.ndarray, home: np.ndarray, unit: np.ndarray, parts: np.ndarray,
               limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of one bucket, one of them at home in it, that pass the limit and did not meet in an earlier table."""
    def near(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i, j = np.nonzero(unit[first] @ unit[second].T >= limit)
        return first[i], second[j]

    if across:  # two blocks: only pairs between them
        low = own == own.min()
        if low.all():
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        found = near(np.flatnonzero(low & home), np.flatnonzero(~low)), near(
            np.flatnonzero(low & ~home), np.flatnonzero(~low & home))
        i, j = (np.concatenate(ends) for ends in zip(*found))
    else:
        i, j = near(np.flatnonzero(home), np.arange(len(home)))
        once = (i < j) | ~home[j]
        i, j = i[once], j[once]
    fresh = np.ones(len(i), dtype=bool)
    for earlier in range(table):
        fresh &= np.bitwise_count(parts[i, earlier] ^ parts[j, earlier]) > 1
    return i[fresh], j[fresh]


def near_vectors(vectors: DataFrame, options: ItqOptions = ItqOptions(), id_column: str = "vec_id",
                 vector_column: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, keep=True)
    rows = only(vectors, vec_id=id_column, vector=vector_column)
    # Buckets carry floats where the table has floats; all sums are in double precision.
    exact = "array<float>" if rows.schema["vector"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("vector", lambda x: x != 0)
    node = F.when(F.coalesce(good, F.lit(False)), F.xxhash64("vector"))
    marked = rows.withColumn("node", node)
    distinct = scratch.store(
        marked.where("node IS NOT NULL").groupBy("node").agg(
            F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.any_value("vector").alias("vector"))
        .withColumn("length", F.size("vector")), "distinct-vectors")
    by_count = distinct.groupBy("length").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "length")
    counts = by_count.limit(options.max_lengths + 1).collect()
    common, more = counts[:options.max_lengths], len(counts) > options.max_lengths
    found = spark.createDataFrame([], "a long, b long, n long")
    for count in common:
        alike = distinct.where(F.col("length") == count["length"])
        listed = _listed(alike, int(count["n"]), int(count["length"]), exact, options)
        found = found.union(_links(listed, exact, options, scratch))
    if more:
        found = found.union(_links(_listed_whole(
            distinct.where(~F.col("length").isin([count["length"] for count in common])), exact), exact, options, scratch))
    found = scratch.store(found, "vector-links")
    linked = found.where("b IS NULL").groupBy(F.col("a").alias("_a")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b IS NOT NULL").select("a", "b"), scratch)
    grouped = (
        distinct.drop("vector").join(linked, F.col("node") == F.col("_a"), "left")
        .join(roots.withColumnRenamed("node", "_b"), F.col("node") == F.col("_b"), "left")
        .select("node", "least", F.coalesce("root", "node").alias("root"),
                (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    named = scratch.store(grouped, "vector-groups")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(least, "root").select(F.col("node").alias("_node"), "n_links", "component")
    return marked.select("vec_id", "node").join(named, F.col("node") == F.col("_node"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(True)).alias("kept"),
    )


def _listed_whole(distinct: DataFrame, exact: str) -> DataFrame:
    """Every vector at home in the one bucket of its length."""
    return distinct.select("node", "copies", F.col("vector").cast(exact).alias("vector"), F.array("length").alias("parts"),
                           F.lit(0).alias("table"), F.col("length").alias("part"), F.lit(True).alias("home"))


def _listed(distinct: DataFrame, total: int, length: int, exact: str, options: ItqOptions) -> DataFrame:
    """Every vector by table at home in its own bucket, and a guest in the buckets above that are one bit away."""
    share = min(1 << 30, (1 << 30) * options.sample // max(1, total) + 1)
    picked = distinct.where(F.pmod(F.xxhash64(F.lit(options.seed), "node"), F.lit(1 << 30)) < share)
    sample = picked.select("node", "vector").toArrow().sort_by("node").column("vector").combine_chunks()
    vectors = np.asarray(sample.flatten()).reshape(-1, length) if len(sample) else np.eye(length)
    code, tables = learn_code(vectors, options, options.most_shift), options.tables

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                unit = unit_rows(np.asarray(batch.column("vector").flatten()).astype(np.float64).reshape(-1, length))
                parts = substrings(code.bits(unit), options).astype(np.int32)
                yield pa.record_batch([
                    batch.column("node"), batch.column("copies"), batch.column("vector"),
                    pa.ListArray.from_arrays(np.arange(0, parts.size + 1, tables, dtype=np.int32), pa.array(parts.ravel())),
                ], ["node", "copies", "vector", "parts"])

    coded = distinct.select("node", "copies", F.col("vector").cast(exact).alias("vector")).mapInArrow(
        encode, f"node long, copies long, vector {exact}, parts array<int>")
    above = F.filter(
        F.transform(F.array(*[F.lit(1 << bit) for bit in range(options.table_bits)]), lambda bit: F.col("own_part").bitwiseOR(bit)),
        lambda part: part != F.col("own_part"))
    return (
        coded.select("*", F.posexplode("parts").alias("table", "own_part"))
        .select("*", F.explode(F.concat(F.array("own_part"), above)).alias("part"))
        .withColumn("home", F.col("part") == F.col("own_part")).drop("own_part")
    )


def _links(listed: DataFrame, exact: str, options: ItqOptions, scratch: Scratch) -> DataFrame:
    """Rows (a, null, n): a has n linked copies in some bucket; rows (a, b, null): stars that connect what is linked."""
    limit = options.cosine
    large = scratch.store(
        listed.groupBy("table", "part").agg(F.count("*").alias("n")).where(F.col("n") > options.block_rows)
        .select(F.col("table").alias("_t"), F.col("part").alias("_p"),
                F.ceil(F.col("n") / options.block_rows).cast("int").alias("blocks")), "large-buckets")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = (
        listed.join(large, (F.col("table") == F.col("_t")) & (F.col("part") == F.col("_p")), "left")
        .withColumn("own", F.pmod(F.xxhash64(F.lit(1), "node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("table", "own", (F.col("own") != F.col("other")).alias("across"), "home", "node", "copies", "vector", "parts",
                F.xxhash64("table", "part", F.least("own", "other"), F.greatest("own", "other")).alias("key"))
    )

    def pair_up(table: pa.Table) -> Iterator[pa.RecordBatch]:
        key = table.column("key").to_numpy()
        edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if end - start < 2:
                continue
            run = table.slice(start, end - start).combine_chunks()
            home = run.column("home").to_numpy()
            if not home.any():
                continue
            unit = unit_rows(run.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(home), -1))
            parts = run.column("parts").combine_chunks().flatten().to_numpy().reshape(len(home), -1)
            i, j = _run_links(run.column("table")[0].as_py(), run.column("across")[0].as_py(), run.column("own").to_numpy(),
                              home, unit, parts, limit)
            if len(i):
                node, copies = run.column("node").to_numpy(), run.column("copies").to_numpy()
                n = np.bincount(i, weights=copies[j], minlength=len(node)) + np.bincount(j, weights=copies[i], minlength=len(node))
                has = np.flatnonzero(n)
                a, b = local_stars(node[i], node[j])
                yield pa.record_batch([
                    pa.array(np.r_[node[has], a]), pa.array([None] * len(has) + b.tolist(), pa.int64()),
                    pa.array(n[has].astype(np.int64).tolist() + [None] * len(a), pa.int64()),
                ], ["a", "b", "n"])

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last key, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            key = table.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            held = table.slice(cut)
            yield from pair_up(table.slice(0, cut))
        if held is not None:
            yield from pair_up(held)

    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(find, "a long, b long, n long")

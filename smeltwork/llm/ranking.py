"""Ranked lexical search over norm buckets, as LEMP does for inner products.

A document is the vector of its impacts, an item the vector of its terms' weights, and a score their inner product. The
vectors hold only terms of the items, are ordered by length (their norm) over the whole table and cut into buckets of
neighbours. For every item a bucket is passed over if the Cauchy-Schwarz bound, norm of the item times the longest norm of
the bucket, or the sum of the bucket's greatest coordinates, stays below the item's threshold. Inside a bucket the item's
coordinates are read in order of what they can add, until what the others can add stays below the threshold; only
documents whose part so far plus that bound reaches it survive. Survivors are scored exactly in integers.

A threshold is the score of the k-th best document met: first of a hash sample of about ``seed_rows`` documents, which any
document of the answer must reach, then of the documents of the task. All bounds are upper bounds, so results are whole.
The items are a stated query set. They go to the tasks in blocks of about ``block_chars`` characters of text, each with a
pass over the documents; an item of a longer text has more.

Defined results: null and empty texts have no terms, give no rows and count for nothing; equal scores go by ascending id,
null last; rows with equal ids are separate documents, items with equal ids are separate items; an item none of whose terms
occur has no rows; an empty table gives no rows; long texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltwork.llm.common import only, text_of
from smeltwork.session import Scratch

#: Over UTF-8 bytes: letters, digits and every byte of a character outside ASCII.
_TERM = rb"[0-9a-z\x80-\xff]+"
_MORE = 1.0 + 1e-9  # bounds are floating-point sums


@dataclass(frozen=True)
class RankOptions:
    k: int = 20
    bucket_rows: int = 4096
    seed_rows: int = 20_000
    block_chars: int = 1 << 24


@dataclass(frozen=True)
class _Item:
    """Terms by number in order, their weights times their repeats, and the norm of these."""

    terms: np.ndarray
    weights: np.ndarray


def terms_of(text: str | None) -> list[bytes]:
    return re.findall(_TERM, (text or "").encode("utf-8", "replace").lower())  # bytes: only A-Z


def _vectors(texts: DataFrame, vocabulary: dict[bytes, int], kind: str) -> DataFrame:
    """``id, n, terms, tfs`` of every document with a term; only terms of the vocabulary are listed."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            keep, n, terms, tfs = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = terms_of(text)
                if found:
                    counts = Counter(found)
                    own = sorted((vocabulary[term], counts[term]) for term in counts.keys() & known)
                    keep.append(i)
                    n.append(len(found))
                    terms.append([term for term, _ in own])
                    tfs.append([tf for _, tf in own])
            if keep:
                yield pa.record_batch(
                    [batch.column("id").take(pa.array(keep, pa.int32())), pa.array(n, pa.int64()),
                     pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], ["id", "n", "terms", "tfs"])

    return texts.mapInArrow(counted, f"id {kind}, n long, terms array<int>, tfs array<long>")


def _impacts(vectors: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """``id, terms, impacts, norm``; documents without a term of the items go."""
    m = F.expr(f"{100 - 25} + ((25 * n * {n_docs}L) div {n_terms}L)")
    impact = F.expr("transform(tfs, tf -> (1000000000L * tf) div (1000L * tf + 12L * m))")
    square = F.aggregate("impacts", F.lit(0.0), lambda sum_, x: sum_ + x.cast("double") * x)
    return (
        vectors.where(F.size("terms") > 0).withColumn("m", m).withColumn("impacts", impact)
        .select("id", "terms", "impacts", F.sqrt(square).alias("norm"))
    )


def _search_bucket(rows: pa.Table, items: list[_Item], floor: list[int], keep: Callable) -> None:
    """Gives ``keep`` the survivors of one bucket: number of the item, numbers of the rows, exact scores."""
    norms = rows.column("norm").to_numpy()
    lists = rows.column("terms").combine_chunks()
    offsets = np.asarray(lists.offsets)
    flat = np.asarray(lists.values)[offsets[0]: offsets[-1]]
    values = rows.column("impacts").combine_chunks()
    impacts = np.asarray(values.values)[values.offsets[0].as_py(): values.offsets[-1].as_py()]
    ends = offsets - offsets[0]
    row = np.repeat(np.arange(len(norms)), np.diff(ends))
    by_term = np.argsort(flat, kind="stable")
    present, begins = np.unique(flat[by_term], return_index=True)
    if not len(present):
        return
    begins = np.r_[begins, len(flat)]
    posting_row, posting = row[by_term], impacts[by_term]
    greatest = np.maximum.reduceat(posting, begins[:-1]).astype(np.float64)
    longest = float(norms.max())
    dense = np.zeros(int(present[-1]) + 1, dtype=np.int64)
    for number, item in enumerate(items):
        place = np.searchsorted(present, item.terms)
        here = (place < len(present)) & (present[np.minimum(place, len(present) - 1)] == item.terms)
        if not here.any():
            continue
        place, weights = place[here], item.weights[here]
        threshold = max(floor[number], 1)
        if math.sqrt(float(np.square(weights, dtype=np.float64).sum())) * longest * _MORE < threshold:
            continue  # Cauchy-Schwarz
        most = weights * greatest[place]
        order = np.argsort(-most, kind="stable")
        place, weights, most = place[order], weights[order], most[order]
        # What the coordinates from each one on can add: by their greatest values, and by Cauchy-Schwarz.
        by_sum = np.r_[np.cumsum(most[::-1])[::-1], 0.0] * _MORE
        by_norm = np.sqrt(np.r_[np.cumsum(np.square(weights[::-1], dtype=np.float64))[::-1], 0.0]) * _MORE
        rest = np.minimum(by_sum, by_norm * longest)
        focus = int(np.argmax(rest < threshold))
        if focus == 0:
            continue
        part = np.zeros(len(norms), dtype=np.int64)
        for term, weight in zip(place[:focus].tolist(), weights[:focus].tolist()):
            of = slice(begins[term], begins[term + 1])
            part[posting_row[of]] += weight * posting[of]
        survivors = np.flatnonzero((part > 0) & (part + np.minimum(by_sum[focus], by_norm[focus] * norms) >= threshold))
        if not len(survivors):
            continue
        if focus < len(place):
            dense[present[place]] = weights
            counts = ends[survivors + 1] - ends[survivors]
            first = np.r_[0, np.cumsum(counts)[:-1]]
            at = np.arange(counts.sum()) + np.repeat(ends[survivors] - first, counts)
            exact = np.add.reduceat(dense[flat[at]] * impacts[at], first)
            dense[present[place]] = 0
        else:
            exact = part[survivors]
        enough = exact >= threshold
        keep(number, survivors[enough], exact[enough])


def _searcher(items: list[_Item], seeds: dict[int, int], kind: pa.DataType, options: RankOptions) -> Callable:
    """From vectors in descending order of norm to each task's best documents of each item."""

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = [seeds.get(number, 0) for number in range(len(items))]
        best: list[list[tuple]] = [[] for _ in items]

        def process(rows: pa.Table) -> None:
            ids = rows.column("id").combine_chunks()

            def keep(number: int, found: np.ndarray, scores: np.ndarray) -> None:
                new = ids.take(pa.array(found)).to_pylist()
                own = best[number] + [(-score, id_ is None, id_) for score, id_ in zip(scores.tolist(), new)]
                own.sort(key=lambda one: (one[0], one[1], () if one[1] else one[2]))
                best[number] = own[: options.k]
                if len(own) >= options.k:
                    floor[number] = max(floor[number], -best[number][-1][0])

            _search_bucket(rows, items, floor, keep)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = options.bucket_rows - sum(one.num_rows for one in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(one.num_rows for one in held) >= options.bucket_rows:
                    process(pa.Table.from_batches(held))
                    held = []
        if held:
            process(pa.Table.from_batches(held))
        found = [(number, id_, -score) for number, own in enumerate(best) for score, _, id_ in own]
        if found:
            columns = [pa.array(values, of) for values, of in zip(zip(*found), (pa.int32(), kind, pa.int64()))]
            yield pa.record_batch(columns, ["item", "id", "score"])

    return search


def _block(texts: DataFrame, rows: list, scratch: Scratch, options: RankOptions) -> DataFrame:
    """``item, rank, id, score`` for the items ``rows`` (id and text), numbered in order."""
    counts = [Counter(terms_of(row["text"])) for row in rows]
    vocabulary = {term: i for i, term in enumerate(dict.fromkeys(term for one in counts for term in one))}
    id_type = texts.schema["id"].dataType
    vectors = scratch.store(_vectors(texts, vocabulary, id_type.simpleString()), "rank-vectors")
    n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    schema = f"item int, id {id_type.simpleString()}, score long"
    if not n_docs:
        return vectors.sparkSession.createDataFrame([], schema)
    # At most one count for each term of the block's items.
    df = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    weight = np.zeros(len(vocabulary), dtype=np.int64)
    for term, n in zip(df.column("term").to_pylist(), df.column("df").to_pylist()):
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))
    items = []
    for one in counts:
        own = sorted((vocabulary[term], repeats) for term, repeats in one.items())
        terms = np.array([term for term, _ in own], dtype=np.int64)
        weights = weight[terms] * np.array([repeats for _, repeats in own], dtype=np.int64)
        items.append(_Item(terms[weights > 0], weights[weights > 0]))
    impacts = _impacts(vectors, n_docs, n_terms)
    arrow = vectors.select("id").limit(0).toArrow().schema.field("id").type

    # The k-th best of any documents bounds the k-th best of all from below.
    share = max(1, n_docs // options.seed_rows)
    sample = impacts.where(F.pmod(F.xxhash64("id", "norm"), F.lit(share)) == 0)
    best = sample.mapInArrow(_searcher(items, {}, arrow, options), schema)
    kth = Window.partitionBy("item").orderBy(F.desc("score"))
    ranked = best.withColumn("rank", F.row_number().over(kth)).where(F.col("rank") <= options.k)
    seeds = {row["item"]: row["score"] for row in ranked.where(F.col("rank") == options.k).collect()}

    # Equal norms, as copies have, are dealt over tasks by the digest of the id.
    order = (F.desc("norm"), F.xxhash64("id"))
    ordered = impacts.repartitionByRange(*order).sortWithinPartitions(F.desc("norm"))
    return ordered.mapInArrow(_searcher(items, seeds, arrow, options), schema)


def _item_text() -> Column:
    return text_of(F.col("text"))


def rank(items: DataFrame, docs: DataFrame, options: RankOptions = RankOptions(), item_column: str = "item_id",
         item_text: str = "text", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents."""
    spark = docs.sparkSession
    scratch = Scratch(spark, keep=True)
    asked = only(items, id=item_column, text=item_text).select("id", _item_text().alias("text"))
    texts = only(docs, id=id_column, text=text_column).select("id", text_of(F.col("text")).alias("text"))
    chars = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = chars // options.block_chars + 1
    parts = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        found = _block(texts, rows, scratch, options)
        names = spark.createDataFrame(
            [(number, row["id"]) for number, row in enumerate(rows)], f"_item int, item_id {asked.schema['id'].dataType.simpleString()}")
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= options.k)
        parts.append(top.join(names, F.col("item") == F.col("_item")).select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


#: The same result with every document scored for every item.
SQL = r"""
WITH doc_terms AS (
    SELECT row, doc_id, term, count(*) AS tf
    FROM (SELECT row, doc_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents))
    GROUP BY row, doc_id, term
), sizes AS (
    SELECT row, doc_id, sum(tf)::BIGINT AS n FROM doc_terms GROUP BY row, doc_id
), corpus AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM doc_terms, corpus GROUP BY term
), item_terms AS (
    SELECT row, item_id, term, count(*) AS repeats
    FROM (SELECT row, item_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM (SELECT row_number() OVER () AS row, item_id, text FROM benchmark))
    GROUP BY row, item_id, term
), lengths AS (
    SELECT row, doc_id, 100 - 25 + ((25 * n * docs) // terms) AS m FROM sizes, corpus
), scored AS (
    SELECT i.row AS item, i.item_id, d.row, d.doc_id,
           sum(i.repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM item_terms i JOIN weights USING (term) JOIN doc_terms d USING (term) JOIN lengths l ON l.row = d.row
    GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

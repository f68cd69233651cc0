"""Bounded samples of labelled documents, for models that are fitted on the driver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 30


@dataclass(frozen=True)
class Sample:
    """``ids``: doc_id and label of the sampled rows; ``shares``: each label's share of all usable labelled rows.

    ``known``: doc_id and label of all usable labelled rows.
    """

    ids: DataFrame
    shares: dict[int, float]
    known: DataFrame


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))), F.lit(folds))


def labelled_sample(labels: DataFrame, label: str, usable: Column, per_class: int, seed: int = 5,
                    id_column: str = "doc_id") -> Sample:
    """About ``per_class`` rows of each label 0 and 1, drawn by a hash of the id.

    Rows without id or label are left out, and so are ids whose rows disagree. The sample is the only part of the
    labels that a model sees, and ``per_class`` is its bound; shares are counted over all usable rows.
    """
    known = (
        labels.where(usable & F.col(id_column).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(id_column).alias("doc_id"))
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("other"))
        .where("label = other").drop("other")
    )
    counts = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    limit = F.lit(0)
    for value, n in counts.items():
        limit = F.when(F.col("label") == value, min(_RANGE, int(_RANGE * per_class / n) + 1)).otherwise(limit)
    drawn = known.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(_RANGE)) < limit)
    return Sample(drawn, {value: n / total for value, n in counts.items()}, known)


def sampled_texts(docs: DataFrame, sample: Sample, id_column: str, text_column: str) -> DataFrame:
    """``label, text`` of the sampled documents; the sample is small by its bound and is broadcast."""
    picked = F.broadcast(sample.ids.withColumnRenamed("doc_id", "_id"))
    texts = docs.select(F.col(f"`{id_column}`").alias("_doc"), F.col(f"`{text_column}`").alias("text"))
    return texts.join(picked, F.col("_doc") == F.col("_id")).select("_doc", "label", "text")

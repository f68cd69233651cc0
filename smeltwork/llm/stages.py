"""The pipeline's stages: each takes (spark, docs, sf_dir) and gives all but the last the columns of ``documents``.

Defined results are those of the operators: a null text is judged, cut, compared and mixed like an empty one and stays null;
rows that repeat an id are documents of their own; ties go by the operators' orders; an empty table passes through as one; very
long texts are read whole. Further columns of any name stay with their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltwork.llm import quality
from smeltwork.llm.common import table, whole_row
from smeltwork.llm.learning import fold
from smeltwork.llm.lines import dedup_lines
from smeltwork.llm.mixing import in_order, mix
from smeltwork.llm.packing import pack
from smeltwork.llm.queries import QUALITY_CUT, QUALITY_FOLD
from smeltwork.llm.simhash import one_per_group
from smeltwork.session import Scratch


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    folds, held = QUALITY_FOLD
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), folds) != held)
    scored = docs.select(whole_row(docs), quality.score(F.col("text"), model).alias("score"))
    return scored.where(F.col("score") >= QUALITY_CUT).select("_row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs are cut out of the texts; a document of which nothing is left goes."""
    cut = dedup_lines(docs).where("n_removed < n_lines")
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return cut.select(*[changed[c].alias(c) if c in changed else F.col(f"_row.`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shard after shard in their local order."""
    return in_order(mix(docs)).select("_row.*")


def pack_lengths(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document is packed."""
    return pack(docs)


def run_stages(spark: SparkSession, sf_dir: str, stages: list[tuple[str, Callable]]) -> DataFrame:
    scratch = Scratch(spark, keep=True)
    docs = table(spark, sf_dir, "documents")
    for name, stage in stages:
        docs = scratch.store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

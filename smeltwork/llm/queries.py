"""The registered queries of this subpackage: thin callers of the operators, and SQL where it can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltwork.llm import languages, lines, mixing, quality, ranking, secrets, spelling, toxicity
from smeltwork.llm.common import table
from smeltwork.llm.embeddings import near_vectors
from smeltwork.llm.learning import fold
from smeltwork.llm.mixing import mix
from smeltwork.llm.packing import pack
from smeltwork.llm.repetition import repetition_rules
from smeltwork.llm.simhash import near_duplicates
from smeltwork.llm.suffixes import remove_repeats


#: Folds and the held-out remainder of the two classifiers, and their cuts.
TOXICITY_FOLD, TOXICITY_CUT = (3, 1), 0.7
QUALITY_FOLD, QUALITY_CUT = (5, 0), 0.3
LANGUAGE_FOLD = (4, 2)


def _classified(spark: SparkSession, sf_dir: str, method, fold_of: tuple[int, int], cut: float) -> DataFrame:
    folds, held = fold_of
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = method.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), folds) != held)
    scored = docs.select(
        "doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), method.score(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def op1_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, toxicity, TOXICITY_FOLD, TOXICITY_CUT)


def op2_quality_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, quality, QUALITY_FOLD, QUALITY_CUT)


def op3_markov_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(secrets.samples_of(docs)))
    return found.select(
        "doc_id",
        *[secrets.n_of(F.col("base"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op4_itq_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(table(spark, sf_dir, "documents"))


def op6_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_line_run_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "_row.doc_id", "n_lines", "n_removed", "longest_run",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


def op8_length_bucket_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "_row.doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.size("_places")).alias("taken"),
        F.col("_places._shard").alias("shards"),
        F.transform("_places", lambda place: mixing.order_of(place)).alias("orders"),
    )


def op10_bucket_pointer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("changed"), "text")


def op11_permuterm_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds, held = LANGUAGE_FOLD
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = languages.train(docs, fold(F.col("doc_id"), folds) != held)
    judged = docs.select(
        "doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), languages.identify(F.col("text"), model).alias("_found"))
    return judged.select("doc_id", "held_out", F.col("_found.lang").alias("lang_pred"), "_found.score", "_found.mixture")


def op13_norm_bucket_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity_fm": op1_toxicity_fm,
    "op2_quality_bradley_terry": op2_quality_bradley_terry,
    "op3_markov_secret_scan": op3_markov_secret_scan,
    "op4_itq_embedding_dedup": op4_itq_embedding_dedup,
    "op5_suffix_repetition": op5_suffix_repetition,
    "op6_simhash_pigeonring": op6_simhash_pigeonring,
    "op7_line_run_dedup": op7_line_run_dedup,
    "op8_length_bucket_packing": op8_length_bucket_packing,
    "op9_source_mixing": op9_source_mixing,
    "op10_bucket_pointer_dedup": op10_bucket_pointer_dedup,
    "op11_permuterm_spelling": op11_permuterm_spelling,
    "op12_language_mixture": op12_language_mixture,
    "op13_norm_bucket_search": op13_norm_bucket_search,
}

SQL: dict[str, str] = {
    "op7_line_run_dedup": lines.SQL,
    "op11_permuterm_spelling": spelling.SQL,
    "op13_norm_bucket_search": ranking.SQL,
}

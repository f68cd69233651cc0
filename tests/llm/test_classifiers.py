import random

import pytest
from pyspark.sql import functions as F

from smeltwork.llm import quality, toxicity
from smeltwork.llm.learning import fold, labelled_sample
from smeltwork.llm.quality import BtOptions
from smeltwork.llm.queries import QUERIES
from smeltwork.llm.toxicity import FmOptions
from tests.llm.conftest import SF


def judged(docs, labels, method, options, label):
    usable = fold(F.col("doc_id"), 3) != 1
    model = method.fit(docs, labels, usable, options, label)
    return docs.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held"), method.score(F.col("text"), model).alias("s"))


def test_fm_learns_an_interaction(spark, make_docs, words):
    """Neither word alone is toxic, only both together: a linear score cannot tell."""
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        extra = ["bad"] * a + ["people"] * b
        text = (words(i, 30, 400) + " " + " ".join(extra)).split()
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(a and b)))
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = judged(make_docs(rows), table, toxicity, FmOptions(), "toxic").where("held").join(table, "doc_id").collect()
    right = sum((r["s"] >= 0.5) == bool(r["toxic"]) for r in got)
    assert right >= 0.95 * len(got) > 200


def test_fm_learns_a_pair_whose_words_alone_say_nothing(spark, make_docs, words):
    """Toxic with one of two words, clean with both or none: each word is as frequent in both classes."""
    rows, labels = [], []
    for i in range(1600):
        a, b = i % 2, i // 2 % 2
        extra = ["bad"] * a + ["people"] * b
        rows.append((i, " ".join([words(i, 12, 200), *extra])))
        labels.append((i, int(a != b)))
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = judged(make_docs(rows), table, toxicity, FmOptions(), "toxic").where("held").join(table, "doc_id").collect()
    right = sum((r["s"] >= 0.5) == bool(r["toxic"]) for r in got)
    assert right >= 0.9 * len(got) > 400, right / len(got)


def test_bradley_terry_ranks_held_out_documents(spark, make_docs, words):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        bad = rng.random() < 0.3
        text = words(i, rng.randrange(20, 400))
        rows.append((i, text.upper().replace(" ", "!! ") if bad else text))
        labels.append((i, int(not bad)))
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    got = judged(make_docs(rows), table, quality, BtOptions(), "quality").where("held").join(table, "doc_id").collect()
    assert sum((r["s"] >= 0.3) == bool(r["quality"]) for r in got) >= 0.97 * len(got) > 150


def test_quality_cut_is_the_quantile_of_all_labelled_documents(spark, make_docs, words):
    """A fit on few sampled rows still cuts off the labels' share of all labelled documents."""
    rng = random.Random(9)
    rows = [(i, words(i, rng.randrange(20, 120))) for i in range(3000)]
    table = spark.createDataFrame([(i, int(rng.random() >= 0.3)) for i, _ in rows], "doc_id long, quality int")
    docs = make_docs(rows)
    model = quality.fit(docs, table, F.lit(True), BtOptions(per_class=40, pairs=2000))
    low = docs.select(quality.score(F.col("text"), model).alias("s")).where("s < 0.3").count()
    assert abs(low - table.where("quality = 0").count()) <= 2


@pytest.mark.parametrize("method,label", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows_and_labels(spark, make_docs, odd_rows, method, label):
    docs = make_docs(odd_rows)
    schema = f"doc_id long, {label} int, other string"
    # A null id, a null label, a label out of range, an id with both labels, an id without a document
    some = spark.createDataFrame([(None, 1, "x"), (4, None, "x"), (5, 7, "x"), (8, 1, "x"), (8, 0, "x"), (77, 1, "x")], schema)
    both = some.union(spark.createDataFrame([(2, 0, "x"), (3, 0, "x"), (9, 1, "x"), (10, 1, "x")], schema))
    for labels in (some, some.limit(0), both):
        got = judged(docs, labels, method, None or (FmOptions() if method is toxicity else BtOptions(pairs=100)), label).collect()
        assert len(got) == len(odd_rows)
        assert all(0 <= r["s"] <= 1 for r in got)
    assert judged(docs.limit(0), both, method, FmOptions() if method is toxicity else BtOptions(), label).count() == 0


def test_sample_is_bounded_and_keeps_true_shares(spark):
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    sample = labelled_sample(labels, "toxic", F.lit(True), 500)
    counts = {r["label"]: r["count"] for r in sample.ids.groupBy("label").count().collect()}
    assert all(400 < n < 600 for n in counts.values())
    assert sample.shares == {0: 0.9, 1: 0.1}


@pytest.mark.parametrize("name,label,folds,held,cut", [
    ("op1_toxicity_fm", "toxic", 3, 1, 0.7), ("op2_quality_bradley_terry", "quality", 5, 0, 0.3)])
def test_queries_keep_their_contract(spark, name, label, folds, held, cut):
    got = QUERIES[name](spark, "/root/testdata/sf0.01").cache()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got.count() == docs.count()
    crc = F.crc32(F.col("doc_id").cast("string")) % folds
    assert got.where((crc == held) != F.col("held_out")).count() == 0
    assert got.where((F.col("score") >= cut).cast("int") != F.col("predicted")).count() == 0
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", label)
    held_out = got.where("held_out").join(labels, "doc_id").collect()
    wrong = sum(r["predicted"] != r[label] for r in held_out)
    assert wrong <= 0.1 * len(held_out)


def test_small_factor(spark):
    assert QUERIES["op2_quality_bradley_terry"](spark, SF).count() == 200

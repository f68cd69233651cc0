import numpy as np
import pytest
from pyspark.sql import functions as F

from smeltwork.llm.mixing import (
    MixOptions, _even, _hypergeometric, block_copies, in_order, mix, mixed_rows, split_quotas, with_targets, write_shards)
from smeltwork.llm.queries import QUERIES
from tests.llm.conftest import SF

OPTIONS = MixOptions(blocks_per_source=256, shard_words=200)


def share_out(sizes, options):
    """The rule, source by source: shares by weight, those above the limit stopped there, the rest shared again."""
    order = sorted(name for name in sizes if name is not None) + [None] * (None in sizes)
    weight = {name: options.weights[i % len(options.weights)] for i, name in enumerate(order)}
    target, left, free = {}, float(sum(sizes.values())), list(order)
    while free:
        unit = left / sum(weight[name] for name in free)
        full = [name for name in free if unit * weight[name] > options.most_repeats * sizes[name]]
        if not full:
            return target | {name: unit * weight[name] for name in free}
        for name in full:
            target[name] = float(options.most_repeats * sizes[name])
            left -= target[name]
        free = [name for name in free if name not in full]
    return target


def targets(spark, sizes):
    order = sorted(name for name in sizes if name is not None) + [None] * (None in sizes)
    rows = [(name, i + 1, sizes[name]) for i, name in enumerate(order)]
    frame = spark.createDataFrame(rows, "_s string, _number long, words long")
    return {r["_s"]: r["_target"] for r in with_targets(frame, MixOptions()).collect()}


def test_targets_stop_at_three_times_the_size_and_share_the_excess(spark):
    target = targets(spark, {"a": 10, "b": 100, "c": 100, None: 90})
    # shares 5, 2, 1, 5 of 300: a stops at 30, the others share 270 by 2, 1, 5
    assert target["a"] == 30
    assert target[None] == pytest.approx(168.75)
    assert target["b"] == pytest.approx(67.5)
    assert target["c"] == pytest.approx(33.75)
    assert sum(target.values()) == pytest.approx(300)


def test_targets_of_empty_sources(spark):
    assert targets(spark, {}) == {}
    assert targets(spark, {"a": 0, "b": 0}) == {"a": 0, "b": 0}
    assert targets(spark, {"a": 0, "b": 8}) == {"a": 0, "b": 8}


def test_targets_equal_the_rule_over_many_rounds(spark):
    rng = np.random.default_rng(2)
    sizes = {f"{i:04}": int(4 ** rng.uniform(0, 9)) for i in range(700)}
    got, want = targets(spark, sizes), share_out(sizes, MixOptions())
    assert got.keys() == want.keys()
    assert all(got[name] == pytest.approx(want[name], rel=1e-9) for name in want)
    assert sum(want[name] == 3 * sizes[name] for name in want) > 100


def test_blocks_come_near_the_target():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 50, 200)
    for target in (0.0, 10.0, words.sum() * 0.37, words.sum() * 1.0, words.sum() * 2.6, words.sum() * 3.0):
        copies = block_copies(words, rng.permutation(200), target, 3)
        assert copies.max() <= 3
        assert abs((words * copies).sum() - target) <= 25


def dense(units, sizes, seed):
    quotas = np.zeros((len(sizes), len(units)), dtype=np.int64)
    for shard, colours, quota in split_quotas(np.array(units), np.array(sizes), seed):
        quotas[shard, colours] = quota
    return quotas


def test_quotas_add_up_and_follow_the_sources():
    units = np.array([5000, 300, 0, 7])
    sizes = _even(5307, 13)
    quotas = dense(units, sizes, [4])
    assert quotas.sum(axis=0).tolist() == units.tolist()
    assert quotas.sum(axis=1).tolist() == sizes.tolist() and sizes.max() - sizes.min() <= 1
    assert abs(quotas[:, 0] - 5000 / 13).max() < 60
    assert (quotas == dense(units, sizes, [4])).all()
    assert list(split_quotas(np.zeros(0, dtype=np.int64), _even(0, 1), [0])) == []
    uneven = dense([40, 60], [5, 0, 90, 5], [1])
    assert uneven.sum(axis=0).tolist() == [40, 60] and uneven.sum(axis=1).tolist() == [5, 0, 90, 5]
    huge = dense([4 * 10**9, 10**9], _even(5 * 10**9, 4), [1])
    assert huge.sum(axis=0).tolist() == [4 * 10**9, 10**9]


def test_large_draws_follow_the_distribution():
    """Mean and spread of inverted draws from a population that numpy does not take."""
    good, bad, sample = 3 * 10**9, 10**9, 10**6
    drawn = np.array([_hypergeometric(np.random.default_rng(i), good, bad, sample) for i in range(400)])
    spread = np.sqrt(sample * 0.75 * 0.25 * (1 - sample / (good + bad)))
    assert abs(drawn.mean() - 0.75 * sample) < 4 * spread / 20
    assert 0.85 < drawn.std() / spread < 1.15
    few = [_hypergeometric(np.random.default_rng(i), 10**9, 10**9, 2) for i in range(400)]
    assert abs(few.count(0) - 100) < 40 and abs(few.count(1) - 200) < 45 and set(few) <= {0, 1, 2}
    assert _hypergeometric(np.random.default_rng(1), 2 * 10**9, 0, 7) == 7


def test_many_sources_in_few_groups(make_docs, words):
    options = MixOptions(blocks_per_source=16, shard_words=200, groups=3)
    rows = [(i, words(i, 1 + i % 9), None if i % 90 == 0 else f"s{i % 90}") for i in range(900)]
    mixed = mix(make_docs(rows), options).collect()
    sizes, taken, target = {}, {}, {}
    for r in mixed:
        name = r["_source"]
        sizes[name] = sizes.get(name, 0) + r["_size"]
        taken[name] = taken.get(name, 0) + r["_size"] * len(r["_places"])
        target[name] = r["_target"]
        assert r["_source_size"] > 0 and len(r["_places"]) <= 3
    want = share_out(sizes, options)
    assert all(target[name] == pytest.approx(want[name]) and abs(taken[name] - want[name]) <= 25 for name in want)
    shards = {}
    for block in {(r["_source"], tuple(map(tuple, r["_places"]))) for r in mixed}:
        for _, shard in block[1]:
            shards[shard] = shards.get(shard, 0) + 1
    assert len(shards) == -(-sum(sizes.values()) // 200)


def test_takes_are_disjoint_and_agree_with_targets(spark, make_docs, words):
    rows = [(i, words(i, 5 + i % 30), ["a", "b", "c", None][min(i % 7, 3)]) for i in range(300)]
    mixed = mix(make_docs(rows), OPTIONS).cache()
    by_source = mixed.groupBy("_source").agg(
        F.first("_target").alias("t"), F.first("_source_size").alias("s"), F.sum("_size").alias("size"),
        F.sum(F.col("_size") * F.size("_places")).alias("taken")).collect()
    for row in by_source:
        assert row["s"] == row["size"]
        assert row["taken"] == pytest.approx(row["t"], abs=25)
        assert row["taken"] <= 3 * row["s"]
    assert sum(r["t"] for r in by_source) == pytest.approx(sum(r["s"] for r in by_source))
    placed = {r["_row"]["doc_id"]: r["_places"] for r in mixed.collect()}
    again = {r["_row"]["doc_id"]: r["_places"] for r in mix(make_docs(rows[::-1]), OPTIONS).collect()}
    assert placed == again
    assert len({p["_shard"] for places in placed.values() for p in places}) > 5


def test_odd_rows(make_docs, odd_rows):
    mixed = mix(make_docs(odd_rows), OPTIONS)
    assert mixed.count() == len(odd_rows)
    assert mixed.where("_size = 0").count() == 4
    taken = mixed_rows(mixed, OPTIONS).select("_row.*")
    assert "extra _size" in [r["_size"] for r in taken.select("_size").distinct().collect()]
    assert mix(make_docs(odd_rows).limit(0), OPTIONS).count() == 0


def test_shards_hold_every_take(spark, make_docs, words, tmp_path):
    mixed = mix(make_docs([(i, words(i, 20), "ab"[i % 2]) for i in range(60)]).select("doc_id", "text", "source"), OPTIONS)
    write_shards(mixed, str(tmp_path / "out"), OPTIONS)
    assert spark.read.parquet(str(tmp_path / "out")).count() == mixed_rows(mixed, OPTIONS).count()


def test_copies_equal_brute_force(make_docs, words):
    """Targets, blocks and copies worked out by hand from the options' rules."""
    rows = [(i, words(i, 3 + i % 17), ["a", "b", None][min(i % 5, 2)]) for i in range(200)]
    mixed = mix(make_docs(rows), OPTIONS)
    blocks = mixed.select("_source", F.pmod(F.xxhash64(F.lit(OPTIONS.seed), "_row.doc_id"), F.lit(256)).alias("b"), "_size", "_places", "_target")
    table = blocks.toPandas()
    table["_source"] = table["_source"].fillna("~")
    for _, source in table.groupby("_source"):
        target, total = source["_target"].iloc[0], source["_size"].sum()
        passes = min(3, int(target / total + 1e-9))
        copies = source["_places"].map(len)
        assert set(copies) <= {passes, passes + 1}  # whole passes, then single blocks
        assert (source.assign(n=copies).groupby("b")["n"].nunique() == 1).all()  # a block is taken as one
        assert abs((source["_size"] * copies).sum() - target) <= source.groupby("b")["_size"].sum().max()


def test_rows_come_shard_after_shard_in_local_order(make_docs, words):
    docs = make_docs([(i, words(i, 20), "ab"[i % 2]) for i in range(80)])
    mixed = mix(docs, OPTIONS)
    laid = [r["doc_id"] for r in in_order(mixed, OPTIONS).select("_row.doc_id").collect()]
    takes = mixed_rows(mixed, OPTIONS).select("_shard", "_order", "_row.doc_id").collect()
    assert laid == [doc for _, _, doc in sorted((r["_shard"], r["_order"], r["doc_id"]) for r in takes)]
    assert laid != sorted(laid)


def test_query_splits_into_shards(spark):
    got = QUERIES["op9_source_mixing"](spark, SF).select("doc_id", "size", "taken", "shards", "orders").collect()
    assert len({shard for r in got for shard in r["shards"]}) == MixOptions().least_shards
    assert all(r["taken"] == r["size"] * len(r["shards"]) and len(r["orders"]) == len(r["shards"]) for r in got)

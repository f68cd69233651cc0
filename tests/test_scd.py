import random

import pytest
from pyspark.sql import functions as F

from smeltwork.functions.clock import BatchClock
from smeltwork.functions.hashing import packed, unpacked
from smeltwork.operators import quality, scd
from smeltwork.operators.surrogate import key_text
from smeltwork.session import Scratch, split_unsorted
from tests.conftest import plan_of, rows_of

T = [f"2024-0{month}-01 00:00:00" for month in range(1, 10)]
CLOCKS = [BatchClock.at(text, "timestamp_ntz") for text in T]
KEYS, SK = ["k"], "item_sk"
THREE = [("1", "a", "f"), ("2", "b", "f"), ("3", "c", "f")]


def batch_of(spark, rows, clock, schema="k string, v string, source_file string"):
    return scd.batch_of(spark.createDataFrame(rows, schema), KEYS, clock)


def stored(spark, merge):
    return Scratch(spark, keep=True).store(merge.rows, "dimension")


def brief(frame):
    """(sk, key, value, start month, end month or None, active) in sk order."""
    month = lambda name: F.when(F.year(name) < 9999, F.month(name))
    chosen = frame.select(SK, "k", "v", month("effective_start_date"), month("effective_end_date"), "is_active")
    return sorted((tuple(row) for row in chosen.collect()), key=lambda row: (int(row[0]), row[3]))


def test_column_order_is_part_of_the_contract(spark):
    frame = batch_of(spark, [("f", "z", "b", "1")], CLOCKS[0], "source_file string, z string, b string, k string")
    merged = scd.initial_load(frame, SK)
    assert merged.rows.columns == [
        "item_sk", "k", "b", "z", "source_file", "effective_start_date", "effective_end_date", "is_active", "hash_key",
    ]
    kinds = dict(merged.rows.dtypes)
    assert (kinds["item_sk"], kinds["is_active"], kinds["hash_key"]) == ("string", "boolean", "string")


def test_metadata_does_not_count_as_change(spark):
    first = batch_of(spark, [("1", "a", "f1")], CLOCKS[0]).staged.first().hash_key
    assert batch_of(spark, [("1", "a", "f2")], CLOCKS[1]).staged.first().hash_key == first


def test_scd1_updates_in_place_and_deletes_nothing(spark):
    old = stored(spark, scd.initial_load(batch_of(spark, THREE, CLOCKS[0]), SK))
    merged = scd.scd1(old, batch_of(spark, [("2", "B", "g"), ("3", "c", "g"), ("0", "n", "g")], CLOCKS[1]), SK)
    assert merged.inserted == 1
    assert brief(merged.rows) == [
        ("001", "1", "a", 1, None, True),
        ("002", "2", "B", 2, None, True),
        ("003", "3", "c", 2, None, True),
        ("004", "0", "n", 2, None, True),
    ]


def test_scd1_can_leave_equal_rows_alone(spark):
    old = stored(spark, scd.initial_load(batch_of(spark, [("1", "a", "f"), ("2", "b", "f")], CLOCKS[0]), SK))
    merged = scd.scd1(old, batch_of(spark, [("1", "a", "g"), ("2", "B", "g")], CLOCKS[1]), SK, skip_unchanged=True)
    assert brief(merged.rows) == [("001", "1", "a", 1, None, True), ("002", "2", "B", 2, None, True)]
    assert sorted(row.source_file for row in merged.rows.collect()) == ["f", "g"]


def test_scd2_ends_and_adds_at_one_instant(spark):
    old = stored(spark, scd.initial_load(batch_of(spark, THREE, CLOCKS[0]), SK))
    merged = scd.scd2(old, batch_of(spark, [("2", "B", "g"), ("3", "c", "g"), ("0", "n", "g")], CLOCKS[1]), SK)
    assert merged.inserted == 2
    assert brief(merged.rows) == [
        ("001", "1", "a", 1, None, True),
        ("002", "2", "b", 1, 2, False),
        ("003", "3", "c", 1, None, True),
        ("004", "0", "n", 2, None, True),
        ("005", "2", "B", 2, None, True),
    ]


def test_scd2_sparse_keys_number_the_whole_batch(spark):
    old = stored(spark, scd.initial_load(batch_of(spark, [("1", "a", "f"), ("2", "b", "f")], CLOCKS[0]), SK))
    batch = batch_of(spark, [("1", "a", "g"), ("2", "B", "g")], CLOCKS[1])
    sparse = scd.scd2(old, batch, SK, dense_sk=False)
    assert [row[0] for row in brief(sparse.rows)] == ["001", "002", "004"]


def test_scd2_close_missing(spark):
    old = stored(spark, scd.initial_load(batch_of(spark, [("1", "a", "f"), ("2", "b", "f")], CLOCKS[0]), SK))
    merged = scd.scd2(old, batch_of(spark, [("2", "b", "g")], CLOCKS[1]), SK, close_missing=True)
    assert brief(merged.rows) == [("001", "1", "a", 1, 2, False), ("002", "2", "b", 1, None, True)]
    # A closed key that comes back gets a new version with a key never used before.
    back = scd.scd2(stored(spark, merged), batch_of(spark, [("1", "a", "h")], CLOCKS[2]), SK)
    assert brief(back.rows)[-1] == ("003", "1", "a", 3, None, True)


def test_a_null_key_is_one_key(spark):
    for make in (scd.scd1, scd.scd2):
        old = stored(spark, scd.initial_load(batch_of(spark, [(None, "a", "f"), ("1", "b", "f")], CLOCKS[0]), SK))
        merged = make(old, batch_of(spark, [(None, "a", "g"), ("1", "b", "g")], CLOCKS[1]), SK)
        assert merged.inserted == 0 and merged.rows.count() == 2


def test_more_than_a_thousand_keys_stay_distinct(spark, many_slices):
    rows = [(f"{n:05d}", "v", "f") for n in range(2500)]
    old = stored(spark, scd.initial_load(batch_of(spark, rows, CLOCKS[0]), SK))
    more = [(f"{n:05d}", "v", "f") for n in range(2400, 2600)]
    merged = scd.scd2(old, batch_of(spark, more, CLOCKS[1]), SK)
    assert merged.inserted == 100
    assert merged.rows.select(SK).distinct().count() == 2600
    assert max(int(row[0]) for row in merged.rows.select(SK).collect()) == 2600


def test_switching_strategies_keeps_ended_versions(spark):
    old = stored(spark, scd.initial_load(batch_of(spark, [("1", "a", "f")], CLOCKS[0]), SK))
    second = stored(spark, scd.merge("SCD2", old, batch_of(spark, [("1", "b", "g")], CLOCKS[1]), SK))
    third = scd.merge("SCD1", second, batch_of(spark, [("1", "c", "h")], CLOCKS[2]), SK)
    assert brief(third.rows) == [("001", "1", "a", 1, 2, False), ("002", "1", "c", 3, None, True)]


def test_unknown_strategy_is_refused(spark):
    for strategy in (None, "SCD3"):
        with pytest.raises(ValueError, match="scd_strategy"):
            scd.merge(strategy, None, batch_of(spark, [("1", "a", "f")], CLOCKS[0]), SK)


def test_two_rows_for_one_key_can_be_refused(spark):
    from smeltwork.plans.control import Target
    from smeltwork.plans.gold import GoldOptions, merge_silver

    silver = spark.createDataFrame([("1", "a"), ("1", "b")], "k string, v string")
    target = Target("gold_item_dim", "item", None, "SCD1", ("k",), None, 1)
    with pytest.raises(ValueError, match="more than one row"):
        merge_silver(silver, None, target, CLOCKS[0], GoldOptions(check_keys=True))


def test_source_checks():
    with pytest.raises(ValueError, match="at least one"):
        scd.check_source(["a"], [], SK)
    with pytest.raises(ValueError, match="not in the source"):
        scd.check_source(["a"], ["k"], SK)
    for name in ("is_active", "hash_key", "effective_start_date", SK):
        with pytest.raises(ValueError, match="reserved"):
            scd.check_source(["k", name], ["k"], SK)


@pytest.mark.parametrize("strategy", ["SCD1", "SCD2"])
def test_columns_may_come_and_go(spark, strategy):
    old = stored(spark, scd.initial_load(batch_of(spark, [("1", "a", "f"), ("2", "b", "f")], CLOCKS[0]), SK))
    batch = scd.batch_of(spark.createDataFrame([("2", 7), ("3", 8)], "k string, w int"), KEYS, CLOCKS[1])
    merged = scd.merge(strategy, old, batch, SK)
    got = {(row.k, row.v, row.w) for row in merged.rows.where("is_active").collect()}
    kept = "b" if strategy == "SCD1" else None
    assert got == {("1", "a", None), ("2", kept, 7), ("3", None, 8)}
    assert dict(merged.rows.dtypes)["w"] == "int"


def _apply_by_hand(state, batch, month):
    """state: key -> [(value, start, end)]; returns the same after an SCD2 batch."""
    for key, value in batch:
        versions = state.setdefault(key, [])
        if versions and versions[-1][2] is None and versions[-1][0] == value:
            continue
        if versions and versions[-1][2] is None:
            versions[-1] = (*versions[-1][:2], month)
        versions.append((value, month, None))
    return state


@pytest.mark.parametrize("seed", [11, 12])
def test_scd2_batches_against_brute_force(spark, many_slices, seed):
    draw = random.Random(seed)
    dimension, state = None, {}
    for step in range(4):
        names = draw.sample([str(n) for n in range(60)] + [None], 40)
        batch = [(name, draw.choice("abc")) for name in names]
        frame = batch_of(spark, [(*pair, "f") for pair in batch], CLOCKS[step])
        merged = scd.merge("SCD2", dimension, frame, SK)
        dimension = stored(spark, merged)
        state = _apply_by_hand(state, batch, step + 1)
        again = scd.scd2(dimension, frame, SK)
        assert again.inserted == 0 and not again.changed
        assert rows_of(again.rows) == rows_of(dimension)
    want = sorted(((key, *version) for key, versions in state.items() for version in versions), key=repr)
    got = sorted((row[1:5] for row in brief(dimension)), key=repr)
    assert got == want
    report = quality.dimension_report(dimension, KEYS, SK).first()
    assert report.keys_with_two_active == report.reversed_ranges == report.repeated_surrogate_keys == 0
    assert report.version_rows == len(want) and report.active_rows == len(state)


def test_small_batches_do_not_shuffle_the_dimension(spark):
    space = Scratch(spark, keep=True)
    rows = spark.range(3000).selectExpr("cast(id AS string) k", "'v' v", "'f' source_file")
    old = stored(spark, scd.initial_load(scd.batch_of(space.store(rows, "silver"), KEYS, CLOCKS[0]), SK))
    batch = scd.batch_of(space.store(rows.limit(5), "silver"), KEYS, CLOCKS[1])
    for merged in (scd.scd1(old, batch, SK), scd.scd2(old, batch, SK)):
        plan = plan_of(merged.current)
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_large_batches_share_one_partitioning(spark):
    space = Scratch(spark, keep=True)
    rows = spark.range(50).selectExpr("cast(id AS string) k", "'v' v", "'f' source_file")
    old = stored(spark, scd.initial_load(scd.batch_of(space.store(rows, "silver"), KEYS, CLOCKS[0]), SK))
    batch = scd.batch_of(space.store(rows, "silver"), KEYS, CLOCKS[1])
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = plan_of(scd.new_versions(old.where("is_active"), batch.staged, KEYS))
    finally:
        spark.conf.set(name, before)
    assert plan.count("Exchange hashpartitioning") == 3 and "CartesianProduct" not in plan


@pytest.mark.parametrize("digest", ["ab" * 32, "AB" * 32, "zz" * 32, "h1", "", None, "é" * 64, "\0" * 33])
def test_a_packed_digest_comes_back(spark, digest):
    frame = spark.createDataFrame([(digest,)], "d string").select("d", packed(F.col("d")).alias("p"))
    row = frame.select("d", "p", unpacked(F.col("p")).alias("again")).first()
    assert row.again == digest
    assert (row.p is None) == (digest is None) and (digest == "ab" * 32) == (row.p is not None and len(row.p) == 32)


def test_merges_move_no_digest_as_text(spark):
    """Digests of the batch are made above the joins, those of the dimension travel packed."""
    old = stored(spark, scd.initial_load(batch_of(spark, THREE, CLOCKS[0]), SK))
    batch = batch_of(spark, [("2", "B", "g"), ("0", "n", "g")], CLOCKS[1])
    found = scd._differing(old, batch)
    above, _, below = plan_of(found).partition("Join")
    assert "sha2" in above and "unhex" in below and "sha2" not in below
    assert "unhex" in plan_of(scd.expire(old, batch.silver, KEYS, CLOCKS[1])).partition("Join")[2]
    above, _, below = plan_of(scd.scd1(old, batch, SK, max_key=3).rows.where("k = '2'")).partition("Join")
    assert "sha2" in above and "unhex" in below


def test_merges_take_digests_that_are_other_text(spark):
    """A dimension made elsewhere may hold any text as its digests: unchanged rows keep it."""
    old = stored(spark, scd.initial_load(batch_of(spark, THREE, CLOCKS[0]), SK))
    old = old.withColumn("hash_key", F.when(F.col("k") == "3", "other").when(F.col("k") == "1", F.lit(None)).otherwise(F.col("hash_key")))
    batch = batch_of(spark, [("2", "b", "g")], CLOCKS[1])
    for merged in (scd.scd2(old, batch, SK), scd.scd1(old, batch, SK, skip_unchanged=True), scd.scd1(old, batch, SK)):
        held = {row.k: row.hash_key for row in merged.rows.collect()}
        assert held["3"] == "other" and held["1"] is None and len(held["2"]) == 64


def test_key_text_pads_as_before(spark):
    numbers = spark.createDataFrame([(n,) for n in (-1234, -5, 0, 7, 42, 99, 100, 999, 1000, 12345678901, None)], "n bigint")
    for row in numbers.select("n", key_text(F.col("n")).alias("got"), F.format_string("%03d", F.col("n")).alias("want")).collect():
        assert row.got == row.want
    large = plan_of(spark.range(200, 300).select(key_text(F.col("id")).alias("sk")))
    assert "CASE WHEN" in large  # Java's formatter only below 100


def test_a_split_write_needs_no_sort(spark, tmp_path):
    """Also in a session that does not set the number of writers."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    own = spark.conf.get(name)
    spark.conf.unset(name)
    seen = []
    try:
        with split_unsorted(spark):
            seen.append(spark.conf.get(name))
        seen.append(spark.conf.get(name, "0"))
        spark.conf.set(name, "7")
        with split_unsorted(spark):
            seen.append(spark.conf.get(name))
        seen.append(spark.conf.get(name))
    finally:
        spark.conf.set(name, own)
    assert seen == ["4", "0", "7", "7"]

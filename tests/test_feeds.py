"""Change sets, the state kept with gold versions, the ledger of deliveries, late changes, options per target."""

import itertools
import os
import random
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from smeltwork.operators import scd
from smeltwork.operators.changes import change_set, newest_changes
from smeltwork.operators.history import versions_from_history
from smeltwork.operators.late import splice
from smeltwork.plans import bronze, control
from smeltwork.plans.audit import GOLD, SILVER, TAKEN_BEFORE, AuditTrail, read_audit
from smeltwork.plans.bronze import run_bronze
from smeltwork.plans.gold import GoldOptions, merge_silver, publish_target
from smeltwork.plans.runner import RunOptions, run_layers
from smeltwork.plans.silver import SilverOptions, cleanse_target, run_silver
from smeltwork.sources import ledger, zones as store
from smeltwork.sources.readers import ReadOptions
from smeltwork.sources.zones import Zones, read_bronze, read_changes, read_gold, read_state, write_gold
from smeltwork.streaming.ingest import stream_targets
from tests.conftest import plan_of, rows_of
from tests.test_layers import CLOCKS, control_of, put, target_row
from tests.test_reruns import ITEM, ids

INCREMENTAL = SilverOptions(incremental=True)


def made(base):
    zones = Zones.under(str(base))
    Path(zones.landing).mkdir(parents=True)
    return zones


@pytest.fixture
def zones(tmp_path):
    return made(tmp_path)


# --- change sets ------------------------------------------------------------


def test_change_set_and_its_composition(spark):
    before = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (None, "n", "x"), (4, None, "x")], "id int, v string, seen string")
    after = spark.createDataFrame([(1, "a", "y"), (None, "m", "y"), (4, "", "y"), (5, "e", "y")], "id int, v string, seen string")
    got = change_set(before, after, ["id"], ignoring=["seen"])
    assert rows_of(got.select("silver_change", "id", "v")) == rows_of(spark.createDataFrame(
        [("changed", None, "m"), ("changed", 4, ""), ("added", 5, "e"), ("gone", 2, None)], "c string, id int, v string"))
    wider = change_set(before.drop("v"), before.withColumn("w", F.lit(None).cast("string")).drop("v"), ["id"])
    assert wider.count() == 0  # a column that comes without values changes nothing
    steps = spark.createDataFrame(
        [(1, "added", "a", 2), (1, "gone", None, 3), (2, "gone", None, 2), (2, "added", "b", 4), (None, "changed", "n", 2)],
        "id int, silver_change string, v string, version long")
    assert rows_of(newest_changes(steps, ["id"], "version")) == rows_of(spark.createDataFrame(
        [(1, "gone", None), (2, "added", "b"), (None, "changed", "n")], "id int, silver_change string, v string"))


def deliveries(seed, batches=4):
    """CSV texts of random keys and values; some keys turn bad and good again, some rows come again unchanged."""
    rng, last, out = random.Random(seed), {}, []
    for n in range(batches):
        for key in rng.sample(range(12), 5):
            if key not in last or rng.random() < 0.7:
                last[key] = rng.choice(["a", "b", "bad", str(n)])
        out.append("id,v\n" + "".join(f"{key},{last[key]}\n" for key in rng.sample(sorted(last), min(6, len(last)))))
    return out


@pytest.mark.parametrize("seed,strategy,gold", [
    (2, "SCD2", GoldOptions(close_missing=True)), (3, "SCD1", GoldOptions(skip_unchanged=True))])
def test_gold_from_changes_equals_gold_from_all_of_silver(spark, tmp_path, seed, strategy, gold):
    found = []
    for incremental in (False, True):
        zones = made(tmp_path / str(incremental))
        rules = control_of(spark, target_row(ITEM, "item", strategy=strategy, rule="v = 'bad'"))
        options = RunOptions(silver=SilverOptions(incremental=incremental), gold=gold)
        for n, text in enumerate(deliveries(seed)):
            put(zones, f"item_{n}.csv", text)
            if n == 2:  # gold misses a batch
                target = control.load_targets(rules)
                trail = AuditTrail(spark, zones.audit, "run-2")
                run_bronze(spark, zones, target, CLOCKS[n], "run-2", trail)
                run_silver(spark, zones, target, CLOCKS[n], "run-2", trail, options.silver)
            else:
                run_layers(spark, zones, rules, CLOCKS[n], f"run-{n}", options=options)
        found.append(rows_of(read_gold(spark, f"{zones.gold}/{ITEM}").drop("silver_timestamp", "ingest_timestamp", "source_file")))
        processed = {r.run_id: r.rows_processed for r in read_audit(spark, zones.audit).where(F.col("layer") == GOLD).collect()}
    assert found[0] == found[1] and len(found[0]) > 5
    assert processed["run-3"] < store.read_silver(spark, f"{zones.silver}/{ITEM}").count()


def test_gold_reads_the_change_set_and_not_silver(spark, zones, monkeypatch):
    rules = control_of(spark, target_row(ITEM, "item"))
    options = RunOptions(silver=INCREMENTAL)
    put(zones, "item_1.csv", "id,v\n1,a\n2,b\n")
    run_layers(spark, zones, rules, CLOCKS[0], "run-1", options=options)
    put(zones, "item_2.csv", "id,v\n2,c\n3,d\n")
    target = control.load_targets(rules)
    trail = AuditTrail(spark, zones.audit, "run-2")
    run_bronze(spark, zones, target, CLOCKS[1], "run-2", trail)
    run_silver(spark, zones, target, CLOCKS[1], "run-2", trail, INCREMENTAL)
    for path in Path(f"{zones.silver}/{ITEM}/v=2").rglob("*.parquet"):
        path.write_text("no longer readable")
    monkeypatch.setattr(store, "_has_data", lambda *a: True)
    monkeypatch.setattr("smeltwork.plans.gold.read_silver", lambda spark, folder: spark.range(0))
    monkeypatch.setattr(scd, "highest_key", None)  # the mark is known, the dimension is not asked
    outcome = publish_target(spark, target[0], zones, CLOCKS[1], {})
    assert (outcome.rows_processed, outcome.rows_inserted, outcome.rows_expired) == (2, 2, 1)
    assert rows_of(read_gold(spark, f"{zones.gold}/{ITEM}").select("item_sk", "id", "v", "is_active")) == [
        ("001", "1", "a", True), ("002", "2", "b", False), ("003", "2", "c", True), ("004", "3", "d", True)]
    assert publish_target(spark, target[0], zones, CLOCKS[1], {}).rows_inserted == 0  # nothing new since


def test_a_missing_change_set_and_a_lost_state_are_made_good_from_the_data(spark, zones):
    rules = control_of(spark, target_row(ITEM, "item"))
    options = RunOptions(silver=INCREMENTAL)
    for n in range(4):
        put(zones, f"item_{n}.csv", f"id,v\n1,a{n}\n{n + 5},b\n")
        if n == 2:
            shutil.rmtree(f"{zones.gold}/{ITEM}/state")
        run_layers(spark, zones, rules, CLOCKS[n], f"run-{n}", options=options)
        if n == 1:
            shutil.rmtree(f"{zones.silver}/{ITEM}/changes")
    gold = read_gold(spark, f"{zones.gold}/{ITEM}")
    assert gold.count() == 8 and gold.select("item_sk").distinct().count() == 8
    state = read_state(spark, f"{zones.gold}/{ITEM}")
    assert (state.silver_version, state.max_key) == (4, 8)


def test_another_rule_or_strategy_merges_all_of_silver(spark, zones):
    options = RunOptions(silver=INCREMENTAL)
    put(zones, "item_1.csv", "id,v\n1,a\n2,b\n")
    run_layers(spark, zones, control_of(spark, target_row(ITEM, "item")), CLOCKS[0], "run-1", options=options)
    put(zones, "item_2.csv", "id,v\n3,c\n")
    run_layers(spark, zones, control_of(spark, target_row(ITEM, "item", rule="v = 'a'")), CLOCKS[1], "run-2", options=options)
    assert read_changes(spark, f"{zones.silver}/{ITEM}", 1, 2, "n") is None  # untouched keys have another verdict
    put(zones, "item_3.csv", "id,v\n4,d\n")
    changed = target_row(ITEM, "item", rule="v = 'a'", strategy="SCD1")
    run_layers(spark, zones, control_of(spark, changed), CLOCKS[2], "run-3", options=options)
    counts = {r.run_id: r.rows_processed for r in read_audit(spark, zones.audit).where(F.col("layer") == GOLD).collect()}
    assert counts == {"run-1": 2, "run-2": 2, "run-3": 3}


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, zones):
    rules = control_of(spark, target_row(ITEM, "item"))
    options = RunOptions(silver=INCREMENTAL, gold=GoldOptions(buckets=8))
    folder = f"{zones.gold}/{ITEM}"
    put(zones, "item_1.csv", "id,v\n" + "".join(f"{n},a\n" for n in range(40)))
    run_layers(spark, zones, rules, CLOCKS[0], "run-1", options=options)
    first = read_state(spark, folder).layout
    assert len(first) == 8 and all("v=1" in path for _, path in first)
    put(zones, "item_2.csv", "id,v\n7,b\n")
    run_layers(spark, zones, rules, CLOCKS[1], "run-2", options=options)
    second = read_state(spark, folder)
    assert sum("v=2" in path for _, path in second.layout) == 1 and len(second.layout) == 8 and second.max_key == 41
    gold = read_gold(spark, folder)
    assert gold.where("is_active").count() == 40 and rows_of(gold.where("id = '7'").select("v", "is_active")) == [("a", False), ("b", True)]
    assert store.drop_superseded(spark, folder, keep=1) == []  # seven buckets are still those of the first version
    put(zones, "item_3.csv", "id,v,w\n7,b,\n8,a,x\n")  # a new column: digests of all rows change
    run_layers(spark, zones, rules, CLOCKS[2], "run-3", options=options)
    assert all("v=3" in path for _, path in read_state(spark, folder).layout)
    assert len(store.drop_superseded(spark, folder, keep=1)) == 2
    gold = read_gold(spark, folder)
    assert gold.where("is_active").count() == 40 and gold.count() == 42 and gold.select("item_sk").distinct().count() == 42
    merged = read_gold(spark, folder, {first[0][0]})
    assert merged.where("is_active").count() < 40


IN_BUCKETS = SilverOptions(incremental=True, buckets=8)


def test_a_batch_rewrites_only_the_silver_buckets_it_touches(spark, zones):
    rules = control_of(spark, target_row(ITEM, "item", rule="v = 'bad'"))
    options, folder = RunOptions(silver=IN_BUCKETS), f"{zones.silver}/{ITEM}"

    def run(number, text):
        put(zones, f"item_{number}.csv", text)
        run_layers(spark, zones, rules, CLOCKS[number - 1], f"run-{number}", options=options)
        return {bucket: path for bucket, verdict, path in store.silver_places(spark, folder, store.silver_state(spark, folder)) if verdict == "clean"}

    first = run(1, "id,v\n" + "".join(f"{n},{'bad' if n == 39 else 'a'}\n" for n in range(40)))
    assert len(first) == 8 and all(path.startswith("v=1/") for path in first.values())
    second = run(2, "id,v,w\n7,b,x\n")  # a new column does not touch the other buckets
    assert sorted(path[:4] for path in second.values()) == ["v=1/"] * 7 + ["v=2/"]
    silver = store.read_silver(spark, folder)
    assert silver.count() == 39 and rows_of(silver.where("w IS NOT NULL").select("id", "v", "w")) == [("7", "b", "x")]
    assert silver.select("silver_timestamp").distinct().count() == 2
    assert rows_of(store.read_silver(spark, folder, "quarantine").select("id")) == [("39",)]
    audit = {row["run_id"]: row for row in read_audit(spark, zones.audit).where(F.col("layer") == SILVER).collect()}
    assert audit["run-2"]["rows_processed"] == 39 and audit["run-2"]["rows_quarantined"] == 1
    assert store.read_quarantine(spark, f"{zones.quarantine}/{ITEM}").count() == 1
    gold = read_gold(spark, f"{zones.gold}/{ITEM}")
    assert gold.where("is_active").count() == 39 and gold.where("is_active AND id = '7'").first()["v"] == "b"
    assert store.drop_old_silver(spark, folder, keep=1) == []  # seven buckets are still those of the first version
    options = RunOptions(silver=SilverOptions(incremental=True, buckets=4))  # another layout: all is written anew
    third = run(3, "id,v,w\n8,c,\n")
    assert len(third) == 4 and all(path.startswith("v=3/") for path in third.values())
    assert len(store.drop_old_silver(spark, folder, keep=1)) == 2
    assert store.read_silver(spark, folder).count() == 39
    options = RunOptions(silver=INCREMENTAL)  # no buckets any more
    assert run(4, "id,v,w\n39,good,\n") == {} and store.read_silver(spark, folder).count() == 40


def test_silver_in_buckets_with_null_keys_no_new_rows_and_other_types(spark, zones):
    rules = control_of(spark, target_row(ITEM, "item"))
    folder = f"{zones.silver}/{ITEM}"
    target = control.load_targets(rules)[0]

    def run(number, rows, schema):
        if rows is not None:
            store.write_bronze(
                spark.createDataFrame(rows, schema).withColumn("ingest_timestamp", F.lit(f"2024-01-0{number}").cast("timestamp")),
                f"{zones.bronze}/{ITEM}", f"run-{number}", [])
        cleanse_target(spark, target, zones, CLOCKS[0], f"run-{number}", IN_BUCKETS)
        return rows_of(store.read_silver(spark, folder).select("id", "v"))

    assert run(1, [(None, 1), ("", 2), ("a", 3)], "id string, v int") == [("", 2), ("a", 3), (None, 1)]
    assert run(2, [(None, 4)], "id string, v int") == [("", 2), ("a", 3), (None, 4)]
    assert run(3, None, None) == [("", 2), ("a", 3), (None, 4)]  # nothing new: every bucket is kept
    assert len(store.silver_state(spark, folder).kept) == len(store.silver_places(spark, folder, store.silver_state(spark, folder)))
    assert run(4, [("", 5.5)], "id string, v double") == [("", 5.5), ("a", 3.0), (None, 4.0)]  # all written anew as double
    assert store.silver_state(spark, folder).kept == ()


def test_silver_refuses_a_column_named_like_the_buckets(spark, tmp_path):
    rows = spark.createDataFrame([("a", "clean", 1)], "id string, verdict string, key_bucket int")
    with pytest.raises(ValueError, match="key_bucket"):
        store.write_silver(rows, str(tmp_path), store.SilverState(buckets=2), F.lit(0))


@pytest.mark.parametrize("seed", [5, 6])
def test_silver_in_buckets_equals_silver_as_a_whole(spark, tmp_path, seed):
    rules = control_of(spark, target_row(ITEM, "item", rule="v = 'bad'"))
    found = []
    for name, silver in (("whole", INCREMENTAL), ("buckets", IN_BUCKETS)):
        zones = made(tmp_path / name)
        for number, text in enumerate(deliveries(seed, 3), start=1):
            put(zones, f"item_{number}.csv", text)
            run_layers(spark, zones, rules, CLOCKS[number - 1], f"run-{number}", options=RunOptions(silver=silver, gold=GoldOptions(close_missing=True)))
        gold = read_gold(spark, f"{zones.gold}/{ITEM}")
        found.append([rows_of(store.read_silver(spark, f"{zones.silver}/{ITEM}", verdict).select("id", "v")) for verdict in ("clean", "quarantine")]
                     + [rows_of(gold.select("id", "v", "is_active", "effective_start_date", "effective_end_date"))])
    assert found[0] == found[1]


def test_a_merge_does_not_shuffle_the_dimension(spark, zones):
    rules = control_of(spark, target_row(ITEM, "item"))
    put(zones, "item_1.csv", "id,v\n1,a\n2,b\n")
    run_layers(spark, zones, rules, CLOCKS[0], "run-1", options=RunOptions(silver=INCREMENTAL, gold=GoldOptions(buckets=4)))
    target = control.load_targets(rules)[0]
    changes = spark.createDataFrame([("2", "c")], "id string, v string")
    dimension = read_gold(spark, f"{zones.gold}/{ITEM}").drop("ingest_timestamp", "source_file", "silver_timestamp")
    merged = merge_silver(changes, dimension, target, CLOCKS[1], max_key=2)
    plan = plan_of(merged.current)
    kept = plan[: plan.index("slices-")] if "slices-" in plan else plan
    assert "BroadcastHashJoin" in kept and "Exchange hashpartitioning" not in kept


def test_a_snapshot_does_not_stand_for_silver(spark, zones):
    rules = control_of(spark, target_row(ITEM, "item"))
    limit = spark.createDataFrame([(True, "gold", "limit", 1, None)], control.EXECUTION_SCHEMA)
    options = RunOptions(silver=INCREMENTAL)
    put(zones, "item_1.csv", "id,v\n1,a\n2,b\n")
    run_layers(spark, zones, rules, CLOCKS[0], "run-1", limit, options)
    put(zones, "item_2.csv", "id,v\n3,c\n")
    run_layers(spark, zones, rules, CLOCKS[1], "run-2", options=options)
    assert ids(read_gold(spark, f"{zones.gold}/{ITEM}")) == ["1", "2", "3"]


def test_types_of_one_target_do_not_break_another(spark, zones):
    rules = control_of(spark, target_row(ITEM, "item", rule="price < 0"), target_row("gold_other_dim", "other"))
    put(zones, "item.csv", "id,price\n1,5\n2,abc\n3,-1\n")
    put(zones, "other.csv", "id,w\n1,x\n")
    options = RunOptions(silver=SilverOptions(types={"price": "double"}, ignore_in_copies=["price"]))
    run_layers(spark, zones, rules, CLOCKS[0], "run-1", options=options)
    assert ids(read_gold(spark, f"{zones.gold}/{ITEM}")) == ["1", "2"]
    assert ids(read_gold(spark, f"{zones.gold}/gold_other_dim")) == ["1"]


# --- the ledger -------------------------------------------------------------


@pytest.mark.parametrize("keys", [("id",), ()])
def test_a_file_that_was_not_archived_is_taken_once(spark, zones, monkeypatch, keys):
    rules = control_of(spark, target_row(ITEM, "item", keys=keys))
    put(zones, "item_1.csv", "id,v\n1,a\n2,b\n")
    spark.sql("SELECT '7' id, 'p' v").write.parquet(f"{zones.landing}/item_2.parquet")
    moved = bronze.archive

    def stops(*arguments):
        raise OSError("the run ends here")

    monkeypatch.setattr(bronze, "archive", stops)
    run_layers(spark, zones, rules, CLOCKS[0], "run-1")
    monkeypatch.setattr(bronze, "archive", moved)
    run_layers(spark, zones, rules, CLOCKS[1], "run-2")
    assert ids(read_bronze(spark, f"{zones.bronze}/{ITEM}")) == ["1", "2", "7"]
    assert ids(store.read_silver(spark, f"{zones.silver}/{ITEM}")) == ["1", "2", "7"]
    trail = read_audit(spark, zones.audit).where("run_id = 'run-2' AND layer = 'Bronze_V2'")
    assert rows_of(trail.select("source_file", "status", "rows_processed")) == [
        ("item_1.csv", TAKEN_BEFORE, 0), ("item_2.parquet", TAKEN_BEFORE, 0)]
    assert sorted(os.listdir(zones.raw_archive)) == [f"{ITEM}_item_1.csv", f"{ITEM}_item_2.parquet"]
    put(zones, "item_1.csv", "id,v\n8,a\n9,b\n")  # the same name and length
    run_layers(spark, zones, rules, CLOCKS[2], "run-3")
    assert ids(read_bronze(spark, f"{zones.bronze}/{ITEM}")) == ["1", "2", "7", "8", "9"]


@pytest.mark.parametrize("mode,taken", [("delivery", 4), ("content", 3), ("off", 4)])
def test_the_same_bytes_delivered_again(spark, zones, mode, taken):
    """A, A, B, A: only content mode passes over the second; the last is a change back and is taken."""
    rules = control.load_targets(control_of(spark, target_row(ITEM, "item")))
    for n, text in enumerate(["id,v\n1,a\n", "id,v\n1,a\n", "id,v\n1,b\n", "id,v\n1,a\n"]):
        path = put(zones, "item.csv", text)
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
        trail = AuditTrail(spark, zones.audit, f"run-{n}")
        run_bronze(spark, zones, rules, CLOCKS[n], f"run-{n}", trail, ReadOptions(ledger=mode))
    assert read_bronze(spark, f"{zones.bronze}/{ITEM}").count() == taken
    assert os.listdir(zones.landing) == ["archive", "raw_archive"] or set(os.listdir(zones.landing)) == {"archive", "raw_archive"}


def test_an_unfinished_attempt_does_not_count(spark, zones, monkeypatch):
    rules = control.load_targets(control_of(spark, target_row(ITEM, "item")))
    put(zones, "item.csv", "id,v\n1,a\n")
    written = bronze.write_ledger

    def stops(*arguments):
        written(*arguments)
        raise OSError("the run ends here")

    monkeypatch.setattr(bronze, "write_ledger", stops)
    run_bronze(spark, zones, rules, CLOCKS[0], "run-1", AuditTrail(spark, zones.audit, "run-1"))
    monkeypatch.setattr(bronze, "write_ledger", written)
    run_bronze(spark, zones, rules, CLOCKS[1], "run-2", AuditTrail(spark, zones.audit, "run-2"))
    assert ids(read_bronze(spark, f"{zones.bronze}/{ITEM}")) == ["1"]


def test_digests_tell_bytes_apart_and_folders_too(spark, zones, monkeypatch):
    def digests():
        entries = bronze.routed_entries(spark, bronze.landing_entries(spark, zones.landing), [(ITEM, "item")])
        return ledger.content_digests(spark, entries, zones.landing)

    put(zones, "item_a.csv", "id\n1\n")
    put(zones, "item_b.csv", "id\n1\n")
    put(zones, "item_c.csv", "id\n2\n")
    spark.range(20).repartition(3).write.csv(f"{zones.landing}/item_d.csv")
    first = digests()
    assert first["item_a.csv"] == first["item_b.csv"] != first["item_c.csv"] and len(first) == 4
    part = next(Path(zones.landing, "item_d.csv").glob("part-*"))
    part.with_name(f".{part.name}.crc").unlink()
    part.write_text("99\n")
    assert digests()["item_d.csv"] != first["item_d.csv"]
    monkeypatch.setattr(ledger, "_WHOLE_BYTES", 0)
    lines = digests()
    assert lines["item_a.csv"] == lines["item_b.csv"] != lines["item_c.csv"]
    with pytest.raises(ValueError):
        ledger.already_taken(spark, zones.bronze, [], zones.landing, "sometimes")


def test_a_stream_archives_what_it_took(spark, zones):
    rules = control.load_targets(control_of(spark, target_row(ITEM, "item")))

    def stream():
        trail = AuditTrail(spark, zones.audit, "s")
        return stream_targets(spark, zones, rules, CLOCKS[0], f"{zones.audit}-checkpoint", trail, put_away=True)

    put(zones, "item_1.csv", "id,v\n1,a\n")
    assert stream() == ["item_1.csv"]
    put(zones, "item_2.csv", "id,v\n2,b\n")
    put(zones, "item_bad.json", '{"id":')
    assert stream() == ["item_2.csv", "item_bad.json"]
    assert ids(read_bronze(spark, f"{zones.bronze}/{ITEM}")) == ["1", "2"]
    assert sorted(os.listdir(zones.raw_archive)) == [f"{ITEM}_item_1.csv", f"{ITEM}_item_2.csv"]
    assert Path(zones.landing, "item_bad.json").exists()


# --- late changes -----------------------------------------------------------

CHANGE = "id int, t timestamp, v string"


def history(spark, seed, rows=60):
    rng = random.Random(seed)
    data = [(rng.choice([None, 1, 2, 3]), f"2024-01-{rng.randrange(1, 20):02d}", rng.choice(["a", "b", None])) for _ in range(rows)]
    return spark.createDataFrame([(k, t, v) for k, t, v in data], "id int, t string, v string").withColumn("t", F.col("t").cast("timestamp"))


def spliced(spark, parts, dimension=None, confirmed=None):
    for part in parts:
        done = splice(dimension, confirmed, part, ["id"], "t", ["v"], "item_sk")
        dimension, confirmed = done.rows, done.confirmed
    return dimension, confirmed


def test_any_order_of_batches_gives_the_whole_history(spark, many_slices):
    whole = history(spark, 1)
    parts = [whole.where(f"pmod(xxhash64(id, t, v), 3) = {n}") for n in range(3)]
    want = rows_of(versions_from_history(whole, ["id"], ["t"], ["v"], "timestamp").select(
        "id", "v", "effective_start_date", "effective_end_date", "is_active", "hash_key"))
    for order in list(itertools.permutations(parts))[1::2]:
        dimension, _ = spliced(spark, order)
        got = dimension.select("id", "v", "effective_start_date", "effective_end_date", "is_active", "hash_key")
        assert rows_of(got) == want
        assert dimension.select("item_sk").distinct().count() == len(want)


def at(spark, *rows):
    return spark.createDataFrame([(k, f"2024-01-{day:02d}", v) for k, day, v in rows], "id int, t string, v string").withColumn(
        "t", F.col("t").cast("timestamp"))


def days(dimension):
    return rows_of(dimension.select("item_sk", "id", "v", F.dayofmonth("effective_start_date"), F.dayofmonth("effective_end_date"), "is_active"))


def test_only_touched_keys_change_and_keys_stay(spark):
    first, confirmed = spliced(spark, [at(spark, (1, 1, "a"), (1, 10, "b"), (1, 12, "b"), (2, 1, "x"), (2, 5, "y"))])
    assert days(first) == [("001", 1, "a", 1, 10, False), ("002", 1, "b", 10, 31, True), ("003", 2, "x", 1, 5, False), ("004", 2, "y", 5, 31, True)]
    # Inside a closed version, before the start of the next with its content, and after a second sighting of b.
    after, confirmed = spliced(spark, [at(spark, (1, 4, "c"), (1, 8, "b"), (1, 11, "d"))], first, confirmed)
    assert days(after) == [
        ("001", 1, "a", 1, 4, False), ("002", 1, "b", 8, 11, False), ("003", 2, "x", 1, 5, False), ("004", 2, "y", 5, 31, True),
        ("005", 1, "c", 4, 8, False), ("006", 1, "d", 11, 12, False), ("007", 1, "b", 12, 31, True)]
    again, _ = spliced(spark, [at(spark, (1, 4, "c"), (2, 5, "y"))], after, confirmed)
    assert days(again) == days(after)  # a change that is known already


def test_a_gap_stays_a_gap(spark):
    first, confirmed = spliced(spark, [at(spark, (1, 1, "a"), (2, 1, "x"))])
    ended = first.withColumn("effective_end_date", F.when(F.col("id") == 1, F.lit("2024-01-06").cast("timestamp")).otherwise(F.col("effective_end_date")))
    ended = ended.withColumn("is_active", F.col("id") != 1)
    after, _ = spliced(spark, [at(spark, (1, 3, "b"))], ended, confirmed)
    assert days(after) == [("001", 1, "a", 1, 3, False), ("002", 2, "x", 1, 31, True), ("003", 1, "b", 3, 6, False)]


def test_rows_without_a_time_are_refused(spark):
    with pytest.raises(ValueError, match="without a time"):
        splice(None, None, spark.sql("SELECT 1 id, CAST(NULL AS timestamp) t, 'a' v"), ["id"], "t", ["v"], "item_sk")


def test_a_new_column_and_an_empty_batch(spark):
    first, confirmed = spliced(spark, [at(spark, (1, 1, "a"))])
    nothing, _ = spliced(spark, [at(spark, (1, 1, "a")).limit(0)], first, confirmed)
    assert days(nothing) == days(first)
    wider = at(spark, (1, 5, "b")).withColumn("note", F.lit("n"))
    after, _ = spliced(spark, [wider], first, confirmed)
    assert rows_of(after.select("v", "note")) == [("a", None), ("b", "n")]


@pytest.mark.parametrize("base", ["plain", "my base+1% [x] {y}"])
def test_attempts_are_found_in_one_listing(spark, tmp_path, base):
    folder = f"{tmp_path}/{base}/t"
    rows = spark.range(1).withColumn("source_file", F.lit("f"))
    for batch in ("b1", "2024-01-01 06h", "b1", "x%y"):
        store.write_bronze(rows, folder, batch)
    Path(f"{folder}/batch_id=open/v=1").mkdir(parents=True)  # has not finished
    assert store.bronze_attempts(spark, folder) == ["batch_id=2024-01-01 06h/v=1", "batch_id=b1/v=2", "batch_id=x%y/v=1"]
    assert store.bronze_attempts(spark, f"{folder}-none") == []


def test_spliced_versions_are_worked_out_once(spark):
    """The windows over all events run before the numbering, not again for each reader of the result."""
    changes = spark.createDataFrame([(1, f"2024-01-0{day}", value) for day, value in ((1, "a"), (2, "b"), (3, "b"))], "k int, t string, v string")
    done = splice(None, None, changes.withColumn("t", F.to_timestamp("t")), ["k"], "t", ["v"], "the_sk")
    assert done.inserted == 2 and done.rows.count() == 2
    assert "Window" not in plan_of(done.rows)


def test_change_sets_move_rows_without_their_digest(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (3, ""), (4, "d")], "k int, v string")
    found = change_set(before, after, ["k"])
    assert rows_of(found) == sorted([(2, "B", "changed"), (3, "", "changed"), (4, "d", "added")], key=repr)
    upserts = plan_of(found).partition("Join")
    assert "sha2" in upserts[0]


def test_dimensions_lie_in_the_closer_codec(spark, tmp_path):
    rows = spark.createDataFrame([("1", True, "h"), ("2", False, "h")], "k string, is_active boolean, hash_key string")
    write_gold(rows, f"{tmp_path}/gold")
    written = [path.name for path in (tmp_path / "gold").rglob("part-*.parquet")]
    assert written and all(name.endswith(".zstd.parquet") for name in written)

"""Retries, refused files and refused settings."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from smeltwork.functions.clock import BatchClock
from smeltwork.functions.naming import free_name
from smeltwork.operators import scd
from smeltwork.operators.dedup import keep_latest, merge_latest
from smeltwork.operators.history import versions_from_history
from smeltwork.operators.quarantine import route
from smeltwork.operators.slices import sorted_slices
from smeltwork.plans import bronze, control
from smeltwork.plans.audit import AuditTrail
from smeltwork.plans.gold import GoldOptions, publish_target
from smeltwork.plans.runner import RunOptions, run_layers
from smeltwork.plans.silver import SilverOptions
from smeltwork.session import Scratch
from smeltwork.sources.readers import ReadOptions
from smeltwork.sources.zones import Zones, read_bronze, read_gold, read_quarantine, read_silver, write_quarantine
from smeltwork.streaming.ingest import stream_targets
from tests.conftest import plan_of, rows_of
from tests.test_layers import CLOCKS, control_of, ingest, put, target_row

ITEM = "gold_item_dim"


@pytest.fixture
def zones(tmp_path):
    made = Zones.under(str(tmp_path))
    Path(made.landing).mkdir(parents=True)
    return made


def ids(frame):
    return sorted(row.id for row in frame.select("id").collect())


def test_a_retry_keeps_rows_of_archived_files(spark, zones):
    rules = control_of(spark, target_row(ITEM, "item"))
    put(zones, "item_a.csv", "id,v\n1,a\n2,b\n")
    put(zones, "item_b.json", '{"id":"3","v":')
    run_layers(spark, zones, rules, CLOCKS[0], "2024-01-01")
    put(zones, "item_b.json", '{"id":"3","v":"c"}\n')
    run_layers(spark, zones, rules, CLOCKS[0], "2024-01-01")
    assert ids(read_bronze(spark, f"{zones.bronze}/{ITEM}")) == ["1", "2", "3"]
    assert ids(read_gold(spark, f"{zones.gold}/{ITEM}")) == ["1", "2", "3"]


def test_a_run_that_stops_between_two_archive_moves(spark, zones, monkeypatch):
    rules = control_of(spark, target_row(ITEM, "item"))
    put(zones, "item_a.csv", "id,v\n1,a\n")
    put(zones, "item_b.csv", "id,v\n2,b\n")
    moved = bronze.archive

    def stops(spark, zones, target, entry, batch_id):
        if entry["name"] == "item_b.csv":
            raise OSError("the run ends here")
        return moved(spark, zones, target, entry, batch_id)

    monkeypatch.setattr(bronze, "archive", stops)
    run_layers(spark, zones, rules, CLOCKS[0], "run-1")
    monkeypatch.setattr(bronze, "archive", moved)
    run_layers(spark, zones, rules, CLOCKS[0], "run-1")
    assert ids(read_bronze(spark, f"{zones.bronze}/{ITEM}")) == ["1", "2"]


@pytest.mark.parametrize("types", [{}, {"price": "double"}])
def test_incremental_silver_equals_a_rescan(spark, tmp_path, types):
    found = []
    for incremental in (False, True):
        zones = Zones.under(str(tmp_path / str(incremental)))
        Path(zones.landing).mkdir(parents=True)
        rules = control_of(spark, target_row(ITEM, "item", rule="try_cast(price AS double) < 0"))
        options = RunOptions(silver=SilverOptions(incremental=incremental, types=types))
        for n, text in enumerate(("1,10\n2,no\n3,-5\n", "2,20\n4,?\n", "3,7\n5,-1\n"), start=1):
            put(zones, f"item_{n}.csv", "id,price\n" + text)
            if n == 2:  # silver does not run for this batch
                trail = AuditTrail(spark, zones.audit, "run-2")
                bronze.run_bronze(spark, zones, control.load_targets(rules), CLOCKS[1], "run-2", trail)
            else:
                run_layers(spark, zones, rules, CLOCKS[n - 1], f"run-{n}", options=options)
        found.append([rows_of(read_silver(spark, f"{zones.silver}/{ITEM}", verdict).select("id", "price", "source_file"))
                      for verdict in ("clean", "quarantine")])
    assert found[0] == found[1]


@pytest.mark.parametrize("batch", ["007", "2024-01-01", "run-1", "1.10", "a b+c%"])
def test_quarantine_ids_stay_text(spark, tmp_path, batch):
    write_quarantine(spark.range(2), str(tmp_path), batch)
    assert {row.quarantine_batch for row in read_quarantine(spark, str(tmp_path)).collect()} == {batch}


@pytest.mark.parametrize(
    "text", ['{"id":"1"}\n{"id":"2"', '{"id":"1"} {"id":"2"}\n', '{"id":"1"}\n\n{\n"id":"2"\n}\n', '[{"id":"1"},\n{"id":"2"}', "id\n1\n"]
)
def test_json_that_holds_more_or_less_than_its_values_is_refused(spark, zones, text):
    put(zones, "item.json", text)
    outcomes, rows = ingest(spark, zones, "t", "item")
    assert "Invalid JSON structure" in outcomes["item.json"].error_message and rows is None


@pytest.mark.parametrize(
    "text", ['{"id":"1"}\t\n{"id":"2"}\t\n', '\n\n {"id":"1"}  \r\n\t{"id":"2"}', '[{"id":"1"},{"id":"2"}]',
             '[\n{"id":"1"},\n{\n"id":"2"}\n]\n\n']
)
def test_json_rows_are_all_read(spark, zones, text):
    put(zones, "item.json", text)
    _, rows = ingest(spark, zones, "t", "item")
    assert ids(rows) == ["1", "2"]


def test_malformed_csv_files_are_refused_and_the_others_written(spark, zones):
    put(zones, "item_good.csv", "id,v\n1,a\n")
    put(zones, "item_long.csv", "id,v\n2,b,surplus\n3,c\n")
    put(zones, "item_short.csv", "id,v\n4\n")
    put(zones, "item_twins.csv", "ID,id\n5,6\n")
    put(zones, "item_empty.csv", "\n\n")
    outcomes, rows = ingest(spark, zones, "t", "item")
    assert ids(rows) == ["1"]
    assert "1 malformed rows" in outcomes["item_long.csv"].error_message
    assert "1 malformed rows" in outcomes["item_short.csv"].error_message
    assert "share a name: ['ID', 'id']" in outcomes["item_twins.csv"].error_message
    assert "No data columns" in outcomes["item_empty.csv"].error_message
    _, kept = ingest(spark, zones, "u", "item", options=ReadOptions(malformed="keep"))
    assert ids(kept) == ["1", "2", "3", "4"]


def test_a_line_break_in_quotes(spark, zones):
    put(zones, "item.csv", 'id,v\n1,"two\nlines"\n')
    outcomes, _ = ingest(spark, zones, "t", "item")
    assert "malformed" in outcomes["item.csv"].error_message
    _, rows = ingest(spark, zones, "u", "item", options=ReadOptions(csv_multiline=True))
    assert rows.first().v == "two\nlines"


def test_reserved_names_are_refused(spark, zones):
    put(zones, "item.csv", "id,Silver_Timestamp\n1,2\n")
    outcomes, rows = ingest(spark, zones, "t", "item")
    assert "reserved names" in outcomes["item.csv"].error_message and rows is None
    with pytest.raises(ValueError, match="reserved"):
        route(spark.range(1).withColumn("quarantine_verdict", F.lit("x")), None)
    with Scratch(spark) as scratch, pytest.raises(ValueError, match="reserved"):
        sorted_slices(spark.range(1).withColumn("_Slice", F.lit(1)), ["id"], scratch)


def test_working_names_do_not_clash(spark):
    assert free_name(["a", "_RANK", "_rank_"], "_rank") == "_rank__"
    frame = spark.createDataFrame([("k", "1", 9), ("k", "2", 8)], "k string, ingest_timestamp string, _rank int")
    assert keep_latest(frame, ["k"]).first()["_rank"] == 8


def test_only_touched_keys_are_ranked(spark):
    state = spark.range(1000).selectExpr("id AS k", "'1' AS ingest_timestamp", "0 AS v")
    batch = spark.sql("SELECT * FROM VALUES (5L, '2', 1), (2000L, '2', 1) AS t(k, ingest_timestamp, v)")
    merged = merge_latest(state, batch, ["k"])
    assert merged.count() == 1001 and merged.where("v = 1").count() == 2
    plan = plan_of(merged)
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("Window ") == 1


def test_control_rows_that_cannot_run_together(spark):
    for rows, said in (
        ([target_row(ITEM, "a"), target_row(ITEM, "b")], "2 active rows for the target"),
        ([target_row("gold_item_dim", "a"), target_row("gold_item_fact", "b")], "surrogate key item_sk"),
        ([target_row(ITEM, " ")], "empty file pattern"),
    ):
        with pytest.raises(ValueError, match=said):
            control.load_targets(control_of(spark, *rows))
    assert len(control.load_targets(control_of(spark, target_row(ITEM, "a"), target_row(ITEM, "b", active=False)))) == 1


def test_history_without_times(spark):
    frame = spark.createDataFrame([("a", None, "x"), ("a", 1, "y"), ("a", 2, None), ("a", 3, "z")], "k string, t long, v string")
    with pytest.raises(ValueError, match="without a time"):
        versions_from_history(frame, ["k"], ["t"], ["v"], "long")
    kept = versions_from_history(
        frame.withColumn("t", F.timestamp_seconds("t")), ["k"], ["t"], ["v"], "timestamp", null_times="drop")
    assert kept.count() == 3 and kept.where("is_active").count() == 1


def test_a_key_twice_in_a_batch_is_refused(spark):
    twice = spark.createDataFrame([("1", "a"), ("1", "b")], "k string, v string")
    with pytest.raises(ValueError, match="more than one row"):
        scd.batch_of(twice, ["k"], CLOCKS[0])


def test_a_snapshot_cannot_close_missing_keys(spark, zones):
    put(zones, "item.csv", "id,v\n1,a\n")
    rules = control_of(spark, target_row(ITEM, "item"))
    run_layers(spark, zones, rules, CLOCKS[0], "run-1")
    settings = {"is_snapshot": True, "snapshot_layer": "gold", "sample_type": "limit", "row_limit": 1}
    with pytest.raises(ValueError, match="close_missing"):
        publish_target(spark, control.load_targets(rules)[0], zones, CLOCKS[1], settings, GoldOptions(close_missing=True))


def test_a_new_column_versions_rows_with_values_only(spark):
    clock = [BatchClock.at(f"2024-0{m}-01 00:00:00") for m in (1, 2, 3, 4)]
    wide = "k string, v string, w string"
    batches = (
        ([("1", "a"), ("2", "b")], "k string, v string"), ([("1", "a", None), ("2", "b", None)], wide),
        ([("1", "a", None), ("2", "b", "new")], wide), ([("1", "a"), ("2", "b")], "k string, v string"),
    )
    dimension, inserted = None, []
    with Scratch(spark) as scratch:
        for at, (rows, schema) in zip(clock, batches):
            merged = scd.merge("SCD2", dimension, scd.batch_of(spark.createDataFrame(rows, schema), ["k"], at), "sk", scratch)
            inserted.append(merged.inserted)
            dimension = scratch.store(merged.rows, "dimension")
        assert inserted == [2, 0, 1, 1]


def test_stream_of_any_layout(spark, zones):
    rules = control.load_targets(control_of(spark, target_row(ITEM, "item")))
    put(zones, "item_a.csv", "id,v\n1,a\n")
    put(zones, "item_b.CSV", "v,id\nb,2\n")
    put(zones, "item_c.json", '{"id":"3"')
    put(zones, "item_d.txt", "x")
    put(zones, "other.csv", "id\n9\n")
    checkpoint = f"{zones.audit}-checkpoint"
    trail = AuditTrail(spark, zones.audit, "s")
    seen = stream_targets(spark, zones, rules, CLOCKS[0], checkpoint, trail)
    assert len(seen) == 5
    assert {(o.source_file, o.status) for _, _, o in trail.outcomes} == {
        ("item_a.csv", "Success"), ("item_b.CSV", "Success"), ("item_c.json", "Failed"), ("item_d.txt", "Failed"),
        ("other.csv", "UNMATCHED")}
    put(zones, "item_e.json", '{"v":"e","id":"5"}')
    assert stream_targets(spark, zones, rules, CLOCKS[1], checkpoint, trail) == ["item_e.json"]
    assert rows_of(read_bronze(spark, f"{zones.bronze}/{ITEM}").select("id", "v")) == [("1", "a"), ("2", "b"), ("5", "e")]


def test_an_unchanged_scd1_batch_writes_nothing(spark, zones):
    rules = control_of(spark, target_row(ITEM, "item", strategy="SCD1"))
    options = RunOptions(gold=GoldOptions(skip_unchanged=True))
    outcomes = []
    for n, text in enumerate(("1,a\n2,b\n", "1,a\n2,b\n", "2,B\n3,c\n"), start=1):
        put(zones, f"item_{n}.csv", "id,v\n" + text)
        trail = run_layers(spark, zones, rules, CLOCKS[n - 1], f"run-{n}", options=options)
        outcomes.append(next(o for layer, _, o in trail.outcomes if layer == "Gold_V2"))
    assert [(o.rows_inserted, o.rows_updated) for o in outcomes] == [(2, 0), (0, 0), (1, 1)]
    gold = Path(f"{zones.gold}/{ITEM}/active")
    assert sorted(p.name for p in gold.iterdir()) == ["v=1", "v=2"]
    assert rows_of(read_gold(spark, f"{zones.gold}/{ITEM}").select("id", "v")) == [("1", "a"), ("2", "B"), ("3", "c")]

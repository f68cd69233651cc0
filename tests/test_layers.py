import json
import shutil
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from smeltwork.functions.clock import BatchClock
from smeltwork.plans import audit, control
from smeltwork.plans.audit import AuditTrail, classic_view, last_status, read_audit, should_skip
from smeltwork.plans.bronze import ingest_target
from smeltwork.plans.gold import GoldOptions
from smeltwork.plans.runner import RunOptions, run_layers
from smeltwork.plans.silver import SilverOptions
from smeltwork.sources import files, zones as store
from smeltwork.sources.landing import landing_entries, routed_entries
from smeltwork.sources.readers import ReadOptions, row_tag
from smeltwork.sources.zones import Zones, read_bronze, read_gold, read_quarantine, read_silver
from smeltwork.streaming.ingest import ingest_available, landing_stream
from tests.conftest import rows_of

CLOCKS = [BatchClock.at(f"2024-0{month}-01 00:00:00") for month in range(1, 6)]


@pytest.fixture
def zones(tmp_path):
    made = Zones.under(str(tmp_path))
    Path(made.landing).mkdir(parents=True)
    return made


def put(zones, name, text):
    path = Path(zones.landing) / name
    path.write_text(text)
    return path


def control_of(spark, *rows):
    return spark.createDataFrame(list(rows), control.CONTROL_SCHEMA)


def target_row(name, pattern, keys=("id",), strategy="SCD2", rule=None, tag=None, priority=1, active=True):
    return (name, "csv", pattern, tag, strategy, list(keys) if keys is not None else None, rule, priority, active)


def ingest(spark, zones, target, pattern, tag=None, options=ReadOptions(), batch="b1"):
    routed = routed_entries(spark, landing_entries(spark, zones.landing), [(target, pattern)])
    rules = control.Target(target, pattern, tag, "SCD1", ("id",), None, 1)
    mine = [entry for entry in routed if entry["target_table"] == target]
    outcomes = ingest_target(spark, rules, mine, zones, CLOCKS[0], batch, options)
    return {outcome.source_file: outcome for outcome in outcomes.values()}, read_bronze(spark, f"{zones.bronze}/{target}")


def test_csv_text_is_kept_unless_types_are_inferred(spark, zones):
    put(zones, "item.csv", "id,price,flag\n007,1.10,TRUE\n")
    _, kept = ingest(spark, zones, "t", "item")
    assert tuple(kept.select("id", "price", "flag").first()) == ("007", "1.10", "TRUE")
    _, inferred = ingest(spark, zones, "t", "item", options=ReadOptions(infer_types=True))
    assert tuple(inferred.select("id", "price", "flag").first()) == ("7", "1.1", "true")
    assert {kind for _, kind in kept.dtypes} == {"string"}


def test_source_file_and_instant(spark, zones):
    put(zones, "my item+1%.csv", "id\n1\n")
    outcomes, rows = ingest(spark, zones, "t", "ITEM")
    assert tuple(rows.first()) == ("1", "my item+1%.csv", "2024-01-01 00:00:00")
    assert outcomes["my item+1%.csv"].rows_processed == 1


def test_landing_folder_with_escaped_characters(spark, tmp_path):
    zones = Zones.under(f"{tmp_path}/my base+1%")
    Path(zones.landing).mkdir(parents=True)
    put(zones, "item.csv", "id\n1\n")
    spark.sql("SELECT 2 id").write.parquet(f"{zones.landing}/item part.parquet")
    _, rows = ingest(spark, zones, "t", "item")
    assert sorted(row.source_file for row in rows.collect()) == ["item part.parquet", "item.csv"]


def test_source_columns_may_have_any_name(spark, zones):
    names = ["id", "v", "batch_id", "rule", "row_hash", "verdict", "source_file"]
    put(zones, "item.csv", ",".join(names) + "\n1,2,3,4,5,6,7\n9,bad,3,4,5,6,7\n")
    rules = control_of(spark, target_row("gold_item_dim", "item", rule="v = 'bad'"))
    run_layers(spark, zones, rules, CLOCKS[0], "run-1")
    want = ("1", "2", "3", "4", "5", "6", "item.csv")
    assert rows_of(read_gold(spark, f"{zones.gold}/gold_item_dim").select(*names)) == [want]
    assert read_quarantine(spark, f"{zones.quarantine}/gold_item_dim").select("id", "batch_id").first() == ("9", "3")


def test_csv_files_with_other_headers_do_not_share_columns(spark, zones):
    put(zones, "item1.csv", "id,v\n1,a\n")
    put(zones, "item2.csv", "id,w\n2,b\n")
    put(zones, "item3.csv", "v,id\nc,3\n")
    _, rows = ingest(spark, zones, "t", "item")
    assert rows_of(rows.select("id", "v", "w")) == sorted([("1", "a", None), ("2", None, "b"), ("3", "c", None)], key=repr)


def test_json_shapes(spark, zones):
    put(zones, "item_array.json", json.dumps([{"id": 1, "v": {"a": [1, 2]}}, {"id": 2}], indent=1))
    put(zones, "item_one.json", json.dumps({"id": 3, "v": None}, indent=2))
    put(zones, "item_lines.json", '{"id": 4}\n\n{"id": 5}\n{"id": 6}\n')
    outcomes, rows = ingest(spark, zones, "t", "item")
    assert sorted(row.id for row in rows.collect()) == ["1", "2", "3", "4", "5", "6"]
    assert outcomes["item_lines.json"].rows_processed == 3
    assert json.loads(rows.where("id = '1'").first().v) == {"a": ["1", "2"]}


def test_multiline_mode_reads_one_object_of_a_lines_file(spark, zones):
    put(zones, "item.json", '{"id": 4}\n{"id": 5}\n')
    _, rows = ingest(spark, zones, "t", "item", options=ReadOptions(json_mode="multiline"))
    assert rows.count() == 1


def test_a_corrupt_json_file_is_rejected_alone(spark, zones):
    put(zones, "item_good.json", '[{"id": 1}]')
    put(zones, "item_bad.json", '[{"id": 2}, {"id": ')
    outcomes, rows = ingest(spark, zones, "t", "item")
    assert outcomes["item_bad.json"].status == audit.FAILED
    assert "Invalid JSON structure" in outcomes["item_bad.json"].error_message
    assert outcomes["item_good.json"].status == audit.SUCCESS
    assert [row.id for row in rows.collect()] == ["1"]


def test_xml_row_tag(spark, zones):
    put(zones, "item.xml", "<all><row><id>007</id><v>a</v></row><row><id>8</id></row></all>")
    outcomes, rows = ingest(spark, zones, "t", "item", tag="row")
    assert rows_of(rows.select("id", "v")) == sorted([("007", "a"), ("8", None)], key=repr)
    wrong, _ = ingest(spark, zones, "t2", "item", tag="nothing")
    assert wrong["item.xml"].status == audit.FAILED and outcomes["item.xml"].status == audit.SUCCESS


def test_default_row_tag():
    assert row_tag("gold_Order_fact", None) == "order"
    assert row_tag("gold_employee_dim", "") == "employee"
    assert row_tag("gold_order_fact", "line") == "line"


def test_parquet_files_with_other_types_share_bronze(spark, zones):
    spark.sql("SELECT 1 id, 2.5D v").write.parquet(f"{zones.landing}/item1.parquet")
    spark.sql("SELECT 'x' id, array(1) v").write.parquet(f"{zones.landing}/item2.parquet")
    _, rows = ingest(spark, zones, "t", "item")
    assert rows_of(rows.select("id", "v")) == [("1", "2.5"), ("x", "[1]")]


def test_a_file_that_breaks_the_write_does_not_stop_the_others(spark, zones):
    put(zones, "item_good.csv", "id\n1\n")
    spark.sql("SELECT 2 id").coalesce(1).write.parquet(f"{zones.landing}/item_good.parquet")
    spark.range(1000).select(F.col("id").cast("string")).coalesce(1).write.parquet(f"{zones.landing}/item_bad.parquet")
    part = next(Path(f"{zones.landing}/item_bad.parquet").glob("part-*"))
    Path(part.parent / f".{part.name}.crc").unlink()
    content = bytearray(part.read_bytes())
    content[4:60] = b"\xff" * 56
    part.write_bytes(bytes(content))
    outcomes, rows = ingest(spark, zones, "t", "item")
    assert {name: outcome.status for name, outcome in outcomes.items()} == {
        "item_good.csv": audit.SUCCESS, "item_good.parquet": audit.SUCCESS, "item_bad.parquet": audit.FAILED,
    }
    assert sorted(row.id for row in rows.collect()) == ["1", "2"]


def test_routing(spark, zones):
    for name in ("Item_1.CSV", "order.item.xlsx", "noextension_item", "other.csv", "my_archive.csv", "order_2.csv"):
        put(zones, name, "id\n1\n")
    Path(zones.raw_archive).mkdir(parents=True)
    entries = landing_entries(spark, zones.landing)
    assert "my_archive.csv" in [entry.name for entry in entries]
    assert not any(entry.is_folder for entry in entries)
    routed = {row["name"]: (row["target_table"], row["route"], row["extension"]) for row in routed_entries(
        spark, entries, [("orders", "order"), ("items", "ITEM")])}
    assert routed["Item_1.CSV"] == ("items", "MATCHED", "csv")
    assert routed["order.item.xlsx"] == ("orders", "UNSUPPORTED", "xlsx")
    assert routed["noextension_item"] == ("items", "UNSUPPORTED", "noextension_item")
    assert routed["other.csv"][:2] == (None, "UNMATCHED")
    assert routed["order_2.csv"][:2] == ("orders", "MATCHED")


def test_missing_landing_folder_is_empty(spark, tmp_path):
    assert landing_entries(spark, f"{tmp_path}/none") == []


def test_two_batches_through_all_layers(spark, zones):
    rules = control_of(
        spark,
        target_row("gold_item_dim", "item", rule="try_cast(v AS INT) < 0"),
        target_row("gold_sales_fact", "sales", strategy="SCD1", priority=2),
        target_row("gold_unused_dim", "unused", active=False),
    )
    put(zones, "item_1.csv", "ID,V \n1,10\n2,20\n3,-1\n")
    put(zones, "sales_1.json", '[{"id": "s1", "amount": 5}]')
    put(zones, "stray.csv", "id\n1\n")
    put(zones, "sales_bad.txt", "?")
    # The headers "V " and "v" of the two batches meet in one column.
    options = RunOptions(silver=SilverOptions(on_collision="coalesce"))
    trail = run_layers(spark, zones, rules, CLOCKS[0], "run-1", options=options)
    assert sorted(Path(zones.raw_archive).iterdir()) == [
        Path(zones.raw_archive) / "gold_item_dim_item_1.csv", Path(zones.raw_archive) / "gold_sales_fact_sales_1.json",
    ]
    assert {path.name for path in Path(zones.landing).iterdir() if path.is_file()} == {"stray.csv", "sales_bad.txt"}
    statuses = {(layer, table, outcome.source_file): outcome.status for layer, table, outcome in trail.outcomes}
    assert statuses[(audit.BRONZE, audit.ALL_TARGETS, "stray.csv")] == audit.UNMATCHED
    assert statuses[(audit.BRONZE, "gold_sales_fact", "sales_bad.txt")] == audit.FAILED

    put(zones, "item_2.csv", "id,v\n1,10\n2,21\n4,40\n")
    put(zones, "sales_2.json", '[{"id": "s1", "amount": 6}, {"id": "s2", "amount": 7}]')
    run_layers(spark, zones, rules, CLOCKS[1], "run-2", options=options)
    item = read_gold(spark, f"{zones.gold}/gold_item_dim")
    brief = item.select("item_sk", "id", "v", F.month("effective_start_date"), "is_active")
    assert rows_of(brief) == [
        ("001", "1", "10", 1, True), ("002", "2", "20", 1, False), ("003", "2", "21", 2, True), ("004", "4", "40", 2, True),
    ]
    sales = read_gold(spark, f"{zones.gold}/gold_sales_fact").select("sales_sk", "id", "amount")
    assert rows_of(sales) == [("001", "s1", "6"), ("002", "s2", "7")]
    quarantined = read_quarantine(spark, f"{zones.quarantine}/gold_item_dim")
    assert [(row.id, row.quarantine_batch) for row in quarantined.collect()] == [("3", "run-1")]
    gold_rows = read_audit(spark, zones.audit).where("run_id = 'run-2' AND layer = 'Gold_V2' AND table_name = 'gold_item_dim'")
    assert tuple(gold_rows.select("rows_processed", "rows_inserted", "rows_expired").first()) == (3, 2, 1)


def test_a_rerun_of_a_batch_changes_nothing(spark, zones):
    rules = control_of(spark, target_row("gold_item_dim", "item", rule="v = 'bad'"))
    for _ in range(2):
        put(zones, "item.csv", "id,v\n1,a\n2,bad\n")
        run_layers(spark, zones, rules, CLOCKS[0], "run-1")
    assert {path.name for path in Path(zones.raw_archive).glob("gold*")} == {
        "gold_item_dim_item.csv", "gold_item_dim_run-1_item.csv",
    }
    assert read_bronze(spark, f"{zones.bronze}/gold_item_dim").count() == 2
    assert read_quarantine(spark, f"{zones.quarantine}/gold_item_dim").count() == 1
    assert read_gold(spark, f"{zones.gold}/gold_item_dim").count() == 1


def test_empty_landing_makes_every_layer_stand_by(spark, zones):
    rules = control_of(spark, target_row("gold_item_dim", "item"))
    trail = run_layers(spark, zones, rules, CLOCKS[0], "run-1")
    assert [(layer, table, outcome.status) for layer, table, outcome in trail.outcomes] == [
        (layer, audit.ALL_TARGETS, audit.SKIPPED_NO_FILES) for layer in (audit.BRONZE, audit.SILVER, audit.GOLD)
    ]
    row = classic_view(read_audit(spark, zones.audit)).first()
    assert (row.duration_seconds is not None, row.rows_processed, row.error_message) == (True, 0, "None")


def test_one_bad_target_does_not_stop_the_others(spark, zones):
    rules = control_of(
        spark,
        target_row("gold_a_dim", "a_", rule="no such column < 1"),
        target_row("gold_b_dim", "b_", strategy="SCD9"),
        target_row("gold_c_dim", "c_"),
        target_row("gold_d_dim", "d_"),
    )
    for name in "abc":
        put(zones, f"{name}_1.csv", "id,v\n1,x\n")
    trail = run_layers(spark, zones, rules, CLOCKS[0], "run-1")
    found = {(layer, table): outcome for layer, table, outcome in trail.outcomes}
    assert found[(audit.SILVER, "gold_a_dim")].status == audit.FAILED
    assert "scd_strategy" in found[(audit.GOLD, "gold_b_dim")].error_message
    assert found[(audit.GOLD, "gold_c_dim")].status == audit.SUCCESS
    assert found[(audit.SILVER, "gold_d_dim")].status == audit.SKIPPED_NO_DATA
    assert read_gold(spark, f"{zones.gold}/gold_c_dim").count() == 1


def test_fail_fast_raises_after_auditing(spark, zones):
    put(zones, "a.txt", "?")
    rules = control_of(spark, target_row("gold_a_dim", "a"))
    with pytest.raises(RuntimeError, match="Unsupported file format: txt"):
        run_layers(spark, zones, rules, CLOCKS[0], "run-1", options=RunOptions(fail_fast=True))
    assert read_audit(spark, zones.audit).where("status = 'Failed'").count() == 1


def test_keyless_targets_end_at_silver(spark, zones):
    put(zones, "log.csv", "a,b\n1,2\n1,2\n3,4\n")
    rules = control_of(spark, target_row("gold_log_fact", "log", keys=None))
    run_layers(spark, zones, rules, CLOCKS[0], "run-1")
    assert read_silver(spark, f"{zones.silver}/gold_log_fact").count() == 2
    assert read_gold(spark, f"{zones.gold}/gold_log_fact") is None


def test_incremental_silver_equals_the_rescan(spark, tmp_path):
    results = []
    for incremental in (False, True):
        zones = Zones.under(f"{tmp_path}/{incremental}")
        Path(zones.landing).mkdir(parents=True)
        rules = control_of(spark, target_row("gold_item_dim", "item", rule="try_cast(v AS INT) < 0"))
        options = RunOptions(silver=SilverOptions(incremental=incremental, on_unknown="drop"))
        for number, text in enumerate(("id,v\n1,1\n2,2\n3,3\n5,x\n", "id,v\n2,-2\n4,4\n", "id,v,w\n1,9,n\n5,5,n\n")):
            put(zones, f"item_{number}.csv", text)
            run_layers(spark, zones, rules, CLOCKS[number], f"run-{number}", options=options)
        silver = read_silver(spark, f"{zones.silver}/gold_item_dim").drop("silver_timestamp")
        gold = read_gold(spark, f"{zones.gold}/gold_item_dim").drop("silver_timestamp")
        caught = read_quarantine(spark, f"{zones.quarantine}/gold_item_dim").select("id", "v", "quarantine_batch")
        results.append([rows_of(frame.select(*sorted(frame.columns))) for frame in (silver, gold, caught)])
    assert results[0] == results[1]


def test_snapshot_mode_limits_gold(spark, zones):
    put(zones, "item.csv", "id,v\n" + "".join(f"{n},x\n" for n in range(10, 60)))
    rules = control_of(spark, target_row("gold_item_dim", "item"))
    execution = spark.createDataFrame([(True, "all", "limit", 5, None)], control.EXECUTION_SCHEMA)
    run_layers(spark, zones, rules, CLOCKS[0], "run-1", execution)
    assert [row.id for row in read_gold(spark, f"{zones.gold}/gold_item_dim").orderBy("id").collect()] == [
        "10", "11", "12", "13", "14",
    ]


def test_an_unfinished_version_is_not_read(spark, zones):
    rules = control_of(spark, target_row("gold_item_dim", "item"))
    put(zones, "item_1.csv", "id,v\n1,a\n")
    run_layers(spark, zones, rules, CLOCKS[0], "run-1")
    folder = f"{zones.gold}/gold_item_dim"
    gold = read_gold(spark, folder)
    # A crash after the first of the two write jobs.
    gold.withColumn("is_active", F.lit(False)).write.partitionBy("is_active").parquet(f"{folder}/active/v=2")
    assert rows_of(read_gold(spark, folder)) == rows_of(gold)
    put(zones, "item_2.csv", "id,v\n1,b\n")
    run_layers(spark, zones, rules, CLOCKS[1], "run-2")
    assert store.current_version(spark, f"{folder}/ended") == 2
    assert rows_of(read_gold(spark, folder).select("v", "is_active")) == [("a", False), ("b", True)]


def test_superseded_active_parts_can_be_dropped(spark, zones):
    rules = control_of(spark, target_row("gold_item_dim", "item"))
    for number in range(4):
        put(zones, f"item_{number}.csv", f"id,v\n1,{number}\n")
        run_layers(spark, zones, rules, CLOCKS[number], f"run-{number}")
    folder = f"{zones.gold}/gold_item_dim"
    before = rows_of(read_gold(spark, folder))
    assert len(store.drop_superseded(spark, folder, keep=2)) == 2
    assert rows_of(read_gold(spark, folder)) == before and len(before) == 4
    silver = f"{zones.silver}/gold_item_dim"
    assert len(store.drop_old_silver(spark, silver, keep=1)) == 3
    assert [row.v for row in read_silver(spark, silver).collect()] == ["3"]


def test_unchanged_scd2_batch_publishes_no_version(spark, zones):
    rules = control_of(spark, target_row("gold_item_dim", "item"))
    for number in range(2):
        put(zones, f"item_{number}.csv", "id,v\n1,a\n")
        run_layers(spark, zones, rules, CLOCKS[number], f"run-{number}")
    assert store.current_version(spark, f"{zones.gold}/gold_item_dim/ended") == 1


def test_close_missing_through_the_layers(spark, zones):
    rules = control_of(spark, target_row("gold_item_dim", "item", rule="v = 'gone'"))
    options = RunOptions(gold=GoldOptions(close_missing=True))
    put(zones, "item_0.csv", "id,v\n1,a\n2,b\n")
    run_layers(spark, zones, rules, CLOCKS[0], "run-0", options=options)
    put(zones, "item_1.csv", "id,v\n2,gone\n")
    run_layers(spark, zones, rules, CLOCKS[1], "run-1", options=options)
    gold = read_gold(spark, f"{zones.gold}/gold_item_dim")
    assert rows_of(gold.select("id", "is_active")) == [("1", True), ("2", False)]


def test_targets_without_good_rows(spark, zones):
    """Header-only files and targets whose every row is bad go through without an error."""
    rules = control_of(
        spark, target_row("gold_none_dim", "none"), target_row("gold_bad_dim", "bad", rule="id >= ''"),
    )
    put(zones, "none.csv", "id,v\n")
    put(zones, "bad.csv", "id,v\n1,a\n")
    trail = run_layers(spark, zones, rules, CLOCKS[0], "run-1")
    assert all(outcome.status in (audit.SUCCESS, audit.SKIPPED_NO_DATA) for _, _, outcome in trail.outcomes)
    put(zones, "none.csv", "id,v\n1,a\n")
    put(zones, "bad.csv", "id,v\n")
    trail = run_layers(spark, zones, rules, CLOCKS[1], "run-2")
    assert all(outcome.status in (audit.SUCCESS, audit.SKIPPED_NO_DATA) for _, _, outcome in trail.outcomes)
    assert read_gold(spark, f"{zones.gold}/gold_none_dim").count() == 1
    assert read_quarantine(spark, f"{zones.quarantine}/gold_bad_dim").count() == 1


def test_strategy_change(spark):
    rows = control_of(spark, target_row("a", "a", strategy="SCD1"), target_row("b", "b", strategy="SCD1"))
    changed = control.change_strategy(rows, "b")
    assert dict(rows_of(changed.select("target_table", "scd_strategy"))) == {"a": "SCD1", "b": "SCD2"}
    assert changed.schema == control.CONTROL_SCHEMA


def test_targets_come_in_priority_order(spark):
    rows = control_of(
        spark, target_row("c", "c", priority=2), target_row("b", "b", priority=1), target_row("a", "a", priority=2),
        target_row("x", "x", active=False), target_row("n", "n", priority=None),
    )
    targets = control.load_targets(rows)
    assert [target.name for target in targets] == ["n", "b", "a", "c"]
    assert [row.target_table for row in control.active_targets(rows).collect()] == ["n", "b", "a", "c"]
    seen = []
    control.in_priority_order(targets, lambda target: seen.append(target.name), at_once=4)
    assert seen[:2] == ["n", "b"] and sorted(seen[2:]) == ["a", "c"]
    assert control.execution_settings(None) == {}


def test_skip_looks_at_the_newest_record_of_the_run(spark, tmp_path):
    folder = f"{tmp_path}/audit"
    assert not should_skip(read_audit(spark, folder), audit.BRONZE)
    first = AuditTrail(spark, folder, "run-1")
    first.record(audit.ALL_TARGETS, audit.BRONZE, audit.now(), audit.Outcome(audit.SKIPPED_NO_FILES))
    first.flush()
    second = AuditTrail(spark, folder, "run-2")
    second.record("t", audit.BRONZE, audit.now(), audit.Outcome(audit.FAILED, error_message="it's {broken}"))
    second.flush()
    trail = read_audit(spark, folder)
    assert should_skip(trail, audit.BRONZE, "run-1") and not should_skip(trail, audit.BRONZE, "run-2")
    assert not should_skip(trail, audit.BRONZE, "run-3")
    later = {run: AuditTrail(spark, folder, run) for run in ("run-1", "run-2")}
    assert later["run-1"].upstream_skipped(audit.BRONZE) and not later["run-2"].upstream_skipped(audit.BRONZE)
    assert classic_view(trail).where("status = 'Failed'").first().error_message == "it's {broken}"
    assert last_status(trail, ("run_id",)).count() == 2


def test_the_trail_lies_by_day_and_lookups_read_the_newest_days(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/audit"

    def write(day, run, status):
        monkeypatch.setattr(audit, "now", lambda: datetime(2024, 3, day, 12, tzinfo=timezone.utc))
        trail = AuditTrail(spark, folder, run)
        trail.record("t", audit.BRONZE, audit.now(), audit.Outcome(status))
        trail.flush()

    # A trail from before there were days: its file lies in the folder itself.
    write(1, "run-0", audit.SKIPPED_NO_FILES)
    for file in Path(folder, "day=2024-03-01").glob("*.parquet"):
        shutil.copy(file, folder)
    shutil.rmtree(f"{folder}/day=2024-03-01")
    assert read_audit(spark, folder).count() == 1 and read_audit(spark, folder, date(2024, 3, 1)) is None
    assert audit.skipped_before(spark, folder, audit.BRONZE)
    for day in range(2, 9):
        write(day, f"run-{day}", audit.SKIPPED_NO_FILES if day == 3 else audit.SUCCESS)
    assert read_audit(spark, folder).count() == 8 and read_audit(spark, folder, date(2024, 3, 7)).count() == 2
    assert not audit.skipped_before(spark, folder, audit.BRONZE) and not audit.skipped_before(spark, folder, audit.SILVER)
    asked = {run: audit.skipped_before(spark, folder, audit.BRONZE, run) for run in ("run-0", "run-3", "run-8", "run-9")}
    assert asked == {"run-0": True, "run-3": True, "run-8": False, "run-9": False}
    Path(folder, "day=2024-03-02", "part-0.parquet").write_text("broken")  # an old day is not read for a newer answer
    assert not audit.skipped_before(spark, folder, audit.BRONZE, "run-8") and not audit.skipped_before(spark, folder, audit.BRONZE)
    assert len(audit.drop_audit_before(spark, folder, date(2024, 3, 7))) == 6
    assert sorted(r.run_id for r in read_audit(spark, folder).collect()) == ["run-7", "run-8"]


def test_stream_reads_each_file_once(spark, zones):
    put(zones, "one.csv", "id,v\n1,a\n")
    schema = spark.createDataFrame([("", "")], "id string, v string").schema
    folder, checkpoint = f"{zones.bronze}/t", f"{zones.bronze}/_checkpoint_t"

    def run():
        stream = landing_stream(spark, zones.landing, "csv", schema, header="true")
        return ingest_available(stream, folder, checkpoint, CLOCKS[0])

    assert (run(), run()) == (1, 0)
    put(zones, "two.csv", "id,v\n2,b\n3,c\n")
    assert run() == 2
    assert rows_of(read_bronze(spark, folder).select("id", "source_file")) == [
        ("1", "one.csv"), ("2", "two.csv"), ("3", "two.csv"),
    ]


def test_a_stream_begun_anew_replaces_nothing(spark, zones):
    put(zones, "one.csv", "id\n1\n")
    schema = spark.createDataFrame([("",)], "id string").schema
    folder = f"{zones.bronze}/t"
    for checkpoint in ("first", "second"):
        stream = landing_stream(spark, zones.landing, "csv", schema, header="true", maxFilesPerTrigger="1")
        assert ingest_available(stream, folder, f"{zones.bronze}/_{checkpoint}", CLOCKS[0]) == 1
        Path(zones.landing, "one.csv").unlink(missing_ok=True)
        put(zones, "two.csv", "id\n2\n")
    assert sorted(row.id for row in read_bronze(spark, folder).collect()) == ["1", "2"]
    names = [path.name for path in Path(folder).iterdir()]
    assert len(names) == 2 and not any("None" in name for name in names)


def test_move_refuses_to_lose_a_file(spark, tmp_path):
    with pytest.raises(Exception):
        files.move(spark, f"{tmp_path}/absent", f"{tmp_path}/there/x")

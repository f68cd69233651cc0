"""Rules that fail on values, records that cannot be read, samples of an exact size, a stream's newest rows."""

import random

import pytest
from pyspark.sql import functions as F

from smeltwork.functions import rules
from smeltwork.operators.dedup import keep_latest
from smeltwork.operators.quarantine import route
from smeltwork.operators.snapshot import exactly
from smeltwork.plans.silver import SilverOptions
from smeltwork.plans.runner import RunOptions, run_layers
from smeltwork.sources.readers import ReadOptions
from smeltwork.sources.zones import read_bronze, read_gold, read_malformed
from smeltwork.streaming.latest import compact_latest, feed_latest, read_latest
from tests.conftest import rows_of
from tests.test_feeds import zones  # noqa: F401 - a fixture
from tests.test_layers import CLOCKS, control_of, ingest, put, target_row
from tests.test_reruns import ITEM, ids


def verdicts(spark, rule, rows, schema="price string, n int", **options):
    frame = spark.createDataFrame(rows, schema)
    return [row.quarantine_verdict for row in route(frame, rule, **options).flagged.collect()]


@pytest.mark.parametrize("unknown,word", [("clean", "clean"), ("quarantine", "quarantine"), ("drop", "dropped")])
def test_a_value_that_does_not_parse_is_unknown(spark, unknown, word):
    rows = [("5", 1), ("abc", 1), ("-1", 1), (None, 1)]
    assert verdicts(spark, "price < 0", rows, on_unknown=unknown) == ["clean", word, "quarantine", word]


@pytest.mark.parametrize("rule,want", [
    ("price < 0 OR n = 7", "quarantine"), ("price < 0 AND n = 7", "unknown"), ("price < 0 AND n = 8", "clean"), ("NOT price < 0", "unknown"),
    ("NOT (price < 0 OR n = 7)", "clean"), ("CAST(price AS DATE) IS NULL", "quarantine"), ("1 / (n - 7) > 0", "unknown"),
    ("n + 2147483647 > 0", "unknown"), ("price IN ('abc')", "quarantine"), ("price BETWEEN 1 AND 5", "unknown"), ("price NOT BETWEEN 1 AND 5", "unknown"),
    ("n BETWEEN 1 AND 7", "quarantine"), ("nullif(CAST(price AS INT) + 1, n) > 0", "unknown"), ("nullif(n / (n - 7), 1) > 0", "unknown"),
    ("nullif(n, 6) = 7", "quarantine"), ("price < 0 OR price > 100", "unknown"), ("price < 0 OR price > 100 OR n > 6", "quarantine"),
    ("CASE WHEN price > 1 THEN 2 ELSE 0 END > 1", "clean"), ("CASE WHEN n = 7 THEN price ELSE 0 END > 1", "unknown"),
    ("if(1 / (n - 7) > 0, 1, 2) = 2", "quarantine"), ("CASE n WHEN 7 THEN 1 END = 1", "quarantine"),
    ("1 / (n - 7) > 0 AND 1 / (n - 7) < 5", "unknown"), ("element_at(array(1), n) = 1", "unknown")])
def test_only_the_part_that_fails_is_unknown(spark, rule, want):
    got = verdicts(spark, rule, [("abc", 7)], on_unknown="drop")
    assert got == ["dropped" if want == "unknown" else want]


def test_faults_of_the_rule_itself_are_still_raised(spark):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        verdicts(spark, "nowhere > 0", [("1", 1)])
    with pytest.raises(Exception, match="PARSE"):
        verdicts(spark, "price <", [("1", 1)])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        verdicts(spark, "price < 0", [("abc", 1)], on_error="fail")
    with pytest.raises(ValueError):
        verdicts(spark, "price < 0", [("abc", 1)], on_error="sometimes")


def test_violations_pass_over_what_fails(spark):
    marks = rules.violations({"low": "price < 0", "seven": "n = 7"})
    frame = spark.createDataFrame([("abc", 7), ("-2", 7)], "price string, n int").select(marks.alias("v"))
    assert [row.v for row in frame.collect()] == [["seven"], ["low", "seven"]]


def test_one_bad_value_does_not_fail_the_target(spark, zones):  # noqa: F811
    put(zones, "item.csv", "id,price\n1,5\n2,abc\n3,-1\n")
    options = RunOptions(silver=SilverOptions(on_unknown="quarantine"))
    run_layers(spark, zones, control_of(spark, target_row(ITEM, "item", rule="price < 0")), CLOCKS[0], "run-1", options=options)
    assert ids(read_gold(spark, f"{zones.gold}/{ITEM}")) == ["1"]


# --- records put aside ------------------------------------------------------


@pytest.mark.parametrize("name,text,good,bad", [
    ("item.csv", "id,v\n1,a\n2\n3,c,d\n4,e\n", ["1", "4"], ["2", "3,c,d"]),
    ("item.json", '{"id":"1"}\n{"id":\n\n{"id":"3"}\nnonsense\n', ["1", "3"], ['{"id":', "nonsense"])])
def test_good_records_go_on_and_bad_ones_are_kept(spark, zones, name, text, good, bad):  # noqa: F811
    options = ReadOptions(malformed="divert")
    put(zones, name, text)
    put(zones, "item_other.csv", "id,v\n9,z\n")
    for _ in range(2):  # another attempt replaces its own records
        outcomes, rows = ingest(spark, zones, ITEM, "item", options=options)
    assert ids(rows) == sorted([*good, "9"]) and "_corrupt_record" not in rows.columns
    aside = read_malformed(spark, f"{zones.quarantine}/{ITEM}")
    assert sorted(row.record for row in aside.collect()) == sorted(bad)
    assert {row.source_file for row in aside.collect()} == {name} and outcomes[name].rows_processed == len(good)


@pytest.mark.parametrize("text", ['[{"id":"1"}, {"id":', '{"id":"1"}\n{"id":"2"} {"id":"3"}\n', "nonsense\n"])
def test_a_file_whose_loss_would_not_show_is_refused(spark, zones, text):  # noqa: F811
    put(zones, "item.json", text)
    outcomes, rows = ingest(spark, zones, ITEM, "item", options=ReadOptions(malformed="divert"))
    assert "Invalid JSON structure" in outcomes["item.json"].error_message and rows is None


def test_nothing_is_put_aside_by_default(spark, zones):  # noqa: F811
    put(zones, "item.csv", "id,v\n1,a\n2\n")
    outcomes, _ = ingest(spark, zones, ITEM, "item")
    assert "malformed" in outcomes["item.csv"].error_message
    assert read_malformed(spark, f"{zones.quarantine}/{ITEM}") is None and read_bronze(spark, f"{zones.bronze}/{ITEM}") is None


# --- samples ----------------------------------------------------------------


@pytest.mark.parametrize("rows", [0, 1, 7, 500, 3000])
def test_a_sample_has_exactly_its_size_on_any_layout(spark, rows):
    frame = spark.range(2000).select((F.col("id") % 900).alias("key"), F.when(F.col("id") < 1500, "hot").when(F.col("id") < 1990, "b").alias("s"), "id")
    sizes = {"hot": 1500, "b": 490, None: 10}
    found = [exactly(frame.repartition(n), rows, ["key"], ["s"]) for n in (1, 5)]
    assert rows_of(found[0]) == rows_of(found[1])
    counts = {row.s: row["count"] for row in found[0].groupBy("s").count().collect()}
    assert counts == {s: min(n, rows) for s, n in sizes.items() if rows}
    assert exactly(frame, rows, ["key"]).count() == min(rows, 2000)


# --- a stream's newest rows -------------------------------------------------

SCHEMA = "id string, v string, ingest_timestamp string, source_file string"


def batches(seed, n=4):
    rng = random.Random(seed)
    rows = [(rng.choice([None, "1", "2", "3", "4"]), rng.choice(["a", "b", None]), rng.choice([None, "2024-01-01", "2024-01-02"]), rng.choice("xy"))
            for _ in range(60)]
    return [rng.sample(rows, 25) for _ in range(n)]


def test_stream_equals_keep_latest_over_restarts(spark, tmp_path):
    taken = []
    for number, rows in enumerate(batches(3)):
        taken += rows
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/n={number}")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in/*")

        def feed():
            return feed_latest(stream, ["id"], f"{tmp_path}/out", f"{tmp_path}/checkpoint")

        assert feed() == 1
        if number == 2:
            compact_latest(spark, f"{tmp_path}/out", ["id"])
            assert feed() == 0
        want = keep_latest(spark.createDataFrame(taken, SCHEMA), ["id"])
        assert rows_of(read_latest(spark, f"{tmp_path}/out", ["id"])) == rows_of(want)


def test_a_replayed_trigger_leaves_its_rows_once(spark, tmp_path):
    """The commit of the last trigger is lost: a restart runs it again, also after its rows were gathered."""
    rows = batches(5, 2)
    for number in range(2):
        spark.createDataFrame(rows[number], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/n={number}")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in/*")
        feed_latest(stream, ["id"], f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    want = rows_of(keep_latest(spark.createDataFrame([*rows[0], *rows[1]], SCHEMA), ["id"]))
    for gathered in (False, True):
        if gathered:
            compact_latest(spark, f"{tmp_path}/out", ["id"])
        for path in (tmp_path / "checkpoint" / "commits").glob("*1*"):
            path.unlink()
        assert feed_latest(stream, ["id"], f"{tmp_path}/out", f"{tmp_path}/checkpoint") == 1
        assert rows_of(read_latest(spark, f"{tmp_path}/out", ["id"])) == want


# --- headers ----------------------------------------------------------------


def test_headers_are_read_from_the_beginning_of_files(spark, zones):  # noqa: F811
    import gzip

    from smeltwork.sources import files

    path = put(zones, "item_1.csv", "\ufeff\r\n  \nid,v\r\n1,a\r\n")
    assert files.first_line(spark, str(path)) in ("\ufeff", "id,v")
    packed = path.with_name("item_2.csv.gz")
    packed.write_bytes(gzip.compress("id,w\n2,é\n".encode()))
    assert files.first_line(spark, str(packed)) == "id,w"
    assert files.first_line(spark, str(put(zones, "item_3.csv", " \n\n"))) is None
    spark.range(3).repartition(3).write.option("header", True).csv(f"{zones.landing}/item_4.csv")
    parts = files.data_files(spark, f"{zones.landing}/item_4.csv")
    assert parts and all("/part-" in part for part in parts)
    assert files.data_files(spark, str(path)) == [f"file:{path}"] or files.data_files(spark, str(path)) == [str(path)]

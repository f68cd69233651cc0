"""Reruns, failures and settings: what a run leaves when something did not go to plan."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltwork.functions.casting import string_safe
from smeltwork.functions.clock import BatchClock
from smeltwork.operators import scd
from smeltwork.operators.snapshot import snapshot
from smeltwork.plans.audit import BRONZE, AuditTrail, classic_view, read_audit, should_skip
from smeltwork.plans.bronze import run_bronze
from smeltwork.plans.control import CONTROL_SCHEMA, EXECUTION_SCHEMA, Target, load_targets
from smeltwork.plans.runner import RunOptions, run_layers
from smeltwork.plans.silver import SilverOptions, cleanse_target
from smeltwork.queries.bronze import CUSTOMERS, INGESTED_AT, ingest_landed, land
from smeltwork.queries.dimensions import CLOCK1, CLOCK2, T1, T2
from smeltwork.queries.registry import Query, instant_text, table, text_list
from smeltwork.session import Scratch, fresh_folder
from smeltwork.sources import files
from smeltwork.sources.zones import Zones, read_gold, read_quarantine, read_silver, write_bronze

_DIM = "gold_customer_dim"
_POOR = "c_acctbal < 0"
_CLOCKS = tuple(BatchClock.at(f"2024-0{month}-01 00:00:00") for month in (1, 2, 3))


def _customer_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, sf_dir, "customer")
    poor = F.coalesce(F.expr(_POOR), F.lit(False))
    return string_safe(customer.where(~poor)), string_safe(customer.where(poor))


def _rerun(again: bool) -> Callable[[SparkSession, str], DataFrame]:
    """One batch id, run twice: the second run finds other files, or the first one's again as well."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        zones = Zones.under(fresh_folder(spark, "rerun"))
        first, second = _customer_files(spark, sf_dir)
        land(first, zones.landing, "feed_1.csv")
        ingest_landed(spark, zones, _DIM)
        if not again:
            files.move(spark, f"{zones.landing}/feed_1.csv", f"{zones.raw_archive}/feed_1.csv")
        land(second, zones.landing, "feed_2.csv")
        return ingest_landed(spark, zones, _DIM)

    return run


_RERUN_SQL = f"""
SELECT {text_list(CUSTOMERS)}, CASE WHEN {_POOR} THEN 'feed_2.csv' ELSE 'feed_1.csv' END AS source_file,
       '{INGESTED_AT}' AS ingest_timestamp
FROM customer
"""


def _three_batches(spark: SparkSession, sf_dir: str) -> Sequence[DataFrame]:
    """All customers, then the poor ones renamed, then one segment renamed."""
    customer = table(spark, sf_dir, "customer")
    renamed = [F.concat("c_name", F.lit(f"-{n}")) for n in (2, 3)]
    return tuple(map(string_safe, (
        customer,
        customer.where(_POOR).withColumn("c_name", renamed[0]),
        customer.where("c_mktsegment = 'BUILDING'").withColumn("c_name", renamed[1]),
    )))


def _after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches folded one by one; the second one's silver never ran."""
    zones = Zones.under(fresh_folder(spark, "failed"))
    control = spark.createDataFrame([(_DIM, "csv", "feed", None, "SCD1", ["c_custkey"], "NONE", 1, True)], CONTROL_SCHEMA)
    options = RunOptions(silver=SilverOptions(incremental=True, types={"c_acctbal": "double"}))
    for number, rows in enumerate(_three_batches(spark, sf_dir), start=1):
        land(rows, zones.landing, f"feed_{number}.csv")
        clock, batch = _CLOCKS[number - 1], f"run-{number}"
        if number == 2:
            run_bronze(spark, zones, load_targets(control), clock, batch, AuditTrail(spark, zones.audit, batch))
        else:
            run_layers(spark, zones, control, clock, batch, options=options)
    return read_silver(spark, f"{zones.silver}/{_DIM}").select(*CUSTOMERS, "source_file")


_AFTER_FAILURE_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
       c_name || CASE WHEN c_mktsegment = 'BUILDING' THEN '-3' WHEN {_POOR} THEN '-2' ELSE '' END AS c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal, c_mktsegment,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'feed_3.csv' WHEN {_POOR} THEN 'feed_2.csv' ELSE 'feed_1.csv' END AS source_file
FROM customer
"""


def _quarantine_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches whose ids look like other types, each cleansed twice: every bad row stays with its first batch."""
    zones = Zones.under(fresh_folder(spark, "ids"))
    target = Target(_DIM, "feed", None, "SCD1", ("c_custkey",), "CAST(c_acctbal AS DOUBLE) < 0", 1)
    customer = string_safe(table(spark, sf_dir, "customer"))
    parts = {"007": "c_mktsegment = 'BUILDING'", "2024-01-01": "c_mktsegment = 'MACHINERY'",
             "1.10": "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"}
    for batch, part in parts.items():
        rows = customer.where(part).select("*", F.lit(f"{batch}.csv").alias("source_file"), F.lit(T1).alias("ingest_timestamp"))
        write_bronze(rows, f"{zones.bronze}/{_DIM}", batch)
        for _ in range(2):
            cleanse_target(spark, target, zones, CLOCK1, batch)
    return read_quarantine(spark, f"{zones.quarantine}/{_DIM}").select("c_custkey", "quarantine_batch")


_QUARANTINE_IDS_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
       CASE c_mktsegment WHEN 'BUILDING' THEN '007' WHEN 'MACHINERY' THEN '2024-01-01' ELSE '1.10' END AS quarantine_batch
FROM customer WHERE {_POOR}
"""


def _stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instants that silver and quarantine put on their rows, over two runs."""
    zones = Zones.under(fresh_folder(spark, "stamps"))
    target = Target(_DIM, "feed", None, "SCD1", ("c_custkey",), "CAST(c_acctbal AS DOUBLE) < 0", 1)
    first, second = _customer_files(spark, sf_dir)
    for batch, rows, clock in (("a", first, CLOCK1), ("b", second, CLOCK2)):
        stamped = rows.select("*", F.lit(f"{batch}.csv").alias("source_file"), F.lit(T1).alias("ingest_timestamp"))
        write_bronze(stamped, f"{zones.bronze}/{_DIM}", batch)
        cleanse_target(spark, target, zones, clock, batch)
    clean = read_silver(spark, f"{zones.silver}/{_DIM}").select("c_custkey", instant_text(F.col("silver_timestamp")).alias("stamp"))
    bad = read_quarantine(spark, f"{zones.quarantine}/{_DIM}").select("c_custkey", instant_text(F.col("quarantined_at")).alias("stamp"))
    return clean.withColumn("zone", F.lit("silver")).unionByName(bad.withColumn("zone", F.lit("quarantine")))


_STAMPS_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, '{T2}' AS stamp,
       CASE WHEN {_POOR} THEN 'quarantine' ELSE 'silver' END AS zone
FROM customer
"""


def _control(spark: SparkSession) -> DataFrame:
    rows = [
        (_DIM, "csv", "customer", None, "SCD2", ["c_custkey"], "NONE", 1, True),
        ("gold_orders_fact", "json", "orders", None, "SCD1", ["o_orderkey"], "NONE", 1, True),
    ]
    return spark.createDataFrame(rows, CONTROL_SCHEMA)


def _one_unit_fails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arrive as JSON cut off in the middle: their unit fails, customers go through all layers."""
    zones = Zones.under(fresh_folder(spark, "unit"))
    land(string_safe(table(spark, sf_dir, "customer")), zones.landing, "customer.csv")
    cut = F.left(F.to_json(F.struct("o_orderkey", "o_orderstatus")), F.lit(12))
    table(spark, sf_dir, "orders").select(cut).write.text(f"{zones.landing}/orders.json")
    run_layers(spark, zones, _control(spark), _CLOCKS[0], "run-1")
    trail = classic_view(read_audit(spark, zones.audit))
    return trail.select("layer", "table_name", "status", "rows_processed", "error_message")


_ONE_UNIT_FAILS_SQL = """
SELECT v.layer, v.table_name, v.status, CASE WHEN v.done THEN n ELSE 0 END AS rows_processed, v.error_message
FROM (SELECT count(*) AS n FROM customer), LATERAL (VALUES
  ('Bronze_V2', 'gold_customer_dim', 'Success', TRUE, 'None'),
  ('Silver_V2', 'gold_customer_dim', 'Success', TRUE, 'None'),
  ('Gold_V2', 'gold_customer_dim', 'Success', TRUE, 'None'),
  ('Bronze_V2', 'gold_orders_fact', 'Failed', FALSE, 'Invalid JSON structure in orders.json'),
  ('Silver_V2', 'gold_orders_fact', 'SKIPPED_NO_DATA', FALSE, 'None'),
  ('Gold_V2', 'gold_orders_fact', 'SKIPPED_NO_DATA', FALSE, 'None')
) AS v(layer, table_name, status, done, error_message)
"""


def _archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the raw files where a run put them away; a refused file stays in landing."""
    zones = Zones.under(fresh_folder(spark, "archive"))
    first, second = _customer_files(spark, sf_dir)
    for number, rows in enumerate((first, second), start=1):
        land(rows, zones.landing, "customer.csv")  # the same name every day
        run_layers(spark, zones, _control(spark), _CLOCKS[number - 1], f"run-{number}")
    raw = spark.read.option("header", True).csv(f"{zones.raw_archive}/*")
    name = F.regexp_extract(F.col("_metadata.file_path"), "/raw_archive/([^/]*)/", 1)
    return raw.select("c_custkey", name.alias("archived_as"))


_ARCHIVED_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
       CASE WHEN {_POOR} THEN 'gold_customer_dim_run-2_customer.csv' ELSE 'gold_customer_dim_customer.csv' END AS archived_as
FROM customer
"""


def _limited_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run under an execution table that limits gold to 700 rows."""
    zones = Zones.under(fresh_folder(spark, "limited"))
    land(table(spark, sf_dir, "customer"), zones.landing, "customer.parquet")
    execution = spark.createDataFrame([(True, "gold", "limit", 700, None)], EXECUTION_SCHEMA)
    run_layers(spark, zones, _control(spark), _CLOCKS[0], "run-1", execution)
    return read_gold(spark, f"{zones.gold}/{_DIM}").select("customer_sk", *CUSTOMERS)


_LIMITED_RUN_SQL = f"""
SELECT printf('%03d', row_number() OVER (ORDER BY c_custkey)) AS customer_sk, *
FROM (SELECT {text_list(CUSTOMERS)} FROM customer ORDER BY CAST(c_custkey AS VARCHAR) LIMIT 700)
"""


def _stored_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asked of the stored trail: does the layer after bronze stand by? One run found files, the next none."""
    zones = Zones.under(fresh_folder(spark, "skip"))
    land(string_safe(table(spark, sf_dir, "customer")), zones.landing, "customer.csv")
    for number in (1, 2):
        run_layers(spark, zones, _control(spark), _CLOCKS[0], f"run-{number}")
    trail = read_audit(spark, zones.audit)
    answers = [(f"run-{n}", should_skip(trail, BRONZE, f"run-{n}")) for n in (1, 2)]
    found = spark.createDataFrame(answers, "run_id string, stands_by boolean")
    rows = trail.where(F.col("layer") == BRONZE).groupBy("run_id").agg(F.sum("rows_processed").alias("rows_processed"))
    return found.join(rows, "run_id")


_STORED_SKIP_SQL = """
SELECT v.run_id, v.stands_by, CASE WHEN v.stands_by THEN 0 ELSE n END AS rows_processed
FROM (SELECT count(*) AS n FROM customer), LATERAL (VALUES ('run-1', FALSE), ('run-2', TRUE)) AS v(run_id, stands_by)
"""


def _schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column comes without values, then with values for some rows: versions per key after each batch."""
    scratch = Scratch(spark, keep=True)
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    loyal = F.when(F.expr(_POOR), F.lit("debtor"))
    batches = (customer, customer.withColumn("c_note", F.lit(None).cast("string")), customer.withColumn("c_note", loyal))
    dimension, out = None, None
    for step, (rows, clock) in enumerate(zip(batches, (CLOCK1, CLOCK1, CLOCK2))):
        batch = scd.batch_of(rows, ["c_custkey"], clock)
        dimension = scratch.store(scd.merge("SCD2", dimension, batch, "customer_sk", scratch).rows, "dimension")
        counted = dimension.groupBy("c_custkey").agg(F.count("*").alias("versions")).withColumn("step", F.lit(step))
        out = counted if out is None else out.unionByName(counted)
    return out


_SCHEMA_CHANGE_SQL = f"""
SELECT c_custkey, CASE WHEN step = 2 AND {_POOR} THEN 2 ELSE 1 END AS versions, step
FROM customer, (VALUES (0), (1), (2)) AS s(step)
"""

_SHARE = 0.25


def _digest_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = {"is_snapshot": True, "snapshot_layer": "all", "sample_type": "key_digest", "sample_fraction": _SHARE}
    return snapshot(table(spark, sf_dir, "orders"), settings, ["o_orderkey"])


def _large_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = {"is_snapshot": True, "snapshot_layer": "all", "sample_type": "limit", "row_limit": 150_000}
    return snapshot(table(spark, sf_dir, "lineitem"), settings, ["l_shipdate", "l_orderkey", "l_linenumber"])


QUERIES = {
    "rerun_with_other_files": Query(_rerun(again=False), _RERUN_SQL),
    "rerun_same_files": Query(_rerun(again=True), _RERUN_SQL),
    "layers_incremental_after_failure": Query(_after_failure, _AFTER_FAILURE_SQL),
    "quarantine_batch_ids": Query(_quarantine_ids, _QUARANTINE_IDS_SQL),
    "layer_stamps": Query(_stamps, _STAMPS_SQL),
    "one_unit_fails": Query(_one_unit_fails, _ONE_UNIT_FAILS_SQL),
    "raw_archive": Query(_archived, _ARCHIVED_SQL),
    "execution_settings": Query(_limited_run, _LIMITED_RUN_SQL),
    "skip_cascade_stored": Query(_stored_skip, _STORED_SKIP_SQL),
    "scd2_schema_change": Query(_schema_change, _SCHEMA_CHANGE_SQL),
    "snapshot_key_digest": Query(
        _digest_sample,
        f"""SELECT * FROM orders
WHERE CAST('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) < {int(_SHARE * 16**8)}""",
    ),
    "snapshot_large_limit": Query(
        _large_limit,
        """SELECT * FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus LIMIT 150000""",
    ),
}

"""Whole layers over landed files, and the audit trail they leave."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltwork.functions import rules
from smeltwork.functions.casting import string_safe
from smeltwork.functions.clock import OPEN_END, BatchClock
from smeltwork.plans.audit import (
    BRONZE,
    FAILED,
    GOLD,
    SILVER,
    SKIPPED_NO_FILES,
    SUCCESS,
    classic_view,
    last_status,
    read_audit,
)
from smeltwork.plans.control import CONTROL_SCHEMA, Target
from smeltwork.plans.gold import publish_target
from smeltwork.plans.runner import RunOptions, run_layers
from smeltwork.plans.silver import SilverOptions, cleanse_target
from smeltwork.queries.bronze import land
from smeltwork.queries.dimensions import CUSTOMER, ORDERS, T1, T2, Source, shown
from smeltwork.queries.registry import Query, digest_sql, table
from smeltwork.session import fresh_folder
from smeltwork.sources.zones import Zones, read_gold, read_quarantine, read_silver, write_bronze

_RULE = "try_cast(c_acctbal AS DOUBLE) < 0"
_CLOCKS = (BatchClock.at(T1), BatchClock.at(T2))


def _control(spark: SparkSession) -> DataFrame:
    rows = [
        ("gold_customer_dim", "csv", "customer", None, "SCD2", ["c_custkey"], _RULE, 1, True),
        ("gold_orders_fact", "parquet", "orders", None, "SCD1", ["o_orderkey"], "NONE", 1, True),
        ("gold_retired_dim", "csv", "retired", None, "SCD1", ["id"], None, 3, False),
    ]
    return spark.createDataFrame(rows, CONTROL_SCHEMA)


def _two_runs(spark: SparkSession, sf_dir: str, options: RunOptions = RunOptions()) -> Zones:
    """Customers as CSV and orders as Parquet, in two batches, then an empty landing folder."""
    zones = Zones.under(fresh_folder(spark, "run"))
    control = _control(spark)
    batches = [
        (CUSTOMER.first(spark, sf_dir), ORDERS.first(spark, sf_dir)),
        (CUSTOMER.second(spark, sf_dir), ORDERS.second(spark, sf_dir)),
    ]
    for number, (customers, orders) in enumerate(batches, start=1):
        land(string_safe(customers), zones.landing, f"customer_{number}.csv")
        land(orders, zones.landing, f"orders_{number}.parquet")
        run_layers(spark, zones, control, _CLOCKS[number - 1], f"run-{number}", options=options)
    run_layers(spark, zones, control, _CLOCKS[1], "run-3", options=options)
    return zones


def _published(source: Source, options: RunOptions = RunOptions()):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        zones = _two_runs(spark, sf_dir, options)
        return shown(read_gold(spark, f"{zones.gold}/{source.target}")).drop("silver_timestamp", "ingest_timestamp")

    return run


def _text(source: Source, relation: str) -> str:
    return ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in source.columns) + f" FROM {relation}"


def _published_sql(source: Source, merge: str, rule: str = "FALSE") -> str:
    """Text rows of both batches, newest per key, then the merge of the target's strategy."""
    stem = source.table
    suffix = "csv" if stem == "customer" else "parquet"
    digest = digest_sql(source.business)
    text = Source(
        "t1", source.target, source.key, (*source.columns, "source_file"), source.changed, source.change, "FALSE", "FALSE"
    )
    plain = Source(stem, source.target, source.key, source.columns, source.changed, source.change, source.gone, source.fresh)
    step = {"SCD1": text.scd1_sql, "SCD2": text.scd2_sql}[merge]("d1", "b2", T2, "d2")
    columns = ", ".join([source.key, *source.business, "source_file"])
    return f"""
{plain.sql()},
t1 AS (SELECT {_text(source, stem)}),
t2 AS (SELECT {_text(source, "s2")}),
silver1 AS (SELECT *, '{stem}_1.{suffix}' AS source_file FROM t1),
silver2 AS (
  SELECT *, '{stem}_2.{suffix}' AS source_file FROM t2
  UNION ALL SELECT * FROM silver1 WHERE {source.key} NOT IN (SELECT {source.key} FROM t2)
)
SELECT * FROM (
  WITH b1 AS (SELECT *, {digest} AS hash_key FROM silver1 WHERE NOT ({rule})),
  b2 AS (SELECT *, {digest} AS hash_key FROM silver2 WHERE NOT ({rule})),
  d1 AS (
    SELECT *, row_number() OVER (ORDER BY {source.key}) AS sk, '{T1}' AS effective_start_date,
           '{OPEN_END}' AS effective_end_date, TRUE AS is_active FROM b1
  ),
  {step}
  SELECT printf('%03d', sk) AS {source.sk}, {columns}, effective_start_date, effective_end_date, is_active, hash_key
  FROM d2
)"""


def _audit_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _two_runs(spark, sf_dir)
    trail = classic_view(read_audit(spark, zones.audit))
    return trail.groupBy("layer", "table_name", "status", "error_message").agg(
        F.count(F.lit(1)).alias("records"), F.sum("rows_processed").alias("rows_processed")
    )


_AUDIT_SQL = f"""
{CUSTOMER.sql()},
orders2 AS (
  SELECT o_orderkey FROM orders WHERE NOT ({ORDERS.gone})
  UNION ALL SELECT -1 - o_orderkey FROM orders WHERE {ORDERS.fresh}
),
counts AS (
  SELECT (SELECT count(*) FROM customer) AS c1, (SELECT count(*) FROM s2) AS c2,
         (SELECT count(*) FROM customer WHERE c_acctbal >= 0) AS g1,
         (SELECT count(*) FROM (SELECT c_custkey, c_acctbal FROM s2 UNION SELECT c_custkey, c_acctbal FROM customer)
          WHERE c_acctbal >= 0) AS g2,
         (SELECT count(*) FROM orders) AS o1, (SELECT count(*) FROM orders2) AS o2,
         (SELECT count(*) FROM (SELECT o_orderkey FROM orders UNION SELECT o_orderkey FROM orders2)) AS m2
)
SELECT layer, table_name, status, 'None' AS error_message, CAST(records AS BIGINT) AS records,
       CAST(rows_processed AS BIGINT) AS rows_processed
FROM counts, LATERAL (VALUES
  ('{BRONZE}', 'gold_customer_dim', 'Success', 2, c1 + c2),
  ('{BRONZE}', 'gold_orders_fact', 'Success', 2, o1 + o2),
  ('{SILVER}', 'gold_customer_dim', 'Success', 2, g1 + g2),
  ('{SILVER}', 'gold_orders_fact', 'Success', 2, o1 + m2),
  ('{GOLD}', 'gold_customer_dim', 'Success', 2, g1 + g2),
  ('{GOLD}', 'gold_orders_fact', 'Success', 2, o1 + m2),
  ('{BRONZE}', 'ALL_TARGETS', 'SKIPPED_NO_FILES', 1, 0),
  ('{SILVER}', 'ALL_TARGETS', 'SKIPPED_NO_FILES', 1, 0),
  ('{GOLD}', 'ALL_TARGETS', 'SKIPPED_NO_FILES', 1, 0)
) AS v(layer, table_name, status, records, rows_processed)
"""

_TARGET = Target("gold_customer_dim", "customer", None, "SCD2", ("c_custkey",), _RULE, 1)


def _roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bronze batch taken through silver and gold three times, twice under one batch id."""
    zones = Zones.under(fresh_folder(spark, "store"))
    rows = string_safe(CUSTOMER.first(spark, sf_dir)).select(
        "*", F.lit("customer.csv").alias("source_file"), F.lit(T1).alias("ingest_timestamp")
    )
    folder = f"{zones.bronze}/{_TARGET.name}"
    write_bronze(rows, folder, "run-1")
    write_bronze(rows, folder, "run-1")
    for batch in ("run-1", "run-1", "run-2"):
        cleanse_target(spark, _TARGET, zones, _CLOCKS[0], batch)
        publish_target(spark, _TARGET, zones, _CLOCKS[0], {})
    name = _TARGET.name
    kept = {
        "silver": read_silver(spark, f"{zones.silver}/{name}", rules.CLEAN),
        "quarantine": read_quarantine(spark, f"{zones.quarantine}/{name}"),
        "gold": read_gold(spark, f"{zones.gold}/{name}"),
    }
    parts = [frame.select(F.lit(zone).alias("zone"), "c_custkey", "c_acctbal") for zone, frame in kept.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


_ROUNDTRIP_SQL = """
SELECT zone, CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal
FROM customer, (VALUES ('silver'), ('quarantine'), ('gold')) AS z(zone)
WHERE (c_acctbal < 0) = (zone = 'quarantine')
"""

_LAYER_OF = {"signup": BRONZE, "purchase": BRONZE, "view": SILVER, "click": SILVER}


def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as audit records: a run per user, a layer per event type."""
    layer = F.lit(GOLD)
    for event_type, name in _LAYER_OF.items():
        layer = F.when(F.col("event_type") == event_type, name).otherwise(layer)
    status = (
        F.when(F.col("value") < 10, SKIPPED_NO_FILES).when(F.col("value") < 20, FAILED).otherwise(F.lit(SUCCESS))
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("target_"), F.col("event_id").cast("string")).alias("table_name"),
        layer.alias("layer"),
        F.col("ts").alias("start_time"),
        F.date_trunc("hour", "ts").alias("end_time"),
        status.alias("status"),
        F.col("user_id").cast("string").alias("run_id"),
    )


_AUDIT_ROWS_SQL = f"""
WITH audit AS (
  SELECT 'target_' || event_id AS table_name,
         CASE WHEN event_type IN ('signup', 'purchase') THEN '{BRONZE}'
              WHEN event_type IN ('view', 'click') THEN '{SILVER}' ELSE '{GOLD}' END AS layer,
         ts AS start_time, date_trunc('hour', ts) AS end_time,
         CASE WHEN value < 10 THEN '{SKIPPED_NO_FILES}' WHEN value < 20 THEN '{FAILED}' ELSE '{SUCCESS}' END AS status,
         CAST(user_id AS VARCHAR) AS run_id
  FROM events
)
"""


def _last_sql(by: str) -> str:
    return f"""SELECT {by}, status FROM audit
QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY end_time DESC, start_time DESC, table_name DESC) = 1"""


def _stand_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each run and layer: does the layer after it stand by?"""
    newest = last_status(audit_rows(spark, sf_dir), by=("run_id", "layer"))
    return newest.select("run_id", "layer", (F.col("status") == SKIPPED_NO_FILES).alias("next_stands_by"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trail of an incremental run: rows inserted, expired and quarantined per target."""
    zones = _two_runs(spark, sf_dir, RunOptions(silver=SilverOptions(incremental=True)))
    counted = ("rows_inserted", "rows_expired", "rows_quarantined")
    trail = read_audit(spark, zones.audit).where(F.col("status") == SUCCESS)
    return trail.groupBy("layer", "table_name").agg(*[F.sum(name).alias(name) for name in counted])


_RECORDS_SQL = f"""
{CUSTOMER.sql()},
orders2 AS (SELECT -1 - o_orderkey AS o_orderkey FROM orders WHERE {ORDERS.fresh}),
all2 AS (SELECT c_custkey, c_acctbal FROM s2 UNION SELECT c_custkey, c_acctbal FROM customer),
good1 AS (SELECT * FROM b1 WHERE c_acctbal >= 0),
good2 AS (SELECT * FROM b2 WHERE c_acctbal >= 0),
changed AS (SELECT count(*) AS n FROM good2 JOIN good1 USING (c_custkey) WHERE good1.hash_key <> good2.hash_key),
added AS (SELECT count(*) AS n FROM good2 WHERE c_custkey NOT IN (SELECT c_custkey FROM good1))
SELECT '{BRONZE}' AS layer, 'gold_customer_dim' AS table_name, CAST(NULL AS BIGINT) AS rows_inserted,
       CAST(NULL AS BIGINT) AS rows_expired, CAST(NULL AS BIGINT) AS rows_quarantined
UNION ALL SELECT '{BRONZE}', 'gold_orders_fact', NULL, NULL, NULL
UNION ALL SELECT '{SILVER}', 'gold_customer_dim', NULL, NULL,
  (SELECT count(*) FROM customer WHERE c_acctbal < 0) + (SELECT count(*) FROM all2 WHERE c_acctbal < 0)
UNION ALL SELECT '{SILVER}', 'gold_orders_fact', NULL, NULL, 0
UNION ALL SELECT '{GOLD}', 'gold_customer_dim',
  (SELECT count(*) FROM good1) + (SELECT n FROM changed) + (SELECT n FROM added), (SELECT n FROM changed), NULL
UNION ALL SELECT '{GOLD}', 'gold_orders_fact', (SELECT count(*) FROM orders) + (SELECT count(*) FROM orders2), 0, NULL
"""


_CUSTOMER_RULE = "CAST(c_acctbal AS DOUBLE) < 0"

QUERIES = {
    "layers_end_to_end": Query(_published(CUSTOMER), _published_sql(CUSTOMER, "SCD2", _CUSTOMER_RULE)),
    "layers_end_to_end_orders": Query(_published(ORDERS), _published_sql(ORDERS, "SCD1")),
    "layers_incremental": Query(
        _published(CUSTOMER, RunOptions(silver=SilverOptions(incremental=True))),
        _published_sql(CUSTOMER, "SCD2", _CUSTOMER_RULE),
    ),
    "layer_store_roundtrip": Query(_roundtrip, _ROUNDTRIP_SQL),
    "audit_rollup": Query(_audit_rollup, _AUDIT_SQL),
    "audit_row_counts": Query(_records, _RECORDS_SQL),
    "last_status": Query(
        lambda spark, sf_dir: last_status(audit_rows(spark, sf_dir)), _AUDIT_ROWS_SQL + _last_sql("layer")
    ),
    "skip_cascade": Query(
        _stand_by,
        _AUDIT_ROWS_SQL
        + f"SELECT run_id, layer, status = '{SKIPPED_NO_FILES}' AS next_stands_by FROM ({_last_sql('run_id, layer')})",
    ),
}


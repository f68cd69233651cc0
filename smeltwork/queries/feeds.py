"""What passes between layers and runs: change sets, the ledger of deliveries, late changes, options per target."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltwork.functions.casting import string_safe
from smeltwork.functions.clock import OPEN_END, BatchClock
from smeltwork.operators.late import splice
from smeltwork.operators.quarantine import route
from smeltwork.operators.snapshot import snapshot
from smeltwork.plans.audit import GOLD, AuditTrail, read_audit
from smeltwork.plans.bronze import run_bronze
from smeltwork.plans.control import CONTROL_SCHEMA, load_targets
from smeltwork.plans.gold import GoldOptions
from smeltwork.plans.runner import RunOptions, run_layers
from smeltwork.plans.silver import SilverOptions, run_silver
from smeltwork.queries.bronze import CUSTOMERS, ingest_landed, land
from smeltwork.queries.dimensions import _history_sql, shown_exact
from smeltwork.queries.registry import Query, instant_text, table, text_list
from smeltwork.session import Scratch, fresh_folder
from smeltwork.sources.readers import ReadOptions
from smeltwork.sources.zones import Zones, read_bronze, read_changes, read_gold, read_malformed, read_silver
from smeltwork.streaming.ingest import stream_targets
from smeltwork.streaming.latest import feed_latest, read_latest

_DIM = "gold_customer_dim"
_POOR, _BUILT = "c_acctbal < 0", "c_mktsegment = 'BUILDING'"
_CLOCKS = tuple(BatchClock.at(f"2024-0{month}-01 00:00:00") for month in (1, 2, 3))
_T1, _, _T3 = (clock.instant for clock in _CLOCKS)


def _control(spark: SparkSession, strategy: str = "SCD2", keys: Sequence[str] = ("c_custkey",), rule: str = "NONE") -> DataFrame:
    return spark.createDataFrame([(_DIM, "csv", "feed", None, strategy, list(keys), rule, 1, True)], CONTROL_SCHEMA)


# --- change sets ------------------------------------------------------------


def _three_runs(
    spark: SparkSession, sf_dir: str, gold: GoldOptions, rule: str, second: DataFrame, third: DataFrame, silver_buckets: int = 0
) -> Zones:
    """Three incremental batches of customers; gold misses the second and merges two change sets at once."""
    zones = Zones.under(fresh_folder(spark, "feeds"))
    control = _control(spark, rule=rule)
    options = RunOptions(silver=SilverOptions(incremental=True, buckets=silver_buckets), gold=gold)
    for number, rows in enumerate((table(spark, sf_dir, "customer"), second, third), start=1):
        land(string_safe(rows), zones.landing, f"feed_{number}.csv")
        clock, batch = _CLOCKS[number - 1], f"run-{number}"
        if number == 2:
            trail = AuditTrail(spark, zones.audit, batch)
            targets = load_targets(control)
            run_bronze(spark, zones, targets, clock, batch, trail)
            run_silver(spark, zones, targets, clock, batch, trail, options.silver)
        else:
            run_layers(spark, zones, control, clock, batch, options=options)
    return zones


def _renamed_twice(
    spark: SparkSession, sf_dir: str, gold: GoldOptions = GoldOptions(), silver_buckets: int = 0
) -> Zones:
    """The poor renamed, then one segment renamed and the poor of another delivered again under their first names."""
    customer = table(spark, sf_dir, "customer")
    second = customer.where(_POOR).withColumn("c_name", F.concat("c_name", F.lit("-2")))
    built = customer.where(_BUILT).withColumn("c_name", F.concat("c_name", F.lit("-3")))
    third = built.unionByName(customer.where(f"{_POOR} AND c_mktsegment = 'MACHINERY'"))
    return _three_runs(spark, sf_dir, gold, "NONE", second, third, silver_buckets)


_NAMED_AGAIN = f"({_BUILT} OR ({_POOR} AND c_mktsegment <> 'MACHINERY'))"


def _from_changes(options: GoldOptions, silver_buckets: int = 0) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold = read_gold(spark, f"{_renamed_twice(spark, sf_dir, options, silver_buckets).gold}/{_DIM}")
        stamps = {name: instant_text(F.col(name)) for name in ("effective_start_date", "effective_end_date")}
        return gold.withColumns(stamps).select("customer_sk", *CUSTOMERS, *stamps, "is_active")

    return run


_FROM_CHANGES_SQL = f"""
WITH t AS (SELECT {text_list(CUSTOMERS)}, {_NAMED_AGAIN} AS again, {_BUILT} AS built FROM customer),
one AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS sk FROM t),
two AS (SELECT *, (SELECT count(*) FROM t) + row_number() OVER (ORDER BY c_custkey) AS sk FROM t WHERE again)
SELECT printf('%03d', sk) AS customer_sk, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       '{_T1}' AS effective_start_date, CASE WHEN again THEN '{_T3}' ELSE '{OPEN_END}' END AS effective_end_date,
       NOT again AS is_active
FROM one
UNION ALL
SELECT printf('%03d', sk), c_custkey, c_name || CASE WHEN built THEN '-3' ELSE '-2' END, c_nationkey, c_acctbal, c_mktsegment,
       '{_T3}', '{OPEN_END}', TRUE
FROM two
"""


def _silver_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few customers renamed by a file with one more column: only the buckets of their keys are written again."""
    zones = Zones.under(fresh_folder(spark, "feeds"))
    customer = table(spark, sf_dir, "customer")
    targets = load_targets(_control(spark, rule="c_acctbal < -900D"))
    renamed = customer.where(_FEW).withColumns({"c_name": F.concat("c_name", F.lit("-2")), "c_note": F.lit("renamed")})
    for number, rows in enumerate((customer, renamed), start=1):
        land(string_safe(rows), zones.landing, f"feed_{number}.csv")
        trail = AuditTrail(spark, zones.audit, f"run-{number}")
        run_bronze(spark, zones, targets, _CLOCKS[number - 1], f"run-{number}", trail)
        run_silver(spark, zones, targets, _CLOCKS[number - 1], f"run-{number}", trail, SilverOptions(incremental=True, buckets=64))
    return read_silver(spark, f"{zones.silver}/{_DIM}").select(*CUSTOMERS, "c_note", "source_file")


_FEW = "c_mktsegment = 'BUILDING' AND c_nationkey < 3"
_SILVER_IN_BUCKETS_SQL = f"""
WITH t AS (SELECT *, {_FEW} AS again FROM customer WHERE c_acctbal >= -900)
SELECT {text_list([name for name in CUSTOMERS if name != "c_name"])}, CASE WHEN again THEN c_name || '-2' ELSE c_name END AS c_name,
       CASE WHEN again THEN 'renamed' END AS c_note, CASE WHEN again THEN 'feed_2.csv' ELSE 'feed_1.csv' END AS source_file
FROM t
"""


def _change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What gold says it has processed: all of silver at first, then only what changed."""
    trail = read_audit(spark, _renamed_twice(spark, sf_dir).audit).where(F.col("layer") == GOLD)
    return trail.select("run_id", "rows_processed", "rows_inserted", "rows_expired")


_CHANGE_COUNTS_SQL = f"""
SELECT 'run-1' AS run_id, count(*) AS rows_processed, count(*) AS rows_inserted, 0 AS rows_expired FROM customer
UNION ALL SELECT 'run-3', count(*), count(*) FILTER ({_NAMED_AGAIN}), count(*) FILTER ({_NAMED_AGAIN})
FROM customer WHERE {_BUILT} OR {_POOR}
"""


def _silver_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second version's change set: renamed, turned bad, new; a segment that came again unchanged is not in it."""
    customer = table(spark, sf_dir, "customer")
    ending = F.when(F.expr(_BUILT), F.lit("-bad")).otherwise(F.lit("-2"))
    renamed = customer.where(_POOR).withColumn("c_name", F.concat("c_name", ending))
    fresh = customer.where("c_mktsegment = 'MACHINERY'").withColumn("c_custkey", -1 - F.col("c_custkey"))
    same = customer.where(f"c_mktsegment = 'FURNITURE' AND NOT ({_POOR})")
    second = renamed.unionByName(fresh).unionByName(same)
    zones = _three_runs(spark, sf_dir, GoldOptions(), "c_name LIKE '%-bad'", second, same)
    changes = read_changes(spark, f"{zones.silver}/{_DIM}", 1, 3, "version")
    return changes.select("silver_change", "c_custkey", "c_name", "version")


_SILVER_CHANGES_SQL = f"""
SELECT CASE WHEN {_BUILT} THEN 'gone' ELSE 'changed' END AS silver_change, CAST(c_custkey AS VARCHAR) AS c_custkey,
       CASE WHEN {_BUILT} THEN NULL ELSE c_name || '-2' END AS c_name, CAST(2 AS BIGINT) AS version
FROM customer WHERE {_POOR}
UNION ALL SELECT 'added', CAST(-1 - c_custkey AS VARCHAR), c_name, 2 FROM customer WHERE c_mktsegment = 'MACHINERY'
"""


def _closed_by_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that turn bad are ended through the change set, and those that are good again come back."""
    customer = table(spark, sf_dir, "customer")
    bad = customer.where(f"{_POOR} OR {_BUILT}").withColumn("c_name", F.concat("c_name", F.lit("-bad")))
    good = customer.where(_BUILT)
    zones = _three_runs(spark, sf_dir, GoldOptions(close_missing=True), "c_name LIKE '%-bad'", bad, good)
    return read_gold(spark, f"{zones.gold}/{_DIM}").groupBy("is_active").agg(
        F.count("*").alias("versions"), F.count_distinct("c_custkey").alias("customers"))


_CLOSED_SQL = f"""
SELECT NOT ({_POOR} AND NOT {_BUILT}) AS is_active, count(*) AS versions, count(DISTINCT c_custkey) AS customers
FROM customer GROUP BY 1
"""


# --- the ledger -------------------------------------------------------------


def _once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run ended after its write and before its files were archived; the next has another id and one more file.

    Then the first name is delivered again with other rows. The target has no keys, so a row taken twice would show.
    """
    zones = Zones.under(fresh_folder(spark, "once"))
    customer = table(spark, sf_dir, "customer")
    poor, others = customer.where(_POOR), customer.where(f"NOT ({_POOR})")
    control = _control(spark, keys=())
    land(string_safe(others), zones.landing, "feed_1.csv")
    ingest_landed(spark, zones, _DIM, "run-1")
    land(string_safe(poor), zones.landing, "feed_2.csv")
    run_layers(spark, zones, control, _CLOCKS[1], "run-2")
    land(string_safe(poor.withColumn("c_name", F.concat("c_name", F.lit("-2")))), zones.landing, "feed_1.csv")
    run_layers(spark, zones, control, _CLOCKS[2], "run-3")
    return read_silver(spark, f"{zones.silver}/{_DIM}").select(*CUSTOMERS, "source_file")


_ONCE_SQL = f"""
SELECT {text_list(CUSTOMERS)}, CASE WHEN {_POOR} THEN 'feed_2.csv' ELSE 'feed_1.csv' END AS source_file FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name || '-2', CAST(c_nationkey AS VARCHAR), CAST(c_acctbal AS VARCHAR),
       c_mktsegment, 'feed_1.csv' FROM customer WHERE {_POOR}
"""


def _once_by_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream takes a file and leaves it; a batch run finds it and one more; the stream comes back and archives."""
    zones = Zones.under(fresh_folder(spark, "once"))
    customer = table(spark, sf_dir, "customer")
    targets = load_targets(_control(spark))

    def stream() -> None:
        trail = AuditTrail(spark, zones.audit, "stream")
        stream_targets(spark, zones, targets, _CLOCKS[0], f"{zones.audit}-checkpoint", trail, put_away=False)

    land(string_safe(customer.where(_POOR)), zones.landing, "feed_1.csv")
    stream()
    land(string_safe(customer.where(f"NOT ({_POOR})")), zones.landing, "feed_2.csv")
    run_bronze(spark, zones, targets, _CLOCKS[1], "run-2", AuditTrail(spark, zones.audit, "run-2"))
    land(string_safe(customer.where(_BUILT)), zones.landing, "feed_3.csv")
    stream()
    return read_bronze(spark, f"{zones.bronze}/{_DIM}").select(*CUSTOMERS, "source_file")


_ONCE_BY_STREAM_SQL = f"""
SELECT {text_list(CUSTOMERS)}, CASE WHEN {_POOR} THEN 'feed_1.csv' ELSE 'feed_2.csv' END AS source_file FROM customer
UNION ALL SELECT {text_list(CUSTOMERS)}, 'feed_3.csv' FROM customer WHERE {_BUILT}
"""


# --- late changes -----------------------------------------------------------


def _late(name: str, keys: list[str], time: str, tracked: list[str], parts: Sequence[str]) -> Callable[[SparkSession, str], DataFrame]:
    """The parts of a history spliced in one after the other, in an order that is not that of time."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        scratch = Scratch(spark, keep=True)
        history = table(spark, sf_dir, name).select(*keys, time, *tracked)
        dimension = confirmed = highest = None
        for part in parts:
            done = splice(dimension, confirmed, history.where(part), keys, time, tracked, "the_sk", scratch, max_key=highest)
            dimension, confirmed = scratch.store(done.rows, "dimension"), scratch.store(done.confirmed, "confirmed")
            highest = done.max_key
        return shown_exact(dimension.drop("the_sk"))

    return run


_EVENTS = ("events", ["user_id"], "ts", ["event_type"])
_ORDERS = ("orders", ["o_custkey"], "o_orderdate", ["o_orderpriority", "o_orderstatus"])
_EVENT_PARTS = ("event_type IN ('purchase', 'error')", "event_type = 'view'", "event_type NOT IN ('purchase', 'error', 'view')")
_ORDER_PARTS = ("o_orderstatus = 'P'", "o_orderpriority < '3'", "o_orderstatus <> 'P' AND o_orderpriority >= '3'")


# --- options per target -----------------------------------------------------


def _own_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types named for one target, a rule on each, and one target that quarantines what its rule cannot judge."""
    zones = Zones.under(fresh_folder(spark, "own"))
    rows = [
        (_DIM, "csv", "customer", None, "SCD2", ["c_custkey"], _POOR, 1, True),
        ("gold_orders_fact", "csv", "orders", None, "SCD1", ["o_orderkey"], "try_cast(o_orderpriority AS INT) > 9", 1, True),
    ]
    land(string_safe(table(spark, sf_dir, "customer")), zones.landing, "customer.csv")
    land(string_safe(table(spark, sf_dir, "orders")), zones.landing, "orders.csv")
    options = RunOptions(
        silver=SilverOptions(types={"c_acctbal": "double"}), silver_of={"gold_orders_fact": SilverOptions(on_unknown="quarantine")})
    run_layers(spark, zones, spark.createDataFrame(rows, CONTROL_SCHEMA), _CLOCKS[0], "run-1", options=options)
    trail = read_audit(spark, zones.audit)
    return trail.select("layer", "table_name", "status", "rows_processed", "rows_quarantined")


_OWN_OPTIONS_SQL = f"""
WITH n AS (SELECT (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM customer WHERE {_POOR}) AS p, (SELECT count(*) FROM orders) AS o)
SELECT v.* FROM n, LATERAL (VALUES
  ('Bronze_V2', '{_DIM}', 'Success', c, NULL), ('Bronze_V2', 'gold_orders_fact', 'Success', o, NULL),
  ('Silver_V2', '{_DIM}', 'Success', c - p, p), ('Silver_V2', 'gold_orders_fact', 'Success', 0, o),
  ('Gold_V2', '{_DIM}', 'Success', c - p, NULL), ('Gold_V2', 'gold_orders_fact', 'Success', 0, NULL)
) AS v(layer, table_name, status, rows_processed, rows_quarantined)
"""


# --- rules that fail, records that cannot be read, samples of a size, a stream's newest rows --------


def _tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price that is no number for one segment, and a division by a balance that may be zero."""
    price = F.when(F.expr(_BUILT), F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", price.alias("price"))
    rule = "(price < 0D AND 10 / c_nationkey > 1) OR (c_custkey % 7 = 0 AND NOT CAST(price AS DOUBLE) > 5000)"
    parts = [route(rows, rule, on_unknown).flagged.withColumn("mode", F.lit(on_unknown)) for on_unknown in ("clean", "quarantine", "drop")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("c_name")


_TOLERANT_SQL = f"""
WITH rows AS (
  SELECT c_custkey, c_nationkey, CASE WHEN {_BUILT} THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS price FROM customer
), judged AS (
  SELECT *, (try_cast(price AS DOUBLE) < 0 AND CASE WHEN c_nationkey <> 0 THEN 10 / c_nationkey > 1 END)
         OR (c_custkey % 7 = 0 AND NOT try_cast(price AS DOUBLE) > 5000) AS bad FROM rows
)
SELECT c_custkey, c_nationkey, price, mode, CASE WHEN bad THEN 'quarantine' WHEN bad IS NULL THEN unknown ELSE 'clean' END AS quarantine_verdict
FROM judged, (VALUES ('clean', 'clean'), ('quarantine', 'quarantine'), ('drop', 'dropped')) AS m(mode, unknown)
"""


def _diverted(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    """Files in which the records of one segment are cut off: the others reach bronze, these are put aside."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        zones = Zones.under(fresh_folder(spark, "diverted"))
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
        if kind == "csv":
            whole, cut, head = F.concat_ws(",", *customer.columns), F.concat_ws(",", "c_custkey", "c_name"), [",".join(customer.columns)]
        else:
            whole = F.to_json(F.struct(*customer.columns))
            cut, head = F.concat(F.lit('{"c_custkey":'), F.col("c_custkey").cast("string")), []
        lines = customer.select(F.when(F.expr(_BUILT), cut).otherwise(whole).alias("value"))
        heads = spark.createDataFrame([(line,) for line in head], "value string")
        ordered = heads.withColumn("n", F.lit(0)).unionByName(lines.withColumn("n", F.lit(1))).coalesce(1).sortWithinPartitions("n")
        ordered.select("value").write.text(f"{zones.landing}/feed_1.{kind}")
        bronze = ingest_landed(spark, zones, _DIM, options=ReadOptions(malformed="divert"))
        bad = read_malformed(spark, f"{zones.quarantine}/{_DIM}")
        good = bronze.select(F.lit("bronze").alias("zone"), F.concat_ws(",", "c_custkey", "c_name", "c_mktsegment").alias("record"))
        return good.unionByName(bad.select(F.lit("malformed").alias("zone"), "record"))

    return run


def _diverted_sql(cut: str) -> str:
    return f"""
SELECT CASE WHEN {_BUILT} THEN 'malformed' ELSE 'bronze' END AS zone,
       CASE WHEN {_BUILT} THEN {cut} ELSE c_custkey || ',' || c_name || ',' || c_mktsegment END AS record
FROM customer"""


_EXACT = {"is_snapshot": True, "snapshot_layer": "all", "sample_type": "exact", "row_limit": 120}


def _stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest order of every customer, from a stream started three times over files that repeat and come late."""
    base = fresh_folder(spark, "latest")
    orders = table(spark, sf_dir, "orders")
    third = [f"pmod(o_orderkey, 3) = {n}" for n in range(3)]
    files_ = [orders.where(third[0]), orders.where(f"{third[0]} OR {third[1]}"), orders.where("o_orderdate < '1996-01-01'").unionByName(orders.where(third[2]))]
    for number, rows in enumerate(files_):
        rows.write.parquet(f"{base}/in/n={number}")
        stream = spark.readStream.schema(orders.schema).parquet(f"{base}/in/*")
        feed_latest(stream, ["o_custkey"], f"{base}/out", f"{base}/checkpoint", ["o_orderdate"])
    return read_latest(spark, f"{base}/out", ["o_custkey"])


QUERIES = {
    "gold_from_changes": Query(_from_changes(GoldOptions()), _FROM_CHANGES_SQL),
    "gold_in_buckets": Query(_from_changes(GoldOptions(buckets=16)), _FROM_CHANGES_SQL),
    "layers_in_buckets": Query(_from_changes(GoldOptions(buckets=16), silver_buckets=16), _FROM_CHANGES_SQL),
    "silver_in_buckets": Query(_silver_in_buckets, _SILVER_IN_BUCKETS_SQL),
    "gold_change_counts": Query(_change_counts, _CHANGE_COUNTS_SQL),
    "silver_change_set": Query(_silver_changes, _SILVER_CHANGES_SQL),
    "gold_closed_by_changes": Query(_closed_by_changes, _CLOSED_SQL),
    "ingest_once": Query(_once, _ONCE_SQL),
    "ingest_once_by_stream": Query(_once_by_stream, _ONCE_BY_STREAM_SQL),
    "scd2_late_changes": Query(_late(*_EVENTS, _EVENT_PARTS), _history_sql(_EVENTS[0], _EVENTS[1], [_EVENTS[2]], _EVENTS[3])),
    "scd2_late_changes_orders": Query(_late(*_ORDERS, _ORDER_PARTS), _history_sql(_ORDERS[0], _ORDERS[1], [_ORDERS[2]], _ORDERS[3])),
    "quarantine_tolerant": Query(_tolerant, _TOLERANT_SQL),
    "ingest_csv_diverted": Query(_diverted("csv"), _diverted_sql("c_custkey || ',' || c_name")),
    "ingest_json_diverted": Query(_diverted("json"), _diverted_sql("""'{"c_custkey":' || c_custkey""")),
    "snapshot_exact": Query(
        lambda spark, sf_dir: snapshot(table(spark, sf_dir, "orders"), _EXACT, ["o_orderkey"]),
        "SELECT * FROM orders ORDER BY sha256(CAST(o_orderkey AS VARCHAR)) LIMIT 120",
    ),
    "snapshot_exact_strata": Query(
        lambda spark, sf_dir: snapshot(table(spark, sf_dir, "lineitem"), _EXACT | {"strata": ["l_shipdate"], "row_limit": 3}, ["l_orderkey", "l_linenumber"]),
        """SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_shipdate ORDER BY sha256(l_orderkey || '||' || l_linenumber), l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) <= 3""",
    ),
    "snapshot_limit_lines": Query(
        lambda spark, sf_dir: snapshot(
            table(spark, sf_dir, "lineitem"), _EXACT | {"sample_type": "limit", "row_limit": 4500}, ["l_shipdate", "l_orderkey", "l_linenumber"]),
        """SELECT * FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus LIMIT 4500""",
    ),
    "stream_latest": Query(
        _stream_latest,
        """SELECT * FROM orders QUALIFY row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderstatus DESC, o_totalprice DESC) = 1""",
    ),
    "options_per_target": Query(_own_options, _OWN_OPTIONS_SQL),
}

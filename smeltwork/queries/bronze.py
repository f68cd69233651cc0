"""Ingest, routing and control-table queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltwork.functions.casting import string_safe
from smeltwork.functions.clock import BatchClock
from smeltwork.functions.naming import surrogate_name_of
from smeltwork.operators.views import control_rules
from smeltwork.plans.audit import AuditTrail
from smeltwork.plans.bronze import ingest_target
from smeltwork.plans.control import Target, active_targets, change_strategy
from smeltwork.queries.registry import Query, table, text_list
from smeltwork.session import fresh_folder
from smeltwork.sources import files
from smeltwork.sources.landing import landing_entries, route, routed_entries
from smeltwork.sources.readers import ReadOptions
from smeltwork.sources.zones import Zones, read_bronze
from smeltwork.streaming.ingest import ingest_available, landing_stream, stream_targets

INGESTED_AT = "2024-01-01 00:00:00"
CLOCK = BatchClock.at(INGESTED_AT)

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]
PARTS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
LINES = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
CUSTOMERS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
EVENTS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def land(frame: DataFrame, landing: str, name: str, tag: str = "row") -> None:
    """Put a frame into the landing folder in the format its name says."""
    kind = name.rsplit(".", 1)[1].lower()
    writer = frame.write
    if kind == "csv":
        writer.option("header", True).csv(f"{landing}/{name}")
    elif kind == "json":
        writer.json(f"{landing}/{name}")
    elif kind == "xml":
        writer.format("xml").option("rowTag", tag).save(f"{landing}/{name}")
    else:
        writer.parquet(f"{landing}/{name}")


def ingest_landed(
    spark: SparkSession, zones: Zones, target: str, batch_id: str = "batch-1", options: ReadOptions = ReadOptions()
) -> DataFrame:
    """Ingest what lies in landing as one batch and read all of the target's bronze back."""
    rules = Target(target, "feed", "row", "SCD1", (), None, 1)
    routed = routed_entries(spark, landing_entries(spark, zones.landing), [(target, "feed")])
    outcomes = ingest_target(spark, rules, routed, zones, CLOCK, batch_id, options)
    failed = [outcome.error_message for outcome in outcomes.values() if outcome.error_message]
    if failed:
        raise RuntimeError(failed[0])
    return read_bronze(spark, f"{zones.bronze}/{target}")


def ingest(
    spark: SparkSession,
    landed: Sequence[tuple[str, DataFrame]],
    target: str,
    options: ReadOptions = ReadOptions(),
) -> DataFrame:
    """Land the frames under their names, ingest them as one batch, and read bronze back."""
    zones = Zones.under(fresh_folder(spark, "ingest"))
    for name, frame in landed:
        land(frame, zones.landing, name)
    return ingest_landed(spark, zones, target, options=options)


def _ingest_one(
    name: str, file: str, options: ReadOptions = ReadOptions()
) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = table(spark, sf_dir, name)
        landed = source if file.endswith("parquet") else string_safe(source)
        return ingest(spark, [(file, landed)], f"gold_{name}_dim", options)

    return run


def _ingest_sql(name: str, columns: list[str], file: str) -> str:
    return (
        f"SELECT {text_list(columns)}, '{file}' AS source_file, '{INGESTED_AT}' AS ingest_timestamp FROM {name}"
    )


_SEGMENT_FILES = {
    "AUTOMOBILE": "feed_automobile.csv",
    "BUILDING": "feed_building.json",
    "FURNITURE": "feed_furniture.xml",
    "HOUSEHOLD": "feed_household.parquet",
    "MACHINERY": "feed_machinery.csv",
}


def _ingest_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One target fed by five files in four formats; one CSV has its columns in another order."""
    customer = table(spark, sf_dir, "customer")
    *named, last = _SEGMENT_FILES
    frames = [(_SEGMENT_FILES[segment], customer.where(F.col("c_mktsegment") == segment)) for segment in named]
    rest = customer.where(F.coalesce(~F.col("c_mktsegment").isin(named), F.lit(True)))
    frames.append((_SEGMENT_FILES[last], rest))
    turned = rest.select(*reversed(CUSTOMERS))
    return ingest(spark, [*frames[:-1], (frames[-1][0], turned)], "gold_customer_dim")


_MIXED_SQL = f"""
SELECT {text_list(CUSTOMERS)},
       CASE c_mktsegment {" ".join(f"WHEN '{segment}' THEN '{file}'" for segment, file in list(_SEGMENT_FILES.items())[:-1])}
       ELSE '{list(_SEGMENT_FILES.values())[-1]}' END AS source_file,
       '{INGESTED_AT}' AS ingest_timestamp
FROM customer
"""


def _drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of one target, the second without one column and with another new one."""
    part = table(spark, sf_dir, "part")
    small = part.where("p_size <= 25").drop("p_type")
    large = part.where("p_size > 25").withColumn("p_origin", F.lit("import"))
    zones = Zones.under(fresh_folder(spark, "drift"))
    for name, frame, batch in (("feed_small.csv", small, "batch-1"), ("feed_large.parquet", large, "batch-2")):
        land(frame, zones.landing, name)
        ingest_landed(spark, zones, "gold_part_dim", batch)
        files.move(spark, f"{zones.landing}/{name}", f"{zones.raw_archive}/{name}")
    return read_bronze(spark, f"{zones.bronze}/gold_part_dim")


_DRIFTED_SQL = f"""
SELECT {text_list([c for c in PARTS if c != "p_type"])},
       CASE WHEN p_size > 25 THEN p_type END AS p_type,
       CASE WHEN p_size > 25 THEN 'import' END AS p_origin,
       CASE WHEN p_size > 25 THEN 'feed_large.parquet' ELSE 'feed_small.csv' END AS source_file,
       '{INGESTED_AT}' AS ingest_timestamp
FROM part
"""


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested values become JSON text."""
    customer = table(spark, sf_dir, "customer")
    nested = customer.select(
        "c_custkey",
        F.struct("c_nationkey", "c_mktsegment").alias("home"),
        F.array("c_name", "c_mktsegment").alias("labels"),
    )
    return string_safe(nested)


_NESTED_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
       '{"c_nationkey":' || c_nationkey || ',"c_mktsegment":"' || c_mktsegment || '"}' AS home,
       '["' || c_name || '","' || c_mktsegment || '"]' AS labels
FROM customer
"""

_PATTERNS = [
    ("gold_urgent_fact", "1-URGENT"),
    ("gold_high_fact", "high"),
    ("gold_order_fact", "_F"),
    ("gold_low_fact", "5-low"),
]


def _landing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing path for every order: priority, status and key in the name, five extensions."""
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(".CSV"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit(".json"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(".xml"))
        .when(F.col("o_orderstatus") == "O", F.lit(".parquet/"))
        .otherwise(F.lit(".xlsx"))
    )
    name = F.concat("o_orderpriority", F.lit("_"), "o_orderstatus", F.lit("."), "o_orderkey", kind)
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("/in/"), name).alias("path"))


_ROUTE_SQL = """
WITH paths AS (
  SELECT '/in/' || o_orderpriority || '_' || o_orderstatus || '.' || o_orderkey ||
         CASE WHEN o_orderpriority = '1-URGENT' THEN '.CSV' WHEN o_orderpriority = '2-HIGH' THEN '.json'
              WHEN o_orderpriority = '3-MEDIUM' THEN '.xml' WHEN o_orderstatus = 'O' THEN '.parquet/' ELSE '.xlsx' END AS path
  FROM orders
), named AS (
  SELECT path, regexp_extract(rtrim(path, '/'), '[^/]*$') AS file_name FROM paths
), matched AS (
  SELECT path, file_name, lower(regexp_extract(file_name, '[^.]*$')) AS extension,
         CASE WHEN contains(lower(path), '1-urgent') THEN 'gold_urgent_fact'
              WHEN contains(lower(path), 'high') THEN 'gold_high_fact'
              WHEN contains(lower(path), '_f') THEN 'gold_order_fact'
              WHEN contains(lower(path), '5-low') THEN 'gold_low_fact' END AS target_table
  FROM named
)
SELECT *, CASE WHEN target_table IS NULL THEN 'UNMATCHED'
               WHEN extension IN ('csv', 'json', 'xml', 'parquet') THEN 'MATCHED' ELSE 'UNSUPPORTED' END AS route
FROM matched
"""


def control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows drawn from the part table: one target per brand and type, a row per part."""
    part = table(spark, sf_dir, "part")
    brand = F.lower(F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("brand")))
    ending = F.when(F.col("p_size") > 25, "_dim").otherwise("_fact")
    words = F.replace("p_name", F.lit(" "), F.lit("_"))
    return part.select(
        F.concat(F.lit("gold_"), brand, F.lit("_"), F.lower("p_type"), ending).alias("target_table"),
        F.lit("csv").alias("source_type"),
        F.concat(words, F.lit("_"), F.col("p_partkey").cast("string")).alias("file_pattern"),
        F.when(F.col("p_size") > 40, F.lit("row")).alias("row_tag"),
        F.when(F.col("p_size") > 10, F.lit("SCD1")).otherwise(F.lit("SCD2")).alias("scd_strategy"),
        F.array(F.lit("p_partkey")).alias("natural_keys"),
        F.lit("NONE").alias("quarantine_rules"),
        F.col("p_size").alias("process_priority"),
        (F.col("p_type") != "SMALL").alias("is_active"),
    )


def _flat_keys(control: DataFrame) -> DataFrame:
    return control.withColumn("natural_keys", F.array_join("natural_keys", ","))


_CONTROL_SQL = """
WITH control AS (
  SELECT 'gold_' || lower(replace(p_brand, 'Brand#', 'brand')) || '_' || lower(p_type) ||
           CASE WHEN p_size > 25 THEN '_dim' ELSE '_fact' END AS target_table,
         'csv' AS source_type,
         replace(p_name, ' ', '_') || '_' || p_partkey AS file_pattern,
         CASE WHEN p_size > 40 THEN 'row' END AS row_tag,
         CASE WHEN p_size > 10 THEN 'SCD1' ELSE 'SCD2' END AS scd_strategy,
         'p_partkey' AS natural_keys,
         'NONE' AS quarantine_rules,
         p_size AS process_priority,
         p_type <> 'SMALL' AS is_active
  FROM part
)
"""
_ONE_TARGET = "gold_brand7_economy_dim"


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event through the file stream; the second run finds nothing new."""
    base = fresh_folder(spark, "stream")
    events = table(spark, sf_dir, "events")
    events.write.parquet(f"{base}/landing/feed_events.parquet")
    folder = f"{base}/bronze/events"
    schema = T.StructType(events.schema.fields)
    for _ in range(2):
        stream = landing_stream(spark, f"{base}/landing", "parquet", schema)
        ingest_available(stream, folder, f"{base}/checkpoint", CLOCK)
    return read_bronze(spark, folder)


def _stream_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines streamed as CSV files of two column orders and a JSON file, routed by the control rows."""
    zones = Zones.under(fresh_folder(spark, "stream"))
    lines = string_safe(table(spark, sf_dir, "lineitem"))
    targets = [Target("gold_line_fact", "feed", None, "SCD1", ("l_orderkey", "l_linenumber"), None, 1)]
    parts = (
        ("feed_a.csv", lines.where("l_returnflag = 'A'")),
        ("feed_n.CSV", lines.where("l_returnflag = 'N'").select(*reversed(LINES))),
        ("feed_rest.json", lines.where("l_returnflag NOT IN ('A', 'N') OR l_returnflag IS NULL")),
    )
    for name, rows in parts:
        land(rows, zones.landing, name)
        trail = AuditTrail(spark, zones.audit, name)
        stream_targets(spark, zones, targets, CLOCK, f"{zones.audit}-checkpoint", trail)
    return read_bronze(spark, f"{zones.bronze}/gold_line_fact")


_STREAM_LAYOUTS_SQL = f"""
SELECT {text_list(LINES)},
       CASE l_returnflag WHEN 'A' THEN 'feed_a.csv' WHEN 'N' THEN 'feed_n.CSV' ELSE 'feed_rest.json' END AS source_file,
       '{INGESTED_AT}' AS ingest_timestamp
FROM lineitem
"""


def _json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object per line, the lines ending in a tab or spaces, in a folder of several files."""
    zones = Zones.under(fresh_folder(spark, "json"))
    events = string_safe(table(spark, sf_dir, "events"))
    end = F.when(F.col("event_type") == "click", F.lit("\t")).otherwise(F.lit("  "))
    text = events.select(F.concat(F.to_json(F.struct(*EVENTS), {"ignoreNullFields": "false"}), end))
    text.repartition(4).write.text(f"{zones.landing}/feed_events.json")
    return ingest_landed(spark, zones, "gold_event_fact")


def _json_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value per line, an array over many lines, and one object over many lines, in one landing folder."""
    zones = Zones.under(fresh_folder(spark, "json"))
    parts = string_safe(table(spark, sf_dir, "part")).select("p_partkey", "p_name")
    parts.select(F.to_json(F.struct("*"))).write.text(f"{zones.landing}/feed_lines.json")
    nations = string_safe(table(spark, sf_dir, "nation")).select(
        F.col("n_nationkey").alias("p_partkey"), F.col("n_name").alias("p_name"))
    listed = nations.agg(F.to_json(F.array_sort(F.collect_list(F.struct("*")))).alias("value"))  # 25 nations at any size
    spread = listed.select(F.replace("value", F.lit("},{"), F.lit("},\n{")))
    spread.coalesce(1).write.text(f"{zones.landing}/feed_array.json")
    region = string_safe(table(spark, sf_dir, "region").where("r_regionkey = 0")).select(
        F.to_json(F.struct(F.col("r_regionkey").alias("p_partkey"), F.col("r_name").alias("p_name")), {"pretty": "true"}))
    region.coalesce(1).write.text(f"{zones.landing}/feed_object.json")
    return ingest_landed(spark, zones, "gold_part_dim")


_JSON_SHAPES_SQL = f"""
SELECT *, '{INGESTED_AT}' AS ingest_timestamp FROM (
  SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, 'feed_lines.json' AS source_file FROM part
  UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name, 'feed_array.json' FROM nation
  UNION ALL SELECT CAST(r_regionkey AS VARCHAR), r_name, 'feed_object.json' FROM region WHERE r_regionkey = 0
)
"""


def _csv_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV folder whose part files have their columns in two orders."""
    zones = Zones.under(fresh_folder(spark, "csv"))
    orders = string_safe(table(spark, sf_dir, "orders"))
    writer = {"header": "true"}
    urgent = F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False))
    orders.where(urgent).write.options(**writer).csv(f"{zones.landing}/feed_orders.csv")
    turned = orders.where(~urgent).select(*reversed(ORDERS))
    turned.write.mode("append").options(**writer).csv(f"{zones.landing}/feed_orders.csv")
    return ingest_landed(spark, zones, "gold_orders_fact")


def _csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks in quoted fields."""
    zones = Zones.under(fresh_folder(spark, "csv"))
    documents = string_safe(table(spark, sf_dir, "documents"))
    keep = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    documents.write.options(**keep).csv(f"{zones.landing}/feed_documents.csv")
    return ingest_landed(spark, zones, "gold_document_fact", options=ReadOptions(csv_multiline=True))


def _parquet_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Parquet folder whose part files have two sets of columns."""
    zones = Zones.under(fresh_folder(spark, "parquet"))
    customer = table(spark, sf_dir, "customer")
    rich = F.coalesce(F.col("c_acctbal") > 0, F.lit(False))
    customer.where(rich).write.parquet(f"{zones.landing}/feed_customer.parquet")
    customer.where(~rich).drop("c_name").write.mode("append").parquet(f"{zones.landing}/feed_customer.parquet")
    return ingest_landed(spark, zones, "gold_customer_dim")


_PARQUET_FOLDER_SQL = f"""
SELECT {text_list([c for c in CUSTOMERS if c != "c_name"])}, CASE WHEN c_acctbal > 0 THEN c_name END AS c_name,
       'feed_customer.parquet' AS source_file, '{INGESTED_AT}' AS ingest_timestamp
FROM customer
"""


def _all_text(names: Sequence[str]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frames = [string_safe(table(spark, sf_dir, name)) for name in names]
        return reduce(DataFrame.unionAll, frames)

    return run


QUERIES = {
    "string_safe_cast": Query(_all_text(["orders"]), f"SELECT {text_list(ORDERS)} FROM orders"),
    "string_safe_cast_lines": Query(_all_text(["lineitem"]), f"SELECT {text_list(LINES)} FROM lineitem"),
    "string_safe_nested": Query(_nested, _NESTED_SQL),
    "ingest_csv": Query(_ingest_one("orders", "feed_orders.csv"), _ingest_sql("orders", ORDERS, "feed_orders.csv")),
    "ingest_csv_inferred": Query(
        _ingest_one("orders", "feed_orders.csv", ReadOptions(infer_types=True)),
        _ingest_sql("orders", ORDERS, "feed_orders.csv"),
    ),
    "ingest_json": Query(
        _ingest_one("documents", "feed_documents.json"), _ingest_sql("documents", DOCUMENTS, "feed_documents.json")
    ),
    "ingest_xml": Query(_ingest_one("part", "feed_part.xml"), _ingest_sql("part", PARTS, "feed_part.xml")),
    "ingest_parquet": Query(
        _ingest_one("lineitem", "feed_lineitem.parquet"), _ingest_sql("lineitem", LINES, "feed_lineitem.parquet")
    ),
    "ingest_mixed_formats": Query(_ingest_mixed, _MIXED_SQL),
    "ingest_schema_drift": Query(_drifted, _DRIFTED_SQL),
    "route_files": Query(lambda spark, sf_dir: route(_landing_paths(spark, sf_dir), _PATTERNS), _ROUTE_SQL),
    "config_active": Query(
        lambda spark, sf_dir: _flat_keys(active_targets(control_rows(spark, sf_dir))),
        _CONTROL_SQL + "SELECT * FROM control WHERE is_active ORDER BY process_priority, target_table",
    ),
    "config_update": Query(
        lambda spark, sf_dir: _flat_keys(change_strategy(control_rows(spark, sf_dir), _ONE_TARGET)),
        _CONTROL_SQL
        + f"""SELECT * REPLACE (CASE WHEN target_table = '{_ONE_TARGET}' THEN 'SCD2' ELSE scd_strategy END AS scd_strategy)
FROM control""",
    ),
    "control_view": Query(
        lambda spark, sf_dir: _flat_keys(control_rules(control_rows(spark, sf_dir), _ONE_TARGET)),
        _CONTROL_SQL + f"SELECT * FROM control WHERE target_table = '{_ONE_TARGET}'",
    ),
    "surrogate_names": Query(
        lambda spark, sf_dir: control_rows(spark, sf_dir).select(
            "target_table", surrogate_name_of(F.col("target_table")).alias("surrogate_name")
        ),
        _CONTROL_SQL
        + """SELECT target_table,
       replace(replace(replace(target_table, 'gold_', ''), '_dim', ''), '_fact', '') || '_sk' AS surrogate_name
FROM control""",
    ),
    "stream_ingest": Query(_stream, _ingest_sql("events", EVENTS, "feed_events.parquet")),
    "stream_ingest_layouts": Query(_stream_layouts, _STREAM_LAYOUTS_SQL),
    "ingest_json_lines": Query(_json_lines, _ingest_sql("events", EVENTS, "feed_events.json")),
    "ingest_json_shapes": Query(_json_shapes, _JSON_SHAPES_SQL),
    "ingest_csv_folder": Query(_csv_folder, _ingest_sql("orders", ORDERS, "feed_orders.csv")),
    "ingest_csv_quoted": Query(_csv_quoted, _ingest_sql("documents", DOCUMENTS, "feed_documents.csv")),
    "ingest_parquet_folder": Query(_parquet_folder, _PARQUET_FOLDER_SQL),
}

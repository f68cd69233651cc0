"""Standardisation, dedup and quarantine queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltwork.functions import rules
from smeltwork.functions.naming import standardise
from smeltwork.operators import quality, quarantine
from smeltwork.operators.dedup import drop_copies, keep_latest, merge_latest
from smeltwork.operators.quarantine import Routed
from smeltwork.plans.silver import SilverOptions, cleanse
from smeltwork.queries.bronze import LINES
from smeltwork.queries.registry import Query, table

_HEADERS = {
    "p_partkey": " P PartKey ",
    "p_name": "Part Name",
    "p_brand": "BRAND",
    "p_type": "Type of.Part",
    "p_size": "size",
    "p_retailprice": "Retail  Price",
}


def _standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return standardise(part.toDF(*[_HEADERS[name] for name in part.columns]))


def _collided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two headers with one standard name; each part has its value under one of them."""
    part = table(spark, sf_dir, "part")
    twice = part.select(
        "p_partkey",
        F.when(F.col("p_size") > 25, F.col("p_name")).alias("Part Name"),
        F.when(F.col("p_size") <= 25, F.col("p_name")).alias("part_name"),
    )
    return standardise(twice, on_collision="coalesce")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


_LINE_KEYS = ["l_orderkey", "l_linenumber"]
_LINE_ORDER = ["l_shipdate"]
_LINE_NEWEST = "l_shipdate DESC, " + ", ".join(
    f"{name} DESC" for name in LINES if name not in (*_LINE_KEYS, *_LINE_ORDER)
)
_LATEST_LINES_SQL = f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_NEWEST}) = 1
"""

_UNSURE_EVENTS = """
SELECT event_id, ts, nullif(user_id, 7) AS user_id, event_type, value, props FROM events
"""


def _null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).withColumn("user_id", F.nullif("user_id", F.lit(7)))
    return keep_latest(events, ["user_id", "event_type"], ["ts", "event_id"])


def _skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key holds more than half of all lines."""
    lines = _lines(spark, sf_dir).withColumn(
        "l_suppkey", F.when(F.col("l_quantity") > 20, F.lit(-1)).otherwise(F.col("l_suppkey"))
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    return keep_latest(lines, ["l_suppkey"], order)


_SKEWED_SQL = """
WITH skewed AS (
  SELECT * REPLACE (CASE WHEN l_quantity > 20 THEN -1 ELSE l_suppkey END AS l_suppkey) FROM lineitem
)
SELECT * FROM skewed
QUALIFY row_number() OVER (
  PARTITION BY l_suppkey
  ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC,
           l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC
) = 1
"""


def _merged_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches by order status, folded one after the other into the newest row per line."""
    joined = _lines(spark, sf_dir)
    state = keep_latest(joined.where("l_returnflag = 'A'"), _LINE_KEYS, _LINE_ORDER)
    other = F.coalesce(~F.col("l_returnflag").isin("A", "N"), F.lit(True))
    for batch in (F.col("l_returnflag") == "N", other):
        state = merge_latest(state, joined.where(batch), _LINE_KEYS, _LINE_ORDER)
    return state


def _own_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source may have columns named like the library's own working columns."""
    ranked = _lines(spark, sf_dir).withColumns({"_rank": F.col("l_linenumber"), "_RANK_": F.lit("kept")})
    return keep_latest(ranked, _LINE_KEYS, _LINE_ORDER)


_RULE = "c_acctbal < 0"
_UNSURE = """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS c_acctbal, c_mktsegment
FROM customer
"""


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; the balance of one segment is unknown."""
    customer = table(spark, sf_dir, "customer")
    known = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    return customer.withColumn("c_acctbal", known)


def _routed(spark: SparkSession, sf_dir: str, on_unknown: str = "clean") -> Routed:
    return quarantine.route(_customers(spark, sf_dir), _RULE, on_unknown)


def _null_key_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).withColumn("user_id", F.nullif("user_id", F.lit(7)))
    return quarantine.route(events, "value > 50", keys=["user_id"], null_keys="quarantine").flagged


_NAMED_RULES = {
    "negative_balance": "c_acctbal < 0",
    "far_nation": "c_nationkey >= 20",
    "unknown_balance": "c_acctbal IS NULL",
    "off": "NONE",
}


def _violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = quarantine.with_violations(_customers(spark, sf_dir), _NAMED_RULES)
    return marked.withColumn("violations", F.array_join("violations", ","))


def _as_bronze(frame: DataFrame) -> DataFrame:
    """Lines as a target's bronze rows: ship date as the ingest time."""
    return frame.withColumnRenamed("l_shipdate", "ingest_timestamp")


_RULED = "l_quantity > 40"
_BRONZE_NEWEST = _LINE_NEWEST.replace("l_shipdate", "ingest_timestamp")
_BRONZE_LINES = "lines AS (SELECT * RENAME (l_shipdate AS ingest_timestamp) FROM lineitem)"


def _cleansed(spark: SparkSession, sf_dir: str, options: SilverOptions = SilverOptions()) -> Routed:
    return cleanse(_as_bronze(_lines(spark, sf_dir)), _LINE_KEYS, _RULED, options)


def _conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.conservation(_lines(spark, sf_dir), _cleansed(spark, sf_dir))


QUERIES = {
    "standardise_columns": Query(
        _standardised,
        """SELECT p_partkey AS "p_partkey", p_name AS part_name, p_brand AS brand, p_type AS "type_of.part",
       p_size AS size, p_retailprice AS retail__price FROM part""",
    ),
    "standardise_collision": Query(_collided, "SELECT p_partkey, p_name AS part_name FROM part"),
    "dedup_latest": Query(
        lambda spark, sf_dir: keep_latest(_events(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"]),
        """SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "dedup_exact": Query(
        lambda spark, sf_dir: drop_copies(table(spark, sf_dir, "documents").select("text", "lang")),
        "SELECT DISTINCT text, lang FROM documents",
    ),
    "dedup_exact_newest": Query(
        lambda spark, sf_dir: drop_copies(table(spark, sf_dir, "documents"), ignoring=["doc_id", "source"]),
        """SELECT * FROM documents
QUALIFY row_number() OVER (PARTITION BY text, lang, n_chars ORDER BY doc_id DESC, source DESC) = 1""",
    ),
    "dedup_composite": Query(
        lambda spark, sf_dir: keep_latest(_lines(spark, sf_dir), _LINE_KEYS, _LINE_ORDER), _LATEST_LINES_SQL
    ),
    "dedup_null_keys": Query(
        _null_keys,
        f"""SELECT * FROM ({_UNSURE_EVENTS})
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "dedup_skewed_key": Query(_skewed, _SKEWED_SQL),
    "dedup_own_names": Query(
        _own_rank, f"SELECT *, l_linenumber AS _rank, 'kept' AS _RANK_ FROM ({_LATEST_LINES_SQL})"
    ),
    "latest_incremental": Query(_merged_batches, _LATEST_LINES_SQL),
    "quarantine_bad": Query(
        lambda spark, sf_dir: _routed(spark, sf_dir).bad, f"SELECT * FROM ({_UNSURE}) WHERE ({_RULE}) IS TRUE"
    ),
    "quarantine_clean": Query(
        lambda spark, sf_dir: _routed(spark, sf_dir).clean, f"SELECT * FROM ({_UNSURE}) WHERE ({_RULE}) IS NOT TRUE"
    ),
    "quarantine_three_valued": Query(
        lambda spark, sf_dir: _routed(spark, sf_dir, "drop").clean, f"SELECT * FROM ({_UNSURE}) WHERE NOT ({_RULE})"
    ),
    "quarantine_unknown": Query(
        lambda spark, sf_dir: _routed(spark, sf_dir, "quarantine").bad,
        f"SELECT * FROM ({_UNSURE}) WHERE coalesce({_RULE}, TRUE)",
    ),
    "quarantine_off": Query(
        lambda spark, sf_dir: quarantine.route(_customers(spark, sf_dir), " none ").clean, _UNSURE
    ),
    "quarantine_counts": Query(
        lambda spark, sf_dir: quarantine.verdict_counts(_routed(spark, sf_dir, "drop")),
        f"""SELECT CASE WHEN {_RULE} THEN '{rules.QUARANTINE}' WHEN NOT ({_RULE}) THEN '{rules.CLEAN}'
            ELSE '{rules.DROPPED}' END AS quarantine_verdict, count(*) AS row_count FROM ({_UNSURE}) GROUP BY 1""",
    ),
    "quarantine_null_keys": Query(
        _null_key_route,
        f"""SELECT *, CASE WHEN user_id IS NULL OR value > 50 THEN 'quarantine' ELSE 'clean' END AS quarantine_verdict
FROM ({_UNSURE_EVENTS})""",
    ),
    "quarantine_violations": Query(
        _violations,
        f"""SELECT *, concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'negative_balance' END,
       CASE WHEN c_nationkey >= 20 THEN 'far_nation' END,
       CASE WHEN c_acctbal IS NULL THEN 'unknown_balance' END) AS violations FROM ({_UNSURE})""",
    ),
    "cleanse_latest_then_rule": Query(
        lambda spark, sf_dir: _cleansed(spark, sf_dir).flagged,
        f"""WITH {_BRONZE_LINES}
SELECT *, CASE WHEN {_RULED} THEN 'quarantine' ELSE 'clean' END AS quarantine_verdict FROM lines
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_BRONZE_NEWEST}) = 1""",
    ),
    "cleanse_last_good": Query(
        lambda spark, sf_dir: _cleansed(spark, sf_dir, SilverOptions(fallback_to_last_good=True)).flagged,
        f"""WITH {_BRONZE_LINES}
SELECT *, 'quarantine' AS quarantine_verdict FROM lines WHERE {_RULED}
UNION ALL
SELECT * FROM (
  SELECT *, 'clean' AS quarantine_verdict FROM lines WHERE NOT ({_RULED})
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_BRONZE_NEWEST}) = 1
)""",
    ),
    "row_conservation": Query(
        _conservation,
        f"""WITH latest AS ({_LATEST_LINES_SQL})
SELECT (SELECT count(*) FROM lineitem) AS bronze_rows,
       count(*) FILTER (NOT ({_RULED})) AS clean_rows,
       count(*) FILTER ({_RULED}) AS bad_rows,
       CAST(0 AS BIGINT) AS dropped_rows,
       (SELECT count(*) FROM lineitem) - count(*) AS superseded_rows
FROM latest""",
    ),
    "repeated_keys": Query(
        lambda spark, sf_dir: quality.repeated_keys(_lines(spark, sf_dir), _LINE_KEYS),
        """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
    ),
}

"""Row digests, surrogate keys and dimension merges."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltwork.functions.clock import OPEN_END, BatchClock
from smeltwork.functions.hashing import row_digest
from smeltwork.functions.naming import refs, surrogate_name
from smeltwork.operators import quality, scd
from smeltwork.operators.history import versions_from_history
from smeltwork.operators.snapshot import snapshot
from smeltwork.operators.surrogate import highest_key, key_text, number_rows, preserve_keys
from smeltwork.operators.views import batch_validation
from smeltwork.queries.registry import Query, digest_sql, instant_text, table
from smeltwork.session import DIMENSION_CODEC, Scratch

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
CLOCK1, CLOCK2, CLOCK3 = (BatchClock.at(text, "timestamp_ntz") for text in (T1, T2, T3))


@dataclass(frozen=True)
class Source:
    """A table as a first batch, and how the second batch differs from it.

    The predicates and the change are SQL that means the same to Spark and to the
    comparison engine.
    """

    table: str
    target: str
    key: str
    columns: tuple[str, ...]
    changed: str
    change: str
    gone: str
    fresh: str

    @property
    def sk(self) -> str:
        return surrogate_name(self.target)

    @property
    def business(self) -> list[str]:
        return sorted(name for name in self.columns if name != self.key)

    def first(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, self.table)

    def second(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """Some rows gone, some changed, and some copied under new keys."""
        rows = self.first(spark, sf_dir)
        kept = rows.where(f"NOT ({self.gone})").withColumn(self.changed, F.expr(self.change))
        added = rows.where(self.fresh).withColumn(self.key, F.expr(f"-1 - {self.key}"))
        return kept.unionByName(added)

    def third(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """The second batch with the rows the first change left alone changed."""
        return self.second(spark, sf_dir).withColumn(self.changed, F.concat(F.col(self.changed), F.lit("!")))

    def sql(self) -> str:
        """The batches ``b1`` to ``b3`` with digests, and the first dimension ``d1``."""
        names = ", ".join(self.columns)
        moved = ", ".join(f"{self.change} AS {name}" if name == self.changed else name for name in self.columns)
        copied = ", ".join(f"-1 - {name} AS {name}" if name == self.key else name for name in self.columns)
        later = ", ".join(f"{name} || '!' AS {name}" if name == self.changed else name for name in self.columns)
        digest = digest_sql(self.business)
        return f"""
WITH s2 AS (
  SELECT {moved} FROM {self.table} WHERE NOT ({self.gone})
  UNION ALL SELECT {copied} FROM {self.table} WHERE {self.fresh}
),
s3 AS (SELECT {later} FROM s2),
b1 AS (SELECT {names}, {digest} AS hash_key FROM {self.table}),
b2 AS (SELECT *, {digest} AS hash_key FROM s2),
b3 AS (SELECT *, {digest} AS hash_key FROM s3),
d1 AS (
  SELECT *, row_number() OVER (ORDER BY {self.key}) AS sk, '{T1}' AS effective_start_date,
         '{OPEN_END}' AS effective_end_date, TRUE AS is_active FROM b1
)"""

    def out(self, relation: str) -> str:
        """The published form of a dimension."""
        columns = ", ".join([self.key, *self.business])
        return (
            f"SELECT printf('%03d', sk) AS {self.sk}, {columns}, effective_start_date, effective_end_date, "
            f"is_active, hash_key FROM {relation}"
        )

    def scd1_sql(self, old: str, batch: str, instant: str, name: str, guard: str = "TRUE") -> str:
        """CTE ``name``: ``old`` updated by ``batch``."""
        take = f"b.{self.key} IS NOT NULL AND {guard}"
        picks = ", ".join(f"CASE WHEN {take} THEN b.{c} ELSE o.{c} END AS {c}" for c in [*self.business, "hash_key"])
        plain = ", ".join([self.key, *self.business, "hash_key"])
        return f"""
{name}_new AS (
  SELECT {plain}, (SELECT max(sk) FROM {old}) + row_number() OVER (ORDER BY {self.key}) AS sk
  FROM {batch} b WHERE NOT EXISTS (SELECT 1 FROM {old} o WHERE o.{self.key} = b.{self.key} AND o.is_active)
),
{name} AS (
  SELECT o.{self.key}, {picks}, o.sk,
         CASE WHEN {take} THEN '{instant}' ELSE o.effective_start_date END AS effective_start_date,
         o.effective_end_date, o.is_active
  FROM {old} o LEFT JOIN {batch} b ON o.{self.key} = b.{self.key} AND o.is_active
  UNION ALL
  SELECT {plain}, sk, '{instant}', '{OPEN_END}', TRUE FROM {name}_new
)"""

    def scd2_sql(self, old: str, batch: str, instant: str, name: str) -> str:
        """CTE ``name``: ``old`` with the versions of ``batch`` added."""
        plain = ", ".join([self.key, *self.business, "hash_key"])
        return f"""
{name}_new AS (
  SELECT {plain}, (SELECT max(sk) FROM {old}) + row_number() OVER (ORDER BY {self.key}) AS sk
  FROM {batch} b WHERE NOT EXISTS (
    SELECT 1 FROM {old} o WHERE o.{self.key} = b.{self.key} AND o.hash_key = b.hash_key AND o.is_active)
),
{name} AS (
  SELECT {plain}, sk, effective_start_date,
         CASE WHEN is_active AND {self.key} IN (SELECT {self.key} FROM {name}_new) THEN '{instant}'
              ELSE effective_end_date END AS effective_end_date,
         is_active AND {self.key} NOT IN (SELECT {self.key} FROM {name}_new) AS is_active
  FROM {old}
  UNION ALL
  SELECT {plain}, sk, '{instant}', '{OPEN_END}', TRUE FROM {name}_new
)"""


CUSTOMER = Source(
    "customer",
    "gold_customer_dim",
    "c_custkey",
    ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "c_mktsegment",
    "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'CHANGED' ELSE c_mktsegment END",
    "c_nationkey = 7",
    "c_nationkey = 3",
)
ORDERS = Source(
    "orders",
    "gold_orders_fact",
    "o_orderkey",
    ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "o_orderstatus",
    "CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END",
    "o_orderpriority = '5-LOW'",
    "o_orderpriority = '1-URGENT'",
)
PART = Source(
    "part",
    "gold_part_dim",
    "p_partkey",
    ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "p_type",
    "CASE WHEN p_size > 40 THEN 'RENEWED' ELSE p_type END",
    "p_size = 7",
    "p_size = 3",
)


def shown(rows: DataFrame) -> DataFrame:
    """A dimension with its validity instants as text."""
    return rows.withColumns(
        {name: instant_text(F.col(name)) for name in ("effective_start_date", "effective_end_date")}
    )


def _batch(source: Source, rows: DataFrame, clock: BatchClock) -> scd.Batch:
    return scd.batch_of(rows, [source.key], clock)


def _first_dimension(source: Source, spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.initial_load(_batch(source, source.first(spark, sf_dir), CLOCK1), source.sk).rows


def _second_batch(source: Source, spark: SparkSession, sf_dir: str) -> scd.Batch:
    return _batch(source, source.second(spark, sf_dir), CLOCK2)


Run = Callable[[SparkSession, str], DataFrame]


def _initial(source: Source) -> Query:
    return Query(lambda spark, sf_dir: shown(_first_dimension(source, spark, sf_dir)), source.sql() + source.out("d1"))


def _scd1(source: Source, skip_unchanged: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        old = _first_dimension(source, spark, sf_dir)
        batch = _second_batch(source, spark, sf_dir)
        return shown(scd.scd1(old, batch, source.sk, skip_unchanged).rows)

    guard = "b.hash_key <> o.hash_key" if skip_unchanged else "TRUE"
    return Query(run, source.sql() + "," + source.scd1_sql("d1", "b2", T2, "d2", guard) + source.out("d2"))


def _scd2(source: Source) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        old = _first_dimension(source, spark, sf_dir)
        batch = _second_batch(source, spark, sf_dir)
        return shown(scd.scd2(old, batch, source.sk).rows)

    return Query(run, source.sql() + "," + source.scd2_sql("d1", "b2", T2, "d2") + source.out("d2"))


def _scd2_expired(source: Source) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        active = _first_dimension(source, spark, sf_dir)
        fresh = scd.new_versions(active, _second_batch(source, spark, sf_dir).staged, [source.key])
        return shown(scd.expire(active, fresh, [source.key], CLOCK2).where("NOT is_active"))

    sql = source.sql() + "," + source.scd2_sql("d1", "b2", T2, "d2") + source.out("d2 WHERE NOT is_active")
    return Query(run, sql)


def _scd2_versions(source: Source) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        active = _first_dimension(source, spark, sf_dir)
        fresh = scd.new_versions(active, _second_batch(source, spark, sf_dir).staged, [source.key])
        return fresh.select(source.key, *source.business, "hash_key")

    columns = ", ".join([source.key, *source.business, "hash_key"])
    return Query(run, source.sql() + "," + source.scd2_sql("d1", "b2", T2, "d2") + f"SELECT {columns} FROM d2_new")


def _scd2_close_missing(source: Source) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        old = _first_dimension(source, spark, sf_dir)
        batch = _second_batch(source, spark, sf_dir)
        return shown(scd.scd2(old, batch, source.sk, close_missing=True).rows)

    gone = f"is_active AND {source.key} NOT IN (SELECT {source.key} FROM b2)"
    closed = f""",
d3 AS (
  SELECT * REPLACE (CASE WHEN {gone} THEN '{T2}' ELSE effective_end_date END AS effective_end_date,
                    is_active AND NOT ({gone}) AS is_active) FROM d2
)"""
    return Query(run, source.sql() + "," + source.scd2_sql("d1", "b2", T2, "d2") + closed + source.out("d3"))


def _scd2_sparse(source: Source) -> Query:
    """Numbers given to every staged row, so unchanged rows leave gaps."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        old = _first_dimension(source, spark, sf_dir)
        batch = _second_batch(source, spark, sf_dir)
        return shown(scd.scd2(old, batch, source.sk, dense_sk=False).rows)

    renumbered = f""",
n2 AS (SELECT {source.key}, (SELECT max(sk) FROM d1) + row_number() OVER (ORDER BY {source.key}) AS gap_sk FROM b2),
d3 AS (
  SELECT d2.* REPLACE (CASE WHEN d2.effective_start_date = '{T2}' THEN n2.gap_sk ELSE d2.sk END AS sk)
  FROM d2 LEFT JOIN n2 USING ({source.key})
)"""
    return Query(run, source.sql() + "," + source.scd2_sql("d1", "b2", T2, "d2") + renumbered + source.out("d3"))


def _switch(source: Source, strategies: Sequence[str]) -> Query:
    """Batches two and three, each merged by its own strategy."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        space = Scratch(spark, keep=True)
        dimension = _first_dimension(source, spark, sf_dir)
        later = ((source.second(spark, sf_dir), CLOCK2), (source.third(spark, sf_dir), CLOCK3))
        for strategy, (batch, clock) in zip(strategies, later):
            merged = scd.merge(strategy, dimension, _batch(source, batch, clock), source.sk, space)
            dimension = space.store(merged.rows, "dimension", DIMENSION_CODEC)
        return shown(dimension)

    make = {"SCD1": source.scd1_sql, "SCD2": source.scd2_sql}
    steps = [make[strategies[0]]("d1", "b2", T2, "d2"), make[strategies[1]]("d2", "b3", T3, "d3")]
    return Query(run, source.sql() + "," + ",".join(steps) + source.out("d3"))


def _schema_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch lacks one column and brings another."""
    old = _first_dimension(CUSTOMER, spark, sf_dir)
    batch = CUSTOMER.second(spark, sf_dir).drop("c_nationkey").withColumn("c_origin", F.lit("import"))
    return shown(scd.scd1(old, _batch(CUSTOMER, batch, CLOCK2), CUSTOMER.sk).rows)


_SCHEMA_CHANGE_SQL = (
    CUSTOMER.sql()
    + f""",
t2 AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, 'import' AS c_origin FROM s2),
e2 AS (SELECT *, {digest_sql(["c_acctbal", "c_mktsegment", "c_name", "c_origin"])} AS hash_key FROM t2),
added AS (
  SELECT c_custkey, (SELECT max(sk) FROM d1) + row_number() OVER (ORDER BY c_custkey) AS new_sk
  FROM e2 WHERE c_custkey NOT IN (SELECT c_custkey FROM d1)
)
SELECT printf('%03d', coalesce(d1.sk, added.new_sk)) AS customer_sk,
       c_custkey, coalesce(e2.c_acctbal, d1.c_acctbal) AS c_acctbal,
       coalesce(e2.c_mktsegment, d1.c_mktsegment) AS c_mktsegment, coalesce(e2.c_name, d1.c_name) AS c_name,
       d1.c_nationkey, e2.c_origin,
       CASE WHEN e2.hash_key IS NOT NULL THEN '{T2}' ELSE d1.effective_start_date END AS effective_start_date,
       '{OPEN_END}' AS effective_end_date, TRUE AS is_active, coalesce(e2.hash_key, d1.hash_key) AS hash_key
FROM d1 FULL JOIN e2 USING (c_custkey) LEFT JOIN added USING (c_custkey)"""
)

_HASHED = {
    "customer": ["c_custkey"],
    "documents": ["doc_id"],
    "events": ["event_id"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "nation": ["n_nationkey"],
    "orders": ["o_orderkey"],
    "part": ["p_partkey"],
    "region": ["r_regionkey"],
    "supplier": ["s_suppkey"],
}
_HASHED_BUSINESS = {
    "customer": ["c_acctbal", "c_mktsegment", "c_name", "c_nationkey"],
    "documents": ["lang", "n_chars", "source", "text"],
    "events": ["event_type", "props", "ts", "user_id", "value"],
    "lineitem": [
        "l_discount", "l_extendedprice", "l_linestatus", "l_partkey", "l_quantity", "l_returnflag",
        "l_shipdate", "l_suppkey", "l_tax",
    ],
    "nation": ["n_name", "n_regionkey"],
    "orders": ["o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"],
    "part": ["p_brand", "p_name", "p_retailprice", "p_size", "p_type"],
    "region": ["r_name"],
    "supplier": ["s_acctbal", "s_name", "s_nationkey"],
}


def _row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for name, keys in _HASHED.items():
        rows = table(spark, sf_dir, name)
        digest = row_digest(scd.business_columns(rows.columns, keys))
        key = F.concat_ws("/", *[column.cast("string") for column in refs(keys)])
        parts.append(rows.select(F.lit(name).alias("table_name"), key.alias("key"), digest.alias("hash_key")))
    return reduce(DataFrame.unionAll, parts)


_ROW_HASH_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, concat_ws('/', {', '.join(keys)}) AS key, "
    f"{digest_sql(_HASHED_BUSINESS[name])} AS hash_key FROM {name}"
    for name, keys in _HASHED.items()
)


def _sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey")
    numbered = number_rows(rows, ["c_custkey"], "number", start_after=40).rows
    return numbered.withColumn("customer_sk", key_text(F.col("number")))


def _composite_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return number_rows(table(spark, sf_dir, "lineitem").select(*keys).distinct(), keys, "number").rows


def _preserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _first_dimension(CUSTOMER, spark, sf_dir)
    return preserve_keys(CUSTOMER.second(spark, sf_dir), old, ["c_custkey"], CUSTOMER.sk)


def _validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _first_dimension(CUSTOMER, spark, sf_dir)
    batch = _second_batch(CUSTOMER, spark, sf_dir)
    merged = scd.scd2(old, batch, CUSTOMER.sk).rows
    return shown(batch_validation(merged, batch.silver, ["c_custkey"]))


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _first_dimension(ORDERS, spark, sf_dir)
    merged = scd.scd2(old, _second_batch(ORDERS, spark, sf_dir), ORDERS.sk).rows
    return quality.dimension_report(merged, ["o_orderkey"], ORDERS.sk)


def _history(name: str, keys: list[str], order_by: list[str], tracked: list[str]) -> Run:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown_exact(versions_from_history(table(spark, sf_dir, name), keys, order_by, tracked))

    return run


def shown_exact(rows: DataFrame) -> DataFrame:
    """Validity instants as text with microseconds."""
    names = ("effective_start_date", "effective_end_date")
    return rows.withColumns({name: F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss.SSSSSS") for name in names})


def _history_sql(name: str, keys: list[str], order_by: list[str], tracked: list[str]) -> str:
    wanted = ", ".join(dict.fromkeys([*keys, *order_by, *tracked]))
    by = ", ".join(keys)
    order = ", ".join([*order_by, "hash_key"])
    start = order_by[0]
    text = "'%Y-%m-%d %H:%M:%S.%f'"
    return f"""
WITH versions AS (SELECT DISTINCT {wanted}, {digest_sql(sorted(tracked))} AS hash_key FROM {name}),
marked AS (SELECT *, lag(hash_key) OVER (PARTITION BY {by} ORDER BY {order}) AS previous FROM versions),
starts AS (SELECT * FROM marked WHERE previous IS NULL OR previous <> hash_key),
ended AS (SELECT *, lead({start}) OVER (PARTITION BY {by} ORDER BY {order}) AS ending FROM starts)
SELECT {", ".join(dict.fromkeys([*keys, *tracked]))}, strftime({start}, {text}) AS effective_start_date,
       coalesce(strftime(ending, {text}), '{OPEN_END}.000000') AS effective_end_date,
       ending IS NULL AS is_active, hash_key
FROM ended"""


_EVENT_HISTORY = ("events", ["user_id"], ["ts", "event_id"], ["event_type"])
_ORDER_HISTORY = ("orders", ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderpriority", "o_orderstatus"])

_LIMITED = {"is_snapshot": True, "snapshot_layer": "Gold", "sample_type": "limit", "row_limit": 500}
_SAMPLED = {"is_snapshot": True, "snapshot_layer": "all", "sample_type": "share", "sample_fraction": 0.25}
_ELSEWHERE = {"is_snapshot": True, "snapshot_layer": "silver", "sample_type": "limit", "row_limit": 500}


def _snapshot(settings: dict) -> Run:
    return lambda spark, sf_dir: snapshot(table(spark, sf_dir, "orders"), settings, ["o_orderkey"], seed=7)


QUERIES = {
    "row_hash": Query(_row_hash, _ROW_HASH_SQL),
    "sk_sequence": Query(
        _sequence,
        """SELECT c_custkey, 40 + row_number() OVER (ORDER BY c_custkey) AS number,
       printf('%03d', 40 + row_number() OVER (ORDER BY c_custkey)) AS customer_sk FROM customer""",
    ),
    "sk_sequence_composite": Query(
        _composite_sequence,
        """SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS number
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
    ),
    "sk_highest": Query(
        lambda spark, sf_dir: highest_key(_first_dimension(ORDERS, spark, sf_dir), ORDERS.sk),
        "SELECT count(*) AS max_key FROM orders",
    ),
    "sk_preserve": Query(
        _preserved,
        CUSTOMER.sql()
        + """SELECT s2.*, CASE WHEN d1.sk IS NOT NULL THEN printf('%03d', d1.sk) END AS customer_sk
FROM s2 LEFT JOIN d1 USING (c_custkey)""",
    ),
    "schema_align": Query(
        lambda spark, sf_dir: scd.aligned(
            table(spark, sf_dir, "customer"), ["c_custkey", "c_acctbal", "c_origin", "c_name"]
        ),
        "SELECT c_custkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_origin, c_name FROM customer",
    ),
    "scd_initial_load": _initial(CUSTOMER),
    "scd_initial_load_orders": _initial(ORDERS),
    "scd1_merge": _scd1(CUSTOMER),
    "scd1_merge_orders": _scd1(ORDERS),
    "scd1_skip_unchanged": _scd1(PART, skip_unchanged=True),
    "scd1_schema_change": Query(_schema_change, _SCHEMA_CHANGE_SQL),
    "scd2_expire": _scd2_expired(CUSTOMER),
    "scd2_new_versions": _scd2_versions(CUSTOMER),
    "scd2_merge": _scd2(CUSTOMER),
    "scd2_merge_orders": _scd2(ORDERS),
    "scd2_close_missing": _scd2_close_missing(PART),
    "scd2_sparse_keys": _scd2_sparse(CUSTOMER),
    "scd1_to_scd2_switch": _switch(CUSTOMER, ["SCD1", "SCD2"]),
    "scd2_to_scd1_switch": _switch(PART, ["SCD2", "SCD1"]),
    "scd2_three_batches": _switch(ORDERS, ["SCD2", "SCD2"]),
    "scd2_from_history": Query(_history(*_EVENT_HISTORY), _history_sql(*_EVENT_HISTORY)),
    "scd2_from_history_orders": Query(_history(*_ORDER_HISTORY), _history_sql(*_ORDER_HISTORY)),
    "batch_validation": Query(
        _validation,
        CUSTOMER.sql()
        + ","
        + CUSTOMER.scd2_sql("d1", "b2", T2, "d2")
        + CUSTOMER.out("d2 WHERE c_custkey IN (SELECT c_custkey FROM b2) ORDER BY c_custkey, effective_start_date LIMIT 7"),
    ),
    "dimension_report": Query(
        _report,
        ORDERS.sql()
        + ","
        + ORDERS.scd2_sql("d1", "b2", T2, "d2")
        + """SELECT count(*) AS version_rows, count(DISTINCT o_orderkey) AS distinct_keys,
       count(*) FILTER (is_active) AS active_rows, CAST(0 AS BIGINT) AS keys_with_two_active,
       count(*) FILTER (effective_start_date > effective_end_date) AS reversed_ranges,
       count(*) - count(DISTINCT sk) AS repeated_surrogate_keys FROM d2""",
    ),
    "snapshot_limit": Query(_snapshot(_LIMITED), "SELECT * FROM orders ORDER BY o_orderkey LIMIT 500"),
    "snapshot_sample": Query(_snapshot(_SAMPLED)),
    "snapshot_off": Query(_snapshot(_ELSEWHERE), "SELECT * FROM orders"),
}

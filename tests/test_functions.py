import hashlib

import pytest
from pyspark.sql import functions as F

from smeltwork.functions import rules
from smeltwork.functions.casting import string_safe, typed
from smeltwork.functions.clock import BatchClock
from smeltwork.functions.hashing import row_digest
from smeltwork.functions.naming import standard_name, standardise, surrogate_name, surrogate_name_of
from smeltwork.operators.quarantine import route, with_violations
from tests.conftest import rows_of


def test_standard_name_trims_lowers_and_joins_words():
    assert standard_name("  Order Date ") == "order_date"
    assert standard_name("a  b") == "a__b"


def test_standardise_renames_dotted_columns(spark):
    frame = spark.createDataFrame([(1, 2)], ["A.B", " C d "])
    assert standardise(frame).columns == ["a.b", "c_d"]


def test_standardise_names_both_sides_of_a_collision(spark):
    frame = spark.createDataFrame([("x", None)], "`Id` string, `id ` string")
    with pytest.raises(ValueError, match="Id"):
        standardise(frame)
    assert rows_of(standardise(frame, on_collision="coalesce")) == [("x",)]


@pytest.mark.parametrize(
    ("target", "expected"),
    [("gold_employee_dim", "employee_sk"), ("gold_sales_fact", "sales_sk"), ("orders", "orders_sk")],
)
def test_surrogate_name(spark, target, expected):
    assert surrogate_name(target) == expected
    assert spark.range(1).select(surrogate_name_of(F.lit(target))).first()[0] == expected


def test_string_safe_keeps_nested_values_parseable(spark):
    frame = spark.sql("SELECT named_struct('a', 1, 'b', null) s, array(1, 2) l, 1.5D d, true t, date'2024-01-02' `x.y`")
    assert [kind for _, kind in string_safe(frame).dtypes] == ["string"] * 5
    assert rows_of(string_safe(frame)) == [('{"a":1,"b":null}', "[1,2]", "1.5", "true", "2024-01-02")]
    assert rows_of(string_safe(frame, nested="cast"))[0][:2] == ("{1, null}", "[1, 2]")


def test_typed_turns_bad_text_into_null(spark):
    frame = typed(spark.createDataFrame([("1.5",), ("abc",)], "v string"), {"v": "double"})
    assert sorted(row.v or 0.0 for row in frame.collect()) == [0.0, 1.5]


def test_joined_digest_is_the_plain_sha256(spark):
    frame = spark.createDataFrame([("x", None, 3)], "a string, b string, c int")
    digest = frame.select(row_digest(["a", "b", "c"])).first()[0]
    assert digest == hashlib.sha256(b"x||||3").hexdigest()


def test_digest_of_no_columns_is_constant(spark):
    assert spark.range(1).select(row_digest([])).first()[0] == hashlib.sha256(b"").hexdigest()


def test_struct_digest_tells_null_from_empty_and_separators_apart(spark):
    rows = [("x||y", ""), ("x", "y||"), ("", None), (None, "")]
    frame = spark.createDataFrame(rows, "a string, b string")
    assert frame.select(row_digest(["a", "b"], "struct")).distinct().count() == 4
    assert frame.select(row_digest(["a", "b"])).distinct().count() == 2
    with pytest.raises(ValueError):
        row_digest(["a"], "other")


def test_a_row_the_rule_cannot_judge(spark):
    frame = spark.createDataFrame([(1, -5.0), (2, 5.0), (3, None)], "id int, v double")
    by_mode = {mode: dict(rows_of(route(frame, "v < 0", mode).flagged.select("id", "quarantine_verdict"))) for mode in
               ("clean", "quarantine", "drop")}
    assert by_mode["clean"] == {1: "quarantine", 2: "clean", 3: "clean"}
    assert by_mode["quarantine"] == {1: "quarantine", 2: "clean", 3: "quarantine"}
    assert by_mode["drop"] == {1: "quarantine", 2: "clean", 3: "dropped"}
    plain = [frame.where("v < 0").count(), frame.where("NOT (v < 0)").count()]
    dropped = route(frame, "v < 0", "drop")
    assert [dropped.bad.count(), dropped.clean.count()] == plain
    with pytest.raises(ValueError):
        rules.verdict("v < 0", "other")


@pytest.mark.parametrize("rule", [None, "", "  ", "NONE", " none "])
def test_no_rule_means_all_clean(spark, rule):
    assert not rules.has_rule(rule)
    assert route(spark.range(3), rule).clean.count() == 3


def test_violations_lists_every_broken_rule(spark):
    frame = spark.createDataFrame([(1, -5), (9, 5), (9, -1)], "a int, b int")
    marked = with_violations(frame, {"big": "a > 5", "low": "b < 0", "off": "NONE"})
    assert [row.violations for row in marked.orderBy("a", "b").collect()] == [["low"], ["big", "low"], ["big"]]
    assert with_violations(frame, {}).first().violations == []


def test_null_keys_can_be_diverted(spark):
    frame = spark.createDataFrame([(None, 1), (2, 1)], "k int, v int")
    assert route(frame, None, keys=["k"], null_keys="quarantine").bad.count() == 1
    assert route(frame, None, keys=["k"]).bad.count() == 0
    with pytest.raises(ValueError):
        route(frame, None, keys=["k"], null_keys="other")


def test_clock_gives_one_instant_and_an_open_end(spark):
    clock = BatchClock.at("2024-01-01 00:00:00", "timestamp_ntz")
    row = spark.range(1).select(clock.now.cast("string"), clock.open_end.cast("string")).first()
    assert tuple(row) == ("2024-01-01 00:00:00", "9999-12-31 00:00:00")

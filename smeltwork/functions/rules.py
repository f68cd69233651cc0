"""Quarantine rules: SQL predicates that are true for bad rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: the rule text that switches quarantine off, in any letter case.
RULE_OFF = "NONE"

CLEAN, QUARANTINE, DROPPED = "clean", "quarantine", "dropped"
_UNKNOWN = {"clean": CLEAN, "quarantine": QUARANTINE, "drop": DROPPED}


def has_rule(rule: str | None) -> bool:
    return bool(rule and rule.strip()) and rule.strip().upper() != RULE_OFF


def tolerant(rule: str) -> Column:
    """A rule whose failing parts yield NULL: a value that does not parse says nothing about its row.

    On the tree that Spark's parser makes of the text, casts become ``try_cast`` and every
    condition between AND, OR and NOT becomes one that yields NULL where it would fail, also by an
    implicit cast, a division by zero or an overflow. So ``price < 0 OR name = 'x'`` still
    holds for a row named x whatever its price. A condition of CASE or IF that fails does not hold.
    """
    spark = SparkSession.active()
    catalyst = spark._jvm.org.apache.spark.sql.catalyst.expressions
    columns = spark._jvm.org.apache.spark.sql.classic.ExpressionUtils
    parser = spark._jsparkSession.sessionState().sqlParser()
    sequence = spark._jvm.org.apache.spark.api.python.PythonUtils.toSeq
    kind_of = lambda node: node.getClass().getSimpleName()

    def called(node) -> str:
        """The name of a function call that Spark would compute outside of its condition."""
        return node.nameParts().apply(0).lower() if kind_of(node) == "UnresolvedFunction" else ""

    def casting(node):
        below = [casting(node.children().apply(place)) for place in range(node.children().size())]
        if called(node) == "nullif":
            return catalyst.If(catalyst.TryEval(catalyst.EqualTo(*below)), parser.parseExpression("NULL"), below[0])
        # Spark moves what stands around a choice into its branches, so its conditions are tried by themselves.
        if kind_of(node) == "CaseWhen":
            below = [catalyst.TryEval(one) if place % 2 == 0 and place + 1 < len(below) else one for place, one in enumerate(below)]
        elif called(node) in ("if", "iff"):
            below = [catalyst.TryEval(below[0]), *below[1:]]
        if below:
            node = node.withNewChildren(sequence(below))
        if kind_of(node) != "Cast":
            return node
        return catalyst.Cast(node.child(), node.dataType(), node.timeZoneId(), catalyst.EvalMode.TRY())

    def judged(node):
        kind = kind_of(node)
        if kind in ("And", "Or"):
            return getattr(catalyst, kind)(judged(node.left()), judged(node.right()))
        if kind == "Not":
            return catalyst.Not(judged(node.child()))
        if called(node) == "between":
            value, low, high = (node.arguments().apply(place) for place in range(3))
            return judged(catalyst.And(catalyst.GreaterThanOrEqual(value, low), catalyst.LessThanOrEqual(value, high)))
        # Inside the function a part that several conditions share is not computed ahead of them, where it would fail.
        tried = Column(columns.column(catalyst.TryEval(casting(node))))
        return columns.expression(F.exists(F.array(F.lit(True)), lambda _: tried)._jc)

    return Column(columns.column(judged(parser.parseExpression(rule))))


_ON_ERROR = {"unknown": tolerant, "fail": F.expr}


def _condition(rule: str, on_error: str) -> Column:
    if on_error not in _ON_ERROR:
        raise ValueError(f"unknown on_error: {on_error}")
    return _ON_ERROR[on_error](rule)


def verdict(rule: str | None, on_unknown: str = "clean", on_error: str = "unknown") -> Column:
    """``clean``, ``quarantine`` or ``dropped`` for each row.

    A rule that yields NULL says nothing about the row. By default such a row stays
    clean; ``on_unknown`` can quarantine it, or drop it as a plain pair of
    ``rule`` / ``NOT rule`` filters would. A rule that fails on a row's values says nothing
    about it either, unless ``on_error="fail"`` lets it stop the job.
    """
    if on_unknown not in _UNKNOWN:
        raise ValueError(f"unknown on_unknown: {on_unknown}")
    if not has_rule(rule):
        return F.lit(CLEAN)
    outcome = _condition(rule, on_error)
    return (
        F.when(outcome, F.lit(QUARANTINE))
        .when(outcome.isNull(), F.lit(_UNKNOWN[on_unknown]))
        .otherwise(F.lit(CLEAN))
    )


def violations(rules: Mapping[str, str], on_error: str = "unknown") -> Column:
    """Names of the rules a row breaks, in the order given; one that fails on its values is not broken."""
    marks = [F.when(_condition(rule, on_error), F.lit(name)) for name, rule in rules.items() if has_rule(rule)]
    if not marks:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*marks))

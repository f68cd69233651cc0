"""Line dedup: later copies of repeated line runs are deleted.

Each document is a sequence of line ids. What can be part of a repeat are its windows of ``least_lines`` lines that occur
again: a run of lines repeats just as far as its sequence of such windows does. Over these windows a suffix array is built
by distributed prefix doubling: a window's rank is its place among the distinct windows, and in each round the rank of
2**k windows and the rank 2**k places further on, found by a join on the later offset, give the rank of twice as many, until
no class of equal ranks is split any more. Ranks are dense numbers of the sorted pairs; only counts per slice of the sort
reach the driver. Neighbours in the array then get their longest common prefix from the ranks of all rounds, the greatest
first. An interval of neighbours with a common prefix is a repeated run: its first member in order of documents stays, the
lines of the others are deleted, and the longest prefix that a suffix shares with a neighbour is the maximal repeated run
that starts there; ``longest_run`` is the greatest of a document. For the deletion the intervals of ``least_lines`` lines
suffice, because longer ones lie within them and cover no further line.

Order is by doc_id (null first), digest of the text, place in the text. Defined results: lines end at ``\\n``; a window
without a word is never deleted and ends a run; a document with fewer than ``least_lines`` lines loses nothing; rows equal
in id and text are copies of each other, the first of them (by digest of the row) comes first; where the text is null it
stays null; a copy of a whole document is left with an empty text; an empty table gives no rows. Lines are told apart by two
64-bit digests. A very long text is split into lines in one row, and its windows are rows of their own from there on.
Everything runs on built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltwork.llm.common import text_of, whole_row
from smeltwork.operators.history import KEY, beside
from smeltwork.operators.slices import sorted_slices
from smeltwork.operators.surrogate import number_rows
from smeltwork.session import Scratch

_PLACE = ("own", "tie", "at")


@dataclass(frozen=True)
class LineOptions:
    least_lines: int = 2


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _names(ids: Column, least_lines: int) -> Column:
    """The names of all runs of ``least_lines`` lines, by doubling; ``ids`` names the single lines."""

    def paired(one: Column, apart: int) -> Column:
        n = F.greatest(F.size(one) - apart, F.lit(0))
        return F.zip_with(F.slice(one, 1, n), F.slice(one, apart + 1, n), lambda a, b: F.xxhash64(a, b))

    names, width = ids, 1
    while 2 * width <= least_lines:
        names = paired(names, width)
        width *= 2
    return paired(names, least_lines - width) if width < least_lines else names


def _has_word(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(" \t\n\r\x0b\x0c"))) > 0


def suffixes_of(texts: DataFrame, options: LineOptions) -> DataFrame:
    """``id, own, tie, at, a, b``: the runs of ``least_lines`` lines at every place, with their two names."""
    least = options.least_lines
    split = texts.select("id", "own", "tie", _lines(F.col("text")).alias("lines"))
    named = split.select(
        "id", "own", "tie",
        F.transform("lines", _has_word).alias("words"),
        F.transform("lines", lambda line: F.xxhash64(F.lit(1), line)).alias("one"),
        F.transform("lines", lambda line: F.xxhash64(F.lit(2), line)).alias("two"),
    )
    worded = F.col("words")
    for apart in range(1, least):
        n = F.greatest(F.size("words") - apart, F.lit(0))
        worded = F.zip_with(F.slice(worded, 1, n), F.slice("words", apart + 1, n), lambda a, b: a | b)
    runs = F.arrays_zip(_names(F.col("one"), least).alias("a"), _names(F.col("two"), least).alias("b"), worded.alias("w"))
    return (
        named.select("id", "own", "tie", F.posexplode(runs).alias("at", "run"))
        .where("run.w").select("id", "own", "tie", "at", "run.a", "run.b")
    )


def _at(table: DataFrame, prefix: str, value: str) -> DataFrame:
    """``rank`` by place, with the place's columns renamed, as the right side of a join."""
    return table.select(*[F.col(name).alias(prefix + name) for name in _PLACE], F.col("rank").alias(value))


def _same(prefix: str, own: str, tie: str, at: Column) -> Column:
    return (F.col(own) == F.col(f"{prefix}own")) & (F.col(tie) == F.col(f"{prefix}tie")) & (at == F.col(f"{prefix}at"))


def _doubled(first: DataFrame, longest: int, classes: int, scratch: Scratch) -> list[DataFrame]:
    """Ranks by place of 1, 2, 4 ... windows, until they settle. ``first`` has those of one, in ``classes`` classes."""
    rounds, step = [first], 1
    while step < longest:
        now = rounds[-1]
        later = _at(now, "_", "after")
        pairs = now.join(later, _same("_", "own", "tie", F.col("at") + step), "left").select(*_PLACE, "rank", "after")
        numbered = number_rows(pairs.select("rank", "after").distinct(), ["rank", "after"], "next", scratch=scratch)
        same = (F.col("rank") == F.col("_rank")) & F.col("after").eqNullSafe(F.col("_after"))
        named = numbered.rows.select(F.col("rank").alias("_rank"), F.col("after").alias("_after"), "next")
        settled = numbered.count == classes
        classes, step = numbered.count, 2 * step
        rounds.append(scratch.store(pairs.join(named, same).select(*_PLACE, F.col("next").alias("rank")), "line-ranks"))
        if settled:
            break
    return rounds


def _shared(pairs: DataFrame, rounds: list[DataFrame], scratch: Scratch) -> DataFrame:
    """``shared`` windows of the suffixes at a place and at ``p_own, p_tie, p_at``, from the ranks of all rounds.

    Equal ranks of 2**k windows move both places on by as many; a rank that ends with its document's run is equal only to
    one that ends likewise, so the length of the run bounds what they share.
    """
    pairs = pairs.withColumn("shared", F.lit(0))
    for k in reversed(range(len(rounds))):
        left, right = _at(rounds[k], "l_", "l_rank"), _at(rounds[k], "r_", "r_rank")
        met = pairs.join(left, _same("l_", "own", "tie", F.col("at") + F.col("shared")), "left")
        met = met.join(right, _same("r_", "p_own", "p_tie", F.col("p_at") + F.col("shared")), "left")
        on = F.when(F.col("l_rank") == F.col("r_rank"), F.lit(1 << k)).otherwise(0)
        pairs = met.withColumn("shared", F.col("shared") + on).drop(*[f"{side}_{name}" for side in "lr" for name in (*_PLACE, "rank")])
        if k % 3 == 0:  # a few joins to a job
            pairs = scratch.store(pairs, "line-prefixes")
    return pairs.withColumn("shared", F.least("shared", "length"))


def _maximal_runs(repeated: DataFrame, buckets: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """``own, tie, longest``: lines of the longest run of each document that occurs again anywhere.

    ``repeated`` has the windows that occur again (own, tie, at, a, b), once for each row of ``docs``.
    """
    classes = number_rows(buckets.select("a", "b"), ["a", "b"], "rank", scratch=scratch)
    ranked = repeated.groupBy(*_PLACE, "a", "b").agg(F.count("*").alias("rows")).join(classes.rows, ["a", "b"])
    in_text = Window.partitionBy("own", "tie").orderBy("at")
    stretch = Window.partitionBy("own", "tie", "stretch")
    placed = ranked.withColumn("stretch", F.col("at") - F.row_number().over(in_text)).withColumn(
        "length", F.max("at").over(stretch) - F.col("at") + 1)
    first = scratch.store(placed.select(*_PLACE, "rank", "rows", "length"), "line-ranks")
    longest = first.agg(F.max("length")).first()[0] or 0
    rounds = _doubled(first.select(*_PLACE, "rank"), longest, classes.count, scratch)
    last = rounds[-1].withColumnRenamed("rank", "place").join(first, list(_PLACE))
    array = sorted_slices(last, ["place", *_PLACE], scratch).withColumn(KEY, F.lit(0))
    before = beside(array.withColumn("self", F.struct(*_PLACE, "rank")), "self", -1, "before")
    neighbour = F.col("before")["value"]
    pairs = before.where(neighbour["rank"] == F.col("rank")).select(
        *_PLACE, "length", *[neighbour[name].alias(f"p_{name}") for name in _PLACE])
    shared = _shared(scratch.store(pairs, "line-neighbours"), rounds, scratch)
    # A prefix shared with the neighbour before counts for both; rows equal in id and text repeat each other.
    both = shared.select("own", "tie", "shared").union(shared.select("p_own", "p_tie", "shared")).union(
        first.where("rows > 1").select("own", "tie", F.col("length").alias("shared")))
    return both.groupBy("own", "tie").agg((F.max("shared") + (least - 1)).alias("longest"))


def dedup_lines(docs: DataFrame, options: LineOptions = LineOptions(), id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """``_row`` (the row of ``docs``), ``kept_text, n_lines, n_removed, longest_run`` (lines of the longest maximal repeated run)."""
    least, scratch = options.least_lines, Scratch(docs.sparkSession, keep=True)
    text = text_of(F.col(f"_row.`{text_column}`"))
    # ``own`` and ``tie``, digests of id and text, are never null: one shuffle serves the join and the window below.
    rows = docs.select(whole_row(docs)).withColumns(
        {"own": F.xxhash64(F.col(f"_row.`{id_column}`")), "tie": F.xxhash64(text)})
    suffixes = scratch.store(
        suffixes_of(rows.select(F.col(f"_row.`{id_column}`").alias("id"), "own", "tie", text.alias("text")), options),
        "line-suffixes")
    buckets = scratch.store(
        suffixes.groupBy("a", "b").agg(F.count("*").alias("members"), F.min(F.struct("id", "tie", "at")).alias("first"))
        .where("members > 1").drop("members"), "line-buckets")
    repeated = scratch.store(suffixes.join(buckets, ["a", "b"]), "line-repeated")
    runs = _maximal_runs(repeated, buckets, least, scratch)
    # A later copy is any member but the first; rows at the very place of the first are told apart at the end.
    later = repeated.where(~F.struct("id", "tie", "at").eqNullSafe(F.col("first"))).select(*_PLACE).distinct()
    spans = later.groupBy("own", "tie").agg(
        F.flatten(F.collect_list(F.sequence("at", F.col("at") + (least - 1)))).alias("later"))
    found = scratch.store(runs.join(spans, ["own", "tie"], "full"), "line-spans")
    twin = Window.partitionBy("own", "tie").orderBy(F.xxhash64("_row"))
    joined = rows.join(found, ["own", "tie"], "left").withColumn("again", F.row_number().over(twin) > 1)
    lines = joined.select("_row", "later", "longest", "again", _lines(text).alias("lines"))
    count, worded = F.size("lines"), F.exists("lines", _has_word)
    every = F.sequence(F.lit(0), count - 1)
    # A second row with the same id and text repeats all its runs.
    whole = F.col("again") & (count >= least) & worded
    removed = F.when(whole, every).otherwise(F.coalesce("later", F.array().cast("array<int>")))
    cut = lines.select("_row", "lines", F.array_except(every, removed).alias("kept"), F.coalesce("longest", F.lit(0)).alias("longest_run"))
    kept_text = F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")
    return cut.select(
        "_row",
        F.when(F.size("kept") < F.size("lines"), kept_text).otherwise(F.col(f"_row.`{text_column}`")).alias("kept_text"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
        F.col("longest_run").cast("long").alias("longest_run"),
    )


#: The same result for ``least_lines`` 2: runs grow line by line as long as they occur again.
SQL = r"""
WITH RECURSIVE lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents
), pairs AS (
    SELECT doc_id, pos, line, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS after,
           lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS there
    FROM lines
), named AS MATERIALIZED (
    SELECT doc_id, pos, dense_rank() OVER (ORDER BY line, after) AS name,
           count(*) OVER (PARTITION BY line, after) AS members,
           first_value(doc_id) OVER same AS first_id, first_value(pos) OVER same AS first_pos
    FROM pairs
    WHERE there IS NOT NULL AND regexp_matches(line || after, '[^\x20\x09-\x0D]')
    WINDOW same AS (PARTITION BY line, after ORDER BY doc_id, pos)
), again AS MATERIALIZED (
    SELECT doc_id, pos, name FROM named WHERE members > 1
), grown AS (
    SELECT doc_id, pos, name, 2 AS n FROM again
    UNION ALL
    SELECT doc_id, pos, name, n FROM (
        SELECT g.doc_id, g.pos, dense_rank() OVER (ORDER BY g.name, a.name) AS name, g.n + 1 AS n,
               count(*) OVER (PARTITION BY g.name, a.name) AS members
        FROM grown g JOIN again a ON a.doc_id = g.doc_id AND a.pos = g.pos + g.n - 1)
    WHERE members > 1
), runs AS (
    SELECT doc_id, max(n) AS longest_run FROM grown GROUP BY doc_id
), later AS (
    SELECT doc_id, pos FROM named WHERE NOT (doc_id = first_id AND pos = first_pos)
), gone AS (
    SELECT doc_id, pos FROM later UNION SELECT doc_id, pos + 1 FROM later
), kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
    FROM lines WHERE (doc_id, pos) NOT IN (SELECT doc_id, pos FROM gone) GROUP BY doc_id
)
SELECT d.doc_id, len(string_split(coalesce(d.text, ''), chr(10))) AS n_lines,
       coalesce((SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id), 0) AS n_removed,
       coalesce(r.longest_run, 0) AS longest_run, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN runs r ON r.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

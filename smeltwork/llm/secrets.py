"""Secret scans: fixed patterns, and two character Markov models compared by log-likelihood ratio.

The patterns find assigned values, access keys and long hex strings. Two first-order Markov models are trained on labelled
samples: random strings, which are what the patterns find and as many base64 texts of digests, and ordinary identifiers, which
are the tokens outside of the patterns. Both are counted over all documents, each distinct secret and identifier once; digits
count as one character, so names that differ in their numbers are one. Letters are compared in lower case, and a second chain
tells how upper and lower case follow each other in tokens that mix them. Counts lean on those of character classes, no single
transition says more than ``most_step``, and those to and from a sign say nothing: paths and dashed names are their parts.
Identifiers that models trained on the others call random by far are left out: a key pasted into many documents is not learned
as ordinary.

A further token of 16 characters or more is a secret if it holds a letter (digits alone are numbers, not secrets) and random
strings explain its transitions better than identifiers by ``least_ratio`` in total and ``least_mean`` per transition (natural
log). Everything runs on built-in functions, and the work grows with the length of a text or token, however many matches it has.

Spans are whole matches in code points, end exclusive; matches of one kind do not overlap, a model's span overlaps no
pattern's. Defined results: a null text is empty; no match gives counts 0 and the digest of the empty string; without
samples of both kinds the models add nothing; rows with equal ids are scanned each on its own; of spans that start together
the kinds' order decides. Very long texts are scanned whole; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltwork.llm.common import only, text_of
from smeltwork.session import Scratch

#: Kind, pattern, group whose length counts, least length. Kinds are in order of rank.
PATTERNS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}+", 0, 32),
)
MODEL_KIND = "markov"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_SIGNS = "+/_=-"
#: What tokens are compared in: lower case, or words in capitals would look random, and 0 for every digit; signs are borders.
_KNOWN = _LETTERS + "0"
_ALPHABET = _KNOWN + _SIGNS
#: A lower-case letter, a capital, anything else.
_CASES = "aA0"
_TO_CASES = (_LETTERS + _LETTERS.upper() + "123456789" + _SIGNS, "a" * 26 + "A" * 26 + "0" * 14)
_TO_KNOWN = ("123456789", "0" * 9)
#: Listed one by one, which Java looks up in a table; ranges it tries in turn.
_CHARACTER = "[" + _LETTERS + _LETTERS.upper() + "0123456789" + "+/_=" + r"\-]"
_TOKEN = f"(?<!{_CHARACTER}){_CHARACTER * 16}{_CHARACTER}*+"
_IDENTIFIER = f"{_CHARACTER * 6}{_CHARACTER}*+"
_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
#: Running sums are made in blocks of so many: an aggregate that gathers an array copies it at every step.
_BLOCK = 128


@dataclass(frozen=True)
class SecretOptions:
    """Identifiers of ``ordinary_docs`` documents or more are ordinary, however many documents there are.

    Of these, what models of the others call random by ``pasted_mean`` per transition is not learned from.
    """

    ordinary_docs: int = 3
    smoothing: float = 0.5
    backing: float = 5.0
    most_step: float = 3.0
    least_ratio: float = 8.0
    least_mean: float = 0.3
    pasted_mean: float = 1.0


def _folded(token: Column) -> Column:
    return F.translate(F.lower(token), *_TO_KNOWN)


def _cased(token: Column) -> Column:
    return F.translate(token, *_TO_CASES)


def _mixed(token: Column) -> Column:
    """Whether there are letters of both cases; a token in one case throughout says nothing by it."""
    return token.rlike("[a-z]") & token.rlike("[A-Z]")


def _none(of: str) -> Column:
    return F.array().cast(of)


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often and in whatever loop it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, start: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each place of an array, ``merge`` over the values up to and with it."""
    def in_blocks(blocks: Column, merged: Column) -> Column:
        return F.flatten(F.transform(blocks, lambda block, i: _with(
            F.aggregate(F.slice(merged, 1, i), start, merge),
            lambda before: F.transform(block, lambda _, j: F.aggregate(F.slice(block, 1, j + 1), before, merge)))))

    return _with(values, lambda every: _with(
        F.transform(F.sequence(F.lit(0), F.size(every), F.lit(_BLOCK)), lambda at: F.slice(every, at + 1, _BLOCK)),
        lambda blocks: _with(F.transform(blocks, lambda block: F.aggregate(block, start, merge)), lambda merged: in_blocks(blocks, merged))))


def _located(text: Column, kind: str, rank: int, pattern: str, found: Column, values: Column, kept: Column) -> Column:
    """Array of (start, rank, end, kind, value) of the matches ``found`` where ``kept``."""
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))  # what lies before each match
    ends = _running(F.zip_with(gaps, found, lambda gap, match: F.length(gap) + F.length(match)), F.lit(0), lambda a, b: a + b)
    places = F.zip_with(ends, found, lambda end, match: F.struct((end - F.length(match)).alias("start"), end.alias("end")))
    marks = F.zip_with(values, kept, lambda value, keep: F.struct(value.alias("value"), keep.alias("kept")))
    spans = F.zip_with(places, marks, lambda place, mark: F.when(mark["kept"], F.struct(
        place["start"].alias("start"), F.lit(rank).alias("rank"), place["end"].alias("end"), F.lit(kind).alias("kind"), mark["value"].alias("value"))))
    return F.filter(spans, lambda span: span.isNotNull())


#: Columns of ``_possible``.
_MAY = [f"may_{kind}" for kind, _, _, _ in PATTERNS]


def _possible(text: Column, tokens: Column) -> list[Column]:
    """For each pattern, whether it may match the text, found in a fraction of the pattern's time; most texts have no match.

    ``tokens``: the text's, all of 32 characters or more among them.
    """
    lower, separated = F.lower(text), text.contains(":") | text.contains("=")
    assign = separated & reduce(or_, [lower.contains(part) for part in ("passw", "secret", "token", "key")])
    hexes = F.exists(tokens, lambda w: (F.octet_length(w) >= 32) & w.rlike("[0123456789abcdef]{32}"))
    return [may.alias(name) for may, name in zip((assign, text.contains("AKIA"), hexes), _MAY, strict=True)]


def base_spans(text: Column, may: list[Column] | None = None) -> Column:
    """Spans of all patterns, by start and then kind. ``may``: false for patterns that are known not to match."""
    parts, may = [], may or [F.lit(True) for _ in PATTERNS]
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        found, values = (F.regexp_extract_all(text, F.lit(pattern), F.lit(of)) for of in (0, group))
        spans = _located(text, kind, rank, pattern, found, values, F.transform(values, lambda value: F.length(value) >= least))
        parts.append(F.when(may[rank], spans).otherwise(_none(_SPANS)))
    return F.when(reduce(or_, may), F.array_sort(F.concat(*parts))).otherwise(_none(_SPANS))


def _class_of(character: str) -> int:
    return 1 if character == "0" else 0


def _chances(counts: dict[tuple[str, str], float], befores: str, afters: str, options: SecretOptions) -> dict[tuple[str, str], float]:
    """Transition probabilities.

    Rows with few counts lean on the class of what follows the class before, and on how often each character of that class occurs.
    """
    classes, pairs = [0.0] * 2, [[options.smoothing] * 2 for _ in range(2)]
    follows = {c: options.smoothing for c in afters}
    for (before, after), n in counts.items():
        follows[after] += n
        pairs[_class_of(before)][_class_of(after)] += n
    for c, n in follows.items():
        classes[_class_of(c)] += n
    there = [k for k in range(2) if classes[k]]
    out = {}
    for before in befores:
        row = pairs[_class_of(before)]
        lean = {c: row[_class_of(c)] / sum(row[k] for k in there) * n / classes[_class_of(c)] for c, n in follows.items()}
        total = sum(counts.get((before, c), 0.0) for c in afters) + options.backing
        for c in afters:
            out[before, c] = (counts.get((before, c), 0.0) + options.backing * lean[c]) / total
    return out


def ratios_of(counts: dict[tuple[bool, str, str, str], float], options: SecretOptions = SecretOptions()) -> list[float] | None:
    """Log-likelihood ratios from counts by (random, chain, before, after), letters' by row and then cases'.

    Steps to and from a sign have 0. None without counts of both kinds.
    """
    out = []
    for chain, befores, afters, all_of in (("letter", _KNOWN, _KNOWN, _ALPHABET), ("case", _CASES, _CASES[:2], _CASES)):
        chance = {}
        for random in (True, False):
            own = {(b, a): n for (r, k, b, a), n in counts.items() if r == random and k == chain and b in befores and a in afters}
            if not own and chain == "letter":
                return None
            chance[random] = _chances(own, befores, afters, options)
        step = {pair: math.log(p / chance[False][pair]) for pair, p in chance[True].items()}
        out += [max(-options.most_step, min(options.most_step, step[b, a])) if (b, a) in step else 0.0
                for b in all_of for a in all_of]
    return out


def _counts(samples: DataFrame) -> Counter[tuple[int, str, str, str]]:
    """Transitions by (part, chain, before, after); at most one count per part and pair of characters reaches the driver."""
    token, known = F.col("token"), f"(?=({_CHARACTER}{_CHARACTER}))"
    letters = F.regexp_extract_all(F.lower(token), F.lit(known), F.lit(1))
    cases = F.when(_mixed(token), F.regexp_extract_all(token, F.lit(known), F.lit(1))).otherwise(_none("array<string>"))
    counted = (
        samples.select("part", letters.alias("letters"), cases.alias("cases"))
        .select("part", F.size("letters").alias("n_letters"), F.posexplode(F.concat("letters", "cases")).alias("place", "step"))
        .groupBy("part", (F.col("place") < F.col("n_letters")).alias("letter"), "step").agg(F.count("*").alias("n"))
    )
    known_by, case_by = str.maketrans(*_TO_KNOWN), str.maketrans(*_TO_CASES)
    out: Counter[tuple[int, str, str, str]] = Counter()
    for r in counted.collect():
        before, after = r["step"].translate(known_by if r["letter"] else case_by)
        if r["letter"] or after != "0":
            out[r["part"], "letter" if r["letter"] else "case", before, after] += r["n"]
    return out


_RANDOM = 2


def _labelled(counts: Counter[tuple[int, str, str, str]], parts: Iterable[int]) -> dict[tuple[bool, str, str, str], float]:
    out: Counter[tuple[bool, str, str, str]] = Counter()
    for (part, *step), n in counts.items():
        if part in parts:
            out[part == _RANDOM, *step] += n
    return {step: float(n) for step, n in out.items()}


def train(samples: DataFrame, options: SecretOptions = SecretOptions()) -> list[float] | None:
    """Log-likelihood ratios, as of ``ratios_of``, from labelled ``samples`` (token string, random boolean).

    Each half of the ordinary samples is looked through by models that learned from the other half.
    """
    with Scratch(samples.sparkSession) as scratch:
        half = F.pmod(F.xxhash64("token"), F.lit(2)).cast("int")
        part = F.when(F.col("random"), _RANDOM).when(~F.col("random"), half)
        stored = scratch.store(samples.select("token", part.alias("part")), "secret-samples")
        counts, pasted = _counts(stored), F.lit(False)
        for this in (0, 1):
            ratios = ratios_of(_labelled(counts, (_RANDOM, 1 - this)))
            if ratios is not None:
                by_far = _likely(F.col("token"), ratios, replace(options, least_mean=options.pasted_mean))
                pasted = pasted | ((F.col("part") == this) & (F.length("token") >= 16) & by_far)
        return ratios_of(_labelled(counts - _counts(stored.where(F.coalesce(pasted, F.lit(True)))), (0, 1, _RANDOM)), options)


def samples_of(docs: DataFrame, options: SecretOptions = SecretOptions(), text_column: str = "text") -> DataFrame:
    """Labelled tokens of all documents, each distinct one once.

    Random: the values that patterns found, and the digest of each in base64, which knows all letters where the values are
    hex. Ordinary: tokens with a letter outside of them that occur, numbers aside, in ``ordinary_docs`` documents or more, as random
    strings hardly do.
    """
    text, words = F.col("text"), F.col("words")
    texts = only(docs, text=text_column).select(text_of(text).alias("text"))
    texts = texts.select("text", F.array_distinct(F.regexp_extract_all(text, F.lit(_IDENTIFIER), F.lit(0))).alias("words"))
    rest = text
    for _, pattern, _, _ in PATTERNS:
        rest = F.regexp_replace(rest, pattern, " ")
    may = [F.col(name) for name in _MAY]
    some = reduce(or_, may)
    apart = F.when(some, F.regexp_extract_all(rest, F.lit(_IDENTIFIER), F.lit(0))).otherwise(words)
    names = F.when(some | text.rlike("[1-9]"), F.array_distinct(F.transform(apart, lambda w: F.regexp_replace(w, "[1-9]", "0")))).otherwise(words)
    marked = texts.select("text", "words", *_possible(text, words)).select(
        F.transform(base_spans(text, may), lambda s: s["value"]).alias("secrets"), names.alias("names"))
    # One pass: the number of documents by identifier, and the secrets by value.
    found = (
        marked.select(F.size("secrets").alias("n_secrets"), F.posexplode(F.concat("secrets", "names")).alias("place", "token"))
        .select("token", (F.col("place") < F.col("n_secrets")).alias("random"))
        .groupBy("token", "random").agg(F.count("*").alias("n"))
        .where(F.col("random") | ((F.col("n") >= options.ordinary_docs) & F.col("token").rlike("[A-Za-z]")))
    )
    digest = F.rtrim(F.base64(F.unhex(F.sha2("token", 256))), F.lit("="))
    return found.select(
        F.explode(F.when(F.col("random"), F.array(F.col("token"), digest)).otherwise(F.array("token"))).alias("token"), "random")


def _likely(token: Column, ratios: list[float], options: SecretOptions) -> Column:
    """Whether random strings explain the token's transitions better, by enough in total and for each.

    Null for tokens with characters that the models do not know.
    """
    def total_of(alphabet: str, of: Column, shift: int) -> Column:
        width = len(alphabet)
        rows = [ratios[shift + at:shift + at + width] for at in range(0, width * width, width)]
        # Place 0 is what stands before the first character and says nothing.
        table = F.lit([0.0] * (width + 1) + [ratio for row in rows for ratio in (0.0, *row)])
        places = F.transform(F.split(of, ""), lambda c: F.instr(F.lit(alphabet), c))
        return F.aggregate(
            places, F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("total")),
            lambda state, place: F.struct(
                place.alias("before"), (state["total"] + F.get(table, state["before"] * (width + 1) + place)).alias("total")),
            lambda state: state["total"])

    by_case = total_of(_CASES, _cased(token), len(_ALPHABET) ** 2)
    total = total_of(_ALPHABET, _folded(token), 0) + F.when(_mixed(token), by_case).otherwise(0.0)
    likely = (total >= options.least_ratio) & (total >= options.least_mean * (F.length(token) - 1))
    return F.when(~token.rlike("[^" + _CHARACTER[1:]), likely)


def _with_apart(base: Column, models: Column) -> Column:
    """The spans ``base`` and those of ``models`` that overlap none of them, in order."""
    fixed, far = lambda span: span["rank"] < len(PATTERNS), F.lit(2**31 - 1)

    def apart(spans: Column) -> Column:
        # How far the patterns' spans reach up to each one, and where the next of them starts.
        reach = _running(F.transform(spans, lambda span: F.when(fixed(span), span["end"]).otherwise(0)), F.lit(0), lambda a, b: F.greatest(a, b))
        after = F.transform(F.reverse(spans), lambda span: F.when(fixed(span), span["start"]).otherwise(far))
        limits = F.zip_with(reach, F.reverse(_running(after, far, lambda a, b: F.least(a, b))), lambda a, b: F.struct(a.alias("reach"), b.alias("next")))
        kept = F.zip_with(spans, limits, lambda span, limit: F.when(
            fixed(span) | ((limit["reach"] <= span["start"]) & (span["end"] <= limit["next"])), span))
        return F.filter(kept, lambda span: span.isNotNull())

    return _with(F.array_sort(F.concat(base, models)), apart)


def scan(docs: DataFrame, ratios: list[float] | None, options: SecretOptions = SecretOptions(),
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, base, spans``: arrays of (start, rank, end, kind, value), sorted; ``spans`` holds the models' too."""
    text, tokens = F.col("text"), F.col("tokens")
    texts = only(docs, doc_id=id_column, text=text_column).select("doc_id", text_of(text).alias("text"))
    texts = texts.select("doc_id", "text", F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)).alias("tokens"))
    found, base = texts.select("doc_id", "text", "tokens", *_possible(text, tokens)), base_spans(text, [F.col(name) for name in _MAY])
    if ratios is None:
        return found.select("doc_id", base.alias("base")).withColumn("spans", F.col("base"))
    secret = F.transform(tokens, lambda token: token.rlike("[A-Za-z]") & _likely(token, ratios, options))
    found = found.select("doc_id", "text", "tokens", base.alias("base"), secret.alias("secret"))
    models = _located(text, MODEL_KIND, len(PATTERNS), _TOKEN, tokens, tokens, F.col("secret"))
    found = found.select("doc_id", "base", F.when(F.array_contains("secret", True), models).otherwise(_none(_SPANS)).alias("models"))
    both = F.when(F.size("models") == 0, F.col("base")).otherwise(_with_apart(F.col("base"), F.col("models")))
    return found.select("doc_id", "base", both.alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def n_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

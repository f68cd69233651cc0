"""Read groups of like files with one scan, tagged with the file each row came from."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltwork.functions.casting import string_safe
from smeltwork.functions.clock import BatchClock
from smeltwork.functions.naming import path_text, standard_name
from smeltwork.sources import files

# The row element when the control table names none.
ORDER_TAG, DEFAULT_TAG = "order", "employee"
CORRUPT = "_corrupt_record"
SOURCE_FILE, INGEST_TIMESTAMP = "source_file", "ingest_timestamp"
_HEADERS = 16  # files whose first line is read side by side

# Names that a source must leave to the layers, compared in standard form. The file's name and the ingest instant are
# not among them: they take the place of source columns of those names.
RESERVED = (CORRUPT, "silver_timestamp", "quarantine_verdict", "quarantined_at")


@dataclass(frozen=True)
class ReadOptions:
    """``infer_types=False`` keeps the text of the file (``007`` stays ``007``).

    ``csv_multiline`` lets quoted fields hold line breaks; such files cannot be split
    between tasks. ``malformed="keep"`` fills short CSV rows with NULL and cuts long ones,
    where the default refuses their file. ``malformed="divert"`` takes the good rows of a CSV or
    JSON-lines file and puts the text of the others aside. ``ledger`` says how a file that bronze holds already
    is known: by its ``delivery``, also by its ``content``, or ``off``: not at all.
    """

    infer_types: bool = False
    json_mode: str = "auto"
    nested: str = "json"
    csv_multiline: bool = False
    malformed: str = "reject"
    ledger: str = "delivery"


@dataclass(frozen=True)
class Feed:
    """Files of one target and format that share a layout.

    ``paths`` are landing entries. A CSV entry may be a folder whose part files differ in
    their headers: ``parts`` then holds the part files of this layout, and ``header`` the
    columns they share.
    """

    target: str
    format: str
    paths: tuple[str, ...]
    row_tag: str | None = None
    json_lines: bool = False
    header: tuple[str, ...] = ()
    parts: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def files(self) -> list[str]:
        return [part for path in self.paths for part in self.parts.get(path, (path,))]

    def only(self, path: str) -> Feed:
        return replace(self, paths=(path,))


class BadFile(ValueError):
    """A file that cannot be ingested, with the reason."""


def row_tag(target: str, configured: str | None) -> str:
    if configured:
        return configured
    return ORDER_TAG if "order" in target.lower() else DEFAULT_TAG


def _lines_of(spark: SparkSession, landing: str, entries: Sequence[dict], whole: bool = False) -> DataFrame:
    """``entry, value``: the text of landed files, by line or in one piece."""
    text = spark.read.text([entry["path"] for entry in entries], wholetext=whole)
    return text.select(landed_name(files.encoded_path(spark, landing)).alias("entry"), "value")


def _one_json_value(text: Column) -> Column:
    """Is the text one JSON object or array, with nothing after it?

    A parser stops at the end of the first value, so the text is put between brackets, as
    an element and as a member: what follows the value breaks one of the two.
    """
    element = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    member = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v string")
    found = (F.size(element) == 1) & member["v"].isNotNull() & text.rlike(r"^\s*[\[{]")
    return F.coalesce(found, F.lit(False))


def _broken_and_mixed(judged: DataFrame) -> tuple[set[str], set[str]]:
    """Entries with a line that is no value by itself, and of them those whose bad lines can be put aside.

    The reader must see for itself that such a line is bad: it would take the first of two values
    on a line and lose the other.
    """
    parsed = F.from_json("value", f"v string, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    seen = F.coalesce(parsed[CORRUPT].isNotNull(), F.lit(False))
    counts = judged.groupBy("entry").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"), F.count_if(~F.col("good") & ~seen).alias("hidden"))
    rows = counts.where("bad > 0").collect()
    return {row["entry"] for row in rows}, {row["entry"] for row in rows if row["good"] and not row["hidden"]}


def _json_feeds(spark, landing, target, entries, options, errors) -> list[Feed]:
    """Files with a value on every line, and files that are one value, from their whole text.

    One pass looks at every line of every file. Where a line is not a value by itself, a
    second pass asks whether the whole file is one; a file that is neither is refused, so no
    row is lost to a guess.
    """
    if options.json_mode != "auto":
        lines, single = (entries, []) if options.json_mode == "lines" else ([], entries)
    else:
        filled = _lines_of(spark, landing, entries).where(F.col("value").rlike(r"\S"))
        judged = filled.select("entry", "value", _one_json_value(F.col("value")).alias("good"))
        if options.malformed == "divert":
            broken, mixed = _broken_and_mixed(judged)
        else:
            bad = judged.where("NOT good").select("entry").distinct()
            broken, mixed = {row["entry"] for row in bad.collect()}, set()
        lines = [entry for entry in entries if entry["name"] not in broken]
        single = [entry for entry in entries if entry["name"] in broken]
        if single:
            texts = _lines_of(spark, landing, single, whole=True)
            neither = texts.where(~_one_json_value(F.col("value"))).select("entry").distinct()
            refused = {row["entry"] for row in neither.collect()}
            lines += [entry for entry in single if entry["name"] in refused & mixed]
            single = [entry for entry in single if entry["name"] not in refused & mixed]
            refused -= mixed
            errors |= {
                entry["path"]: f"Invalid JSON structure in {entry['name']}"
                for entry in single
                if entry["name"] in refused
            }
            single = [entry for entry in single if entry["name"] not in refused]
    made = [(lines, True), (single, False)]
    return [Feed(target, "json", tuple(e["path"] for e in group), json_lines=flag) for group, flag in made if group]


def _csv_feeds(spark, landing, target, entries, errors) -> list[Feed]:
    """Part files grouped by their header line, read from the beginning of each file.

    Columns of a CSV file are bound by position, so files with other headers must not
    share a scan. Two headers that differ in case only are refused here, before Spark
    renames them.
    """
    parts = [(entry["name"], file) for entry in entries for file in files.data_files(spark, entry["path"])]
    with ThreadPoolExecutor(_HEADERS) as pool:
        found = list(pool.map(lambda part: files.first_line(spark, part[1]), parts))
    by_name = {entry["name"]: entry["path"] for entry in entries}
    groups: dict[tuple[str, ...], dict[str, list[str]]] = defaultdict(lambda: defaultdict(list))
    for row in ({"entry": name, "file": file, "line": line} for (name, file), line in zip(parts, found) if line is not None):
        path = by_name[row["entry"]]
        names = next(csv.reader([row["line"].removeprefix("\ufeff")]))
        header = tuple(name or f"_c{i}" for i, name in enumerate(names))
        twins = [name for name in header if sum(other.lower() == name.lower() for other in header) > 1]
        if twins:
            errors[path] = f"columns share a name: {twins} in {row['entry']}"
        groups[header][path].append(row["file"])
    seen = {path for group in groups.values() for path in group}
    errors |= {path: f"No data columns in {name}" for name, path in by_name.items() if path not in seen}
    return [
        Feed(target, "csv", paths, header=header, parts={path: tuple(group[path]) for path in paths})
        for header, group in groups.items()
        if (paths := tuple(path for path in group if path not in errors))
    ]


def feeds(
    spark: SparkSession,
    target: str,
    routed: Sequence[dict],
    tag: str | None,
    options: ReadOptions,
    landing: str,
) -> tuple[list[Feed], dict[str, str]]:
    """Group the routed files of one target; files whose layout cannot be read come back as errors.

    The number of jobs does not depend on the number of files.
    """
    errors: dict[str, str] = {}
    kinds: dict[str, list[dict]] = defaultdict(list)
    for entry in routed:
        kinds[entry["extension"]].append(entry)
    made: list[Feed] = []
    for kind, entries in kinds.items():
        try:
            if kind == "csv":
                made += _csv_feeds(spark, landing, target, entries, errors)
            elif kind == "json":
                made += _json_feeds(spark, landing, target, entries, options, errors)
            else:
                paths = tuple(entry["path"] for entry in entries)
                made.append(Feed(target, kind, paths, row_tag(target, tag) if kind == "xml" else None))
        except Exception as error:  # noqa: BLE001 - find the file that cannot be read at all
            if len(entries) == 1:
                errors[entries[0]["path"]] = str(error)
                continue
            for entry in entries:
                single, failed = feeds(spark, target, [entry], tag, options, landing)
                made, errors = made + single, errors | failed
    return made, errors


def raw_frame(spark: SparkSession, feed: Feed, options: ReadOptions) -> DataFrame:
    """The rows of a feed as the reader gives them."""
    paths = feed.files
    text = "false" if options.infer_types else "true"
    typed = "true" if options.infer_types else "false"
    if feed.format == "csv":
        lines = "true" if options.csv_multiline else "false"
        reader = spark.read.options(header="true", multiLine=lines)
        kinds = ["string"] * len(feed.header)
        if options.infer_types:
            kinds = [kind for _, kind in reader.options(inferSchema="true").csv(paths).dtypes]
        fields = [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in zip(feed.header, kinds)]
        fields.append(T.StructField(CORRUPT, T.StringType()))
        return reader.options(columnNameOfCorruptRecord=CORRUPT).schema(T.StructType(fields)).csv(paths)
    if feed.format == "json":
        multiline = "false" if feed.json_lines else "true"
        return spark.read.options(multiLine=multiline, primitivesAsString=text).json(paths)
    if feed.format == "xml":
        return spark.read.format("xml").options(rowTag=feed.row_tag, inferSchema=typed).load(paths)
    if feed.format == "parquet":
        return spark.read.option("mergeSchema", True).parquet(*paths)
    raise BadFile(f"Unsupported file format: {feed.format}")


def landed_name(landing: str) -> Column:
    """The landing child a row came from, also when that child is a folder of part files.

    ``landing`` is the folder's encoded path. The name is cut out by position, and
    decoded only if it holds an escape, since this runs for every row.
    """
    prefix = landing.rstrip("/") + "/"
    path = F.col("_metadata.file_path")
    below = F.substr(path, F.instr(path, prefix) + F.lit(len(prefix)))
    return path_text(F.substring_index(below, "/", 1))


def tagged(spark: SparkSession, frame: DataFrame, landing: str, clock: BatchClock, options: ReadOptions) -> DataFrame:
    """All columns as text, plus the landing name and the ingest instant."""
    added = {SOURCE_FILE: landed_name(files.encoded_path(spark, landing)), INGEST_TIMESTAMP: clock.now}
    return string_safe(frame.withColumns(added), options.nested)


def bronze_frame(
    spark: SparkSession, feed: Feed, landing: str, clock: BatchClock, options: ReadOptions = ReadOptions()
) -> DataFrame:
    """A feed as bronze rows; refuses files without a readable layout."""
    frame = raw_frame(spark, feed, options)
    names = ", ".join(path.rsplit("/", 1)[-1] for path in feed.paths)
    diverts = feed.format == "csv" or (feed.json_lines and options.malformed == "divert")
    if not diverts and CORRUPT in frame.columns:
        raise BadFile(f"Invalid {feed.format.upper()} structure in {names}")
    source = [name for name in frame.columns if not diverts or name != CORRUPT]
    if not source:
        raise BadFile(f"No data columns in {names}")
    reserved = [name for name in source if standard_name(name) in RESERVED]
    if reserved:
        raise BadFile(f"source columns use reserved names: {reserved} in {names}")
    return tagged(spark, frame, landing, clock, options)

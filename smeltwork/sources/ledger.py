"""What bronze has taken: one row per delivered file, kept beside the attempt that holds its rows.

A file whose rows are in bronze but that could not be archived still lies in landing when the next
batch runs. The ledger tells it from a new delivery. A delivery is known by name, length and
modification time, which the listing gives without reading the file; ``content`` mode also
compares a digest of the bytes, so that a file sent again unchanged is not taken twice. Entries
count only if their attempt has finished, and are matched with the few files that wait.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltwork.functions.naming import path_text
from smeltwork.sources import files
from smeltwork.sources.readers import landed_name

LEDGER = "ledger"
DELIVERY, CONTENT, OFF = "delivery", "content", "off"
MODES = (DELIVERY, CONTENT, OFF)
_SCHEMA = "source_file string, length bigint, modified bigint, digest string"
_WHOLE_BYTES = 1 << 30  # longer files are digested line by line

Entry = dict


def _digest(parts: DataFrame, landing: str, place: Column, content: Column) -> DataFrame:
    """``source_file, digest``: of all parts of a landing entry, in any order, each with its place."""
    name = landed_name(landing).alias("source_file")
    both = [F.sum(F.xxhash64(F.lit(salt), place, content).cast("decimal(38,0)")) for salt in (1, 2)]
    return parts.groupBy(name).agg(F.sha2(F.concat_ws(",", F.count("*"), *both), 256).alias("digest"))


def content_digests(spark: SparkSession, entries: Sequence[Entry], landing: str) -> dict[str, str]:
    """A digest of the bytes of every entry; one row per entry reaches the driver.

    A file is read whole by one task, or line by line where it is too long for that.
    """
    root = files.encoded_path(spark, landing)
    below = F.regexp_replace(F.substr(F.col("_metadata.file_path"), F.instr("_metadata.file_path", root) + F.lit(len(root))), "^/*[^/]*", "")
    found: dict[str, str] = {}
    whole = [entry["path"] for entry in entries if entry["length"] < _WHOLE_BYTES]
    long = [entry["path"] for entry in entries if entry["length"] >= _WHOLE_BYTES]
    reader = spark.read.option("recursiveFileLookup", True)
    if whole:
        frame = reader.format("binaryFile").load(whole)
        found |= {row["source_file"]: row["digest"] for row in _digest(frame, root, below, F.sha2("content", 256)).collect()}
    if long:
        frame = reader.text(long)
        found |= {row["source_file"]: row["digest"] for row in _digest(frame, root, below, F.sha2("value", 256)).collect()}
    return found


def write_ledger(spark: SparkSession, folder: str, attempt: str, entries: Sequence[Entry], landing: str, mode: str) -> None:
    """Note the files of an attempt, before its rows are written."""
    digests = content_digests(spark, entries, landing) if mode == CONTENT else {}
    rows = [
        {"source_file": entry["name"], "length": entry["length"], "modified": entry["modified"], "digest": digests.get(entry["name"])}
        for entry in entries
    ]
    files.write_text(spark, f"{folder}/{LEDGER}/{attempt}/files.json", "\n".join(map(json.dumps, rows)))


def _matches(spark: SparkSession, folder: str, entries: Sequence[Entry]) -> list:
    """Ledger rows with the name and length of an entry, with their attempts: at most those of the waiting files."""
    waiting = spark.createDataFrame([(e["name"], e["length"]) for e in entries], "_name string, _length bigint")
    noted = spark.read.schema(_SCHEMA).option("recursiveFileLookup", True).json(f"{folder}/{LEDGER}")
    attempt = path_text(F.regexp_extract("_metadata.file_path", f"/{LEDGER}/([^/]+/[^/]+)/[^/]*$", 1))
    same = (F.col("source_file") == F.col("_name")) & (F.col("length") == F.col("_length"))
    rows = noted.withColumn("attempt", attempt).join(F.broadcast(waiting), same)
    return rows.select("source_file", "length", "modified", "digest", "attempt").collect()


def already_taken(
    spark: SparkSession, folder: str, entries: Sequence[Entry], landing: str, mode: str = DELIVERY, batch_id: str | None = None
) -> dict[str, str]:
    """Of these landing entries the names whose rows bronze holds, each with the attempt that holds them.

    What ``batch_id`` itself has taken does not count: another attempt at a batch replaces its own rows.

    In ``content`` mode an entry also counts as taken if its bytes are those of the newest delivery
    under its name; an older one with the same bytes does not count, for the file may have been
    changed and changed back.
    """
    if mode not in MODES:
        raise ValueError(f"unknown ledger mode: {mode}")
    if mode == OFF or not entries or not files.exists(spark, f"{folder}/{LEDGER}"):
        return {}
    finished: dict[str, bool] = {}

    def counts(attempt: str) -> bool:
        if attempt not in finished:
            own = attempt.rsplit("/", 1)[0] == f"batch_id={batch_id}"
            finished[attempt] = not own and files.exists(spark, f"{folder}/{attempt}/_SUCCESS")
        return finished[attempt]

    noted: dict[str, list] = {}
    for row in _matches(spark, folder, entries):
        if counts(row["attempt"]):
            noted.setdefault(row["source_file"], []).append(row)
    taken = {}
    for entry in entries:
        for row in noted.get(entry["name"], ()):
            if row["modified"] == entry["modified"]:
                taken[entry["name"]] = row["attempt"]
    if mode == CONTENT:
        open_ = [entry for entry in entries if entry["name"] in noted and entry["name"] not in taken]
        digests = content_digests(spark, open_, landing) if open_ else {}
        for entry in open_:
            newest = max(noted[entry["name"]], key=lambda row: row["modified"])
            if newest["digest"] is not None and newest["digest"] == digests.get(entry["name"]):
                taken[entry["name"]] = newest["attempt"]
    return taken

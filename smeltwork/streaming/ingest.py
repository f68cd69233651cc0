"""Bronze ingest as a file stream that remembers which files it has seen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltwork.functions.casting import string_safe
from smeltwork.functions.clock import BatchClock
from smeltwork.plans.audit import ALL_TARGETS, BRONZE, FAILED, UNMATCHED, AuditTrail, Outcome, now
from smeltwork.plans.bronze import archive, ingest_target
from smeltwork.plans.control import Target
from smeltwork.sources import files
from smeltwork.sources.landing import landing_entries, routed_entries
from smeltwork.sources.readers import INGEST_TIMESTAMP, SOURCE_FILE, ReadOptions, landed_name
from smeltwork.sources.zones import Zones, write_bronze


def landing_stream(
    spark: SparkSession,
    landing: str,
    kind: str,
    schema: T.StructType,
    archive: str | None = None,
    **options: str,
) -> DataFrame:
    """New files of one format, with the name of the file each row came from.

    Only landing children with the format's extension are listed, so bronze and archive
    folders that lie below the landing folder are never walked.
    With ``archive`` the source moves files away once a later batch has finished.
    """
    reader = spark.readStream.format(kind).schema(schema).options(**options)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    stream = reader.load(f"{landing.rstrip('/')}/*.{kind}")
    return stream.withColumn(SOURCE_FILE, landed_name(files.encoded_path(spark, landing)))


def ingest_available(stream: DataFrame, folder: str, checkpoint: str, clock: BatchClock, nested: str = "json") -> int:
    """Write every file not seen before to bronze, then stop; returns the rows written.

    A micro-batch owns one bronze folder and replaces it, so a batch that is replayed
    after a failure leaves its rows once. The folder carries the query id kept in the
    checkpoint: a stream begun anew cannot replace what an earlier one wrote.
    """
    written: dict[int, int] = {}

    def write(rows: DataFrame, number: int) -> None:
        query_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        seen = Observation()
        stamped = rows.withColumn(INGEST_TIMESTAMP, clock.now)
        counted = string_safe(stamped, nested).observe(seen, F.count(F.lit(1)).alias("rows"))
        write_bronze(counted, folder, f"stream-{query_id}-{number}")
        written[number] = seen.get["rows"]

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(written.values())


def stream_targets(
    spark: SparkSession,
    zones: Zones,
    targets: Sequence[Target],
    clock: BatchClock,
    checkpoint: str,
    trail: AuditTrail,
    options: ReadOptions = ReadOptions(),
    put_away: bool = False,
) -> list[str]:
    """Ingest all landed files not seen before, by the same steps as a batch run; returns the landed names.

    The stream carries the names of files, not their rows: what it has seen is kept in its
    checkpoint, and each micro-batch routes its files, groups them by layout, refuses bad
    ones and leaves audit rows like ``run_bronze``. Files of every format, with any header,
    may arrive; files stay where they are, since the checkpoint knows them, or are archived with
    ``put_away``, so that the next trigger lists new files only. A file that a batch run has
    taken, or that a replayed micro-batch finds again, is not taken twice. Names without a
    dot are not listed, and so neither are the archive folders below landing.
    """
    names: list[str] = []
    patterns = [(target.name, target.file_pattern) for target in targets if target.file_pattern]
    by_name = {target.name: target for target in targets}
    inner = [files.encoded_path(spark, folder) for folder in (zones.bronze, zones.raw_archive)]
    listing = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .option("ignoreMissingFiles", True)  # a replayed micro-batch may name files that were put away
        .load(f"{zones.landing.rstrip('/')}/*.*")
        .select(landed_name(files.encoded_path(spark, zones.landing)).alias("name"), "path")
    )

    def write(rows: DataFrame, number: int) -> None:
        query_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        outside = ~reduce(Column.__or__, [F.contains("path", F.lit(f"{folder}/")) for folder in inner])
        landed = {row["name"] for row in rows.where(outside).select("name").distinct().collect()}
        waiting = [entry for entry in landing_entries(spark, zones.landing) if entry.name in landed]
        routed = routed_entries(spark, waiting, patterns)
        for entry in routed:
            if entry["target_table"] is None:
                trail.record(ALL_TARGETS, BRONZE, now(), Outcome(UNMATCHED, source_file=entry["name"]))
        for name, target in by_name.items():
            mine = [entry for entry in routed if entry["target_table"] == name]
            if mine:
                start = now()
                outcomes = ingest_target(spark, target, mine, zones, clock, f"stream-{query_id}-{number}", options)
                for entry in mine:
                    outcome = outcomes[entry["path"]]
                    if put_away and outcome.status != FAILED:
                        archive(spark, zones, name, entry, f"stream-{query_id}-{number}")
                    trail.record(name, BRONZE, start, outcome)
        trail.flush()
        names.extend(sorted(landed))

    query = (
        listing.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return names

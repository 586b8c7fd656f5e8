"""Few files for closed days of a landed table, beside the stream that writes it and its readers.

The stream adds files to a day with every batch, and its log names them for good. So a day is copied:
its rows go to a folder of a new version, in files of a good size, and last a manifest of the landed
files that the version holds is written. A version counts from the moment its manifest is complete.
Readers take the newest version of a day, open none of the files that it holds, and add files that
landed later; a day with such files is copied again by the next run. A version that was replaced
stays until the run after that, for readers that have begun.
"""

from __future__ import annotations

from collections import defaultdict
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.schema import EVENT_DATE
from footfall.sources import folders
from footfall.sources.tables import LANDED_DDL, landed_view

PARTITIONS = ["verdict", EVENT_DATE]
COPIED_DDL = f"{LANDED_DDL}, version long"


def landed_files(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The committed files of each day, from the stream's log; none is opened."""
    files = defaultdict(list)
    if folders.exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
        for file in spark.read.schema(LANDED_DDL).parquet(path).inputFiles():
            day = file.rsplit(f"/{EVENT_DATE}=", 1)[1].split("/", 1)[0]
            files[unquote(day)].append(file)
    return files


def versions(spark: SparkSession, copy: str) -> dict[str, list[int]]:
    """The complete versions of each day, in order."""
    found = {}
    for day in folders.values(spark, f"{copy}/manifest", EVENT_DATE):
        folder = f"{copy}/manifest/{EVENT_DATE}={day}"
        complete = [int(v) for v in folders.values(spark, folder, "version")]
        complete = sorted(v for v in complete if folders.is_complete(spark, f"{folder}/version={v}"))
        if complete:
            found[day] = complete
    return found


def copied_files(spark: SparkSession, copy: str, day: str, version: int) -> set[str]:
    """The landed files that a version of a day holds: names of one day's files."""
    return {row.file for row in spark.read.parquet(f"{copy}/manifest/{EVENT_DATE}={day}/version={version}").collect()}


def read_files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """The rows of some files of the landed table, with its partition columns."""
    return spark.read.schema(LANDED_DDL).option("basePath", path).parquet(*files)


def compact_days(spark: SparkSession, path: str, copy: str, through: str, least_files: int = 2) -> list[str]:
    """Copy the days up to ``through`` that have at least ``least_files`` landed files or new ones; the days copied.

    Run one at a time. Rows without a day are never closed and stay where they are.
    """
    path, copy = path.rstrip("/"), copy.rstrip("/")
    held, copied = versions(spark, copy), []
    for day, files in sorted(landed_files(spark, path).items()):
        if not day[:1].isdigit() or date.fromisoformat(day) > date.fromisoformat(through):
            continue
        known = held.get(day, [])
        if known and copied_files(spark, copy, day, known[-1]) == set(files) or not known and len(files) < least_files:
            continue
        version = known[-1] + 1 if known else 1
        rows = read_files(spark, path, files).drop(EVENT_DATE).hint("rebalance", "verdict")
        rows.write.mode("overwrite").partitionBy("verdict").parquet(f"{copy}/rows/{EVENT_DATE}={day}/version={version}")
        listed = spark.createDataFrame([(file,) for file in files], "file string")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{copy}/manifest/{EVENT_DATE}={day}/version={version}")
        for old in known[:-1]:  # the one before stays for readers that have begun
            folders.remove(spark, f"{copy}/manifest/{EVENT_DATE}={day}/version={old}")
            folders.remove(spark, f"{copy}/rows/{EVENT_DATE}={day}/version={old}")
        copied.append(day)
    return copied


def read_compacted(spark: SparkSession, path: str, copy: str, verdict: str | None = "valid") -> DataFrame:
    """The same rows as ``read_landed``, from few files for the days that were copied."""
    path, copy = path.rstrip("/"), copy.rstrip("/")
    newest = {day: found[-1] for day, found in versions(spark, copy).items()}
    files = landed_files(spark, path)
    late = [
        file
        for day, version in sorted(newest.items())
        if files.get(day)
        for file in sorted(set(files[day]) - copied_files(spark, copy, day, version))
    ]
    days = [F.lit(day).cast("date") for day in newest]
    landed = spark.read.schema(LANDED_DDL).parquet(path)
    if not newest:
        return landed_view(landed, verdict)
    rows = landed.filter(F.col(EVENT_DATE).isNull() | ~F.col(EVENT_DATE).isin(*days))
    if late:
        rows = rows.unionByName(read_files(spark, path, late))
    for version in sorted(set(newest.values())):  # mostly one
        of_version = [F.lit(day).cast("date") for day, v in newest.items() if v == version]
        parts = spark.read.schema(COPIED_DDL).parquet(f"{copy}/rows")
        parts = parts.filter((F.col("version") == version) & F.col(EVENT_DATE).isin(*of_version)).drop("version")
        rows = rows.unionByName(parts)
    return landed_view(rows, verdict)

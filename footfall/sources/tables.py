"""Feature, segment and landed event tables in parquet."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.schema import EVENT_DATE, EVENT_DDL
from footfall.sources import folders

LANDED_DDL = f"{EVENT_DDL}, _corrupt_record string, arrived_at timestamp, failed_rules array<string>, verdict string, {EVENT_DATE} date"


RUN_DATE = "run_date"


def replace_days(rows: DataFrame, path: str) -> None:
    """Replace those ``run_date`` partitions that ``rows`` has; others stay as they are."""
    writer = rows.hint("rebalance", RUN_DATE).write.mode("overwrite").partitionBy(RUN_DATE)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def in_runs(spark: SparkSession, path: str, ddl: str, first: str | None, through: str | None) -> DataFrame:
    """The rows of a range of runs, both ends included; none from a table that is not there yet."""
    if not folders.values(spark, path, RUN_DATE):
        return spark.createDataFrame([], ddl)
    rows = spark.read.schema(f"{ddl}, {RUN_DATE} date").parquet(path)
    if first is not None:
        rows = rows.filter(F.col(RUN_DATE) >= F.lit(first).cast("date"))
    if through is not None:
        rows = rows.filter(F.col(RUN_DATE) <= F.lit(through).cast("date"))
    return rows.drop(RUN_DATE)


def write_features(features: DataFrame, path: str, run_date: str | None = None) -> None:
    """Replace the table, or with ``run_date`` only that day's partition.

    A run without rows leaves an empty partition, not the rows of an earlier run.
    """
    if run_date is not None:
        path = f"{path.rstrip('/')}/run_date={date.fromisoformat(run_date)}"
    features.write.mode("overwrite").parquet(path)


def write_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """Each of a few small tables, whole, in the folder of its name."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def read_features(spark: SparkSession, path: str, run_date: str | None = None) -> DataFrame:
    """The feature table, or the partition of one run."""
    return _read(spark, path, run_date)


def write_segments(predictions: DataFrame, path: str, run_date: str | None = None) -> None:
    write_features(predictions.select("user_id", "segment"), path, run_date)


def read_segments(spark: SparkSession, path: str, run_date: str | None = None) -> DataFrame:
    return _read(spark, path, run_date)


def _read(spark: SparkSession, path: str, run_date: str | None) -> DataFrame:
    table = spark.read.parquet(path)
    if run_date is None:
        return table
    return table.filter(F.col("run_date") == F.lit(run_date).cast("date")).drop("run_date")


def save_bucketed(users: DataFrame, name: str, path: str, buckets: int) -> None:
    """Store a per-user table as catalog table ``name``, bucketed and sorted by user.

    Feature and segment tables with the same number of buckets join without a shuffle.
    """
    (
        users.repartition(buckets, "user_id")
        .write.mode("overwrite")
        .bucketBy(buckets, "user_id")
        .sortBy("user_id")
        .option("path", path)
        .saveAsTable(name)
    )


def read_landed(
    spark: SparkSession, path: str, verdict: str | None = "valid", with_file: bool = False
) -> DataFrame:
    """Landed events with one verdict, ``valid`` or ``rejected``; None reads both.

    ``parsed`` reads the events of all lines, as the JSON scan gives them. ``with_file`` adds
    the file that holds each event, as ``file``.
    """
    landed = spark.read.schema(LANDED_DDL).parquet(path)
    if with_file:
        landed = landed.withColumn("file", F.col("_metadata.file_path"))
    return landed_view(landed, verdict)


def landed_view(landed: DataFrame, verdict: str | None) -> DataFrame:
    """Of all landed rows those with a verdict, with the columns that ``read_landed`` gives them."""
    if verdict is None:
        return landed
    about = ("_corrupt_record", "arrived_at", "failed_rules")
    if verdict == "parsed":
        return landed.drop("verdict", *about)
    landed = landed.filter(F.col("verdict") == verdict).drop("verdict")
    return landed.drop(*about) if verdict == "valid" else landed


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> None:
    """Make frames or parquet paths available to ``spark.sql`` under the given names."""
    for name, table in tables.items():
        frame = spark.read.parquet(table) if isinstance(table, str) else table
        frame.createOrReplaceTempView(name)

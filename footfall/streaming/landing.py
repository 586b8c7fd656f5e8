"""Landing of an event stream as a partitioned parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions.rules import mark_failed_rules
from footfall.functions.time_range import utc_day
from footfall.schema import ARRIVAL, CORRUPT_COLUMN, EVENT_DATE


def with_landing_columns(events: DataFrame) -> DataFrame:
    """Add the rule verdict and the UTC date that partition the landed table."""
    verdict = F.when(F.size("failed_rules") == 0, "valid").otherwise("rejected")
    for column, kind in ((CORRUPT_COLUMN, "string"), (ARRIVAL, "timestamp")):
        if column not in events.columns:
            events = events.withColumn(column, F.lit(None).cast(kind))
    return mark_failed_rules(events).withColumns(
        {"verdict": verdict, EVENT_DATE: utc_day(F.col("timestamp"))}
    )


def land_events(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    files_per_day: int | None = None,
) -> StreamingQuery:
    """Write the stream below ``verdict=.../event_date=...``, each event exactly once.

    Valid and rejected events go to the same table in one pass, so a bad line is kept
    with its reasons and is skipped by partition pruning when events are read. The
    default trigger lands what is there and stops; pass ``{"processingTime": ...}`` to
    keep running.

    Each task writes a file per verdict and day it meets. ``files_per_day`` shuffles once
    to write at most that many per batch instead; whole input tasks share a file, so
    that the files are even whatever the events hold.
    """
    rows = with_landing_columns(events)
    if files_per_day:
        rows = (
            rows.withColumn("file", F.spark_partition_id() % files_per_day)
            .repartition("verdict", EVENT_DATE, "file")
            .drop("file")
        )
    return (
        rows.writeStream.format("parquet")
        .partitionBy("verdict", EVENT_DATE)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )

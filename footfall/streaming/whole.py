"""Whole results of a stream at any time: what is open counts too, and later batches replace it.

One query knows copies, and each of its batches is reduced to two kinds of rows that can be added
up: key rows of the daily features and activity slots of the sessions. A batch writes them to
folders of its own number, so that a batch that is run again after a failure replaces what it wrote
before and nothing is counted twice. Readers add up the batches and finish the second level, the
same that the batch operators use, so a stream that has read all events gives exactly their rows.

Days and sessions need no closing: nothing waits for the watermark, which only bounds the memory
for copies and turns away events that are later than it. There is no aggregate in the state store.

Every ``fold`` batches the days that were touched are folded: their batches are added up into one
table. A day's readers take its newest complete fold and the batches after it. What a fold replaces
stays for another ``fold`` batches, for readers that have begun.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions.time_range import utc_day
from footfall.operators.features import MEASURES, added_key_rows, features_of_keys, key_rows
from footfall.operators.temporal import activity_slots, merged_slots, sessions_of_slots
from footfall.schema import EVENT_COLUMNS, EVENT_DATE
from footfall.sources import folders
from footfall.streaming.live import fresh_events

FOLD = 16
KEY_ROWS, SLOTS = "key_rows", "slots"

_SUMS = ", ".join(f"{name} {'double' if name == 'amount_sum' else 'long'}" for name in MEASURES)
DDL = {
    KEY_ROWS: f"user_id string, kind int, key string, {_SUMS}",
    SLOTS: "user_id string, slot long, first_at timestamp, last_at timestamp, events long",
}


def added_up(rows: DataFrame, kind: str) -> DataFrame:
    """One row per day and key."""
    if kind == KEY_ROWS:
        return added_key_rows(rows, [EVENT_DATE, "user_id"])
    return merged_slots(rows, [EVENT_DATE, "user_id", "slot"])


def complete_batches(spark: SparkSession, table: str) -> list[int]:
    """The batches whose rows are all there; at most those of two spans are kept."""
    found = (int(b) for b in folders.values(spark, f"{table}/batches", "batch"))
    return [b for b in found if folders.is_complete(spark, f"{table}/batches/batch={b}")]


def folds(spark: SparkSession, table: str) -> list[tuple[int, str]]:
    """(batch, day) of every complete fold."""
    batches = [int(b) for b in folders.values(spark, f"{table}/fold", "batch")]
    complete = [b for b in batches if folders.is_complete(spark, f"{table}/fold/batch={b}")]
    return [(b, day) for b in complete for day in folders.values(spark, f"{table}/fold/batch={b}", EVENT_DATE)]


def newest(found: Iterable[tuple[int, str]]) -> dict[str, int]:
    """For each day its newest fold."""
    upto: dict[str, int] = {}
    for batch, day in found:
        upto[day] = max(batch, upto.get(day, batch))
    return upto


def read_parts(spark: SparkSession, path: str, kind: str, below: int | None = None) -> DataFrame:
    """Rows that add up to all events so far, each counted once, with their UTC day.

    Folders of jobs that did not commit do not count, nor folds from batch ``below`` on.
    """
    table = f"{path.rstrip('/')}/{kind}"
    schema = f"{DDL[kind]}, batch long, {EVENT_DATE} date"
    upto = newest((batch, day) for batch, day in folds(spark, table) if below is None or batch < below)
    rows = spark.createDataFrame([], schema).drop("batch")
    # one row per day that has been folded
    days = spark.createDataFrame(list(upto.items()), "day string, upto long").select(
        F.to_date("day").alias(EVENT_DATE), "upto"
    )
    complete = complete_batches(spark, table)
    if complete:
        batches = spark.read.schema(schema).parquet(f"{table}/batches").filter(F.col("batch").isin(complete))
        later = F.col("upto").isNull() | (F.col("batch") > F.col("upto"))
        rows = rows.unionByName(batches.join(days, EVENT_DATE, "left").filter(later).drop("batch", "upto"))
    if upto:
        # other folds are not even opened: one of them may be just written, or removed
        folded = spark.read.schema(schema).parquet(f"{table}/fold").filter(F.col("batch").isin(*set(upto.values())))
        folded = folded.join(days, EVENT_DATE)
        rows = rows.unionByName(folded.filter(F.col("batch") == F.col("upto")).drop("batch", "upto"))
    return rows


def write_parts(rows: DataFrame, folder: str) -> None:
    """Replace the whole folder, whatever the session's overwrite mode; few files for each day."""
    # the rows of a day go to one task, those of a large day to several
    rows.hint("rebalance", EVENT_DATE).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(EVENT_DATE).parquet(folder)


def fold(spark: SparkSession, path: str, kind: str, batch: int, span: int) -> None:
    """Add up the days that the last ``span`` batches touched, and drop what the fold before replaced."""
    table = f"{path.rstrip('/')}/{kind}"
    stored = complete_batches(spark, table)
    touched = {
        day
        for b in stored
        if batch - span < b <= batch
        for day in folders.values(spark, f"{table}/batches/batch={b}", EVENT_DATE)
    }
    if touched:
        days = [F.lit(day).cast("date") for day in sorted(touched)]
        rows = read_parts(spark, path, kind, below=batch).filter(F.col(EVENT_DATE).isin(*days))
        write_parts(added_up(rows, kind), f"{table}/fold/batch={batch}")
    before, found = batch - span, folds(spark, table)
    for b in stored:
        if b <= before:
            folders.remove(spark, f"{table}/batches/batch={b}")
    settled = newest((b, day) for b, day in found if b <= before)
    for b, day in found:
        if b < settled.get(day, b):
            folders.remove(spark, f"{table}/fold/batch={b}/{EVENT_DATE}={day}")


def start_whole(
    events: DataFrame,
    path: str,
    checkpoint: str,
    gap_seconds: int = 1800,
    watermark: str = "1 hour",
    identity: Iterable[str] | None = EVENT_COLUMNS,
    trigger: dict | None = None,
    span: int = FOLD,
) -> StreamingQuery:
    """Keep the daily features and sessions of a stream; read them with ``read_daily`` and ``read_sessions``.

    The source is read once and copies are known once for both. Use one ``gap_seconds`` for a path.
    """
    if gap_seconds <= 0:
        raise ValueError("gap_seconds must be positive")

    def keep(batch_events: DataFrame, batch: int) -> None:
        spark = batch_events.sparkSession
        held = batch_events.persist()
        try:
            day = utc_day(F.col("timestamp")).alias(EVENT_DATE)
            slots = activity_slots(held, gap_seconds)
            slot_day = utc_day(F.timestamp_micros("slot"))
            parts = {
                KEY_ROWS: key_rows(held, [day, "user_id"]),
                SLOTS: slots.withColumn(EVENT_DATE, slot_day),
            }
            for kind, rows in parts.items():
                write_parts(rows, f"{path.rstrip('/')}/{kind}/batches/batch={batch}")
        finally:
            held.unpersist()
        if (batch + 1) % span == 0:
            for kind in parts:
                fold(spark, path, kind, batch, span)

    return (
        fresh_events(events, watermark, identity)
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """The feature row per user and UTC day of all events so far, open days included."""
    rows = added_up(read_parts(spark, path, KEY_ROWS), KEY_ROWS)
    return features_of_keys(rows, [EVENT_DATE, "user_id"]).withColumnRenamed(EVENT_DATE, "day")


def read_sessions(spark: SparkSession, path: str, gap_seconds: int = 1800) -> DataFrame:
    """All sessions of the events so far, open ones included, numbered per user."""
    slots = merged_slots(read_parts(spark, path, SLOTS))
    return sessions_of_slots(slots, gap_seconds)

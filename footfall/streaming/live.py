"""Features and sessions over an event stream."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.functions.rules import implausible_time, mark_failed_rules
from footfall.functions.time_range import utc_day
from footfall.operators.features import (
    KEYS, key_counts, known_users, merged_features, named, spread_keys,
)
from footfall.operators.temporal import seconds
from footfall.schema import EVENT_COLUMNS, ISO_MICROS


def fresh_events(
    events: DataFrame, watermark: str, identity: Iterable[str] | None = EVENT_COLUMNS
) -> DataFrame:
    """Events of known users under a watermark, without redelivered copies.

    Events whose time breaks a rule stay out: one from the far future would move the
    watermark there and close every day before it. ``identity`` names the columns two
    copies of one event share; None keeps copies. Of several columns the state holds a
    digest, 32 bytes per event inside the watermark.
    """
    timed = known_users(events).filter(F.col("timestamp").isNotNull() & ~implausible_time(events))
    timed = timed.withWatermark("timestamp", watermark)
    if identity is None:
        return timed
    identity = list(identity)
    if len(identity) == 1:
        return timed.dropDuplicatesWithinWatermark(identity)
    told = F.to_json(F.struct(*identity), {"timestampFormat": ISO_MICROS})
    told = timed.withColumn("copy_of", F.unhex(F.sha2(told, 256)))
    return told.dropDuplicatesWithinWatermark(["copy_of"]).drop("copy_of")


def rejected_times(events: DataFrame) -> DataFrame:
    """Events that the streams leave out for their time, with the rules they break."""
    wrong = F.col("timestamp").isNull() | implausible_time(events)
    return mark_failed_rules(events).filter(wrong)


def live_daily_features(
    events: DataFrame, watermark: str = "1 hour", identity: Iterable[str] | None = EVENT_COLUMNS
) -> DataFrame:
    """The exact feature row per user and UTC day, emitted once the watermark closes the day.

    Same two levels as in batch: state is one row per open (user, session) and
    (user, page), never a set that grows inside one row. Later events are dropped.
    """
    key_rows = (
        spread_keys(fresh_events(events, watermark, identity), KEYS)
        .groupBy(F.window("timestamp", "1 day"), "user_id", "kind", "key")
        .agg(*named(key_counts()))
    )
    day = F.window(F.window_time("window"), "1 day")
    per_day = key_rows.groupBy(day, "user_id").agg(*named(merged_features()))
    return per_day.withColumn("window", utc_day(F.col("window.start"))).withColumnRenamed("window", "day")


def live_sessions(
    events: DataFrame,
    gap_seconds: int,
    watermark: str = "1 hour",
    identity: Iterable[str] | None = EVENT_COLUMNS,
) -> DataFrame:
    """Sessions by inactivity gap, emitted once the watermark passes their end plus the gap.

    ``build_session`` turns on merging of sessions before the shuffle, so that a busy user
    arrives as a few open sessions per task. Sessions built elsewhere should set
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` as well.
    """
    first, last = F.min("timestamp"), F.max("timestamp")
    return (
        fresh_events(events, watermark, identity)
        .groupBy(F.session_window("timestamp", f"{gap_seconds} seconds"), "user_id")
        .agg(
            first.alias("session_start"),
            last.alias("session_end"),
            seconds(F.unix_micros(last) - F.unix_micros(first)).alias("duration_s"),
            F.count("*").alias("events"),
        )
        .drop("session_window")
    )


def start_append(
    results: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append finished rows to parquet; by default process what is there and stop."""
    return (
        results.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def stream_features(
    events: DataFrame,
    path: str,
    checkpoint: str,
    watermark: str = "1 hour",
    gap_seconds: int = 1800,
    identity: Iterable[str] | None = EVENT_COLUMNS,
    trigger: dict | None = None,
) -> tuple[StreamingQuery, ...]:
    """Start the streams: ``path/daily``, ``path/sessions``, and ``path/rejected`` for impossible times.

    A run that stops at the end of its input does not emit the days still open.
    """
    daily = live_daily_features(events, watermark, identity)
    sessions = live_sessions(events, gap_seconds, watermark, identity)
    return (
        start_append(daily, f"{path}/daily", f"{checkpoint}/daily", trigger),
        start_append(sessions, f"{path}/sessions", f"{checkpoint}/sessions", trigger),
        start_append(rejected_times(events), f"{path}/rejected", f"{checkpoint}/rejected", trigger),
    )

"""Time-of-day, session and frequency measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.features import (
    DAY, KEYS, SESSION, distinct_keys, key_counts, known_users, merged_features, merged_sum,
    named, spread_keys,
)

# Hours of the day per part, both ends included.
DAY_PARTS = {"night": (0, 5), "morning": (6, 11), "afternoon": (12, 17), "evening": (18, 23)}


def seconds(micros: Column) -> Column:
    return micros / 1e6


def day_part_counts() -> dict[str, Column]:
    hour = F.hour("timestamp")
    return {part: F.count_if(hour.between(*span)) for part, span in DAY_PARTS.items()}


def pageviews() -> Column:
    return F.count_if(F.col("event_type") == "pageview")


def time_of_day(events: DataFrame) -> DataFrame:
    """Events per user in each part of the day."""
    return known_users(events).groupBy("user_id").agg(*named(day_part_counts()))


def session_summary(events: DataFrame) -> DataFrame:
    """Start, end, duration and size of each declared session.

    Session ids may repeat across users, so a session is a (user, session id) pair.
    """
    first, last = F.min("timestamp"), F.max("timestamp")
    return (
        known_users(events)
        .filter(F.col("session_id").isNotNull())
        .groupBy("user_id", "session_id")
        .agg(
            first.alias("session_start"),
            last.alias("session_end"),
            seconds(F.unix_micros(last) - F.unix_micros(first)).alias("duration_s"),
            F.count("*").alias("events"),
        )
    )


def with_duration(sessions: DataFrame) -> DataFrame:
    """Add ``duration_s`` to sessions that have a start and an end."""
    span = F.unix_micros("session_end") - F.unix_micros("session_start")
    return sessions.withColumn("duration_s", seconds(span))


def added_sessions(parts: DataFrame) -> DataFrame:
    """Declared sessions from the summaries of several parts of the events."""
    return with_duration(
        parts.groupBy("user_id", "session_id").agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.sum("events").alias("events"),
        )
    )


def session_duration(events: DataFrame) -> DataFrame:
    """Mean and longest declared-session duration per user, in seconds."""
    span = F.unix_micros("session_end") - F.unix_micros("session_start")
    return session_summary(events).groupBy("user_id").agg(
        F.count("*").alias("sessions"),
        seconds(F.try_divide(F.sum(span), F.count(span))).alias("mean_duration_s"),
        seconds(F.max(span)).alias("max_duration_s"),
    )


def activity_slots(events: DataFrame, gap_seconds: int) -> DataFrame:
    """user_id, slot, first_at, last_at, events: activity per gap-wide time slot.

    Events of one user in the same slot always share a session, so slots are all that
    sessions need to know; slots of parts of the events can be merged.
    """
    if gap_seconds <= 0:
        raise ValueError("gap_seconds must be positive")
    gap = F.lit(int(gap_seconds * 1_000_000))
    micros = F.unix_micros("timestamp")
    return (
        known_users(events)
        .filter(F.col("timestamp").isNotNull())
        .groupBy("user_id", (micros - F.pmod(micros, gap)).alias("slot"))
        .agg(
            F.min("timestamp").alias("first_at"),
            F.max("timestamp").alias("last_at"),
            F.count("*").alias("events"),
        )
    )


def merged_slots(slots: DataFrame, by: Sequence[str] = ("user_id", "slot")) -> DataFrame:
    """One row per user and slot from the slots of several parts of the events."""
    return slots.groupBy(*by).agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.sum("events").alias("events")
    )


def sessions_of_slots(slots: DataFrame, gap_seconds: int) -> DataFrame:
    """Sessions of stretches of activity that do not overlap, such as slots or earlier sessions."""
    gap = F.lit(int(gap_seconds * 1_000_000))
    in_order = Window.partitionBy("user_id").orderBy("first_at")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pause = F.unix_micros("first_at") - F.unix_micros(F.lag("last_at").over(in_order))
    starts = F.when(pause <= gap, 0).otherwise(1)
    first, last = F.min("first_at"), F.max("last_at")
    return (
        slots.withColumn("starts", starts)
        .withColumn("session_number", F.sum("starts").over(so_far))
        .groupBy("user_id", "session_number")
        .agg(
            first.alias("session_start"),
            last.alias("session_end"),
            seconds(F.unix_micros(last) - F.unix_micros(first)).alias("duration_s"),
            F.sum("events").alias("events"),
        )
    )


def sessionize(events: DataFrame, gap_seconds: int) -> DataFrame:
    """Sessions derived from inactivity: a pause longer than the gap starts a new one.

    Events are first reduced to one row per (user, slot). What is then ordered per user is
    bounded by the covered time divided by the gap, however many events a user has.
    """
    return sessions_of_slots(activity_slots(events, gap_seconds), gap_seconds)


def mean_gap_seconds(first: Column, last: Column, events: Column) -> Column:
    """Mean pause between consecutive events, NULL for a single event."""
    return seconds(F.try_divide(F.unix_micros(last) - F.unix_micros(first), events - 1))


def interaction_frequency(events: DataFrame) -> DataFrame:
    """Events per active day and mean seconds between a user's consecutive events."""
    n = F.count("timestamp")
    return known_users(events).groupBy("user_id").agg(
        F.try_divide(n, F.count_distinct(F.to_date("timestamp"))).alias("events_per_active_day"),
        mean_gap_seconds(F.min("timestamp"), F.max("timestamp"), n).alias("mean_gap_s"),
    )


def pages_viewed(events: DataFrame) -> DataFrame:
    return known_users(events).groupBy("user_id").agg(
        pageviews().alias("pageviews"),
        F.count_distinct("page").alias("unique_pages_visited"),
    )


def behavior_profile(events: DataFrame) -> DataFrame:
    """User features and all per-user temporal measures from a single scan."""
    extra = {"pageviews": pageviews(), **day_part_counts()}
    keys = {**KEYS, DAY: F.to_date("timestamp")}
    key_rows = (
        spread_keys(known_users(events), keys)
        .groupBy("user_id", "kind", "key")
        .agg(
            *named(key_counts() | extra),
            F.count("timestamp").alias("timed_events"),
            F.min("timestamp").alias("first_at"),
            F.max("timestamp").alias("last_at"),
        )
    )
    in_session = (F.col("kind") == SESSION) & F.col("key").isNotNull()
    span = F.when(in_session, F.unix_micros("last_at") - F.unix_micros("first_at"))
    timed = merged_sum("timed_events")
    return key_rows.groupBy("user_id").agg(
        *named(merged_features() | {name: merged_sum(name) for name in extra}),
        seconds(F.try_divide(F.sum(span), F.count(span))).alias("mean_duration_s"),
        seconds(F.max(span)).alias("max_duration_s"),
        F.try_divide(timed, distinct_keys(DAY)).alias("events_per_active_day"),
        mean_gap_seconds(F.min("first_at"), F.max("last_at"), timed).alias("mean_gap_s"),
    )

"""One feature row per user from raw events.

Exact distinct counts next to plain counts are computed in two levels: every event
counts once for its session and once for its page, in rows keyed ``(user, kind, key)``,
and those rows are then merged per user. Both levels combine on the map side, so a user
with a third of all events is spread over its sessions and pages first and reaches the
second shuffle as one row per task. Counting both distincts in a single ``agg`` gives
the same result, but repeats every event three times instead of twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.schema import DEVICES, FEATURE_COLUMNS

# Kinds of key rows. Every event is in exactly one row of each kind.
SESSION, PAGE, DAY = 0, 1, 2
KEYS = {SESSION: "session_id", PAGE: "page"}
# Columns of key rows, all of which add up.
MEASURES = [
    "total_events", "total_searches", "total_cart_adds", "total_purchases", "amount_sum", "amount_count", *DEVICES,
]
DISTINCTS = {"total_sessions": SESSION, "unique_pages_visited": PAGE}


def known_users(events: DataFrame) -> DataFrame:
    return events.filter(F.col("user_id").isNotNull())


def named(aggregates: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in aggregates.items()]


def event_counts(counted: Column | None = None) -> dict[str, Column]:
    """Additive measures over raw events, or over those rows where ``counted`` holds."""
    counted = F.lit(True) if counted is None else counted
    of_type = lambda name: F.count_if(counted & (F.col("event_type") == name))
    amount = F.when(counted, F.col("total_amount"))
    return {
        "total_events": F.count_if(counted),
        "total_searches": F.count_if(counted & F.col("search_query").isNotNull()),
        "total_cart_adds": of_type("add_to_cart"),
        "total_purchases": of_type("purchase"),
        "amount_sum": F.sum(amount),
        "amount_count": F.count(amount),
        **{name: F.count_if(counted & (F.col("device_type") == name)) for name in DEVICES},
    }


def key_counts() -> dict[str, Column]:
    """The measures over key rows: only session rows carry them, the others are keys and zeros."""
    return event_counts(F.col("kind") == SESSION)


def spread_keys(events: DataFrame, keys: dict[int, str | Column]) -> DataFrame:
    """Repeat each event once per entry of ``keys`` as columns ``kind`` and ``key``."""
    tags = [
        F.struct(
            F.lit(kind).alias("kind"),
            (F.col(key) if isinstance(key, str) else key).cast("string").alias("key"),
        )
        for kind, key in keys.items()
    ]
    return events.select("*", F.inline(F.array(*tags)))


def merged_sum(name: str, kind: int = SESSION) -> Column:
    """Total of a measure over the key rows of one kind, which cover each event once."""
    return F.sum(F.when(F.col("kind") == kind, F.col(name)))


def distinct_keys(kind: int) -> Column:
    return F.count_if((F.col("kind") == kind) & F.col("key").isNotNull())


def merged_features() -> dict[str, Column]:
    """Feature aggregates over key rows, in feature order."""
    merged = {name: merged_sum(name) for name in FEATURE_COLUMNS}
    merged["avg_purchase_amount"] = F.try_divide(merged_sum("amount_sum"), merged_sum("amount_count"))
    merged.update({name: distinct_keys(kind) for name, kind in DISTINCTS.items()})
    return merged


def key_rows(events: DataFrame, by: Sequence[str | Column] = ("user_id",)) -> DataFrame:
    """The first level: measures per ``by``, kind and key. Rows of parts of the events can be added up."""
    return spread_keys(known_users(events), KEYS).groupBy(*by, "kind", "key").agg(*named(key_counts()))


def added_key_rows(rows: DataFrame, by: Sequence[str] = ("user_id",)) -> DataFrame:
    """One row per ``by``, kind and key from the key rows of several parts of the events."""
    return rows.groupBy(*by, "kind", "key").agg(*[F.sum(name).alias(name) for name in MEASURES])


def features_of_keys(
    rows: DataFrame, by: Sequence[str] = ("user_id",), columns: Sequence[str] = FEATURE_COLUMNS
) -> DataFrame:
    """The second level: the feature row per ``by`` from rows with one of each key."""
    merged = merged_features()
    return rows.groupBy(*by).agg(*[merged[name].alias(name) for name in columns])


def user_features(
    events: DataFrame,
    by: Sequence[str | Column] = ("user_id",),
    columns: Sequence[str] = FEATURE_COLUMNS,
) -> DataFrame:
    """The feature row per user, or per ``by`` such as day and user.

    ``columns`` limits the result to some features; without a distinct count among them
    one aggregate over unrepeated events is enough. ``avg_purchase_amount`` stays NULL
    for users without an amount.
    """
    if not set(columns) & set(DISTINCTS):
        return plain_features(events, by, columns)
    rows = key_rows(events, by)
    return features_of_keys(rows, rows.columns[: len(by)], columns)


def plain_features(
    events: DataFrame, by: Sequence[str | Column], columns: Sequence[str]
) -> DataFrame:
    aggregates = {**event_counts(), "avg_purchase_amount": F.avg("total_amount")}
    return known_users(events).groupBy(*by).agg(*[aggregates[name].alias(name) for name in columns])


def daily_features(events: DataFrame) -> DataFrame:
    """``user_features`` per user and day."""
    return user_features(events, [F.to_date("timestamp").alias("day"), "user_id"])


def user_totals(events: DataFrame) -> DataFrame:
    return user_features(events, columns=FEATURE_COLUMNS[:4])


def user_avg_purchase(events: DataFrame) -> DataFrame:
    """Mean of all present amounts per user, whatever the event type."""
    return user_features(events, columns=["avg_purchase_amount"])


def user_distincts(events: DataFrame) -> DataFrame:
    """Exact distinct sessions and pages per user."""
    return (
        spread_keys(known_users(events), KEYS)
        .select("user_id", "kind", "key")
        .distinct()
        .groupBy("user_id")
        .agg(*[distinct_keys(kind).alias(name) for name, kind in DISTINCTS.items()])
    )


def device_counts(events: DataFrame) -> DataFrame:
    return known_users(events).groupBy("user_id", "device_type").count()


def device_pivot(events: DataFrame) -> DataFrame:
    """One zero-filled count column per known device.

    The columns are fixed, so they never depend on the data and no job has to look for
    them; counting under a condition needs one shuffle where a pivot needs two.
    """
    return user_features(events, columns=DEVICES)


def features_join(events: DataFrame) -> DataFrame:
    """Behaviour and device columns joined per user; ``user_features`` avoids the join."""
    return user_features(events).drop(*DEVICES).join(device_pivot(events), "user_id")

"""Validity rules of one web event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.schema import (
    ARRIVAL, CORRUPT_COLUMN, DEVICES, EVENT_TYPES, QUANTITY_RANGE, TIMESTAMP_RANGE,
)

#: How far an event's clock may be ahead of its arrival.
AHEAD = "1 hour"


def implausible_time(events: DataFrame) -> Column:
    """Whether a timestamp is outside the plausible range, or later than the event's arrival.

    False without a timestamp. Arrival counts where the column is there.
    """
    first, end = (F.lit(day).cast("timestamp") for day in TIMESTAMP_RANGE)
    odd = (F.col("timestamp") < first) | (F.col("timestamp") >= end)
    if ARRIVAL in events.columns:
        ahead = F.col("timestamp") > F.col(ARRIVAL) + F.expr(f"INTERVAL {AHEAD}")
        odd = odd | F.coalesce(ahead, F.lit(False))
    return F.coalesce(odd, F.lit(False))


def not_finite(column: Column) -> Column:
    """Whether a number is NaN or infinite; false for NULL."""
    return F.coalesce(F.isnan(column) | (F.abs(column) == F.lit(float("inf"))), F.lit(False))


def event_rules(events: DataFrame) -> dict[str, Column]:
    """Rule name -> condition that is true when an event breaks the rule.

    Lines the JSON scan could not parse break ``unparseable`` where the scan kept them.
    """
    is_type = lambda name: F.col("event_type").eqNullSafe(name)
    fails = lambda condition: ~F.coalesce(condition, F.lit(False))
    rules = {
        "user_missing": F.col("user_id").isNull(),
        "session_missing": F.col("session_id").isNull(),
        "timestamp_missing": F.col("timestamp").isNull(),
        "event_type_unknown": fails(F.col("event_type").isin(EVENT_TYPES)),
        "device_unknown": fails(F.col("device_type").isin(DEVICES)),
        "search_without_query": is_type("search") & F.col("search_query").isNull(),
        "cart_without_product": is_type("add_to_cart") & F.col("product_id").isNull(),
        "cart_quantity_out_of_range": is_type("add_to_cart")
        & fails(F.col("quantity").between(*QUANTITY_RANGE)),
        "purchase_without_order": is_type("purchase") & F.col("order_id").isNull(),
        "purchase_amount_not_positive": is_type("purchase") & fails(F.col("total_amount") > 0),
        "timestamp_implausible": implausible_time(events),
        "amount_not_finite": not_finite(F.col("total_amount")),
    }
    if CORRUPT_COLUMN in events.columns:
        rules["unparseable"] = F.col(CORRUPT_COLUMN).isNotNull()
    return rules


def mark_failed_rules(events: DataFrame) -> DataFrame:
    """Add ``failed_rules``, the names of the rules an event breaks; empty means valid."""
    names = [F.when(broken, F.lit(name)) for name, broken in event_rules(events).items()]
    return events.withColumn("failed_rules", F.array_compact(F.array(*names)))


def validate_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split events into (valid, rejected); rejected rows name the rules they break."""
    marked = mark_failed_rules(events)
    passes = F.size("failed_rules") == 0
    return marked.filter(passes).drop("failed_rules", CORRUPT_COLUMN, ARRIVAL), marked.filter(~passes)

"""Event schema, value domains and feature order shared by every module."""

from __future__ import annotations

# Column names, types and order of one raw web event.
EVENT_DDL = (
    "user_id string, session_id string, timestamp timestamp, event_type string, "
    "page string, user_agent string, location string, device_type string, "
    "search_query string, product_id string, quantity int, order_id string, "
    "total_amount double"
)
EVENT_COLUMNS = [field.split()[0] for field in EVENT_DDL.split(", ")]

# The domains a valid event draws from.
EVENT_TYPES = ["pageview", "click", "search", "add_to_cart", "purchase"]
DEVICES = ["desktop", "mobile", "tablet"]
QUANTITY_RANGE = (1, 5)

# Slots of the clustering vector, in order.
FEATURE_COLUMNS = [
    "total_events", "total_searches", "total_cart_adds", "total_purchases",
    "avg_purchase_amount", "total_sessions", "unique_pages_visited",
    "desktop", "mobile", "tablet",
]

# Metrics of the segment radar and of the segment detail table.
RADAR_METRICS = FEATURE_COLUMNS[:5]
DETAIL_METRICS = FEATURE_COLUMNS[:7]

# What a timestamp may be; an event dated outside was written by a broken clock.
TIMESTAMP_RANGE = ("2000-01-01", "2100-01-01")

CORRUPT_COLUMN = "_corrupt_record"
#: When a stream received an event; a column so that reading again gives the same verdict.
ARRIVAL = "arrived_at"
EVENT_DATE = "event_date"

# ISO-8601 without a zone and with every microsecond, as events are published.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

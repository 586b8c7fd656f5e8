"""Presents the ``events`` test table in the shape of raw web events.

The mapping is a test convention: view -> pageview, signup -> search,
error -> add_to_cart; the remaining columns are derived from ids and ``props.k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The file stores wall-clock values; read as timestamps they count as UTC and
# filters on them reach the scan without a cast in between.
SOURCE_DDL = (
    "event_id bigint, ts timestamp, user_id bigint, event_type string, "
    "value double, props string"
)

# Fixed values of the test convention.
PAGES = [
    "/home", "/products", "/category/electronics", "/category/clothing", "/cart",
    "/checkout", "/search", "/account", "/about", "/contact",
]
USER_AGENTS = ["ua_windows", "ua_mac", "ua_iphone", "ua_android"]
LOCATIONS = ["US", "UK", "CA", "AU", "DE", "FR", "JP", "IN"]
DEVICE_CYCLE = ["desktop", "mobile", "tablet"]
QUERIES = ["laptop", "phone", "camera", "headphones"]
TYPE_NAMES = {"view": "pageview", "signup": "search", "error": "add_to_cart"}


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``events`` table as web events, with its ``event_id``."""
    return as_web_events(spark.read.schema(SOURCE_DDL).parquet(f"{sf_dir}/events.parquet"))


def as_web_events(events: DataFrame) -> DataFrame:
    """Map a batch or streaming ``events`` frame to web-event columns."""
    # a column of its own, so that each row's JSON is parsed once
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("k")
    raw_type = F.col("event_type")

    def pick(values, position):
        return F.element_at(F.array(*map(F.lit, values)), (position % len(values) + 1).cast("int"))

    def only(source_type, value):
        return F.when(raw_type == source_type, value)

    event_type = raw_type
    for source_type, name in TYPE_NAMES.items():
        event_type = F.when(raw_type == source_type, F.lit(name)).otherwise(event_type)

    return events.select(
        "event_id",
        F.concat(F.lit("user_"), "user_id").alias("user_id"),
        F.concat(
            F.lit("session_"), "user_id", F.lit("_"), F.date_format("ts", "yyyyMMdd")
        ).alias("session_id"),
        F.col("ts").alias("timestamp"),
        event_type.alias("event_type"),
        pick(PAGES, k).alias("page"),
        pick(USER_AGENTS, k).alias("user_agent"),
        pick(LOCATIONS, F.col("user_id")).alias("location"),
        pick(DEVICE_CYCLE, F.col("event_id")).alias("device_type"),
        only("signup", pick(QUERIES, k)).alias("search_query"),
        only("error", F.concat(F.lit("prod_"), (k + 1).cast("string"))).alias("product_id"),
        only("error", (k % 7).cast("int")).alias("quantity"),
        only("purchase", F.concat(F.lit("order_"), "event_id")).alias("order_id"),
        only("purchase", F.col("value")).alias("total_amount"),
    )

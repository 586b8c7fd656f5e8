"""Recommendations from segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Tasks over which the users of one segment are spread.
SPREAD = 64


def recommend(events: DataFrame, segments: DataFrame, n: int = 3, item: str = "page") -> DataFrame:
    """The ``n`` most frequent items of each user's segment, less those the user has touched.

    Events are reduced to one row per (user, item) before they meet the segments, so the
    join sees no hot user. The rank filter keeps ``n`` rows per segment and task before
    its shuffle. A segment's list becomes one row, and is repeated for each of ``SPREAD``
    salts, so that the users of a segment, however many, meet it in as many tasks; where
    it is small enough, adaptive execution broadcasts it.
    """
    touched = (
        events.filter(F.col("user_id").isNotNull() & F.col(item).isNotNull())
        .groupBy("user_id", item)
        .agg(F.count("*").alias("times"))
    )
    by_rank = Window.partitionBy("segment").orderBy(F.desc("segment_events"), item)
    ranked = (
        touched.join(segments, "user_id")
        .groupBy("segment", item)
        .agg(F.sum("times").alias("segment_events"))
        .withColumn("segment_rank", F.row_number().over(by_rank))
        .filter(F.col("segment_rank") <= n)
    )
    salts = F.array(*[F.lit(i) for i in range(SPREAD)])
    lists = (
        ranked.groupBy("segment")
        .agg(F.collect_list(F.struct(item, "segment_events", "segment_rank")).alias("best"))
        .withColumn("salt", F.explode(salts))
    )
    salted = segments.select("user_id", "segment").withColumn(
        "salt", F.pmod(F.xxhash64("user_id"), F.lit(SPREAD)).cast("int")
    )
    return (
        salted.join(lists, ["segment", "salt"])
        .select("user_id", "segment", F.inline("best"))
        # keeps `times` on this side too, so that both uses read one shuffle
        .join(touched, ["user_id", item], "left")
        .filter(F.col("times").isNull())
        .select("user_id", "segment", item, "segment_rank", "segment_events")
    )

"""Segment reports.

The feature table is joined with the segment table and reduced to totals per segment
once, by ``segment_summary``. All reports, and any choice of segments, are computed from
that summary of a few rows; a caller that needs several persists it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.schema import DETAIL_METRICS, DEVICES, RADAR_METRICS

SUM, COUNT = "sum_", "count_"


def profile_join(features: DataFrame, segments: DataFrame) -> DataFrame:
    return features.join(segments, "user_id")


def segment_summary(profile: DataFrame) -> DataFrame:
    """Users, buyers, and the sum and count of every other column, per segment.

    Columns no report asks for are pruned from the aggregate and from the scan.
    """
    others = {"user_id", "segment", "features"}
    measures = [c for c in profile.columns if c not in others]
    totals = [F.count("*").alias("users")]
    if "total_purchases" in measures:
        totals.append(F.count_if(F.col("total_purchases") > 0).alias("buyers"))
    for name in measures:
        totals += [F.sum(name).alias(SUM + name), F.count(name).alias(COUNT + name)]
    return profile.groupBy("segment").agg(*totals)


def mean_of(name: str) -> Column:
    """Mean over the users that have a value, NULL without any."""
    return F.try_divide(F.col(SUM + name), F.col(COUNT + name))


def segment_means(summary: DataFrame, columns: Iterable[str]) -> DataFrame:
    return summary.select("segment", *[mean_of(name).alias(name) for name in columns])


def filter_segments(table: DataFrame, segment_ids: Iterable[int] | None = None) -> DataFrame:
    """Keep the given segments of a profile or a summary; None keeps all."""
    if segment_ids is None:
        return table
    return table.filter(F.col("segment").isin(list(segment_ids)))


def segment_options(table: DataFrame) -> DataFrame:
    """The segments of a profile or a summary, in order."""
    return table.select("segment").distinct().orderBy("segment")


def segment_sizes(summary: DataFrame) -> DataFrame:
    return summary.select("segment", F.col("users").alias("count")).orderBy("segment")


def segment_counts_desc(summary: DataFrame) -> DataFrame:
    return summary.select("segment", F.col("users").alias("count")).orderBy(F.desc("count"), "segment")


def segment_profile(summary: DataFrame) -> DataFrame:
    """Mean of every feature column per segment."""
    measures = [c.removeprefix(SUM) for c in summary.columns if c.startswith(SUM)]
    return segment_means(summary, measures).orderBy("segment")


def segment_radar(summary: DataFrame) -> DataFrame:
    """Behaviour means per segment in long form, raw and scaled to [0, 1] per metric.

    ``scaled`` is NULL where all segments share one mean.
    """
    means = segment_means(summary, RADAR_METRICS).unpivot(
        "segment", RADAR_METRICS, "metric", "mean_value"
    )
    over = Window.partitionBy("metric")
    low, high = F.min("mean_value").over(over), F.max("mean_value").over(over)
    return means.withColumn("scaled", F.try_divide(F.col("mean_value") - low, high - low))


def segment_devices(summary: DataFrame) -> DataFrame:
    """Mean events per device and segment in long form, with each device's share."""
    all_devices = sum((F.col(name) for name in DEVICES[1:]), F.col(DEVICES[0]))
    return (
        segment_means(summary, DEVICES)
        .withColumn("all_devices", all_devices)
        .unpivot(["segment", "all_devices"], DEVICES, "device", "mean_events")
        .select(
            "segment", "device", "mean_events",
            F.try_divide("mean_events", "all_devices").alias("share"),
        )
    )


def kpis(summary: DataFrame, text: bool = False) -> DataFrame:
    """Users, mean purchase value over buyers, and percentage of users who bought.

    The averages are NULL on an empty selection. ``text=True`` adds display columns.
    """
    amount = "avg_purchase_amount"
    headline = summary.agg(
        F.coalesce(F.sum("users"), F.lit(0)).alias("total_users"),
        F.try_divide(F.sum(SUM + amount), F.sum(COUNT + amount)).alias("avg_purchase_value"),
        (F.try_divide(F.sum("buyers"), F.sum("users")) * 100).alias("conversion_rate"),
    )
    if not text:
        return headline
    return headline.select(
        "*",
        F.when(
            F.col("avg_purchase_value").isNotNull(), F.format_string("$%.2f", "avg_purchase_value")
        ).alias("avg_purchase_value_text"),
        F.when(
            F.col("conversion_rate").isNotNull(), F.format_string("%.1f%%", "conversion_rate")
        ).alias("conversion_rate_text"),
    )


def segment_details(summary: DataFrame) -> DataFrame:
    """Behaviour means per segment to two decimals."""
    rounded = [F.round(mean_of(name), 2).alias(name) for name in DETAIL_METRICS]
    return summary.select("segment", *rounded).orderBy("segment")

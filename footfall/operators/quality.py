"""Data-quality monitoring: daily volumes against their recent past, and failure rates."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.rules import event_rules
from footfall.schema import EVENT_COLUMNS, EVENT_TYPES, TIMESTAMP_RANGE

OTHER = "other"


def daily_counts(events: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Events per calendar day and type, with zeros, from the first day to the last.

    One scan reduces to one row per day; all else happens on those rows. Types outside
    the known domain are counted together as ``other``. Without ``first`` and ``last`` the
    series covers the days of events with a plausible time. Events outside the series are
    counted by type in rows without a day, so one bad date costs a row and not a long series.
    """
    event_type = F.col("event_type")
    known = [F.count_if(event_type == name).alias(name) for name in EVENT_TYPES]
    unknown = F.count_if(~F.coalesce(event_type.isin(EVENT_TYPES), F.lit(False))).alias(OTHER)
    types = [*EVENT_TYPES, OTHER]
    per_day = (
        events.filter(F.col("timestamp").isNotNull())
        .groupBy(F.to_date("timestamp").alias("day"))
        .agg(*known, unknown)
    )
    inside = F.col("day").between(*(
        F.lit(given).cast("date") if given else default
        for given, default in (
            (first, F.lit(TIMESTAMP_RANGE[0]).cast("date")),
            (last, F.date_sub(F.lit(TIMESTAMP_RANGE[1]).cast("date"), 1)),
        )
    ))
    counts = per_day.unpivot("day", types, "event_type", "events")
    outside = (
        counts.filter(~inside & (F.col("events") > 0))
        .groupBy("event_type")
        .agg(F.sum("events").alias("events"))
        .select("event_type", F.lit(None).cast("date").alias("day"), "events")
    )
    present = counts.filter(inside)
    ends = [day for day in (first, last) if day]
    if ends:
        zeros = events.sparkSession.createDataFrame(
            [(day, name, 0) for day in ends for name in types], "day string, event_type string, events long"
        ).withColumn("day", F.col("day").cast("date"))
        present = present.unionByName(zeros).groupBy("day", "event_type").agg(F.sum("events").alias("events"))
    next_day = F.lead("day").over(Window.partitionBy("event_type").orderBy("day"))
    up_to = F.coalesce(F.date_sub(next_day, 1), "day")
    return present.select(
        "event_type", "events", F.col("day").alias("first"), up_to.alias("up_to")
    ).select(
        "event_type",
        F.explode(F.sequence("first", "up_to")).alias("day"),
        F.when(F.col("day") == F.col("first"), F.col("events")).otherwise(0).alias("events"),
    ).unionByName(outside)


def dq_zscore(
    events: DataFrame, days: int = 7, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Daily events per type as a z-score against the ``days`` calendar days before.

    ``z_score`` is NULL while there are fewer than ``days`` earlier days, and where
    those all have the same count. Rows without a day count events outside the series.
    """
    if days < 2:
        raise ValueError("days must be at least 2")
    dated = F.col("day").isNotNull()
    before = Window.partitionBy("event_type", dated).orderBy("day").rowsBetween(-days, -1)
    enough = F.count("*").over(before) == days
    mean, std = F.avg("events").over(before), F.stddev_samp("events").over(before)
    return (
        daily_counts(events, first, last)
        .withColumns({"mean_before": F.when(enough, mean), "std_before": F.when(enough, std)})
        .withColumn(
            "z_score", F.try_divide(F.col("events") - F.col("mean_before"), F.col("std_before"))
        )
    )


def share(condition: Column) -> Column:
    return F.count_if(condition) / F.count("*")


def dq_failure_rates(events: DataFrame) -> DataFrame:
    """Events per day, share of rejected events, and share of events failing each rule."""
    rules = event_rules(events)
    return events.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("events"),
        share(reduce(or_, rules.values())).alias("rejected_rate"),
        *[share(broken).alias(f"{name}_rate") for name, broken in rules.items()],
    )


def dq_null_rates(events: DataFrame, columns: list[str] = EVENT_COLUMNS) -> DataFrame:
    """Share of NULLs per day in each of ``columns``."""
    return events.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("events"),
        *[share(F.col(name).isNull()).alias(f"{name}_null_rate") for name in columns],
    )


def field_presence(events: DataFrame, line: str = "line") -> DataFrame:
    """Each top-level field of the lines: in how many it is, as a share, of what types, and if declared.

    Declared fields that no line has are there with 0. Lines that are no JSON object have no fields.
    Types are string, number, boolean, object, array, null and other, in that order.
    """
    spark = events.sparkSession
    lines = events.select(line)
    fields = lines.lateralJoin(spark.tvf.variant_explode(F.col(line).outer()).select("key", "value"))
    fields = fields.filter(F.col("key").isNotNull()).select("key", F.schema_of_variant("value").alias("type"))
    of = F.regexp_extract("type", "^[A-Z]+", 0)
    kinds = {
        "string": of == "STRING",
        "number": of.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT"),
        "boolean": of == "BOOLEAN",
        "object": of == "OBJECT",
        "array": of == "ARRAY",
        "null": of == "VOID",
    }
    known = reduce(lambda a, b: a | b, kinds.values())
    counts = fields.groupBy(F.col("key").alias("field")).agg(
        F.count("*").alias("lines"),
        *[F.count_if(is_kind).alias(kind) for kind, is_kind in (kinds | {"other": ~known}).items()],
    )
    types = [F.when(F.col(kind) > 0, F.lit(kind)) for kind in (*kinds, "other")]
    declared = spark.createDataFrame([(name,) for name in EVENT_COLUMNS], "field string")
    return (
        counts.join(declared.withColumn("declared", F.lit(True)), "field", "full")
        .withColumn("all_lines", lines.agg(F.count("*")).scalar())
        .select(
            "field",
            F.coalesce("declared", F.lit(False)).alias("declared"),
            F.coalesce("lines", F.lit(0)).alias("lines"),
            F.coalesce(F.try_divide("lines", "all_lines"), F.lit(0.0)).alias("share"),
            F.array_join(F.array_compact(F.array(*types)), ",").alias("types"),
        )
    )

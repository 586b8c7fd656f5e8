"""Daily runs whose results go on from run to run: sessions, distinct counts, late events.

Every run writes the partition of its day and nothing else of it, so a run can be repeated. What a
later day needs of an earlier one is a table of its own, never the earlier day's events.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.functions.time_range import filter_range
from footfall.operators.features import (
    DISTINCTS, KEYS, SESSION, known_users, spread_keys, user_features,
)
from footfall.operators.temporal import (
    activity_slots, added_sessions, session_summary, sessions_of_slots, with_duration,
)
from footfall.schema import EVENT_DATE, FEATURE_COLUMNS
from footfall.session import work_dir
from footfall.sources import folders
from footfall.sources.tables import RUN_DATE, in_runs, read_landed, replace_days

STRETCH_DDL = "user_id string, first_at timestamp, last_at timestamp, events long"
DECLARED_DDL = "user_id string, session_id string, session_start timestamp, session_end timestamp, events long"
NUMBERS_DDL = "kind int, scope string, key string, lane int, number long"
BITMAPS_DDL = "user_id string, kind int, bucket long, bitmap binary"
#: Keys are numbered in so many lanes, so that no numbering is one task's alone.
LANES = 16


# Sessions


def sessions_run(spark: SparkSession, events: DataFrame, path: str, run_date: str, gap_seconds: int = 1800) -> None:
    """Sessions of one UTC day, going on from the sessions that were open when the day before ended.

    A session that an event of the next day could continue is carried over: it goes to
    ``open/run_date=...``, others to ``closed/run_date=...``, each as one row whatever its length.
    Declared sessions are kept by day and added up when they are read. Runs follow each other
    day by day; after repeating one, repeat those that came later.
    """
    path, day = path.rstrip("/"), date.fromisoformat(run_date)
    before = day - timedelta(days=1)
    runs = folders.values(spark, f"{path}/open", RUN_DATE)
    if any(run < run_date for run in runs) and str(before) not in runs:
        raise ValueError(f"the run of {before} must come first")
    todays = filter_range(events, run_date, run_date)

    stretches = activity_slots(todays, gap_seconds).drop("slot")
    if str(before) in runs:
        carried = spark.read.schema(STRETCH_DDL).parquet(f"{path}/open/{RUN_DATE}={before}")
        stretches = stretches.unionByName(carried)
    sessions = sessions_of_slots(stretches, gap_seconds).select(
        "user_id", F.col("session_start").alias("first_at"), F.col("session_end").alias("last_at"), "events"
    )
    day_end = F.unix_micros(F.lit(day + timedelta(days=1)).cast("timestamp"))
    goes_on = day_end - F.unix_micros("last_at") <= int(gap_seconds * 1_000_000)
    staged = work_dir(spark, "sessions")
    sessions.withColumn("goes_on", goes_on).write.parquet(staged)
    sessions = spark.read.schema(f"{STRETCH_DDL}, goes_on boolean").parquet(staged)
    declared = session_summary(todays).drop("duration_s")
    for name, rows in {
        "declared": declared,
        "closed": sessions.filter(~F.col("goes_on")).drop("goes_on"),
        "open": sessions.filter("goes_on").drop("goes_on"),  # last: a run counts as there with it
    }.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}/{RUN_DATE}={day}")


def read_sessions(spark: SparkSession, path: str, through: str) -> DataFrame:
    """All sessions up to the run of ``through``, those still open then included, numbered per user."""
    path = path.rstrip("/")
    closed = in_runs(spark, f"{path}/closed", STRETCH_DDL, None, through)
    still_open = in_runs(spark, f"{path}/open", STRETCH_DDL, through, through)
    in_order = Window.partitionBy("user_id").orderBy("first_at")
    sessions = closed.unionByName(still_open).select(
        "user_id",
        F.row_number().over(in_order).cast("long").alias("session_number"),
        F.col("first_at").alias("session_start"),
        F.col("last_at").alias("session_end"),
        "events",
    )
    return with_duration(sessions)


def read_declared_sessions(spark: SparkSession, path: str, first: str | None, through: str) -> DataFrame:
    """Declared sessions of the runs from ``first`` to ``through``, each whole whatever days it has."""
    return added_sessions(in_runs(spark, f"{path.rstrip('/')}/declared", DECLARED_DDL, first, through))


# Distinct counts


def distincts_run(spark: SparkSession, events: DataFrame, path: str, run_date: str) -> None:
    """Exact bitmaps of each user's sessions and pages on one UTC day.

    A bitmap has a bit for each numbered key: pages are numbered for all users, sessions for each
    user, so that bitmaps are short (they end with their last bit). Numbers are given once, when a
    key is first seen, and only ever added to ``numbers``; so a day can be run again at any time and
    in any order.
    """
    path = path.rstrip("/")
    kinds = spread_keys(known_users(filter_range(events, run_date, run_date)), KEYS)
    todays = kinds.select("user_id", "kind", "key").distinct().withColumn("scope", scope())
    staged = work_dir(spark, "distincts")
    todays.write.parquet(staged)
    todays = spark.read.schema("user_id string, kind int, key string, scope string").parquet(staged)

    known = numbered_keys(spark, path)
    keys = todays.filter(F.col("key").isNotNull()).select("kind", "scope", "key").distinct()
    fresh = keys.join(known, ["kind", "scope", "key"], "left_anti")
    fresh = fresh.withColumn("lane", F.pmod(F.xxhash64("key"), F.lit(LANES)).cast("int"))
    lane = ["kind", "scope", "lane"]
    so_far = known.groupBy(*lane).agg((F.max("number") + 1).alias("taken"))
    in_lane = F.row_number().over(Window.partitionBy(*lane).orderBy("key")) - 1
    numbers = fresh.join(so_far, lane, "left").select(
        "kind", "scope", "key", "lane", (F.coalesce("taken", F.lit(0)) + in_lane).cast("long").alias("number")
    )
    numbers.write.mode("append").parquet(f"{path}/numbers")

    bit = F.col("number") * LANES + F.col("lane")
    marked = todays.join(numbered_keys(spark, path), ["kind", "scope", "key"], "left").select(
        "user_id", "kind", F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("bit")
    )
    bitmaps = marked.groupBy("user_id", "kind", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("bitmap"), F.max("bit").alias("last")
    )
    short = F.expr("substring(bitmap, 1, CAST(last div 8 + 1 AS INT))")
    bitmaps.select("user_id", "kind", "bucket", short.alias("bitmap")).write.mode("overwrite").parquet(
        f"{path}/bitmaps/{RUN_DATE}={date.fromisoformat(run_date)}"
    )


def scope():
    """Whose numbering a key belongs to."""
    return F.when(F.col("kind") == SESSION, F.col("user_id")).otherwise(F.lit(""))


def numbered_keys(spark: SparkSession, path: str) -> DataFrame:
    if not folders.exists(spark, f"{path}/numbers"):
        return spark.createDataFrame([], NUMBERS_DDL)
    return spark.read.schema(NUMBERS_DDL).parquet(f"{path}/numbers")


def read_distincts(spark: SparkSession, path: str, first: str, through: str) -> DataFrame:
    """Exact distinct sessions and pages per user over a range of runs, from bitmaps alone."""
    bitmaps = in_runs(spark, f"{path.rstrip('/')}/bitmaps", BITMAPS_DDL, first, through)
    merged = bitmaps.groupBy("user_id", "kind", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    count = F.when(F.col("bucket").isNull(), 0).otherwise(F.bitmap_count("bitmap"))
    columns = {
        name: F.sum(F.when(F.col("kind") == kind, F.col("keys")).otherwise(0)) for name, kind in DISTINCTS.items()
    }
    return merged.select("user_id", "kind", count.alias("keys")).groupBy("user_id").agg(
        *[column.alias(name) for name, column in columns.items()]
    )


# Late events


def transform_days(
    spark: SparkSession, landed_path: str, features_path: str, start: str, end: str, events: str = "parsed"
) -> None:
    """The feature row per user and UTC day of landed events, a ``run_date`` partition per day.

    Which landed files a day was made of is kept next to the table, for ``refresh_days``.
    """
    landed = filter_range(read_landed(spark, landed_path, events, with_file=True), start, end)
    files = landed_files(landed)
    staged = work_dir(spark, "files")
    files.write.parquet(staged)  # as they are now, before the events are read
    write_days(spark, landed, spark.read.schema(files.schema).parquet(staged), features_path)


def refresh_days(spark: SparkSession, landed_path: str, features_path: str, events: str = "parsed") -> list[str]:
    """Bring written days up to date with events that landed since; the days that were touched.

    Only days with new files are read, and of these only users with rows in the new files are
    aggregated again; other users keep their rows. Days never transformed stay out.
    """
    inputs = f"{features_path.rstrip('/')}/_inputs"
    written = folders.values(spark, features_path, RUN_DATE)
    if not written:
        return []
    used = spark.read.schema(f"file string, {RUN_DATE} date").parquet(inputs)
    days = [F.lit(day).cast("date") for day in written]
    landed = read_landed(spark, landed_path, events, with_file=True).filter(F.col(EVENT_DATE).isin(*days))
    staged = work_dir(spark, "files")
    landed_files(landed).write.parquet(staged)
    files = spark.read.schema(f"{RUN_DATE} date, file string").parquet(staged)
    fresh = files.join(used, [RUN_DATE, "file"], "left_anti")
    touched = [row[0] for row in fresh.select(RUN_DATE).distinct().orderBy(RUN_DATE).collect()]  # some days
    if not touched:
        return []

    of_days = landed.filter(F.col(EVENT_DATE).isin(*touched))
    new_rows = of_days.join(
        fresh.select(F.col(RUN_DATE).alias(EVENT_DATE), "file"), [EVENT_DATE, "file"], "left_semi"
    )
    users = new_rows.filter(F.col("user_id").isNotNull()).select(F.col(EVENT_DATE), "user_id").distinct()
    again = day_features(of_days.join(users, [EVENT_DATE, "user_id"], "left_semi"))
    kept = spark.read.schema(again.schema).parquet(features_path).filter(F.col(RUN_DATE).isin(*touched))
    kept = kept.join(users.withColumnRenamed(EVENT_DATE, RUN_DATE), [RUN_DATE, "user_id"], "left_anti")
    result = work_dir(spark, "refresh")
    again.unionByName(kept).write.parquet(result)  # the table cannot be replaced while it is read
    replace_days(spark.read.schema(again.schema).parquet(result), features_path)
    replace_days(files.filter(F.col(RUN_DATE).isin(*touched)), inputs)
    return [str(day) for day in touched]


def day_features(events: DataFrame) -> DataFrame:
    features = user_features(events, [EVENT_DATE, "user_id"])
    return features.select("user_id", *FEATURE_COLUMNS, F.col(EVENT_DATE).alias(RUN_DATE))


def landed_files(landed: DataFrame) -> DataFrame:
    """run_date, file: the files that hold the events of each day; no column is read."""
    return landed.filter(F.col(EVENT_DATE).isNotNull()).select(F.col(EVENT_DATE).alias(RUN_DATE), "file").distinct()


def write_days(spark: SparkSession, landed: DataFrame, files: DataFrame, features_path: str) -> None:
    replace_days(day_features(landed), features_path)
    replace_days(files, f"{features_path.rstrip('/')}/_inputs")

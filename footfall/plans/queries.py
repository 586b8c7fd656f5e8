"""Registered queries over the test tables, one per operator.

Each takes ``(spark, sf_dir)``. Doubles that depend on summation order are rounded and
times are written as text, so that results compare exactly with ``oracles.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.adapter import SOURCE_DDL, as_web_events, web_events
from footfall.functions.rules import mark_failed_rules
from footfall.functions.time_range import filter_range
from footfall.operators import (
    centres, experiments, features, quality, recommend, reports, segments, temporal,
)
from footfall.plans import jobs, runs
from footfall.schema import (
    DETAIL_METRICS, DEVICES, EVENT_COLUMNS, FEATURE_COLUMNS, ISO_MICROS, RADAR_METRICS,
)
from footfall.session import work_dir
from footfall.sources import catalog
from footfall.sources import events as event_sources
from footfall.sources import tables
from footfall.streaming import compaction, landing, live, whole

Query = Callable[[SparkSession, str], DataFrame]

DAY = "2024-01-10"
RANGE = ("2024-01-10", "2024-01-12")
HALF = "2024-01-16"
GAP_SECONDS = 4 * 3600
WATERMARK = "1 hour"
CHOSEN_SEGMENTS = [1, 3]
EXPERIMENT = "checkout"
# How far planted groups of users are apart in total_events.
APART = 10_000

# Centroids that stand in for a trained model, so that reports have an oracle.
CENTROID_COLUMNS = ["total_events", "avg_purchase_amount"]
CENTROIDS = [(52, 40), (60, 60), (66, 45), (72, 55), (80, 48)]

# Quotients of exact integers: every engine computes the same double, so none is rounded.
EXACT = {"duration_s", "mean_duration_s", "max_duration_s", "events_per_active_day", "mean_gap_s"}


def plain(result: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles and write dates and timestamps as text."""
    columns = []
    for field in result.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType) and field.name not in EXACT:
            column = F.round(column, digits)
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(column.alias(field.name))
    return result.select(columns)


def all_features(spark, sf_dir, columns=FEATURE_COLUMNS) -> DataFrame:
    return features.user_features(web_events(spark, sf_dir), columns=columns)


def day_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.user_features(filter_range(web_events(spark, sf_dir), DAY, DAY))


def profile(spark, sf_dir, columns=FEATURE_COLUMNS) -> DataFrame:
    """Features with the segment of the nearest fixed centroid.

    Averages are rounded first: their last bits depend on the order of summation and
    would decide between two centroids at the same distance.
    """
    users = all_features(spark, sf_dir, columns).withColumn(
        "avg_purchase_amount", F.round("avg_purchase_amount", 6)
    )
    return segments.nearest_centroid(users, CENTROID_COLUMNS, CENTROIDS)


def stored_profile_parts(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Write the feature and segment tables the way the batch programs do."""
    folder = work_dir(spark, "tables")
    tables.write_features(profile(spark, sf_dir).drop("segment"), f"{folder}/features")
    stored = tables.read_features(spark, f"{folder}/features")
    assigned = segments.nearest_centroid(stored, CENTROID_COLUMNS, CENTROIDS)
    tables.write_segments(assigned, f"{folder}/segments")
    return f"{folder}/features", f"{folder}/segments"


def stored_json(spark: SparkSession, sf_dir: str) -> str:
    folder = work_dir(spark, "json")
    event_sources.write_json_events(web_events(spark, sf_dir), folder)
    return folder


def streamed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a glob, because a file stream reads folders or globs but no single file
    return as_web_events(spark.readStream.schema(SOURCE_DDL).parquet(f"{sf_dir}/event[s].parquet"))


def finished_rows(spark: SparkSession, results: DataFrame) -> DataFrame:
    """Run a stream over what is there and read the rows it has emitted."""
    folder = work_dir(spark, "stream")
    live.start_append(results, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(results.schema).parquet(f"{folder}/rows")


def over_events(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(operator(web_events(spark, sf_dir)))


def over_profile(report: Callable[[DataFrame], DataFrame], columns=FEATURE_COLUMNS) -> Query:
    return lambda spark, sf_dir: plain(report(profile(spark, sf_dir, columns)))


def over_summary(report: Callable[[DataFrame], DataFrame], columns=FEATURE_COLUMNS) -> Query:
    return over_profile(lambda users: report(reports.segment_summary(users)), columns)


# Sources and sinks


def scan_json(spark, sf_dir):
    return plain(event_sources.read_events(spark, stored_json(spark, sf_dir)))


def event_to_json(spark, sf_dir):
    messages = event_sources.encode_events(web_events(spark, sf_dir))
    return plain(event_sources.decode_events(messages).drop("_corrupt_record"))


def roundtrip_features(spark, sf_dir):
    folder = work_dir(spark, "features")
    tables.write_features(all_features(spark, sf_dir), folder)
    return plain(tables.read_features(spark, folder))


def transform_job(spark, sf_dir):
    folder = work_dir(spark, "transform")
    jobs.transform_events(spark, stored_json(spark, sf_dir), folder, *RANGE)
    return plain(tables.read_features(spark, folder))


def landed_path(spark, sf_dir) -> str:
    folder = work_dir(spark, "landing")
    stream = event_sources.stream_events(spark, stored_json(spark, sf_dir))
    landing.land_events(stream, f"{folder}/events", f"{folder}/checkpoint").awaitTermination()
    return f"{folder}/events"


def transform_landed_job(spark, sf_dir):
    folder = work_dir(spark, "transform")
    jobs.transform_events(spark, landed_path(spark, sf_dir), folder, *RANGE, landed=True, events="valid")
    return plain(tables.read_features(spark, folder))


def transform_inputs(spark, sf_dir):
    """JSON lines and landed events give the same features, with the same default."""
    folder = work_dir(spark, "transform")
    jobs.transform_events(spark, stored_json(spark, sf_dir), f"{folder}/json", *RANGE)
    jobs.transform_events(spark, landed_path(spark, sf_dir), f"{folder}/landed", *RANGE, landed=True)
    read = [
        plain(tables.read_features(spark, f"{folder}/{name}")).withColumn("input", F.lit(name))
        for name in ("json", "landed")
    ]
    return read[0].unionByName(read[1])


def rejected_lines(spark, sf_dir):
    """Lines by the rules they break: in each seven of the events, five have something wrong."""
    events, number = web_events(spark, sf_dir), F.col("event_id") % 7
    text = F.date_format("timestamp", ISO_MICROS)
    wrong = events.withColumns({
        "timestamp": F.when(number == 2, "bad").when(number == 5, "2999-01-01T00:00:00.000000").otherwise(text),
        "user_id": F.when(number != 3, F.col("user_id")),
        "total_amount": F.when(number == 4, F.lit(float("nan"))).otherwise(F.col("total_amount")),
    })
    line = F.to_json(F.struct(*EVENT_COLUMNS))
    folder = work_dir(spark, "lines")
    wrong.select(F.when(number == 1, F.concat(F.lit("x"), line)).otherwise(line).alias("value")).write.text(folder)
    marked = mark_failed_rules(event_sources.read_events(spark, folder, keep_corrupt=True))
    return marked.groupBy(F.array_join("failed_rules", ",").alias("failed_rules")).agg(F.count("*").alias("lines"))


def lines_with_more_fields(spark, sf_dir) -> DataFrame:
    """Events as lines of which some have fields that no schema declares, and some are no JSON."""
    every = lambda n, value: F.when(F.col("event_id") % n == 0, value)
    events = web_events(spark, sf_dir).withColumns({
        "experiment": every(3, F.concat(F.lit("variant "), F.col("event_id") % 2)),
        "scroll": F.when(F.col("event_id") % 4 == 0, F.col("event_id") % 100),
        "geo": every(5, F.struct("location", (F.col("event_id") % 90).alias("lat"))),
        "tags": every(6, F.array("page", "event_type")),
        "timestamp": F.date_format("timestamp", ISO_MICROS),
    })
    line = F.to_json(F.struct(*EVENT_COLUMNS, "experiment", "scroll", "geo", "tags"))
    folder = work_dir(spark, "lines")
    events.select(F.when(F.col("event_id") % 50 == 7, F.concat(F.lit("{"), line)).otherwise(line).alias("value")).write.text(folder)
    return event_sources.read_events_whole(spark, folder)


def undeclared_fields(spark, sf_dir):
    return quality.field_presence(lines_with_more_fields(spark, sf_dir))


def undeclared_by_value(spark, sf_dir):
    """Users and purchases by a field that the schema does not declare, and one inside another."""
    events = lines_with_more_fields(spark, sf_dir)
    events = event_sources.with_field(events, "experiment")
    events = event_sources.with_field(events, "latitude", "int", "$.geo.lat")
    return events.groupBy("experiment").agg(
        F.count("*").alias("lines"),
        F.count_distinct("user_id").alias("users"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.sum("latitude").alias("latitudes"),
    )


def land_events(spark, sf_dir):
    landed = tables.read_landed(spark, landed_path(spark, sf_dir), verdict=None)
    return plain(
        landed.withColumn("failed_rules", F.array_join("failed_rules", ",")).drop("_corrupt_record", "arrived_at")
    )


def compacted_days(spark, sf_dir):
    """Landed events by day and verdict, after closed days were copied and late ones landed."""
    folder, events = work_dir(spark, "compaction"), web_events(spark, sf_dir)
    late = F.col("event_id") % 10 == 0
    for part, arrives in (("first", ~late), ("late", late)):
        event_sources.write_json_events(events.filter(arrives), f"{folder}/in/{part}")
        stream = event_sources.stream_events(spark, f"{folder}/in/*")
        landing.land_events(stream, f"{folder}/events", f"{folder}/checkpoint").awaitTermination()
        if part == "first":
            compaction.compact_days(spark, f"{folder}/events", f"{folder}/copy", "2024-01-05", least_files=1)
    rows = compaction.read_compacted(spark, f"{folder}/events", f"{folder}/copy", verdict=None)
    return plain(
        rows.groupBy("event_date", "verdict").agg(
            F.count("*").alias("events"),
            F.count_distinct("user_id").alias("users"),
            F.sum("quantity").alias("quantity"),
            F.min("timestamp").alias("first_at"),
        )
    )


def validate_events(spark, sf_dir):
    marked = mark_failed_rules(web_events(spark, sf_dir))
    return marked.select(
        "event_id",
        F.array_join("failed_rules", ",").alias("failed_rules"),
        (F.size("failed_rules") == 0).alias("valid"),
    )


def sql_top_spenders(spark, sf_dir):
    spending = all_features(spark, sf_dir, ["total_purchases", "avg_purchase_amount"])
    tables.register_views(spark, {"user_features": spending})
    return spark.sql(
        """
        SELECT user_id, total_purchases,
          round(avg_purchase_amount * total_purchases, 2) AS total_spend
        FROM user_features
        ORDER BY total_spend DESC, user_id
        LIMIT 10
        """
    )


def sql_stored_tables(spark, sf_dir):
    """Buyers and spending by segment, in SQL over stored and analyzed tables, of one of two runs."""
    folder, suffix = work_dir(spark, "catalog"), uuid.uuid4().hex
    for day in run_days()[:2]:
        chosen = features.user_features(filter_range(web_events(spark, sf_dir), day, day))
        tables.write_features(chosen, f"{folder}/features", day)
    tables.write_segments(profile(spark, sf_dir, CENTROID_COLUMNS), f"{folder}/segments")
    names = {f"{table}_{suffix}": f"{folder}/{table}" for table in ("features", "segments")}
    features_name, segments_name = names
    catalog.register_tables(spark, names)
    found = spark.sql(
        f"""
        SELECT segment, count(*) AS users, count_if(total_purchases > 0) AS buyers,
          round(sum(avg_purchase_amount * total_purchases), 2) AS spend
        FROM {features_name} JOIN {segments_name} USING (user_id)
        WHERE run_date = DATE '{DAY}'
        GROUP BY segment
        """
    )
    found.write.parquet(f"{folder}/result")
    for name in names:  # the names only, the files stay
        spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(f"{folder}/result")


# Filters and joins


def filter_range_closed(spark, sf_dir):
    return plain(filter_range(web_events(spark, sf_dir), *RANGE, closed="both"))


def filter_range_daily(spark, sf_dir):
    return plain(filter_range(web_events(spark, sf_dir), DAY, DAY))


def profile_join(spark, sf_dir):
    features_path, segments_path = stored_profile_parts(spark, sf_dir)
    return plain(
        reports.profile_join(
            tables.read_features(spark, features_path), tables.read_segments(spark, segments_path)
        )
    )


def kpis_day(spark, sf_dir):
    """Headline of all user days, many of which are without a purchase."""
    users = features.daily_features(web_events(spark, sf_dir)).drop("day").withColumn("segment", F.lit(0))
    return plain(reports.kpis(reports.segment_summary(users), text=True))


def report_job(spark, sf_dir):
    paths = stored_profile_parts(spark, sf_dir)
    return plain(jobs.segment_report(spark, *paths, CHOSEN_SEGMENTS)["kpis"])


def report_tables(spark, sf_dir):
    """Every written report table in long form: table, segment, metric, value."""
    folder = work_dir(spark, "report")
    jobs.segment_report(spark, *stored_profile_parts(spark, sf_dir), output_path=folder)

    def long(name, keys, metrics, metric=None):
        table = spark.read.parquet(f"{folder}/{name}")
        values = [F.col(c).cast("double").alias(c) for c in metrics]
        if "segment" not in table.columns:
            table = table.withColumn("segment", F.lit(None).cast("int"))
        table = table.select("segment", *keys, *values).unpivot(["segment", *keys], metrics, "measure", "value")
        metric = F.col("measure") if metric is None else F.concat_ws(" ", metric, "measure")
        return table.select(F.lit(name).alias("table"), "segment", metric.alias("metric"), F.round("value", 6).alias("value"))

    parts = [
        long("kpis", [], ["total_users", "avg_purchase_value", "conversion_rate"]),
        long("segment_counts", [], ["count"]),
        long("segment_radar", ["metric"], ["mean_value", "scaled"], "metric"),
        long("segment_devices", ["device"], ["mean_events", "share"], "device"),
        long("segment_details", [], DETAIL_METRICS),
    ]
    return reduce(DataFrame.unionByName, parts)


# Segments


def feature_vector(spark, sf_dir):
    """The vectors of all user days, most of them without an average."""
    vectors = segments.prepare_features(features.daily_features(web_events(spark, sf_dir)))
    return plain(segments.feature_slots(vectors, ["day", "user_id"]))


def trained(spark, sf_dir, apart: int = 0, **how):
    """A fit on all users; with ``apart`` in five groups that the best clusters must find."""
    folder = work_dir(spark, "features")
    group = F.substring_index("user_id", "_", -1).cast("long") % 5
    users = all_features(spark, sf_dir).withColumn("total_events", F.col("total_events") + apart * group)
    tables.write_features(users, folder)
    vectors = segments.prepare_features(tables.read_features(spark, folder))
    return segments.train_kmeans(vectors, partitions=8, **how), vectors


def kmeans_segments(spark, sf_dir):
    return segments.segment_map(segments.assign_segments(*trained(spark, sf_dir, APART)))


def kmeans_mass(spark, sf_dir):
    """Once K-Means has settled, the centres weighted by their sizes are the mean of all users."""
    model, _ = trained(spark, sf_dir, tol=0.0, max_iter=200)
    sizes, found = model.summary.clusterSizes, model.clusterCenters()
    means = sum(n * centre for n, centre in zip(sizes, found)) / sum(sizes)
    rows = [(feature, float(mean)) for feature, mean in zip(FEATURE_COLUMNS, means)]
    return plain(spark.createDataFrame(rows, "feature string, mean double"))


def kmeans_invariants(spark, sf_dir):
    """Users, users with a segment, segments out of range, users nearer to another centre."""
    model, vectors = trained(spark, sf_dir)
    placed = segments.assign_segments(model, vectors)
    found = model.clusterCenters()
    order = segments.centre_order(model)
    nearest = segments.nearest_centroid(
        placed.withColumnRenamed("segment", "assigned"),
        FEATURE_COLUMNS,
        [found[cluster] for cluster in order],
    )
    in_range = F.col("assigned").between(0, len(found) - 1)
    return nearest.agg(
        F.count("*").alias("users"),
        F.count_distinct("user_id").alias("assigned_users"),
        F.count_if(~in_range).alias("out_of_range"),
        F.count_if(F.col("segment") != F.col("assigned")).alias("misplaced"),
    )


def cluster_centers(spark, sf_dir):
    return plain(segments.cluster_centers(spark, trained(spark, sf_dir, APART, tol=0.0)[0]))


def planted(spark, sf_dir, apart: dict[str, int]) -> DataFrame:
    """Stored features of all users, in five groups by their number: as far ``apart`` in some features."""
    folder = work_dir(spark, "features")
    group = F.substring_index("user_id", "_", -1).cast("long") % 5
    users = all_features(spark, sf_dir)
    for name, distance in apart.items():
        users = users.withColumn(name, F.col(name) + (distance * group if distance > 0 else -distance * (4 - group)))
    tables.write_features(users, folder)
    return tables.read_features(spark, folder)


def kmeans_layouts(spark, sf_dir):
    """Users, users whose segment differs between tables of 8 and of 64 parts, and segments."""
    vectors = segments.prepare_features(planted(spark, sf_dir, {})).select("user_id", "features")
    placed = []
    for parts in (8, 64):
        laid = vectors.repartition(parts).persist()
        try:
            fitted = centres.fit(laid, k=5, max_iter=10)
        finally:
            laid.unpersist()
        placed.append(centres.assign(vectors, fitted).select("user_id", F.col("segment").alias(f"of_{parts}")))
    return placed[0].join(placed[1], "user_id").agg(
        F.count("*").alias("users"),
        F.count_if(F.col("of_8") != F.col("of_64")).alias("moved"),
        F.count_distinct("of_8").alias("segments"),
    )


def segment_reassign(spark, sf_dir):
    """Users placed by a stored fit of scaled features, read again."""
    folder, users = work_dir(spark, "fit"), planted(spark, sf_dir, dict.fromkeys(FEATURE_COLUMNS, APART))
    deviations = segments.feature_deviations(users)
    vectors = segments.prepare_features(users, True, deviations).select("user_id", "features")
    centres.write_segmentation(spark, centres.fit(vectors, k=5, deviations=deviations), folder)
    placed = centres.assign_features(users, centres.read_segmentation(spark, folder))
    return segments.segment_map(placed)


def segment_refit(spark, sf_dir):
    """Ids kept by a refit of users whose totals have changed so much that their order is reversed."""
    folder = work_dir(spark, "fit")
    first, second = (planted(spark, sf_dir, {"total_searches": APART, "total_events": way}) for way in (300, -300))
    fits = [centres.fit(segments.prepare_features(users).select("user_id", "features"), k=5) for users in (first, second)]
    centres.write_segmentation(spark, fits[0], folder)
    kept = centres.with_ids_of(fits[1], centres.read_segmentation(spark, folder))
    placed = centres.assign_features(second, kept).withColumnRenamed("segment", "kept")
    plain_refit = centres.assign_features(second, fits[1]).withColumnRenamed("segment", "renumbered")
    return placed.select("user_id", "kept").join(plain_refit.select("user_id", "renumbered"), "user_id")


def silhouette(spark, sf_dir):
    vectors = segments.prepare_features(profile(spark, sf_dir)).select("segment", "features")
    vectors.persist()
    try:
        value = segments.silhouette(vectors)
    finally:
        vectors.unpersist()
    return plain(spark.createDataFrame([(value,)], "silhouette double"), 9)


# Streams


def stream_closed_days(spark, sf_dir):
    stream = live.live_daily_features(streamed_events(spark, sf_dir), WATERMARK, ["event_id"])
    return plain(finished_rows(spark, stream))


def stream_closed_sessions(spark, sf_dir):
    stream = live.live_sessions(streamed_events(spark, sf_dir), GAP_SECONDS, WATERMARK, ["event_id"])
    return plain(finished_rows(spark, stream))


def streamed_in_halves(spark, sf_dir) -> str:
    """A stream that stops after the first half of the month and is started again for the second."""
    folder = work_dir(spark, "whole")
    rows = spark.read.schema(SOURCE_DDL).parquet(f"{sf_dir}/events.parquet")
    first = F.col("ts") < F.lit(HALF).cast("timestamp")
    for half in (first, ~first):
        rows.filter(half).write.mode("append").parquet(f"{folder}/source")
        events = as_web_events(spark.readStream.schema(SOURCE_DDL).parquet(f"{folder}/source"))
        whole.start_whole(
            events, f"{folder}/rows", f"{folder}/checkpoint", GAP_SECONDS, WATERMARK, ["event_id"], span=4
        ).awaitTermination()
    return f"{folder}/rows"


def stream_daily_features(spark, sf_dir):
    return plain(whole.read_daily(spark, streamed_in_halves(spark, sf_dir)))


def stream_sessions(spark, sf_dir):
    return plain(whole.read_sessions(spark, streamed_in_halves(spark, sf_dir), GAP_SECONDS))


# Daily runs


def run_days() -> list[str]:
    first, last = map(date.fromisoformat, RANGE)
    return [str(first + timedelta(days=n)) for n in range((last - first).days + 1)]


def session_runs(spark, sf_dir):
    """Sessions of three days that were run one by one."""
    folder, events = work_dir(spark, "session-runs"), web_events(spark, sf_dir)
    for day in run_days():
        runs.sessions_run(spark, events, folder, day, GAP_SECONDS)
    return plain(runs.read_sessions(spark, folder, RANGE[1]))


def declared_session_runs(spark, sf_dir):
    """Declared sessions, one per user and device, that go on over three runs."""
    folder = work_dir(spark, "declared-runs")
    events = web_events(spark, sf_dir).withColumn("session_id", F.concat_ws(" ", "user_id", "device_type"))
    for day in run_days():
        runs.sessions_run(spark, events, folder, day, GAP_SECONDS)
    return plain(runs.read_declared_sessions(spark, folder, *RANGE))


def distinct_runs(spark, sf_dir):
    """Distinct counts of three days from the bitmaps of three runs, the last day run first."""
    folder, events = work_dir(spark, "distinct-runs"), web_events(spark, sf_dir)
    for day in reversed(run_days()):
        runs.distincts_run(spark, events, folder, day)
    return plain(runs.read_distincts(spark, folder, *RANGE))


def refreshed_days(spark, sf_dir):
    """Days that were transformed before a tenth of their events landed."""
    folder, events = work_dir(spark, "refresh"), web_events(spark, sf_dir)
    late = F.col("event_id") % 10 == 0
    for part, arrives in (("first", ~late), ("late", late)):
        event_sources.write_json_events(events.filter(arrives), f"{folder}/in/{part}")
        stream = event_sources.stream_events(spark, f"{folder}/in/*")
        landing.land_events(stream, f"{folder}/events", f"{folder}/checkpoint").awaitTermination()
        if part == "first":
            runs.transform_days(spark, f"{folder}/events", f"{folder}/features", *RANGE)
    runs.refresh_days(spark, f"{folder}/events", f"{folder}/features")
    return plain(spark.read.parquet(f"{folder}/features").withColumnRenamed("run_date", "day"))


# Experiments and recommendations


def ab_test(spark, sf_dir):
    users = experiments.assign_variant(all_features(spark, sf_dir, ["total_purchases"]), EXPERIMENT)
    return plain(experiments.ab_test(users, converted=F.col("total_purchases") >= 14))


def ab_test_days(spark, sf_dir):
    """Days of users, which convert by a purchase; not every day has one."""
    days = experiments.assign_variant(features.daily_features(web_events(spark, sf_dir)), EXPERIMENT)
    return plain(experiments.ab_test(days))


def recommender(n: int, item: str) -> Query:
    """Of products, or of pages by search term and agent: users have not touched all of them."""

    def query(spark, sf_dir):
        folder = work_dir(spark, "segments")
        tables.write_segments(profile(spark, sf_dir, CENTROID_COLUMNS), folder)
        assigned = tables.read_segments(spark, folder)
        seen = web_events(spark, sf_dir).withColumn(
            "view", F.concat_ws(" ", "page", "user_agent", "device_type", "event_type")
        )
        return recommend.recommend(seen, assigned, n, item)

    return query


QUERIES: dict[str, Query] = {
    "scan_json": scan_json,
    "event_to_json": event_to_json,
    "roundtrip_features": roundtrip_features,
    "transform_job": transform_job,
    "land_events": land_events,
    "compacted_days": compacted_days,
    "transform_landed_job": transform_landed_job,
    "transform_inputs": transform_inputs,
    "rejected_lines": rejected_lines,
    "undeclared_fields": undeclared_fields,
    "undeclared_by_value": undeclared_by_value,
    "validate_events": validate_events,
    "sql_top_spenders": sql_top_spenders,
    "sql_stored_tables": sql_stored_tables,
    "filter_range_closed": filter_range_closed,
    "filter_range_daily": filter_range_daily,
    "segment_map": over_profile(segments.segment_map, CENTROID_COLUMNS),
    "segment_filter": over_profile(lambda p: reports.filter_segments(p, CHOSEN_SEGMENTS)),
    "segment_options": over_profile(reports.segment_options, CENTROID_COLUMNS),
    "features_join": over_events(features.features_join),
    "profile_join": profile_join,
    "user_totals": over_events(features.user_totals),
    "user_avg_purchase": over_events(features.user_avg_purchase),
    "user_distincts": over_events(features.user_distincts),
    "device_counts": over_events(features.device_counts),
    "device_pivot": over_events(features.device_pivot),
    "user_features": lambda spark, sf_dir: plain(all_features(spark, sf_dir)),
    "user_features_day": lambda spark, sf_dir: plain(day_features(spark, sf_dir)),
    "daily_features": over_events(features.daily_features),
    "segment_sizes": over_summary(reports.segment_sizes, CENTROID_COLUMNS),
    "segment_profile": over_summary(reports.segment_profile),
    "segment_counts_desc": over_summary(reports.segment_counts_desc, CENTROID_COLUMNS),
    "segment_radar": over_summary(reports.segment_radar, RADAR_METRICS),
    "segment_devices": over_summary(reports.segment_devices, CENTROID_COLUMNS + DEVICES),
    "kpis": over_summary(reports.kpis, CENTROID_COLUMNS + ["total_purchases"]),
    "kpis_day": kpis_day,
    "report_job": report_job,
    "report_tables": report_tables,
    "segment_details": over_summary(reports.segment_details),
    "feature_vector": feature_vector,
    "segment_assign": over_profile(lambda assigned: assigned, CENTROID_COLUMNS),
    "kmeans_segments": kmeans_segments,
    "kmeans_invariants": kmeans_invariants,
    "kmeans_mass": kmeans_mass,
    "kmeans_layouts": kmeans_layouts,
    "segment_reassign": segment_reassign,
    "segment_refit": segment_refit,
    "silhouette": silhouette,
    "cluster_centers": cluster_centers,
    "time_of_day": over_events(temporal.time_of_day),
    "session_summary": over_events(temporal.session_summary),
    "session_duration": over_events(temporal.session_duration),
    "sessionize": over_events(lambda e: temporal.sessionize(e, GAP_SECONDS)),
    "interaction_frequency": over_events(temporal.interaction_frequency),
    "pages_viewed": over_events(temporal.pages_viewed),
    "behavior_profile": over_events(temporal.behavior_profile),
    "stream_closed_days": stream_closed_days,
    "stream_closed_sessions": stream_closed_sessions,
    "stream_daily_features": stream_daily_features,
    "stream_sessions": stream_sessions,
    "session_runs": session_runs,
    "declared_session_runs": declared_session_runs,
    "distinct_runs": distinct_runs,
    "refreshed_days": refreshed_days,
    "ab_test": ab_test,
    "ab_test_days": ab_test_days,
    "segment_recommend": recommender(10, "view"),
    "segment_recommend_products": recommender(10, "product_id"),
    "dq_daily_zscore": over_events(quality.dq_zscore),
    "dq_failure_rates": over_events(quality.dq_failure_rates),
    "dq_null_rates": over_events(quality.dq_null_rates),
}

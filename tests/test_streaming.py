"""Streams give the batch results; late rows and copies are left out."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.adapter import SOURCE_DDL, as_web_events
from footfall.functions.time_range import filter_range
from footfall.operators import features, temporal
from footfall.sources.events import read_events, stream_events, write_json_events
from footfall.sources.tables import read_landed
from footfall.streaming.landing import land_events
from footfall.streaming.live import live_daily_features, live_sessions, start_append, stream_features

GAP = 4 * 3600


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def rounded(frame):
    return frame.withColumn("avg_purchase_amount", F.round("avg_purchase_amount", 6))


def run(results, folder):
    start_append(results, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return results.sparkSession.read.schema(results.schema).parquet(f"{folder}/rows")


@pytest.fixture(scope="module")
def in_time_order(spark, events, tmp_path_factory):
    """The events as six parquet files, which a stream reads one by one, oldest first."""
    folder = str(tmp_path_factory.mktemp("ordered"))
    ordered = spark.read.schema(SOURCE_DDL).parquet("/root/testdata/sf0.01/events.parquet")
    sixth = F.ntile(6).over(Window.orderBy("ts"))
    parts = ordered.withColumn("part", sixth).cache()
    for part in range(1, 7):
        parts.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(folder)
    return folder


def source(spark, folder):
    reader = spark.readStream.schema(SOURCE_DDL).option("maxFilesPerTrigger", "1")
    return as_web_events(reader.parquet(folder))


def test_daily_features_over_micro_batches(spark, events, in_time_order, tmp_path):
    streamed = run(live_daily_features(source(spark, in_time_order), identity=["event_id"]), tmp_path)
    # the last day is still open when the input ends
    closed = features.daily_features(events).filter("day < DATE '2024-01-30'")
    assert closed.count() == 3873
    assert same(rounded(closed), rounded(streamed))


def test_sessions_over_micro_batches(spark, events, in_time_order, tmp_path):
    streamed = run(live_sessions(source(spark, in_time_order), GAP, identity=["event_id"]), tmp_path)
    watermark = events.agg(F.max("timestamp") - F.expr("INTERVAL 1 HOUR")).first()[0]
    closed = temporal.sessionize(events, GAP).drop("session_number").filter(
        F.col("session_end") + F.expr(f"INTERVAL {GAP} SECONDS") <= F.lit(watermark)
    )
    assert closed.count() == 6883
    assert same(closed, streamed)


def write_batches(make_events, folder, batches):
    """One JSON file per batch, in an order the file stream follows."""
    import os
    import time

    for number, rows in enumerate(batches):
        write_json_events(make_events(rows).coalesce(1), f"{folder}/{number}")
        stamp = time.time() - 100 + number
        for name in os.listdir(f"{folder}/{number}"):
            os.utime(f"{folder}/{number}/{name}", (stamp, stamp))


def event(user, when, **more):
    base = {
        "user_id": user, "session_id": f"{user}-s", "event_type": "pageview", "page": "/home",
        "device_type": "mobile", "timestamp": when,
    }
    return {**base, **more}


def test_late_rows_and_copies_are_left_out(spark, make_events, tmp_path):
    day = datetime(2025, 4, 1)
    at = lambda days, hours: day + timedelta(days=days, hours=hours)
    write_batches(make_events, f"{tmp_path}/in", [
        [event("a", at(0, 1)), event("a", at(0, 1)), event("a", at(0, 2), page="/cart")],
        [event("a", at(0, 1)), event("b", at(0, 23)), event("x", at(1, 3))],
        # the watermark is now 02:00 on the second day, which closes the first one; Spark
        # turns late rows away from the batch after that on
        [event("b", at(1, 4))],
        [event("late", at(0, 23)), event("late", at(1, 1), page="/cart")],
        [event("x", at(3, 0))],
    ])
    stream = stream_events(spark, f"{tmp_path}/in/*", maxFilesPerTrigger="1")
    rows = run(live_daily_features(stream, "1 hour"), tmp_path / "out").collect()
    found = {(r.day.isoformat(), r.user_id): (r.total_events, r.unique_pages_visited) for r in rows}
    assert found == {
        ("2025-04-01", "a"): (2, 2),
        ("2025-04-01", "b"): (1, 1),
        ("2025-04-02", "b"): (1, 1),
        ("2025-04-02", "x"): (1, 1),
    }


def test_copies_are_kept_when_asked(spark, make_events, tmp_path):
    day = datetime(2025, 4, 1)
    write_batches(make_events, f"{tmp_path}/in", [
        [event("a", day), event("a", day)], [event("b", day + timedelta(days=2))],
    ])
    stream = stream_events(spark, f"{tmp_path}/in/*")
    rows = run(live_daily_features(stream, identity=None), tmp_path / "out").collect()
    assert [(r.user_id, r.total_events) for r in rows] == [("a", 2)]


def test_landing_is_exactly_once_across_restarts(spark, make_events, events, tmp_path):
    day = datetime(2025, 4, 1, 23, 59, 59, 999999)
    folders = (f"{tmp_path}/landed", f"{tmp_path}/checkpoint")

    def land():
        land_events(stream_events(spark, f"{tmp_path}/in/*"), *folders).awaitTermination()

    first = [event("a", day), event("a", day + timedelta(microseconds=1)), event("b", day, device_type="tv")]
    write_batches(make_events, f"{tmp_path}/in", [first])
    land()
    land()
    assert read_landed(spark, folders[0], verdict=None).count() == 3
    write_json_events(make_events([event("c", day)]), f"{tmp_path}/in/later")
    (tmp_path / "in" / "broken").mkdir()
    (tmp_path / "in" / "broken" / "part.json").write_text("not json\n")
    land()
    valid = read_landed(spark, folders[0])
    rejected = read_landed(spark, folders[0], "rejected")
    assert sorted((r.user_id, r.event_date.isoformat()) for r in valid.collect()) == [
        ("a", "2025-04-01"), ("a", "2025-04-02"), ("c", "2025-04-01"),
    ]
    assert {r._corrupt_record: r.failed_rules[-1] for r in rejected.collect()} == {
        None: "device_unknown", "not json": "unparseable",
    }
    assert filter_range(valid, "2025-04-02", "2025-04-02").count() == 1


def test_landed_days_prune_and_agree_with_the_source(spark, events, tmp_path):
    write_json_events(events, f"{tmp_path}/in")
    land_events(
        stream_events(spark, f"{tmp_path}/in"), f"{tmp_path}/landed", f"{tmp_path}/checkpoint"
    ).awaitTermination()
    landed = read_landed(spark, f"{tmp_path}/landed", verdict=None).drop(
        "_corrupt_record", "arrived_at", "failed_rules", "verdict"
    )
    day = filter_range(landed, "2024-01-10", "2024-01-10")
    assert same(day.drop("event_date"), filter_range(read_events(spark, f"{tmp_path}/in"), "2024-01-10", "2024-01-10"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def seven_days(make_events, folder, *more):
    day = datetime(2025, 4, 1)
    write_batches(make_events, folder, [
        [event(f"u{i}", day + timedelta(days=number, hours=12, minutes=i)) for i in range(5)]
        + (list(more) if number == 1 else [])
        for number in range(7)
    ])


def test_one_impossible_time_closes_no_day(spark, make_events, tmp_path):
    found = {}
    for name, more in (("good", []), ("bad", [event("u1", datetime(2999, 1, 1)), event("u2", None)])):
        seven_days(make_events, f"{tmp_path}/{name}", *more)
        stream = stream_events(spark, f"{tmp_path}/{name}/*", maxFilesPerTrigger="1")
        for query in stream_features(stream, f"{tmp_path}/{name}-out", f"{tmp_path}/{name}-cp"):
            query.awaitTermination()
        found[name] = spark.read.parquet(f"{tmp_path}/{name}-out/daily")
    assert {r.day.isoformat() for r in found["bad"].collect()} == {f"2025-04-0{d}" for d in range(1, 7)}
    assert same(found["good"], found["bad"])
    rejected = spark.read.parquet(f"{tmp_path}/bad-out/rejected").collect()
    assert sorted(r.failed_rules for r in rejected) == [["timestamp_implausible"], ["timestamp_missing"]]


def test_events_later_than_their_arrival_are_rejected(spark, make_events, tmp_path):
    soon = datetime.now() + timedelta(days=3)
    write_batches(make_events, f"{tmp_path}/in", [[event("a", soon), event("b", datetime(2025, 4, 1))]])
    land_events(
        stream_events(spark, f"{tmp_path}/in/*"), f"{tmp_path}/landed", f"{tmp_path}/checkpoint"
    ).awaitTermination()
    assert [r.user_id for r in read_landed(spark, f"{tmp_path}/landed").collect()] == ["b"]
    assert [r.user_id for r in read_landed(spark, f"{tmp_path}/landed", "rejected").collect()] == ["a"]
    assert read_landed(spark, f"{tmp_path}/landed", "parsed").count() == 2


def test_live_days_are_utc_days_in_any_time_zone(spark, make_events, tmp_path):
    write_batches(make_events, f"{tmp_path}/in", [
        [event("a", datetime(2025, 4, 1, 1))], [event("b", datetime(2025, 4, 3))], [event("b", datetime(2025, 4, 4))],
    ])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stream = stream_events(spark, f"{tmp_path}/in/*", maxFilesPerTrigger="1")
        rows = run(live_daily_features(stream), tmp_path / "out").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # written in UTC without a zone, so read as New York time: five in the morning UTC
    assert [(r.user_id, r.day.isoformat()) for r in rows if r.user_id == "a"] == [("a", "2025-04-01")]


def test_files_per_day_bounds_the_files_of_a_batch(spark, events, tmp_path):
    write_json_events(events.repartition(6), f"{tmp_path}/in")
    landed = {}
    # adaptive execution would merge partitions this small into one file
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for files in (None, 2):
            out = f"{tmp_path}/{files}"
            land_events(
                stream_events(spark, f"{tmp_path}/in"), f"{out}/landed", f"{out}/checkpoint",
                files_per_day=files,
            ).awaitTermination()
            landed[files] = read_landed(spark, f"{out}/landed")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert same(landed[None], landed[2])

    def most_files(table):
        names = table.groupBy("event_date", F.input_file_name().alias("file")).count()
        return names.groupBy("event_date").count().agg(F.max("count")).first()[0]

    assert most_files(landed[None]) == 6
    assert most_files(landed[2]) == 2


@pytest.mark.parametrize("zone", ["Pacific/Kiritimati", "Etc/GMT+12", "America/New_York"])
def test_landed_days_are_complete_in_any_time_zone(spark, events, tmp_path, zone):
    """Folders are UTC days while a range is in session time: none may be pruned too early."""
    write_json_events(events, f"{tmp_path}/in")
    land_events(
        stream_events(spark, f"{tmp_path}/in"), f"{tmp_path}/landed", f"{tmp_path}/checkpoint"
    ).awaitTermination()
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        landed = read_landed(spark, f"{tmp_path}/landed", verdict=None)
        for closed in ("day", "both"):
            pruned = filter_range(landed, "2024-01-10", "2024-01-12", closed)
            whole = filter_range(landed.drop("event_date"), "2024-01-10", "2024-01-12", closed)
            assert pruned.count() == whole.count() > 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

"""Rows the test tables lack: NULLs, unknown devices, bad lines, exact midnight."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.functions.rules import mark_failed_rules, validate_events
from footfall.functions.time_range import filter_range
from footfall.operators import features, quality, reports, segments, temporal
from footfall.schema import DEVICES, EVENT_COLUMNS, FEATURE_COLUMNS
from footfall.sources.events import decode_events, encode_events, read_events, write_json_events

LINES = """\
{"user_id":"u1","session_id":"s1","timestamp":"2025-04-01T00:00:00","event_type":"purchase","page":"/home","device_type":"desktop","order_id":"o1","total_amount":10.5}
{"user_id":"u1","session_id":"s1","timestamp":"2025-04-01T10:11:12.123456","event_type":"add_to_cart","page":"/cart","device_type":"mobile","product_id":"p1","quantity":2}
{"user_id":"u2","session_id":"s1","timestamp":"2025-04-01T23:59:59.999","event_type":"search","page":"/home","device_type":null,"search_query":""}
{"user_id":null,"session_id":"s3","timestamp":"2025-04-01T01:00:00","event_type":"search","page":"/home","device_type":"mobile","search_query":"x"}
{"user_id":"u4","session_id":"s4","timestamp":"2025-04-02T00:00:00","event_type":"pageview","page":"/home","device_type":"watch"}
{"user_id":"u3","timestamp":"bad","quantity":"abc"}
not json
"""
DAY = "2025-04-01"


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    folder = tmp_path_factory.mktemp("edge")
    (folder / "part.json").write_text(LINES)
    return str(folder)


@pytest.fixture(scope="module")
def edge(spark, path):
    return read_events(spark, path)


@pytest.fixture(scope="module")
def daily(edge):
    return filter_range(edge, DAY, DAY)


def test_scan_is_permissive(edge):
    rows = edge.collect()
    assert len(rows) == 7
    assert edge.columns == EVENT_COLUMNS
    assert [r for r in rows if r.user_id == "u3"][0].asDict() == {
        **dict.fromkeys(EVENT_COLUMNS), "user_id": "u3",
    }
    assert sum(all(v is None for v in r) for r in rows) == 1
    assert {r.timestamp.microsecond for r in rows if r.timestamp} == {0, 123456, 999000}


def test_corrupt_text_is_kept_on_request(spark, path):
    kept = read_events(spark, path, keep_corrupt=True).cache()
    texts = {r._corrupt_record for r in kept.collect()} - {None}
    assert texts == set(LINES.splitlines()[-2:])


def test_ranges(edge):
    assert filter_range(edge, DAY, DAY, closed="both").count() == 1
    assert filter_range(edge, DAY, "2025-04-02", closed="both").count() == 5
    daily = filter_range(edge, DAY, DAY)
    assert daily.count() == 4
    assert daily.filter("user_id IS NOT NULL").count() == 3
    assert filter_range(edge, DAY, "2025-04-02").count() == 5
    with pytest.raises(ValueError):
        filter_range(edge, DAY, DAY, closed="left")


def test_daily_features(daily):
    rows = {r.user_id: tuple(r)[1:] for r in features.user_features(daily).collect()}
    assert rows == {
        "u1": (2, 0, 1, 1, 10.5, 1, 2, 1, 1, 0),
        "u2": (1, 1, 0, 0, None, 1, 1, 0, 0, 0),
    }
    joined = {r.user_id: tuple(r)[1:] for r in features.features_join(daily).collect()}
    assert joined == rows


def test_device_columns_never_depend_on_data(edge, daily):
    assert features.device_pivot(daily).columns == ["user_id", *DEVICES]
    unknown = features.device_pivot(edge).filter("user_id = 'u4'").first()
    assert tuple(unknown) == ("u4", 0, 0, 0)
    counts = {(r.user_id, r.device_type): r["count"] for r in features.device_counts(edge).collect()}
    assert counts[("u2", None)] == 1 and counts[("u4", "watch")] == 1


def test_pivot_gives_the_same_device_columns(events):
    pivoted = events.groupBy("user_id").pivot("device_type", DEVICES).count().fillna(0)
    assert pivoted.exceptAll(features.device_pivot(events)).isEmpty()


def test_two_levels_equal_one_aggregate(spark):
    # NULL keys, and one user with a third of all events
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("u"), (F.col("id") % 40).cast("string"))
        ).alias("user_id"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 53).cast("string")).alias("session_id"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 11).cast("string")).alias("page"),
        F.element_at(F.array(*map(F.lit, ["purchase", "search", "click"])), (F.col("id") % 3 + 1).cast("int"))
        .alias("event_type"),
        F.when(F.col("id") % 4 == 0, F.col("id") * 0.25).alias("total_amount"),
        F.lit(None).cast("string").alias("search_query"),
        F.lit("tablet").alias("device_type"),
    )
    expected = rows.groupBy("user_id").agg(
        F.count("*").alias("total_events"),
        F.count_if(F.col("event_type") == "purchase").alias("total_purchases"),
        F.avg("total_amount").alias("avg_purchase_amount"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.count_distinct("page").alias("unique_pages_visited"),
    )
    got = features.user_features(rows).select(*expected.columns)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    some = features.user_features(rows, columns=["total_purchases", "avg_purchase_amount"])
    assert some.exceptAll(expected.select(*some.columns)).isEmpty()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.fixed_dictionaries({
            "user_id": st.sampled_from([None, "a", "a", "b"]),
            "session_id": st.sampled_from([None, "s", "t"]),
            "page": st.sampled_from([None, "/home", "/cart", "s"]),
            "event_type": st.sampled_from([None, "purchase", "add_to_cart", "hover"]),
            "device_type": st.sampled_from([None, "desktop", "tv"]),
            "search_query": st.sampled_from([None, "", "x"]),
            "total_amount": st.sampled_from([None, 0.5, 2.0, -1.0]),
        }),
        max_size=25,
    )
)
def test_features_match_brute_force(make_events, rows):
    expected = {}
    for user in {r["user_id"] for r in rows} - {None}:
        mine = [r for r in rows if r["user_id"] == user]
        present = lambda name: [r[name] for r in mine if r[name] is not None]
        amounts = present("total_amount")
        expected[user] = (
            len(mine), len(present("search_query")),
            present("event_type").count("add_to_cart"), present("event_type").count("purchase"),
            sum(amounts) / len(amounts) if amounts else None,
            len(set(present("session_id"))), len(set(present("page"))),
            *[present("device_type").count(device) for device in DEVICES],
        )
    found = features.user_features(make_events(rows)).collect()
    assert {r.user_id: tuple(r)[1:] for r in found} == expected
    assert len(found) == len(expected)


def test_vectors_fill_missing_averages_only_in_the_vector(daily):
    table = features.user_features(daily)
    vectors = segments.prepare_features(table)
    assert vectors.filter("user_id = 'u2'").first().avg_purchase_amount is None
    slots = {r.user_id: tuple(r)[1:] for r in segments.feature_slots(vectors).collect()}
    assert slots["u2"] == (1.0, 1.0, 0.0, 0.0, 0.0, 1.0, 1.0, 0.0, 0.0, 0.0)
    assert slots["u1"][FEATURE_COLUMNS.index("avg_purchase_amount")] == 10.5


def test_empty_input(edge):
    none = edge.filter(F.lit(False))
    table = features.user_features(none)
    assert table.columns == ["user_id", *FEATURE_COLUMNS]
    assert table.count() == 0
    summary = reports.segment_summary(table.withColumn("segment", F.lit(0)))
    assert tuple(reports.kpis(summary, text=True).first()) == (0, None, None, None, None)
    assert temporal.behavior_profile(none).count() == 0


def test_kpi_averages_cover_buyers_only(daily):
    users = features.user_features(daily).withColumn("segment", F.col("total_events").cast("int"))
    summary = reports.segment_summary(users)
    assert reports.segment_sizes(summary).count() == 2
    headline = reports.kpis(summary, text=True).first()
    assert tuple(headline) == (2, 10.5, 50.0, "$10.50", "50.0%")


def test_each_rule(make_events):
    good = {
        "user_id": "u", "session_id": "s", "timestamp": "2025-04-01T00:00:00",
        "event_type": "pageview", "page": "/home", "device_type": "tablet",
    }
    cart = {**good, "event_type": "add_to_cart", "product_id": "p", "quantity": 5}
    buy = {**good, "event_type": "purchase", "order_id": "o", "total_amount": 0.01}
    cases = [
        (good, []),
        ({**good, "event_type": "search", "search_query": ""}, []),
        (cart, []),
        (buy, []),
        ({**good, "user_id": None}, ["user_missing"]),
        ({**good, "session_id": None}, ["session_missing"]),
        ({**good, "timestamp": None}, ["timestamp_missing"]),
        ({**good, "event_type": None}, ["event_type_unknown"]),
        ({**good, "event_type": "hover"}, ["event_type_unknown"]),
        ({**good, "device_type": None}, ["device_unknown"]),
        ({**good, "device_type": "watch"}, ["device_unknown"]),
        ({**good, "event_type": "search"}, ["search_without_query"]),
        ({**cart, "product_id": None}, ["cart_without_product"]),
        ({**cart, "quantity": 0}, ["cart_quantity_out_of_range"]),
        ({**cart, "quantity": 6}, ["cart_quantity_out_of_range"]),
        ({**cart, "quantity": None}, ["cart_quantity_out_of_range"]),
        ({**buy, "order_id": None}, ["purchase_without_order"]),
        ({**buy, "total_amount": 0.0}, ["purchase_amount_not_positive"]),
        ({**buy, "total_amount": None}, ["purchase_amount_not_positive"]),
        ({**buy, "total_amount": float("nan")}, ["amount_not_finite"]),
        ({**buy, "total_amount": float("inf")}, ["amount_not_finite"]),
        ({**buy, "total_amount": float("-inf")}, ["purchase_amount_not_positive", "amount_not_finite"]),
        ({**buy, "timestamp": "2999-01-01T00:00:00"}, ["timestamp_implausible"]),
        ({**buy, "timestamp": "1970-01-01T00:00:00"}, ["timestamp_implausible"]),
        ({}, ["user_missing", "session_missing", "timestamp_missing", "event_type_unknown",
              "device_unknown"]),
    ]
    rows = make_events([{**row, "page": str(i)} for i, (row, _) in enumerate(cases)])
    failed = {int(r.page): r.failed_rules for r in mark_failed_rules(rows).collect()}
    assert failed == {i: names for i, (_, names) in enumerate(cases)}
    valid, rejected = validate_events(rows)
    assert valid.columns == EVENT_COLUMNS
    assert valid.count() == 4 and rejected.count() == len(cases) - 4


def test_unparseable_lines_are_rejected(spark, path):
    valid, rejected = validate_events(read_events(spark, path, keep_corrupt=True).cache())
    assert valid.count() == 2
    reasons = [r.failed_rules for r in rejected.collect()]
    assert sum("unparseable" in names for names in reasons) == 2


def test_failure_rates_cover_unparseable_lines(spark, path):
    rates = quality.dq_failure_rates(read_events(spark, path, keep_corrupt=True).cache())
    without_day = rates.filter("day IS NULL").first()
    assert (without_day.events, without_day.unparseable_rate) == (2, 1.0)
    assert rates.filter("day = DATE '2025-04-01'").first().rejected_rate == 0.5


def test_json_round_trip_keeps_nulls_and_microseconds(spark, edge, tmp_path):
    write_json_events(edge, str(tmp_path / "json"))
    again = read_events(spark, str(tmp_path / "json"))
    # the line of NULLs is written as an empty object
    assert again.exceptAll(edge).isEmpty() and edge.exceptAll(again).isEmpty()


def test_messages_leave_out_absent_fields(daily):
    message = encode_events(daily.filter("event_type = 'add_to_cart'")).first().value
    assert json.loads(bytes(message)) == {
        "user_id": "u1", "session_id": "s1", "timestamp": "2025-04-01T10:11:12.123456",
        "event_type": "add_to_cart", "page": "/cart", "device_type": "mobile",
        "product_id": "p1", "quantity": 2,
    }


def test_broken_messages_keep_their_text(spark):
    raw = spark.createDataFrame([(b"not json",), (b'{"user_id":"u","quantity":"abc"}',)], "value binary")
    rows = decode_events(raw).collect()
    assert [r.user_id for r in rows] == [None, "u"]
    assert [r._corrupt_record for r in rows] == ["not json", '{"user_id":"u","quantity":"abc"}']

"""A/B tests, recommendations and data-quality series against brute force."""

from collections import Counter
from datetime import datetime, timedelta
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from footfall.operators import experiments, quality, recommend
from footfall.schema import EVENT_TYPES


def test_ab_test_by_hand(spark):
    rows = [(f"u{i}", "A", int(i < 20)) for i in range(100)]
    rows += [(f"v{i}", "B", int(i < 60)) for i in range(200)]
    users = spark.createDataFrame(rows, "user_id string, variant string, total_purchases long")
    row = experiments.ab_test(users).first()
    assert (row.users_a, row.converters_a, row.users_b, row.converters_b) == (100, 20, 200, 60)
    assert row.lift == pytest.approx(0.5)
    pooled = 80 / 300
    z = 0.1 / (pooled * (1 - pooled) * (1 / 100 + 1 / 200)) ** 0.5
    assert row.z_score == pytest.approx(z)


@pytest.mark.parametrize("rows", [[], [("u", "A", 0)], [("u", "A", 1), ("v", "B", 1)]])
def test_ab_test_undefined_ratios_are_null(spark, rows):
    users = spark.createDataFrame(rows, "user_id string, variant string, total_purchases long")
    assert experiments.ab_test(users).first().z_score is None


def test_variants_are_stable_and_even(spark):
    users = spark.range(10000).select(F.concat(F.lit("user_"), "id").alias("user_id"))
    split = experiments.assign_variant(users, "checkout")
    sizes = {r.variant: r["count"] for r in split.groupBy("variant").count().collect()}
    assert sum(sizes.values()) == 10000 and all(4700 < n < 5300 for n in sizes.values())
    assert split.exceptAll(experiments.assign_variant(users.repartition(5), "checkout")).isEmpty()
    other = experiments.assign_variant(users, "search").withColumnRenamed("variant", "o")
    differ = split.join(other, "user_id").filter("variant <> o").count()
    assert 4500 < differ < 5500


def brute_recommendations(touches, placed, n):
    counts = Counter()
    for user, item in touches:
        counts[(placed[user], item)] += 1
    result = set()
    for user, segment in placed.items():
        ranked = sorted((-c, item) for (s, item), c in counts.items() if s == segment)[:n]
        for rank, (negative, item) in enumerate(ranked, 1):
            if (user, item) not in touches:
                result.add((user, segment, item, rank, -negative))
    return result


def test_recommendations_match_brute_force(spark, make_events, events):
    touches = [
        (r.user_id, r.product_id) for r in events.filter("product_id IS NOT NULL").collect()
    ]
    users = sorted({r.user_id for r in events.select("user_id").distinct().collect()})
    placed = {user: len(user) % 2 for user in users}
    assigned = spark.createDataFrame(list(placed.items()), "user_id string, segment int")
    got = recommend.recommend(events, assigned, 4, "product_id")
    assert got.columns == ["user_id", "segment", "product_id", "segment_rank", "segment_events"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == brute_recommendations(touches, placed, 4)


def test_users_who_saw_everything_and_users_without_events(spark, make_events):
    events = make_events([
        {"user_id": "a", "page": "/home"}, {"user_id": "a", "page": "/cart"},
        {"user_id": "b", "page": "/home"}, {"user_id": "b"}, {"page": "/cart"},
    ])
    assigned = spark.createDataFrame([("a", 0), ("b", 0), ("quiet", 0)], "user_id string, segment int")
    rows = {tuple(r) for r in recommend.recommend(events, assigned, 5).collect()}
    assert rows == {
        ("b", 0, "/cart", 2, 1), ("quiet", 0, "/home", 1, 2), ("quiet", 0, "/cart", 2, 1),
    }


def test_zscore_counts_silent_days_as_zero(make_events):
    start = datetime(2025, 4, 1)
    per_day = [5, 3, 0, 4, 6, 5, 4, 9, 0, 7]  # clicks; days 3 and 9 have no event at all
    rows = [
        {"user_id": "u", "event_type": "click", "timestamp": start + timedelta(days=day, seconds=i)}
        for day, n in enumerate(per_day) for i in range(n)
    ]
    rows += [{"user_id": "u", "event_type": t, "timestamp": start} for t in ("hover", None)]
    rows += [{"user_id": "u", "event_type": "click"}]
    series = quality.dq_zscore(make_events(rows)).orderBy("event_type", "day").collect()
    assert {r.event_type for r in series} == {*EVENT_TYPES, "other"}
    clicks = [r for r in series if r.event_type == "click"]
    assert [r.events for r in clicks] == per_day
    assert [r.z_score for r in clicks[:7]] == [None] * 7
    for day in range(7, 10):
        before = per_day[day - 7: day]
        assert clicks[day].z_score == pytest.approx((per_day[day] - mean(before)) / stdev(before))
    assert [r.events for r in series if r.event_type == "other"] == [2] + [0] * 9
    assert all(r.z_score is None for r in series if r.event_type == "search")


def test_one_bad_date_makes_no_long_series(make_events):
    rows = [{"user_id": "u", "event_type": "click", "timestamp": t} for t in (
        "2024-01-01T00:00:00", "2024-01-03T00:00:00", "9998-01-01T00:00:00", "1970-01-01T00:00:00",
    )]
    series = quality.daily_counts(make_events(rows)).collect()
    assert len(series) == 3 * 6 + 1
    assert sum(r.events for r in series) == 4
    assert [(r.event_type, r.events) for r in series if r.day is None] == [("click", 2)]
    scored = quality.dq_zscore(make_events(rows), first="2024-01-02", last="2024-01-12").collect()
    assert len(scored) == 11 * 6 + 1 and sum(r.events for r in scored) == 4
    assert [r.events for r in scored if r.day is None] == [3]


def test_failure_and_null_rates(make_events):
    good = {
        "user_id": "u", "session_id": "s", "timestamp": "2025-04-01T00:00:00",
        "event_type": "pageview", "page": "/home", "device_type": "tablet",
    }
    no_device = {**good, "device_type": None}
    bad_search = {**good, "event_type": "search", "device_type": "tv"}
    rows = make_events([good, good, no_device, bad_search])
    rates = quality.dq_failure_rates(rows).first()
    assert (rates.events, rates.rejected_rate) == (4, 0.5)
    assert (rates.device_unknown_rate, rates.search_without_query_rate) == (0.5, 0.25)
    nulls = quality.dq_null_rates(rows, ["device_type", "page"]).first()
    assert (nulls.device_type_null_rate, nulls.page_null_rate) == (0.25, 0.0)

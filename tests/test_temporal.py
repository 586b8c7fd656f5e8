from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.operators import temporal

GAP = 60
EPOCH = datetime(1970, 1, 1)


def at(micros):
    return EPOCH + timedelta(microseconds=micros)


def brute_sessions(micros, gap):
    """(first, last, events) of each run of times with no pause above the gap."""
    sessions = []
    for t in sorted(micros):
        if sessions and t - sessions[-1][1] <= gap:
            first, _, n = sessions[-1]
            sessions[-1] = (first, t, n + 1)
        else:
            sessions.append((t, t, 1))
    return sessions


def sessions_of(frame):
    rows = frame.select(
        "user_id", "session_number",
        F.unix_micros("session_start").alias("a"), F.unix_micros("session_end").alias("b"), "events",
    ).collect()
    found = {}
    for r in sorted(rows):
        found.setdefault(r.user_id, []).append((r.a, r.b, r.events))
        assert r.session_number == len(found[r.user_id])
    return found


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    # around the epoch, so that slots below zero are covered; whole and odd multiples of the gap
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b"]),
            st.one_of(
                st.integers(-5 * GAP * 10**6, 5 * GAP * 10**6),
                st.integers(-5, 5).map(lambda n: n * GAP * 10**6),
            ),
        ),
        min_size=1, max_size=40,
    )
)
def test_sessionize_matches_brute_force(make_events, rows):
    frame = make_events([{"user_id": u, "timestamp": at(t)} for u, t in rows])
    expected = {
        user: brute_sessions([t for u, t in rows if u == user], GAP * 10**6)
        for user in {u for u, _ in rows}
    }
    assert sessions_of(temporal.sessionize(frame, GAP)) == expected


def test_pause_equal_to_the_gap_stays(make_events):
    rows = [{"user_id": "u", "timestamp": at(t)} for t in (0, GAP * 10**6, 2 * GAP * 10**6 + 1)]
    assert sessions_of(temporal.sessionize(make_events(rows), GAP)) == {
        "u": [(0, GAP * 10**6, 2), (2 * GAP * 10**6 + 1, 2 * GAP * 10**6 + 1, 1)]
    }


def test_sessionize_agrees_with_session_window(events):
    gap = 4 * 3600
    built_in = events.groupBy("user_id", F.session_window("timestamp", f"{gap} seconds")).agg(
        F.min("timestamp").alias("session_start"), F.max("timestamp").alias("session_end"),
        F.count("*").alias("events"),
    ).drop("session_window")
    ours = temporal.sessionize(events, gap).select(*built_in.columns)
    assert ours.count() == 6940
    assert ours.exceptAll(built_in).isEmpty()


def test_sessionize_drops_nothing_else(make_events):
    frame = make_events([
        {"user_id": "u", "timestamp": at(0)}, {"user_id": "u"}, {"timestamp": at(0)},
    ])
    assert sessions_of(temporal.sessionize(frame, GAP)) == {"u": [(0, 0, 1)]}
    with pytest.raises(ValueError):
        temporal.sessionize(frame, 0)


def test_time_of_day_parts(make_events):
    frame = make_events([
        {"user_id": "u", "timestamp": datetime(2025, 4, 1, hour, 59, 59)} for hour in range(24)
    ])
    assert tuple(temporal.time_of_day(frame).first()) == ("u", 6, 6, 6, 6)


def test_session_ids_are_per_user(make_events):
    frame = make_events([
        {"user_id": "a", "session_id": "s", "timestamp": at(0)},
        {"user_id": "a", "session_id": "s", "timestamp": at(2_500_000)},
        {"user_id": "b", "session_id": "s", "timestamp": at(9_000_000)},
        {"user_id": "b", "timestamp": at(99_000_000)},
    ])
    rows = sorted(tuple(r) for r in temporal.session_duration(frame).collect())
    assert rows == [("a", 1, 2.5, 2.5), ("b", 1, 0.0, 0.0)]


def test_frequency(make_events):
    day = 86_400_000_000
    frame = make_events([
        {"user_id": "a", "timestamp": at(t)} for t in (0, 1_000_000, day)
    ] + [{"user_id": "b", "timestamp": at(0)}])
    rows = sorted(tuple(r) for r in temporal.interaction_frequency(frame).collect())
    assert rows == [("a", 1.5, 43200.0), ("b", 1.0, None)]


def test_behavior_profile_without_sessions_or_times(make_events):
    frame = make_events([{"user_id": "u", "page": "/home", "event_type": "pageview"}])
    row = temporal.behavior_profile(frame).first()
    assert (row.total_events, row.total_sessions, row.pageviews) == (1, 0, 1)
    assert (row.mean_duration_s, row.max_duration_s) == (None, None)
    assert (row.events_per_active_day, row.mean_gap_s) == (None, None)


def test_behavior_profile_equals_its_parts(events):
    whole = temporal.behavior_profile(events)
    for part in (temporal.time_of_day, temporal.pages_viewed, temporal.interaction_frequency):
        single = part(events)
        assert whole.select(*single.columns).exceptAll(single).isEmpty()

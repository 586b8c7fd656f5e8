"""Daily runs give what one run over all days gives: sessions, distinct counts, late events."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from footfall.functions.time_range import filter_range
from footfall.operators import features, temporal
from footfall.plans import cli, runs
from footfall.sources import folders
from footfall.sources.events import stream_events, write_json_events
from footfall.sources.tables import read_landed
from footfall.streaming.landing import land_events
from tests.test_streaming import event, rounded, same

GAP = 4 * 3600
DAYS = ["2024-01-10", "2024-01-11", "2024-01-12"]
DAY = datetime(2025, 4, 1)


def at(hours, minutes=0):
    return DAY + timedelta(hours=hours, minutes=minutes)


def test_sessions_go_on_over_midnight(spark, make_events, tmp_path):
    path = str(tmp_path / "s")
    rows = [
        event("a", at(23, 50)), event("a", at(24, 10)),  # one session
        event("b", at(23, 30)), event("b", at(24, 0)),  # a pause equal to the gap stays in the session
        event("c", at(23, 29)), event("c", at(24, 0)),  # a longer one does not
        event("d", at(10)), event("d", at(72, 5)),
        event("e", at(23, 45)), event("e", at(24, 5)), event("e", at(47, 40)), event("e", at(48, 1)),
        event(None, at(1)), event("f", None),
    ]
    events = make_events(rows)
    for n in range(4):
        runs.sessions_run(spark, events, path, str((DAY + timedelta(days=n)).date()), 1800)
        seen = filter_range(events, "2025-04-01", str((DAY + timedelta(days=n)).date()))
        expected = temporal.sessionize(seen, 1800)
        assert same(expected, runs.read_sessions(spark, path, str((DAY + timedelta(days=n)).date())))
    # what is carried over is one row per session that may go on
    first = spark.read.parquet(f"{path}/open/run_date=2025-04-01")
    assert sorted(r.user_id for r in first.collect()) == ["a", "b", "e"]


def test_a_gap_of_days_carries_sessions_over_days(spark, make_events, tmp_path):
    path, gap = str(tmp_path / "s"), 3 * 86400
    events = make_events([event("a", at(1)), event("a", at(60)), event("b", at(2)), event("b", at(80))])
    for n in range(5):
        runs.sessions_run(spark, events, path, str((DAY + timedelta(days=n)).date()), gap)
    assert same(temporal.sessionize(events, gap), runs.read_sessions(spark, path, "2025-04-05"))


def test_runs_can_be_repeated_and_must_follow_each_other(spark, events, tmp_path):
    path = str(tmp_path / "s")
    runs.sessions_run(spark, events, path, DAYS[0], GAP)
    with pytest.raises(ValueError, match="2024-01-11"):
        runs.sessions_run(spark, events, path, DAYS[2], GAP)
    for day in [DAYS[1], DAYS[1], DAYS[0], DAYS[1], DAYS[2]]:
        runs.sessions_run(spark, events, path, day, GAP)
    expected = temporal.sessionize(filter_range(events, DAYS[0], DAYS[2]), GAP)
    assert same(expected, runs.read_sessions(spark, path, DAYS[2]))
    declared = temporal.session_summary(filter_range(events, DAYS[0], DAYS[2]))
    assert same(declared, runs.read_declared_sessions(spark, path, DAYS[0], DAYS[2]))
    one_day = temporal.session_summary(filter_range(events, DAYS[1], DAYS[1]))
    assert same(one_day, runs.read_declared_sessions(spark, path, DAYS[1], DAYS[1]))


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1], [1, 1, 0, 2, 1]])
def test_bitmaps_of_days_count_any_range(spark, events, tmp_path, order):
    path = str(tmp_path / "d")
    for n in order:
        runs.distincts_run(spark, events, path, DAYS[n])
    for first, last in [(0, 2), (1, 2), (0, 0)]:
        expected = features.user_distincts(filter_range(events, DAYS[first], DAYS[last]))
        assert same(expected, runs.read_distincts(spark, path, DAYS[first], DAYS[last]))
    numbers = spark.read.parquet(f"{path}/numbers")
    assert numbers.count() == numbers.select("kind", "scope", "lane", "number").distinct().count()
    longest = spark.read.parquet(f"{path}/bitmaps").agg(F.max(F.length("bitmap"))).first()[0]
    assert longest < 64  # of up to 4,096 bytes


def test_bitmaps_of_many_keys_and_none(spark, make_events, tmp_path):
    path = str(tmp_path / "d")
    rows = [event("u", at(0, i % 1400), page=f"/p{i}", session_id=f"s{i % 700}") for i in range(3000)]
    rows += [event("u", at(24, i % 1400), page=f"/p{i}", session_id=f"s{i}") for i in range(2500, 4000)]
    rows += [event("none", at(1), page=None, session_id=None), event("v", at(1), page="/p1", session_id=None)]
    events = make_events(rows)
    for day in ("2025-04-01", "2025-04-02", "2025-04-03"):  # the last has no events
        runs.distincts_run(spark, events, path, day)
    found = runs.read_distincts(spark, path, "2025-04-01", "2025-04-03")
    assert same(features.user_distincts(events), found)
    assert {r.user_id: (r.total_sessions, r.unique_pages_visited) for r in found.collect()} == {
        "u": (2200, 4000), "none": (0, 0), "v": (0, 1)
    }
    assert runs.read_distincts(spark, str(tmp_path / "nothing"), "2025-04-01", "2025-04-02").collect() == []


def test_more_keys_than_a_bucket_has_bits(spark, make_events, tmp_path):
    path = str(tmp_path / "d")
    one = make_events([event("u", at(1))])
    many = one.drop("page").crossJoin(spark.range(40_000).selectExpr("concat('/', id) AS page")).select(*one.columns)
    runs.distincts_run(spark, many, path, "2025-04-01")
    assert spark.read.parquet(f"{path}/bitmaps").filter("kind = 1").count() >= 2
    found = runs.read_distincts(spark, path, "2025-04-01", "2025-04-01").collect()
    assert [(r.total_sessions, r.unique_pages_visited) for r in found] == [(1, 40_000)]


def land(spark, make_events, folder, name, rows):
    write_json_events(make_events(rows), f"{folder}/in/{name}")
    stream = stream_events(spark, f"{folder}/in/*")
    land_events(stream, f"{folder}/landed", f"{folder}/checkpoint").awaitTermination()


def by_day(spark, folder):
    landed = read_landed(spark, f"{folder}/landed", "parsed").filter("event_date IS NOT NULL")
    expected = features.user_features(landed, ["event_date", "user_id"]).withColumnRenamed("event_date", "run_date")
    return rounded(expected), rounded(spark.read.parquet(f"{folder}/features"))


def files_of(folder, day):
    return sorted(n for n in os.listdir(f"{folder}/features/run_date={day}") if n.endswith(".parquet"))


def test_late_events_refresh_their_days_only(spark, make_events, tmp_path):
    folder = str(tmp_path)
    land(spark, make_events, folder, "a", [
        event("a", at(1)), event("b", at(2), total_amount=5.0), event("a", at(25)), event("c", at(49)),
    ])
    runs.transform_days(spark, f"{folder}/landed", f"{folder}/features", "2025-04-01", "2025-04-03")
    assert same(*by_day(spark, folder))
    before = {day: files_of(folder, day) for day in ("2025-04-01", "2025-04-02", "2025-04-03")}
    assert runs.refresh_days(spark, f"{folder}/landed", f"{folder}/features") == []

    land(spark, make_events, folder, "b", [
        event("a", at(3), page="/cart"), event("new", at(4)), event("c", at(50)), event(None, at(26)),
        event("x", None),
    ])
    assert runs.refresh_days(spark, f"{folder}/landed", f"{folder}/features") == [
        "2025-04-01", "2025-04-02", "2025-04-03"
    ]
    assert same(*by_day(spark, folder))
    land(spark, make_events, folder, "c", [event("a", at(27))])
    before = {day: files_of(folder, day) for day in before}
    assert runs.refresh_days(spark, f"{folder}/landed", f"{folder}/features") == ["2025-04-02"]
    assert same(*by_day(spark, folder))
    after = {day: files_of(folder, day) for day in before}
    assert [after[day] == before[day] for day in sorted(before)] == [True, False, True]
    assert runs.refresh_days(spark, f"{folder}/landed", f"{folder}/features") == []


def test_a_refresh_that_failed_half_way_runs_again(spark, make_events, tmp_path, monkeypatch):
    folder = str(tmp_path)
    land(spark, make_events, folder, "a", [event("a", at(1)), event("b", at(2))])
    assert runs.refresh_days(spark, f"{folder}/landed", f"{folder}/features") == []  # nothing written yet
    runs.transform_days(spark, f"{folder}/landed", f"{folder}/features", "2025-04-01", "2025-04-01")
    land(spark, make_events, folder, "b", [event("a", at(3)), event("z", at(30))])
    replace, calls = runs.replace_days, []

    def broken(rows, path):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        replace(rows, path)

    monkeypatch.setattr(runs, "replace_days", broken)
    with pytest.raises(RuntimeError):
        runs.refresh_days(spark, f"{folder}/landed", f"{folder}/features")
    monkeypatch.setattr(runs, "replace_days", replace)
    assert runs.refresh_days(spark, f"{folder}/landed", f"{folder}/features") == ["2025-04-01"]
    found = {r.user_id: r.total_events for r in spark.read.parquet(f"{folder}/features").collect()}
    assert found == {"a": 2, "b": 1}  # the second day was never transformed


def test_commands(spark, make_events, tmp_path, monkeypatch, capsys):
    folder = str(tmp_path)
    monkeypatch.setattr(cli, "build_session", lambda app: spark)
    land(spark, make_events, folder, "a", [event("a", at(1)), event("a", at(1, 10))])
    for command in ("sessions", "distincts"):
        cli.main([command, "--landed", "--input-path", f"{folder}/landed", "--output-path", f"{folder}/{command}", "--run-date", "2025-04-01"])
    assert runs.read_sessions(spark, f"{folder}/sessions", "2025-04-01").collect()[0].events == 2
    assert runs.read_distincts(spark, f"{folder}/distincts", "2025-04-01", "2025-04-01").count() == 1
    paths = ["--input-path", f"{folder}/landed", "--output-path", f"{folder}/features"]
    cli.main(["days", *paths, "--start-date", "2025-04-01", "--end-date", "2025-04-01"])
    land(spark, make_events, folder, "b", [event("b", at(2))])
    cli.main(["refresh", *paths])
    assert "Refreshed: 2025-04-01" in capsys.readouterr().out
    assert spark.read.parquet(f"{folder}/features").count() == 2
    assert folders.exists(spark, f"{folder}/features/_inputs")

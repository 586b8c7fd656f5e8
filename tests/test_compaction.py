"""Copies of closed days beside the stream and readers."""

import os
import shutil
from datetime import datetime, timedelta

import pytest

from footfall.plans import cli
from footfall.sources import folders
from footfall.sources.events import stream_events, write_json_events
from footfall.sources.tables import read_landed
from footfall.streaming import compaction
from footfall.streaming.landing import land_events
from tests.test_streaming import event, same

DAY = datetime(2025, 4, 1)


def at(hours):
    return DAY + timedelta(hours=hours)


def land(spark, make_events, folder, name, rows):
    write_json_events(make_events(rows).repartition(2), f"{folder}/in/{name}")
    stream = stream_events(spark, f"{folder}/in/*")
    land_events(stream, f"{folder}/landed", f"{folder}/checkpoint").awaitTermination()


def check(spark, folder):
    for verdict in (None, "valid", "rejected", "parsed"):
        expected = read_landed(spark, f"{folder}/landed", verdict)
        found = compaction.read_compacted(spark, f"{folder}/landed", f"{folder}/copy", verdict)
        assert sorted(found.columns) == sorted(expected.columns)
        assert same(expected, found)


@pytest.fixture
def folder(spark, make_events, tmp_path):
    for n in range(3):
        land(spark, make_events, tmp_path, f"n{n}", [
            event("a", at(n)), event("b", at(24 + n)), event("c", at(48 + n)), event(None, at(n)), event("odd", None),
        ])
    return str(tmp_path)


def files_read(spark, folder):
    return compaction.read_compacted(spark, f"{folder}/landed", f"{folder}/copy", None).inputFiles()


def test_closed_days_are_copied_and_late_files_added(spark, make_events, folder):
    before = len(files_read(spark, folder))
    days = lambda through, **how: compaction.compact_days(spark, f"{folder}/landed", f"{folder}/copy", through, **how)
    check(spark, folder)
    assert days("2025-04-02") == ["2025-04-01", "2025-04-02"]
    check(spark, folder)
    rows = [n for _, _, names in os.walk(f"{folder}/copy/rows") for n in names if n.endswith(".parquet")]
    assert len(rows) <= 4 < before  # one per day and verdict
    assert days("2025-04-02") == []
    land(spark, make_events, folder, "late", [event("late", at(5)), event("new", at(49))])
    check(spark, folder)
    assert days("2025-04-02") == ["2025-04-01"]
    check(spark, folder)
    assert days("2025-04-03", least_files=100) == []
    assert days("2025-04-03") == ["2025-04-03"]
    check(spark, folder)
    # a version that was replaced goes with the next copy of its day
    for name in ("x", "y"):
        land(spark, make_events, folder, name, [event("late", at(6))])
        days("2025-04-02")
        check(spark, folder)
    assert folders.values(spark, f"{folder}/copy/rows/event_date=2025-04-01", "version") == ["3", "4"]


def test_copied_files_are_not_opened(spark, folder):
    compaction.compact_days(spark, f"{folder}/landed", f"{folder}/copy", "2025-04-03")
    expected = sorted(map(tuple, read_landed(spark, f"{folder}/landed", "valid").collect()), key=repr)
    for day in ("2025-04-01", "2025-04-02", "2025-04-03"):
        shutil.rmtree(f"{folder}/landed/verdict=valid/event_date={day}")
    found = compaction.read_compacted(spark, f"{folder}/landed", f"{folder}/copy", "valid")
    assert sorted(map(tuple, found.select(read_landed(spark, f"{folder}/landed").columns).collect()), key=repr) == expected


def test_a_copy_without_its_manifest_does_not_count(spark, make_events, folder):
    compaction.compact_days(spark, f"{folder}/landed", f"{folder}/copy", "2025-04-01")
    land(spark, make_events, folder, "late", [event("late", at(5))])
    rows = f"{folder}/copy/rows/event_date=2025-04-01"
    shutil.copytree(f"{rows}/version=1", f"{rows}/version=2")  # rows of a run that was lost before its manifest
    check(spark, folder)
    assert compaction.compact_days(spark, f"{folder}/landed", f"{folder}/copy", "2025-04-01") == ["2025-04-01"]
    check(spark, folder)


def test_beside_a_running_stream(spark, make_events, tmp_path):
    """Copies and reads between the batches of a stream that keeps running."""
    folder = str(tmp_path)
    write_json_events(make_events([event("a", at(0)), event("a", at(1))]).repartition(2), f"{folder}/in/0")
    stream = stream_events(spark, f"{folder}/in/*")
    query = land_events(stream, f"{folder}/landed", f"{folder}/checkpoint", {"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
        for n in range(1, 4):
            compaction.compact_days(spark, f"{folder}/landed", f"{folder}/copy", "2025-04-01", least_files=1)
            check(spark, folder)
            write_json_events(make_events([event("a", at(n)), event("b", at(24 + n))]), f"{folder}/in/{n}")
            query.processAllAvailable()
            check(spark, folder)
    finally:
        query.stop()
    assert read_landed(spark, f"{folder}/landed").count() == 8


def test_command(spark, folder, monkeypatch, capsys):
    monkeypatch.setattr(cli, "build_session", lambda app: spark)
    cli.main(["compact", "--input-path", f"{folder}/landed", "--output-path", f"{folder}/copy", "--through", "2025-04-01"])
    assert capsys.readouterr().out.strip().endswith("Copied: 2025-04-01")
    check(spark, folder)

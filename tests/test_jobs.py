import pytest
from pyspark.sql import functions as F

from footfall.operators import features, temporal
from footfall.plans import cli, jobs
from footfall.schema import EVENT_COLUMNS, FEATURE_COLUMNS
from footfall.session import work_dir
from footfall.sources import events as event_sources
from footfall.sources import tables

DAY = "2024-01-10"


@pytest.fixture(scope="module")
def raw(spark, events, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    event_sources.write_json_events(events, folder)
    return folder


def test_events_to_segments_to_report(spark, raw, tmp_path, capsys):
    table, placed = f"{tmp_path}/features", f"{tmp_path}/segments"
    cli.main(["transform", "--input-path", raw, "--output-path", table,
              "--start-date", DAY, "--end-date", DAY])
    stored = tables.read_features(spark, table)
    assert stored.columns == ["user_id", *FEATURE_COLUMNS]
    assert stored.count() == 133
    assert stored.filter("avg_purchase_amount IS NULL").count() == 82

    cli.main(["segment", "--features-path", table, "--output-path", placed, "--num-clusters", "3",
              "--partitions", "4"])
    assigned = tables.read_segments(spark, placed)
    assert assigned.columns == ["user_id", "segment"]
    assert assigned.count() == 133
    assert "Silhouette: 0." in capsys.readouterr().out

    report = jobs.segment_report(spark, table, placed, [0, 2])
    chosen = assigned.filter("segment <> 1").count()
    headline = report["kpis"].first()
    assert headline.total_users == chosen
    assert headline.conversion_rate_text.endswith("%")
    assert sum(r["count"] for r in report["segment_counts"].collect()) == chosen
    assert report["segment_radar"].count() == 2 * 5
    assert report["segment_devices"].count() == 2 * 3
    assert [r.segment for r in report["segment_details"].collect()] == [0, 2]
    cli.main(["report", "--features-path", table, "--segments-path", placed])
    assert "segment_radar" in capsys.readouterr().out


def test_literal_closed_range_is_an_option(spark, raw, tmp_path):
    jobs.transform_events(spark, raw, f"{tmp_path}/f", DAY, DAY, closed="both")
    assert tables.read_features(spark, f"{tmp_path}/f").count() == 0


def test_landed_input_counts_valid_events_only(spark, raw, events, tmp_path):
    cli.main(["land", "--input-path", raw, "--output-path", f"{tmp_path}/landed",
              "--checkpoint", f"{tmp_path}/checkpoint"])
    for source, which, expected in (
        (["--input-path", f"{tmp_path}/landed", "--landed"], "valid", 312),
        (["--input-path", f"{tmp_path}/landed", "--landed"], "parsed", 330),
        (["--input-path", raw], "valid", 312),
        (["--input-path", raw], "parsed", 330),
    ):
        cli.main(["transform", *source, "--temporal", "--events", which,
                  "--output-path", f"{tmp_path}/f", "--start-date", DAY, "--end-date", DAY])
        stored = tables.read_features(spark, f"{tmp_path}/f")
        assert stored.agg(F.sum("total_events")).first()[0] == expected
        assert stored.columns == temporal.behavior_profile(events).columns


def test_reports_are_whole(spark, events, tmp_path, capsys):
    table, placed, out = (f"{tmp_path}/{name}" for name in ("features", "segments", "report"))
    tables.write_features(features.user_features(events), table)
    cli.main(["segment", "--features-path", table, "--output-path", placed, "--report-path", f"{out}/fit"])
    cli.main(["report", "--features-path", table, "--segments-path", placed, "--output-path", out])
    assert "only showing" not in capsys.readouterr().out
    rows = {name: spark.read.parquet(f"{out}/{name}").count() for name in (
        "fit/centers", "fit/sizes", "fit/profile", "kpis", "segment_counts", "segment_radar", "segment_devices",
        "segment_details",
    )}
    assert rows == {
        "fit/centers": 50, "fit/sizes": 5, "fit/profile": 5, "kpis": 1, "segment_counts": 5, "segment_radar": 25,
        "segment_devices": 15, "segment_details": 5,
    }


def test_scaled_centres_are_in_the_features_units(spark, events, tmp_path):
    tables.write_features(features.user_features(events), f"{tmp_path}/f")
    result = jobs.segment_users(spark, f"{tmp_path}/f", f"{tmp_path}/s", 3, scale=True)
    total = [r.value for r in result.centers.collect() if r.feature == "total_events"]
    means = [r.total_events for r in result.profile.collect()]
    assert total == pytest.approx(means, rel=0.05) and min(total) > 40


def test_a_run_without_rows_leaves_no_old_rows(spark, events, tmp_path):
    path, table = f"{tmp_path}/history", features.user_features(events).cache()
    for run_date, users in (("2024-01-01", 5), ("2024-01-02", 7), ("2024-01-01", 0)):
        tables.write_features(table.limit(users), path, run_date)
    assert tables.read_features(spark, path, "2024-01-01").count() == 0
    assert tables.read_features(spark, path).count() == 7
    with pytest.raises(ValueError):
        tables.write_features(table, path, "01.02.2024")


def test_published_lines_lose_no_text(spark, tmp_path):
    lines = ['{"user_id":"u1","timestamp":"bad"}', "not json", '{"user_id":"ü"}']
    (tmp_path / "part.json").write_text("\n".join([*lines, "", " "]) + "\n")
    messages = event_sources.event_lines(spark, str(tmp_path))
    assert sorted(bytes(r.value).decode() for r in messages.collect()) == sorted(lines)
    assert event_sources.decode_events(messages).filter("_corrupt_record IS NOT NULL").count() == 2


def test_a_new_checkpoint_reads_a_topic_from_its_start():
    assert event_sources.kafka_options("s:1", "t") == {
        "kafka.bootstrap.servers": "s:1", "subscribe": "t", "startingOffsets": "earliest",
    }
    args = cli.parse(["land", "--output-path", "o", "--checkpoint", "c", "--bootstrap-servers", "b", "--topic", "t",
                      "--starting-offsets", "latest", "--max-offsets-per-trigger", "9"])
    options = event_sources.kafka_options("b", "t", args.starting_offsets, args.max_offsets_per_trigger)
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "9"


def test_runs_replace_their_own_date_only(spark, events, tmp_path):
    path = f"{tmp_path}/history"
    table = features.user_features(events).cache()
    for run_date, users in (("2024-01-01", 5), ("2024-01-02", 7), ("2024-01-01", 3)):
        tables.write_features(table.limit(users), path, run_date)
    assert tables.read_features(spark, path).count() == 10
    one = tables.read_features(spark, path, "2024-01-01")
    assert one.count() == 3 and one.columns == table.columns
    tables.write_features(table.limit(2), path)
    assert tables.read_features(spark, path).count() == 2


def test_programs_over_one_of_several_runs(spark, raw, tmp_path):
    table, placed = f"{tmp_path}/features", f"{tmp_path}/segments"
    for day in ("2024-01-10", "2024-01-11"):
        jobs.transform_events(spark, raw, table, day, day, run_date=day)
    with pytest.raises(ValueError, match="run_date"):
        jobs.segment_users(spark, table, placed, 3)
    result = jobs.segment_users(spark, table, placed, 3, partitions=4, scale=True, run_date=DAY)
    assert sum(r["count"] for r in result.sizes.collect()) == 133
    assert result.profile.columns == ["segment", *FEATURE_COLUMNS]
    with pytest.raises(ValueError, match="run_date"):
        jobs.segment_report(spark, table, placed)
    report = jobs.segment_report(spark, table, placed, run_date=DAY)
    assert report["kpis"].first().total_users == 133


def test_segment_tables_keep_two_columns(spark, events, tmp_path):
    path = f"{tmp_path}/segments"
    table = features.user_features(events).withColumn("segment", F.lit(1))
    tables.write_segments(table, path, "2024-01-02")
    assert tables.read_segments(spark, path, "2024-01-02").columns == ["user_id", "segment"]
    assert tables.read_segments(spark, path).columns == ["user_id", "segment", "run_date"]


def test_views_take_frames_and_paths(spark, events, tmp_path):
    events.limit(3).write.parquet(f"{tmp_path}/t")
    tables.register_views(spark, {"stored_events": f"{tmp_path}/t", "all_events": events})
    assert spark.sql("SELECT count(*) FROM stored_events").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM all_events").first()[0] == 10000


def test_published_messages_hold_every_event(events):
    messages = event_sources.encode_events(events)
    assert messages.dtypes == [("value", "binary")]
    again = event_sources.decode_events(messages).select(*EVENT_COLUMNS)
    assert again.exceptAll(events.select(*EVENT_COLUMNS)).isEmpty()


def test_kafka_needs_its_connector(spark, events):
    """The connector is not on this classpath; on a cluster it comes with --packages."""
    with pytest.raises(Exception, match="[Kk]afka"):
        event_sources.kafka_events(spark, "localhost:9092", "events")


def test_live_command_writes_closed_days_and_sessions(spark, raw, tmp_path):
    cli.main(["live", "--input-path", raw, "--output-path", f"{tmp_path}/live",
              "--checkpoint", f"{tmp_path}/checkpoint", "--gap-seconds", "14400"])
    assert spark.read.parquet(f"{tmp_path}/live/daily").count() == 3873
    assert spark.read.parquet(f"{tmp_path}/live/sessions").count() == 6883


def test_land_arguments():
    with pytest.raises(SystemExit):
        cli.parse(["land", "--output-path", "o", "--checkpoint", "c", "--bootstrap-servers", "b"])
    args = cli.parse(["segment", "--features-path", "f", "--output-path", "o"])
    assert args.num_clusters == 5


def test_work_folder_is_below_the_shared_checkpoint_folder(spark, monkeypatch):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = work_dir(spark, "x")
    assert folder != work_dir(spark, "x")
    if shared:
        assert folder.startswith(shared)

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "yarn"}.get(key, default))

    class SmallCluster(Cluster):
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "local-cluster[3,2,900]"}.get(key, default))

    for session in (Cluster, SmallCluster):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_dir(session, "x")

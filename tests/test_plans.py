"""Physical plans stay the ones that scale."""

import re

import pytest

from footfall.adapter import web_events
from footfall.functions.time_range import filter_range
from footfall.operators import features, recommend, reports, segments, temporal
from footfall.plans.queries import CENTROID_COLUMNS, QUERIES, profile
from footfall.schema import FEATURE_COLUMNS
from footfall.sources.tables import read_landed, save_bucketed
from footfall.streaming.landing import with_landing_columns
from tests.conftest import SF_DIR

TRAINED = {"kmeans_segments", "kmeans_invariants", "kmeans_mass", "cluster_centers", "silhouette"}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def scanned(spark):
    return web_events(spark, SF_DIR)


# Queries that end in, or ask for, one row over everything.
ONE_ROW = {"kpis", "kpis_day", "report_job", "ab_test", "ab_test_days", "kmeans_layouts", "undeclared_fields"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TRAINED))
def test_no_cross_join_no_python_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not re.search("CartesianProduct|NestedLoopJoin|Python|MapInPandas", plan)
    assert "SinglePartition" not in plan or name in ONE_ROW


def test_flagship_scans_once_and_joins_nothing(scanned):
    for frame in (features.user_features(scanned), temporal.behavior_profile(scanned)):
        plan = plan_of(frame)
        assert plan.count("FileScan") == 1
        assert "Join" not in plan
        assert plan.count("Exchange hashpartitioning") == 2


def test_hot_users_are_spread_before_they_are_merged(scanned):
    plan = plan_of(features.user_features(scanned))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert [len(k.split(", ")) for k in keys] == [1, 3]
    slots = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan_of(temporal.sessionize(scanned, 3600)))
    assert [len(k.split(", ")) for k in slots] == [1, 2]


def test_filters_and_columns_reach_the_scan(scanned):
    plan = plan_of(features.device_pivot(filter_range(scanned, "2024-01-10", "2024-01-10")))
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    assert "GreaterThanOrEqual(ts" in scan and "LessThan(ts" in scan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,user_id:bigint>" in scan


def test_a_day_of_landed_events_reads_its_folders_and_columns(spark, scanned, tmp_path):
    landed = f"{tmp_path}/landed"
    with_landing_columns(scanned.drop("event_id")).write.partitionBy("verdict", "event_date").parquet(landed)
    day = filter_range(read_landed(spark, landed), "2024-01-10", "2024-01-10")
    plan = plan_of(temporal.behavior_profile(day))
    scan = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scan) == 1 and "Join" not in plan
    folders = scan[0].split("PartitionFilters: [")[1].split("]")[0]
    assert "verdict" in folders and "event_date" in folders
    assert re.findall(r"event_date#\d+ [<>]= (\d{4}-\d\d-\d\d)", folders) == ["2024-01-10", "2024-01-10"]
    assert "GreaterThanOrEqual(timestamp" in scan[0] and "IsNotNull(user_id)" in scan[0]
    assert "user_agent" not in scan[0] and "location" not in scan[0]


def test_plain_features_need_one_shuffle(scanned):
    plan = plan_of(features.user_totals(scanned))
    assert plan.count("Exchange") == 1


def test_recommendations_rank_before_the_shuffle(spark, scanned):
    assigned = segments.segment_map(profile(spark, SF_DIR, CENTROID_COLUMNS))
    plan = plan_of(recommend.recommend(scanned, assigned))
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_recommendations_shuffle_no_users_by_segment(spark, scanned):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assigned = segments.segment_map(profile(spark, SF_DIR, CENTROID_COLUMNS))
        plan = plan_of(recommend.recommend(scanned, assigned))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # by segment alone: items per segment, after the rank filter; users meet their list by segment and salt
    by_segment = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(segment#\d+, \d+\)", line)]
    spread = re.findall(r"Exchange hashpartitioning\(segment#\d+, salt#\d+, \d+\)", plan)
    assert len(spread) == 2 and len(by_segment) <= 1


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    users = profile(spark, SF_DIR)
    save_bucketed(users.drop("segment"), "bucketed_features", f"{tmp_path}/features", 4)
    save_bucketed(users.select("user_id", "segment"), "bucketed_segments", f"{tmp_path}/segments", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = reports.profile_join(spark.table("bucketed_features"), spark.table("bucketed_segments"))
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 150
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE bucketed_features")
        spark.sql("DROP TABLE bucketed_segments")


def test_joined_features_share_their_partitioning(scanned):
    # both sides end hashed by user, so that the join adds no shuffle
    plan = plan_of(features.features_join(scanned))
    assert plan.count("Exchange hashpartitioning") == 3
    assert features.features_join(scanned).columns == ["user_id", *FEATURE_COLUMNS]

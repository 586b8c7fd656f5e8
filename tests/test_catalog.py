"""Registered tables prune by run, and plans follow their statistics."""

import uuid

import pytest
from pyspark.sql import functions as F

from footfall.operators import features
from footfall.sources import catalog, tables


@pytest.fixture
def named(spark):
    names = []

    def name(base):
        names.append(f"{base}_{uuid.uuid4().hex[:8]}")
        return names[-1]

    before = {key: spark.conf.get(key) for key in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled")}
    yield name
    for key, value in before.items():
        spark.conf.set(key, value)
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


@pytest.fixture(scope="module")
def folder(spark, events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    users = features.user_features(events).cache()
    for day in ("2025-04-01", "2025-04-02"):
        tables.write_features(users.withColumn("total_events", F.col("total_events") + F.lit(int(day[-1]))), f"{path}/features", day)
    segments = users.select("user_id", (F.hash("user_id") % 3).alias("segment"))
    segments.write.parquet(f"{path}/segments")
    return path


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan()


def physical(frame):
    return frame._jdf.queryExecution().sparkPlan().toString()


def test_runs_are_partitions_and_are_pruned(spark, folder, named):
    name = named("features")
    catalog.register_table(spark, name, f"{folder}/features")
    assert catalog.is_partitioned(spark, name)
    one = spark.sql(f"SELECT user_id, total_events FROM {name} WHERE run_date = DATE '2025-04-02'")
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in scan and "ReadSchema: struct<user_id:string,total_events:bigint>" in scan
    direct = tables.read_features(spark, f"{folder}/features", "2025-04-02")
    assert sorted(map(tuple, catalog.run_of(spark, name, "2025-04-02").select(direct.columns).collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


def test_new_runs_appear_and_removed_ones_go(spark, events, named, tmp_path):
    name, path = named("features"), str(tmp_path / "t")
    users = features.user_features(events).limit(5).cache()
    tables.write_features(users, path, "2025-04-01")
    catalog.register_table(spark, name, path)
    tables.write_features(users, path, "2025-04-02")
    catalog.refresh_table(spark, name)
    assert spark.table(name).count() == 10
    assert catalog.run_of(spark, name, "2025-04-02").count() == 5


def test_statistics_are_kept(spark, folder, named):
    name = named("segments")
    catalog.register_tables(spark, {name: f"{folder}/segments"})
    described = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {name} segment").collect()}
    assert int(described["distinct_count"]) >= 2 and described["num_nulls"] == "0"
    statistics = optimized(spark.table(name)).stats()
    assert statistics.rowCount().get() == spark.table(name).count()
    other = named("features")
    catalog.register_table(spark, other, f"{folder}/features")
    catalog.analyze_table(spark, other, [])
    catalog.analyze_table(spark, other, ["total_events", "user_id"])


def test_a_join_changes_with_statistics(spark, folder, named):
    """A filter leaves few users; only their statistics say so."""
    users, placed = named("features"), named("segments")
    for name, path in ((users, "features"), (placed, "segments")):
        catalog.register_table(spark, name, f"{folder}/{path}")
    text = f"""SELECT f.user_id, f.total_events, s.segment FROM {users} f JOIN {placed} s ON f.user_id = s.user_id
               WHERE f.total_events = 60"""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3000")
    try:
        before = spark.sql(text)
        assert "SortMergeJoin" in physical(before) or "ShuffledHashJoin" in physical(before)
        for name in (users, placed):
            catalog.analyze_table(spark, name)
        catalog.use_statistics(spark)
        after = spark.sql(text)
        assert "BroadcastHashJoin" in physical(after)
        assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_names_are_quoted():
    assert catalog.quoted("db.ta`ble") == "`db`.`ta``ble`"

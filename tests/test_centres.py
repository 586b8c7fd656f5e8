"""Segments that do not depend on the layout, are stored, and keep their ids."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.operators import centres, features, segments
from footfall.plans import cli, jobs
from footfall.schema import FEATURE_COLUMNS
from footfall.sources import tables

K = 4


@pytest.fixture(scope="module")
def table(spark, events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("features") / "table")
    tables.write_features(features.user_features(events), path)
    return tables.read_features(spark, path)


@pytest.fixture(scope="module")
def vectors(table):
    return segments.prepare_features(table)


@pytest.fixture(scope="module")
def fitted(vectors):
    return centres.fit(vectors, K, tol=0.0, max_iter=200)


def placed(vectors, by):
    return {r.user_id: r.segment for r in centres.assign(vectors, by).select("user_id", "segment").collect()}


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_layout_and_shuffle_do_not_matter(spark, vectors, fitted, parts):
    again = centres.fit(vectors.repartition(parts).sortWithinPartitions(F.rand()), K, tol=0.0, max_iter=200)
    assert again == fitted
    assert placed(vectors, again) == placed(vectors, fitted)


def test_settled_centres_are_means_and_users_nearest(vectors, fitted):
    rows = [list(map(float, r.features)) for r in vectors.collect()]
    x, c = np.array(rows), np.array(fitted.centres)
    at = ((x[:, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
    for i in range(K):
        assert np.allclose(x[at == i].mean(axis=0), c[i], rtol=1e-9)
    assert fitted.centres == sorted(fitted.centres) and fitted.ids == list(range(K))
    found = placed(vectors, fitted)
    assert [found[r.user_id] for r in vectors.collect()] == at.tolist()


def test_as_good_as_mllib(vectors, fitted):
    def cost(centres_):
        x = np.array([list(map(float, r.features)) for r in vectors.collect()])
        return ((x[:, None, :] - np.array(centres_)[None]) ** 2).sum(axis=2).min(axis=1).sum()

    model = segments.train_kmeans(vectors, K, partitions=4, tol=0.0, max_iter=200)
    assert cost(fitted.centres) < 1.25 * cost(model.clusterCenters())
    same = centres.of_model(model)
    by_model = {r.user_id: r.segment for r in segments.assign_segments(model, vectors).collect()}
    assert placed(vectors, same) == by_model


def test_few_and_equal_users(spark, table):
    one = segments.prepare_features(table.limit(1))
    copies = one.crossJoin(spark.range(30).withColumnRenamed("id", "n"))
    alone = centres.fit(copies, 5)
    assert len(alone.centres) == 1 and set(placed(copies, alone).values()) == {0}
    two = segments.prepare_features(table.orderBy("user_id").limit(2))
    assert len(centres.fit(two, 5).centres) == 2
    with pytest.raises(ValueError, match="no users"):
        centres.fit(segments.prepare_features(table.limit(0)), 3)
    with pytest.raises(ValueError, match="positive"):
        centres.fit(two, 0)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6])
def test_cheapest_pairs_against_all_orders(n):
    rng = np.random.default_rng(n)
    for kind in range(20):
        cost = rng.random((n, n)) if kind % 2 else rng.integers(0, 4, (n, n)).astype(float)
        best = min(sum(cost[i, p[i]] for i in range(n)) for p in itertools.permutations(range(n)))
        pairs = centres.cheapest_pairs(cost)
        assert sorted(pairs) == list(range(n))
        assert sum(cost[i, j] for i, j in enumerate(pairs)) == pytest.approx(best)


def segmentation(values, ids=None, deviations=None):
    rows = [[float(v)] + [0.0] * (len(FEATURE_COLUMNS) - 1) for v in values]
    return centres.Segmentation(rows, ids or list(range(len(rows))), deviations)


def test_ids_go_on():
    old = segmentation([10, 20, 30], [4, 0, 7])
    assert centres.with_ids_of(segmentation([11, 19, 33]), old).ids == [4, 0, 7]
    assert centres.with_ids_of(segmentation([31, 12, 18]), old).ids == [7, 4, 0]
    more = centres.with_ids_of(segmentation([9, 21, 29, 500]), old)
    assert more.ids == [4, 0, 7, 8]
    fewer = centres.with_ids_of(segmentation([19, 31]), old)
    assert fewer.ids == [0, 7]
    # ids that went are not given again
    assert centres.with_ids_of(segmentation([19, 31, 900]), centres.with_ids_of(segmentation([19, 31]), old)).ids == [0, 7, 8]
    # other units: the same users, scaled by other deviations
    scaled = [2.0] + [1.0] * (len(FEATURE_COLUMNS) - 1)
    assert centres.with_ids_of(segmentation([5.5, 9.5, 16.0], None, scaled), old).ids == [4, 0, 7]


def test_stored_fit_gives_the_same_segments(spark, table, tmp_path):
    deviations = segments.feature_deviations(table)
    vectors = segments.prepare_features(table, True, deviations)
    fitted = centres.fit(vectors, K, deviations=deviations)._replace(ids=[3, 9, 1, 0])
    centres.write_segmentation(spark, fitted, f"{tmp_path}/fit")
    back = centres.read_segmentation(spark, f"{tmp_path}/fit")
    assert dict(zip(back.ids, back.centres)) == dict(zip(fitted.ids, fitted.centres))
    assert back.deviations == deviations
    again = {r.user_id: r.segment for r in centres.assign_features(table, back).collect()}
    assert again == placed(vectors, fitted)
    plain = centres.fit(segments.prepare_features(table), K)
    centres.write_segmentation(spark, plain, f"{tmp_path}/fit")
    assert centres.read_segmentation(spark, f"{tmp_path}/fit") == plain


def test_jobs_fit_store_assign_and_refit(spark, table, tmp_path, monkeypatch, capsys):
    folder = str(tmp_path)
    tables.write_features(table, f"{folder}/f", "2025-04-01")
    tables.write_features(table.withColumn("total_events", -F.col("total_events")), f"{folder}/f", "2025-04-02")
    report = jobs.segment_users(
        spark, f"{folder}/f", f"{folder}/s", 3, run_date="2025-04-01", model_path=f"{folder}/fit"
    )
    first = {r.user_id: r.segment for r in tables.read_segments(spark, f"{folder}/s", "2025-04-01").collect()}
    assert [r.segment for r in report.sizes.collect()] == [0, 1, 2]
    monkeypatch.setattr(cli, "build_session", lambda app: spark)
    cli.main(["assign", "--features-path", f"{folder}/f", "--model-path", f"{folder}/fit", "--output-path",
              f"{folder}/again", "--run-date", "2025-04-01"])
    again = {r.user_id: r.segment for r in tables.read_segments(spark, f"{folder}/again", "2025-04-01").collect()}
    assert again == first
    assert "sizes" in capsys.readouterr().out
    cli.main(["segment", "--features-path", f"{folder}/f", "--output-path", f"{folder}/s", "--num-clusters", "3",
              "--run-date", "2025-04-01", "--model-path", f"{folder}/fit", "--keep-ids-of", f"{folder}/fit"])
    assert {r.user_id: r.segment for r in tables.read_segments(spark, f"{folder}/s", "2025-04-01").collect()} == first


def test_rows_stay_where_they_are(vectors):
    """Assigning and the steps of a fit move nothing but one row per task and centre."""
    by = segmentation([1, 2, 3])
    plan = centres.assign(vectors, by)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

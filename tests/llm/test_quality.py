"""The quality classifier: flattened trees, held-out accuracy, defined cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import quality
from tests.conftest import SF_DIR

DDL = "doc_id long, text string, score double, quality string"


def walk(model, row):
    total = model.base
    inner = model.feature.shape[1]
    for tree in range(len(model.feature)):
        node = 0
        while node < inner:
            right = row[model.feature[tree, node]] > model.threshold[tree, node]
            node = 2 * node + (2 if right else 1)
        total += model.value[tree, node - inner]
    return 1 / (1 + np.exp(-total))


def test_flat_trees_equal_a_walk_down_each_tree():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(600, 7)).round(1)
    label = ((rows[:, 0] > 0) ^ (rows[:, 3] > 0.4)).astype(float)
    model = quality.grow(rows, label, 25, 4, 32, 0.2, 1.0)
    scores = model.scores(rows)
    assert np.allclose(scores[:80], [walk(model, row) for row in rows[:80]])
    assert ((scores >= 0.5) == label).mean() > 0.98  # an exclusive or, no linear rule


def test_first_split_is_the_best_of_all_thresholds():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 9, (300, 3)).astype(float)
    label = (rows[:, 1] + rng.normal(size=300) > 4).astype(float)
    model = quality.grow(rows, label, 1, 1, 64, 1.0, 1.0)
    p = label.mean()
    gradient, hessian = p - label, np.full(300, p * (1 - p))

    def gain(right):
        return sum(gradient[s].sum() ** 2 / (hessian[s].sum() + 1) for s in (right, ~right))

    best = max(gain(rows[:, f] > t) for f in range(3) for t in range(9))
    f, t = model.feature[0, 0], model.threshold[0, 0]
    assert gain(rows[:, f] > t) == pytest.approx(best)


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels")]


def test_held_out_accuracy(tables):
    docs, labels = tables
    rows = quality.digest(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").collect()
    held_out = [r for r in rows if r.held_out]
    assert len(held_out) > 80
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == r.quality for r in held_out]) > 0.97


def test_held_out_labels_and_other_columns_change_nothing(tables):
    docs, labels = tables
    other = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    first = quality.digest(docs, labels).orderBy("doc_id").collect()
    assert first == quality.digest(changed, other).orderBy("doc_id").collect()


def test_defined_cases(spark, tables):
    rows = [(1, None, 0.5, "q"), (None, "", 0.5, "q"), (3, "word " * 60_000, None, None), (3, "word " * 60_000, None, None), (4, "\u00e9", 0.1, "x")]
    docs = spark.createDataFrame(rows, DDL)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.digest(docs, none).collect()} == {0.5}
    one_kind = spark.createDataFrame([(i, 1) for i in range(5)] + [(None, 0), (1, None)], "doc_id long, quality int")
    assert all(r.score > 0.99 for r in quality.digest(docs, one_kind).collect())
    model = quality.fit(*tables)
    scored = quality.with_score(docs, model, "_score")
    assert scored.columns == [*docs.columns, "_score"]
    found = scored.collect()
    assert len(found) == 5 and found[0]._score == found[1]._score
    kept = quality.accepted(docs, one_kind)
    assert kept.columns == docs.columns and kept.count() == 5
    empty = spark.createDataFrame([], DDL)
    assert quality.digest(empty, none).count() == 0


def test_statistics_read_whole_texts():
    text = "plain words here. " * 3000
    assert not np.allclose(quality.statistics(text), quality.statistics(text + "|%$ " * 500))
    assert len(quality.statistics("x")) == len(quality.statistics("")) == quality.N_STATISTICS

"""Segments whose centres are drawn the same way on any cluster, stored, and keep their ids.

K-Means starts from users that a hash chooses, and its steps are aggregates of one row per centre.
So no row moves, all cores of a cluster take part, and the segments do not depend on how the rows
are laid out, which a sample per partition does. What is stored of a fit assigns any later features
without another fit, and a refit takes over the ids of the segments it finds again.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.segments import SEED, prepare_features
from footfall.schema import FEATURE_COLUMNS

#: Users of whom the first centres are chosen; a bound of the driver's work, not of the fit.
SAMPLE = 10_000
#: Digits of a centre; sums in another order differ only beyond them.
DIGITS = 12


class Segmentation(NamedTuple):
    """Centres of the vectors, the segment id of each, and what the features were divided by."""

    centres: list[list[float]]
    ids: list[int]
    deviations: list[float] | None = None


def starting_centres(vectors: DataFrame, k: int, seed: int = SEED, sample: int = SAMPLE) -> np.ndarray:
    """k of the ``sample`` users with the smallest hashes, far from each other (k-means++).

    Fewer if there are fewer different vectors.
    """
    if k < 1:
        raise ValueError("k must be positive")
    drawn = F.xxhash64(F.lit(seed), "user_id")
    rows = vectors.select(vector_to_array("features").alias("x"), drawn.alias("drawn"), "user_id")
    chosen = rows.orderBy("drawn", "user_id").limit(sample).select("x").collect()
    if not chosen:
        raise ValueError("no users to fit")
    points = np.unique(np.array([row.x for row in chosen], np.float64), axis=0)
    rng = np.random.default_rng(seed)
    rng.shuffle(points)
    centres = points[:1]
    while len(centres) < min(k, len(points)):
        gaps = ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).min(axis=1)
        nearer = np.searchsorted(np.cumsum(gaps), rng.random() * gaps.sum(), side="right")
        centres = np.concatenate([centres, points[[min(nearer, len(points) - 1)]]])
    return centres


def nearest(x, centres: Sequence[Sequence[float]]):
    """The number of the nearest centre to an array column; the lowest wins a tie."""

    def distance(centre):
        return sum((x[i] - F.lit(float(c))) ** 2 for i, c in enumerate(centre))

    ranked = [F.struct(distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]
    return F.array_min(F.array(*ranked))["i"]


def settled_centres(
    vectors: DataFrame, centres: np.ndarray, tol: float = 1e-4, max_iter: int = 20
) -> np.ndarray:
    """Move every centre to the mean of the vectors nearest to it, until none moves further than ``tol``.

    A centre without vectors stays where it is. Hold ``vectors`` in storage.
    """
    dims = centres.shape[1]
    x = F.col("x")
    for _ in range(max_iter):
        placed = vectors.select(vector_to_array("features").alias("x")).select("x", nearest(x, centres).alias("at"))
        means = placed.groupBy("at").agg(*[F.avg(x[i]).alias(f"m{i}") for i in range(dims)])
        moved = centres.copy()
        for row in means.collect():  # one row per centre
            moved[row["at"]] = [float(f"{value:.{DIGITS}g}") for value in row[1:]]
        settled = ((moved - centres) ** 2).sum(axis=1).max() <= tol * tol
        centres = moved
        if settled:
            break
    return centres


def in_order(centres: np.ndarray, deviations: Sequence[float] | None = None) -> Segmentation:
    """Ids follow the order of the centres: total events first, then the other slots."""
    ordered = sorted([float(value) for value in centre] for centre in centres)
    return Segmentation(ordered, list(range(len(ordered))), list(deviations) if deviations else None)


def fit(
    vectors: DataFrame,
    k: int = 5,
    seed: int = SEED,
    tol: float = 1e-4,
    max_iter: int = 20,
    deviations: Sequence[float] | None = None,
    sample: int = SAMPLE,
) -> Segmentation:
    """K-Means over ``user_id`` and ``features``; hold them in storage."""
    centres = starting_centres(vectors, k, seed, sample)
    return in_order(settled_centres(vectors, centres, tol, max_iter), deviations)


def of_model(model: KMeansModel, deviations: Sequence[float] | None = None) -> Segmentation:
    """What MLlib has fitted, in the order of its centres."""
    return in_order(np.array(model.clusterCenters()), deviations)


def assign(vectors: DataFrame, by: Segmentation) -> DataFrame:
    """Add ``segment``, the id of the nearest centre, to rows with ``features``."""
    at = nearest(F.col("x"), by.centres)
    ids = F.array(*map(F.lit, by.ids))
    placed = vectors.withColumn("x", vector_to_array("features"))
    return placed.withColumn("segment", F.element_at(ids, at + 1)).drop("x")


def assign_features(features: DataFrame, by: Segmentation) -> DataFrame:
    """Add ``segment`` to a feature table, scaled as the fit was."""
    vectors = prepare_features(features, scale=by.deviations is not None, deviations=by.deviations)
    return assign(vectors, by).drop("features")


def cheapest_pairs(cost: np.ndarray) -> list[int]:
    """For each row of a square matrix its column, all different, with the least sum of costs."""
    n = len(cost)
    row_price, column_price = np.zeros(n + 1), np.zeros(n + 1)
    row_of = np.full(n + 1, n)  # of each column; the last column is a start
    for row in range(n):
        row_of[n], at = row, n
        slack, came = np.full(n, np.inf), np.full(n, n)
        seen = np.zeros(n + 1, bool)
        while row_of[at] != n:
            seen[at] = True
            left = cost[row_of[at]] - row_price[row_of[at]] - column_price[:n]
            better = ~seen[:n] & (left < slack)
            slack[better], came[better] = left[better], at
            step = np.where(seen[:n], np.inf, slack)
            following = int(step.argmin())
            for column in np.flatnonzero(seen):
                row_price[row_of[column]] += step[following]
                column_price[column] -= step[following]
            slack[~seen[:n]] -= step[following]
            at = following
        while at != n:
            row_of[at], at = row_of[came[at]], came[at]
    columns = [0] * n
    for column in range(n):
        columns[row_of[column]] = column
    return columns


def with_ids_of(new: Segmentation, old: Segmentation) -> Segmentation:
    """The new centres with the old ids, so that the sum of squared ways from old to new is least.

    Distances are in the features' units, divided by the old deviations if there are any. Centres
    beyond the old ones get ids that were not used before; ids of segments that went are left out.
    """
    units = np.array(new.deviations or [1.0] * len(new.centres[0]))
    scale = np.array([d or 1.0 for d in old.deviations or [1.0] * len(units)])
    here = np.array(new.centres) * units / scale
    there = np.array(old.centres) * np.array(old.deviations or [1.0] * len(units)) / scale
    size = max(len(here), len(there))
    cost = np.zeros((size, size))  # nothing for a centre without a counterpart
    cost[: len(here), : len(there)] = ((here[:, None, :] - there[None, :, :]) ** 2).sum(axis=2)
    unused = iter(range(max(old.ids, default=-1) + 1, max(old.ids, default=-1) + 1 + size))
    pairs = cheapest_pairs(cost)[: len(here)]
    ids = [old.ids[column] if column < len(there) else next(unused) for column in pairs]
    return new._replace(ids=ids)


def write_segmentation(spark: SparkSession, by: Segmentation, path: str) -> None:
    """Replace the stored segmentation: a row per segment and feature."""
    deviations = by.deviations or [None] * len(by.centres[0])
    rows = [
        (segment, slot, feature, float(centre[slot]), None if deviations[slot] is None else float(deviations[slot]))
        for segment, centre in zip(by.ids, by.centres)
        for slot, feature in enumerate(FEATURE_COLUMNS)
    ]
    schema = "segment int, slot int, feature string, centre double, deviation double"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def read_segmentation(spark: SparkSession, path: str) -> Segmentation:
    rows = spark.read.parquet(path).orderBy("segment", "slot").collect()  # segments times features
    by_segment: dict[int, list] = {}
    for row in rows:
        by_segment.setdefault(row.segment, []).append(row)
    deviations = [row.deviation for row in next(iter(by_segment.values()))]
    return Segmentation(
        [[row.centre for row in slots] for slots in by_segment.values()],
        list(by_segment),
        None if None in deviations else deviations,
    )


def centre_table(spark: SparkSession, by: Segmentation) -> DataFrame:
    """One row per (segment, feature) with the centre's coordinate, in the feature's own unit."""
    units = by.deviations or [1.0] * len(FEATURE_COLUMNS)
    rows = [
        (segment, feature, float(value) * unit)
        for segment, centre in sorted(zip(by.ids, by.centres))
        for feature, value, unit in zip(FEATURE_COLUMNS, centre, units)
    ]
    return spark.createDataFrame(rows, "segment int, feature string, value double")
